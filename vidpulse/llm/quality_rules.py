"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` names a statistic and the range it must lie in.  Statistics are
Spark expressions over the whole text (split, higher-order functions, hash);
no user function, no shuffle.  Repeated 8-word windows are found by hashing
words and doubling (1, 2, 4, 8 words), so a long text costs linear work.

Defined results: null or blank text has zero words and fails the base rule;
ratios over nothing are 0; ties do not arise; no rows give no rows; further
columns are passed through by ``passing`` and ignored by ``assess``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.llm.common import SPACE, let, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the corpus languages (fixed values).
STOP_WORDS = (
    "the of and to in is that it was for on are as with be at by this from or an "
    "der die das und ist nicht ein eine zu den von mit sich des auf für im dem es "
    "le la les de et un une est que des en du qui dans pour par sur au "
    "el los que y en un una es se del las por con para su al lo como"
).split()

#: (statistic, least, most); None leaves a side open.  shout: words ending in
#: two exclamation marks; echo: words equal to the word before them.
RULES = [
    ("mean_word_chars", 2.0, 12.0),
    ("symbol_ratio", None, 0.05),
    ("shout_ratio", None, 0.25),
    ("stop_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.60),
    ("echo_ratio", None, 0.30),
]


def _shifted_pairs(h: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on."""
    later = F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0)))
    return F.zip_with(h, later, lambda a, b: F.xxhash64(a, b))


def _covered(windows: Column) -> Column:
    """Words inside windows whose value occurs at least twice."""
    def spans(s: Column) -> Column:
        value = lambda k: F.get(s, k)["h"]
        twice = F.transform(s, lambda e, k: F.when((value(k - 1) == e["h"]) | (value(k + 1) == e["h"]), e["i"]))
        return F.aggregate(
            F.array_sort(F.filter(twice, lambda i: i.isNotNull())),
            F.struct(F.lit(0).cast("long").alias("total"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct((acc["total"] + F.least(i - acc["last"], F.lit(WINDOW))).cast("long").alias("total"), i.alias("last")),
            lambda acc: acc["total"])

    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(windows) > F.size(F.array_distinct(windows)), let(F.array_sort(placed), spans)).otherwise(F.lit(0).cast("long"))


def _repeat_words(w: Column) -> Column:
    h1 = F.transform(w, lambda x: F.xxhash64(x))
    h8 = let(h1, lambda a: let(_shifted_pairs(a, 1), lambda b: let(_shifted_pairs(b, 2), lambda c: _shifted_pairs(c, 4))))
    return let(F.slice(h8, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))), _covered)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    return let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def statistics(text: Column) -> Column:
    """Struct of counts and ratios for one text."""
    text = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop"),
            F.size(F.filter(w, lambda x: x.endswith("!!"))).cast("long").alias("n_shout"),
            F.size(F.filter(F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: a.eqNullSafe(b)), lambda x: x)).cast("long").alias("n_echo"))

    return F.struct(
        let(words(text), of_words).alias("w"), _dup_lines(text).alias("lines"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))


def verdict(s: Column) -> Column:
    """Struct of ``base_failed`` and ``kept`` for one struct of ``statistics``:
    kept if the base rules passed and every rule of ``RULES`` holds."""
    n, chars = s["w"]["n_words"], s["word_chars"]
    ratios = {
        "mean_word_chars": _ratio(chars, n),
        "symbol_ratio": _ratio(s["n_symbols"], chars),
        "shout_ratio": _ratio(s["w"]["n_shout"], n),
        "stop_ratio": _ratio(s["w"]["n_stop"], n),
        "dup_line_ratio": _ratio(s["lines"]["dup"], s["lines"]["n"]),
        "echo_ratio": _ratio(s["w"]["n_echo"], n),
    }
    failed = (n < 20) | (100 * s["w"]["n_repeat_words"] > 30 * n)
    good = ~failed
    for name, least, most in RULES:
        if least is not None:
            good = good & (ratios[name] >= least)
        if most is not None:
            good = good & (ratios[name] <= most)
    return F.struct(failed.alias("base_failed"), good.alias("kept"))


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` columns packed as ``row``, the statistics and the verdict."""
    s = docs.select(F.struct("*").alias("row"), statistics(F.col(text)).alias("s"))
    return s.select(
        "row", "s.w.*", "s.word_chars", "s.n_symbols", F.col("s.lines.n").alias("n_lines"), F.col("s.lines.dup").alias("n_dup_lines"),
        verdict(F.col("s")).alias("v")).select("*", "v.*").drop("v")


def passing(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that every rule accepts, columns unchanged.

    A plain filter would be pushed below the projection with the statistics
    written out for every use; filtering a one-element array evaluates them
    once per row, and no filter is pushed through the generator.
    """
    accepted = F.filter(F.array(statistics(F.col(text))), lambda s: verdict(s)["kept"])
    return docs.select(F.struct("*").alias("row"), F.explode(accepted).alias("s")).select("row.*")
