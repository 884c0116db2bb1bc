"""Secret scans: fixed patterns plus character Markov models.

Two bigram models are trained on labelled samples: random strings (secrets
that the fixed patterns find, and hashes of ids written in hex and base64)
and ordinary identifiers (the words of the texts, alone and joined as code
joins them).  A long token is a secret when its mean log-likelihood ratio per
character pair is ``LEAST_RATIO`` or more.  Training counts pairs with joins and groupings and returns at most
one row per pair of alphabet characters; scoring is a column expression over
a constant table.  No Python runs on the executors.

Training uses the documents that a hash picks, ``SAMPLE_DOCS`` of them on
average (all when there are fewer); scanning covers every text.

Defined results: null text counts as empty and has no spans; an empty table
trains on nothing and returns no rows, a table that has rows but trains on
nothing is an error; spans of one start are ordered as the
kinds are listed; repeated rows are scanned alike; further columns stay in
``row``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.llm import spans as S
from vidpulse.llm.common import let

SAMPLE_DOCS, LEAST_RATIO = 2000, 1.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: What the models score.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: kind, pattern, group that must pass, least length of it.
BASE = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}+", 0, 16),
    ("hex", r"[0-9a-f]{32,}+", 0, 32),
]


def base_spans(text: Column) -> Column:
    return F.concat(*[
        S.found(text, pattern, kind, k, lambda v, n=least: F.length(v) >= n, group)
        for k, (kind, pattern, group, least) in enumerate(BASE)])


def labelled_samples(docs: DataFrame, id_col: str, text: str, most: int = SAMPLE_DOCS) -> DataFrame:
    """(label, token): 'random' and 'ordinary' strings, each once."""
    count = docs.count()
    draw = F.xxhash64(F.lit("markov"), F.col(id_col), F.octet_length(text))
    picked = docs if count <= most else docs.where(draw < most * 2**64 // count - 2**63)  # a share of all 64-bit hashes
    some = picked.select(F.coalesce(F.col(text), F.lit("")).alias("t"), F.sha2(F.concat_ws(":", F.lit("id"), F.col(id_col).cast("string")), 256).alias("hash"))
    plain = F.regexp_extract_all("t", F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z_]{3,}+(?![A-Za-z0-9+/_=-])"), F.lit(0))
    # identifiers as code writes them: words alone, in snake, kebab and camel case, and constants
    def joined(words: Column) -> Column:
        pairs = F.zip_with(F.slice(words, 1, F.size(words)), F.slice(words, 2, F.size(words)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        forms = F.transform(F.filter(pairs, lambda p: p["b"].isNotNull()), lambda p: F.array(
            F.concat(p["a"], F.lit("_"), p["b"]), F.concat(p["a"], F.lit("-"), p["b"]), F.concat(F.lower(p["a"]), F.initcap(p["b"])),
            F.upper(F.concat(p["a"], F.lit("_"), p["b"]))))
        return F.concat(words, F.flatten(forms))

    ordinary = some.select(F.lit("ordinary").alias("label"), F.explode(let(plain, joined)).alias("token"))
    seen = some.select(F.explode(F.transform(base_spans(F.col("t")), lambda s: s["value"])).alias("token"))
    made = some.select(F.explode(F.array("hash", F.base64(F.unhex("hash")), F.upper(F.conv(F.substring("hash", 1, 15), 16, 36)))).alias("token"))
    return ordinary.union(seen.union(made).select(F.lit("random").alias("label"), "token")).distinct()


def _places(token: Column) -> Column:
    """Place of each character in the alphabet, 0 for any other."""
    return F.transform(F.split(token, ""), lambda c: F.position(c, F.lit(ALPHABET)))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio (random to ordinary) of the second character given
    the first, for each pair; place 0 stands for any other character."""
    size = len(ALPHABET) + 1
    token = F.col("token")
    places = samples.where(F.length(token) > 1).select("label", _places(token).alias("p"))
    pairs = places.select("label", F.explode(F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"), F.slice("p", 2, F.size("p")).alias("b"))).alias("pair"))
    counts = pairs.groupBy("label", "pair.a", "pair.b").count()
    table = {label: [1.0] * (size * size) for label in ("random", "ordinary")}
    for label, a, b, n in counts.collect():  # at most two rows per pair of characters
        table[label][a * size + b] += n
    ratio = []
    for a in range(size):
        row = slice(a * size, (a + 1) * size)
        random, ordinary = table["random"][row], table["ordinary"][row]
        ratio += [math.log(r / sum(random)) - math.log(o / sum(ordinary)) for r, o in zip(random, ordinary)]
    return ratio


def mean_ratio(token: Column, ratio: list[float]) -> Column:
    """Mean log-likelihood ratio per character pair."""
    size = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")

    def step(acc: Column, b: Column) -> Column:
        more = F.when(acc["a"] < 0, 0.0).otherwise(F.element_at(table, acc["a"] * size + b + 1))
        return F.struct(b.alias("a"), (acc["sum"] + more).alias("sum"))

    start = F.struct(F.lit(-1).alias("a"), F.lit(0.0).alias("sum"))  # no character before the first
    return F.aggregate(_places(token), start, step, lambda acc: acc["sum"]) / (F.length(token) - 1)


def scan(docs: DataFrame, ratio: list[float], text: str = "text") -> DataFrame:
    """``row`` (the input), ``base`` spans and ``all`` spans."""
    t = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    tokens = S.found(F.col("t"), TOKEN, "markov", len(BASE))
    t = t.select("row", base_spans(F.col("t")).alias("base"), tokens.alias("tokens"))
    scored = F.transform(S.apart(F.col("tokens"), F.col("base")), lambda s: s.withField("score", mean_ratio(s["value"], ratio)))
    return t.select("row", "base", F.array_sort(F.concat("base", F.filter(scored, lambda s: s["score"] >= LEAST_RATIO))).alias("all"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Train on ``docs`` and scan them."""
    ratio = train(labelled_samples(docs, id_col, text, sample_docs))
    if not any(ratio) and not docs.isEmpty():
        raise ValueError(f"no document of a table that has some was drawn for training (sample_docs={sample_docs})")
    return scan(docs, ratio, text)
