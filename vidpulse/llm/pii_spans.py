"""Personal data: patterns propose, checksums confirm, context adjusts.

A kind has a pattern, an optional validator (Luhn for cards, mod-97 for
IBANs, ranges and digit counts), a prior score and context words that raise
the score when they stand near.  The base kinds always stay; a further kind
stays from ``KEEP`` on, and without a checksum only where no base span stands:
an IBAN stays beside a card number that its digits happen to be.  Everything is a
column expression: no Python runs on the executors.

Defined results: null text counts as empty and has no spans; spans of one
start are ordered as the kinds are listed; repeated rows are scanned alike;
no rows give no rows; further columns stay in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.llm import spans as S
from vidpulse.llm.common import let

KEEP, REACH, RAISE = 0.5, 40, 0.4


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Luhn checksum over the digits of ``value``."""
    def sum_of(digits: Column) -> Column:
        def add(acc: Column, d: Column) -> Column:
            twice = d["n"] * (1 + d["i"] % 2)
            return acc + twice - F.when(twice > 9, 9).otherwise(0)

        numbered = F.transform(digits, lambda c, i: F.struct(c.cast("int").alias("n"), i.alias("i")))
        return F.aggregate(numbered, F.lit(0), add)

    return sum_of(F.split(F.reverse(_digits(value)), "")) % 10 == 0


def mod97(value: Column) -> Column:
    """IBAN check: first four characters moved to the end, letters as 10 to 35, remainder 1."""
    def check(v: Column) -> Column:
        chars = F.split(F.concat(F.substr(v, F.lit(5)), F.substr(v, F.lit(1), F.lit(4))), "")
        return F.aggregate(chars, F.lit(0), lambda acc, c: F.when(
            c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)) == 1

    return let(F.regexp_replace(value, " ", ""), check)


def _count_between(least: int, most: int):
    return lambda v: F.length(_digits(v)).between(least, most)


def _octets(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: p.try_cast("double") <= 255)


#: IBAN characters by country (ISO 13616 registry).
IBAN_CHARS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
#: Group 1 is the longest candidate; only its first four characters are consumed, so a candidate may start inside another.
IBAN = r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])))[A-Z]{2}[0-9]{2}"


def iban_of(value: Column) -> Column:
    """The part of a candidate that passes mod-97, null if none does: a word
    after an IBAN in groups of four may look like one more group.  The length
    of the country goes first, then the whole; a country that is not listed
    offers every part from four groups on, the longest first."""
    lengths = F.create_map(*[F.lit(x) for country, n in IBAN_CHARS.items() for x in (country, n + (n - 1) // 4)])
    listed, whole = F.try_element_at(lengths, F.substr(value, F.lit(1), F.lit(2))), F.length(value)
    sizes = F.when(listed.isNotNull(), F.array(listed, whole)).otherwise(F.concat(F.array(whole), F.array(*map(F.lit, range(39, 18, -5)))))
    aligned = F.filter(sizes, lambda n: (n <= whole) & F.substr(value, n + 1, F.lit(1)).isin("", " "))
    return F.get(F.filter(F.transform(aligned, lambda n: F.substr(value, F.lit(1), n)), mod97), F.lit(0))


def _ibans(spans: Column) -> Column:
    """Candidates cut to the part that passes; those without one go."""
    cut = F.transform(spans, lambda s: s.withField("value", iban_of(s["value"])))
    cut = F.transform(cut, lambda s: s.withField("end", s["start"] + F.length(s["value"])))
    return F.filter(cut, lambda s: s["value"].isNotNull())


#: Further kinds that a checksum confirms.
CONFIRMED = ["iban"]
#: kind, pattern, must contain, validator, prior score, context words.
BASE = [
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", None, 0.9, ["mail", "email", "contact"]),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", _octets, 0.6, ["ip", "address", "host", "server"]),
    ("card", r"[0-9](?:[\x20-]?+[0-9]){11,}+", None, lambda v: _count_between(12, 19)(v) & luhn(v), 0.8, ["card", "visa", "credit", "payment"]),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", _count_between(9, 15), 0.7, ["phone", "tel", "call", "mobile"]),
]
FURTHER = [
    ("iban", IBAN, None, None, 0.8, ["iban", "account", "konto", "bank"]),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", None, 0.2, ["ssn", "social security"]),
    ("local_phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])", None, None, 0.2, ["phone", "tel", "call", "mobile"]),
]


def _raised(text: Column, parts: Column, spans: Column, context: list[str]) -> Column:
    """Scores raised where a context word stands near."""
    return F.transform(spans, lambda s: s.withField(
        "score", F.least(F.lit(1.0), s["score"] + F.when(S.near(text, parts, s, context, REACH), RAISE).otherwise(0.0))))


def _spans(text: Column, parts: Column, kinds: list, rank: int) -> Column:
    out = []
    for k, (kind, pattern, part, valid, prior, context) in enumerate(kinds):
        spans = _ibans(S.found(text, pattern, kind, rank + k, group=1, score=prior)) if pattern == IBAN else S.found(text, pattern, kind, rank + k, valid, score=prior)
        if part:
            spans = F.when(F.contains(text, F.lit(part)), spans).otherwise(F.array().cast(S.SPAN))
        out.append(_raised(text, parts, spans, context))
    return F.concat(*out)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input), ``base`` and ``all`` spans with scores."""
    t = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = t.withColumn("parts", S.parts_of(F.col("t")))
    t = t.select("row", *[_spans(F.col("t"), F.col("parts"), kinds, rank).alias(name) for name, kinds, rank in (("base", BASE, 0), ("more", FURTHER, len(BASE)))])
    more = F.filter(F.col("more"), lambda s: s["score"] >= KEEP)
    confirmed = F.filter(more, lambda s: s["kind"].isin(CONFIRMED))
    others = S.apart(F.filter(more, lambda s: ~s["kind"].isin(CONFIRMED)), F.col("base"))
    return t.select("row", "base", F.array_sort(F.concat("base", confirmed, others)).alias("all"))
