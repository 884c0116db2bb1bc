"""Positions of regular-expression matches, with DataFrame functions only.

Spark returns matched strings but not where they stand.  ``split`` on the
same pattern gives the gaps between the matches, so start and end follow by
running sums of lengths, in code points.  The work grows with the text and
its matches, not with their square.  Patterns are written for one linear pass:
possessive repeats and look-behinds that change no match.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vidpulse.llm.common import let

#: start, place of the kind in its list, end, kind; sorts as the contracts ask.
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>"


#: Values that one fold carries; longer lists go block by block.
BLOCK = 256
#: Code points of the parts that a long text is cut into once.
PART, LONG = 4096, 16_384


def running(values: Column, combine: Callable[[Column, Column], Column], start: int = 0) -> Column:
    """Running sums (or maxima, ...) of an array of int.  A fold copies what it
    has gathered at every step, so it goes over blocks and then over the
    blocks' last values."""
    empty = F.array().cast("array<int>")

    def fold(part: Column) -> Column:
        step = lambda acc, v: F.struct(combine(acc["at"], v).alias("at"), F.concat(acc["upto"], F.array(combine(acc["at"], v))).alias("upto"))
        return F.aggregate(part, F.struct(F.lit(start).alias("at"), empty.alias("upto")), step)

    def by_blocks(own: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(own), F.lit(BLOCK)), lambda at: fold(F.slice(own, at, F.lit(BLOCK))))
        return let(blocks, lambda b: let(fold(F.transform(b, lambda x: x["at"]))["upto"], lambda before: F.flatten(F.transform(
            b, lambda x, i: F.when(i == 0, x["upto"]).otherwise(F.transform(x["upto"], lambda v: combine(F.get(before, i - 1), v)))))))

    return let(values, lambda own: F.when(F.size(own) <= BLOCK, fold(own)["upto"]).otherwise(by_blocks(own)))


def found(text: Column, pattern: str, kind: str, rank: int, keep: Callable[[Column], Column] | None = None,
          group: int = 0, score: float = 1.0) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` passes
    ``keep``.  ``value`` is that group's text."""
    matches = lambda k: F.regexp_extract_all(text, F.lit(pattern), F.lit(k))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pairs = F.zip_with(gaps, matches(0), lambda g, m: F.struct(g.alias("gap"), F.length(m).alias("size"), m.alias("value")))
    pairs = F.filter(pairs, lambda p: p["value"].isNotNull())  # one more gap than matches
    if group:
        pairs = F.zip_with(pairs, matches(group), lambda p, v: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), v.alias("value")))
    spans = let(pairs, lambda own: F.zip_with(own, running(F.transform(own, lambda p: p["gap"] + p["size"]), lambda x, y: x + y), lambda p, end: F.struct(
        (end - p["size"]).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
        p["value"].alias("value"), F.lit(score).alias("score")))).cast(SPAN)
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s["value"]))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def apart(spans: Column, others: Column) -> Column:
    """``spans`` that overlap none of ``others``, by start: both lists are
    merged, and a span is compared with how far the others reach that start
    no later, and with the next one that starts after it."""
    far = 2**31 - 1

    def clear(both: Column) -> Column:
        reach = running(F.transform(both, lambda x: F.when(x["own"] == 0, x["span"]["end"]).otherwise(0)), lambda x, y: F.greatest(x, y))
        ahead = running(F.transform(F.reverse(both), lambda x: F.when(x["own"] == 0, x["start"]).otherwise(far)), lambda x, y: F.least(x, y), far)
        rows = F.arrays_zip(both.alias("x"), reach.alias("reach"), F.reverse(ahead).alias("ahead"))
        kept = F.filter(rows, lambda r: (r["x"]["own"] == 1) & (r["reach"] <= r["x"]["start"]) & (r["ahead"] >= r["x"]["span"]["end"]))
        return F.transform(kept, lambda r: r["x"]["span"])

    tagged = lambda some, own: F.transform(some, lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s.alias("span")))
    both = F.sort_array(F.concat(tagged(others, 0), tagged(spans, 1)))
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(let(both, clear))


def parts_of(text: Column) -> Column:
    """A long text in parts of ``PART`` code points, null for others."""
    return F.when(F.length(text) > LONG, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)))


def piece(text: Column, parts: Column, first: Column, size: Column) -> Column:
    """``size`` code points from ``first`` (0 is the first): of a long text
    from its ``parts``, as finding a place in a text takes time in its length."""
    one = F.floor(first / PART).cast("int")
    many = F.floor((first + size) / PART).cast("int") - one + 1
    return F.when(parts.isNull(), F.substr(text, first + 1, size)).otherwise(
        F.substr(F.array_join(F.slice(parts, one + 1, many), ""), first - one * PART + 1, size))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def near(text: Column, parts: Column, span: Column, words: Sequence[str], reach: int) -> Column:
    """Whether one of ``words`` stands within ``reach`` characters of the span."""
    first = F.greatest(span["start"] - reach, F.lit(0))
    around = piece(text, parts, first, span["end"] + reach - first)
    return F.lower(around).rlike(r"(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])")
