"""Stored comment index: positional postings in blocks, kept in levels.

A row of the index is one word in one block of ``BLOCK`` document numbers: the
documents of the block that have the word, each with the places of the word.
A common word is thus many rows, of bounded size, and the blocks of different
words line up: words can only stand together in a block that all of them have.
Rows are sorted by (word, block), so a look-up skips files and row groups.

The index grows by batches and merges them like any levelled table (a block's
lists of several batches become one).  A document number belongs to one batch;
delivering a batch again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.functions.text import word_array
from vidpulse.streaming.levels import LevelledTable
from vidpulse.streaming.sinks import BATCH_COL

#: Document numbers that one block spans.
BLOCK = 4096

_POSTINGS = "array<struct<doc:long,places:array<int>>>"


def postings(texts: DataFrame, doc: str = "doc", text: str = "comment") -> DataFrame:
    """(word, block, postings) of a batch: words are lower-case letter runs,
    places count from 0; documents without words leave no row."""
    words = texts.select(F.col(doc).cast("bigint").alias("doc"), F.posexplode(word_array(F.col(text))).alias("place", "word"))
    per_doc = words.groupBy("word", "doc").agg(F.sort_array(F.collect_list("place")).alias("places"))  # within one text
    blocks = per_doc.groupBy("word", F.floor(F.col("doc") / BLOCK).alias("block"))
    return blocks.agg(F.sort_array(F.collect_list(F.struct("doc", "places"))).cast(_POSTINGS).alias("postings"))


class PostingsTable(LevelledTable):
    """Index over all batches so far."""

    def __init__(self, path: str, merge_every: int | None = 8, level_rows: int = 1_000_000, fanout: int = 8, file_rows: int = 500_000):
        super().__init__(path, ["word", "block"], merge_every=merge_every, level_rows=level_rows, fanout=fanout, file_rows=file_rows)

    def add(self, texts: DataFrame, batch_id: int, doc: str = "doc", text: str = "comment") -> None:
        """Index a batch of texts."""
        self(postings(texts, doc, text), batch_id)

    def _folded(self, raw: DataFrame) -> DataFrame:
        lists = F.sort_array(F.flatten(F.collect_list("postings")))
        return raw.groupBy(*self.keys).agg(lists.alias("postings"), F.max(BATCH_COL).alias(BATCH_COL))


def _wanted(words: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(w.lower() for w in words))


def common_blocks(index: DataFrame, words: Sequence[str]) -> DataFrame:
    """(block, lists): the blocks that all of ``words`` have, with the list of
    each word.  Blocks that lack a word go before any list is opened."""
    wanted = _wanted(words)
    lists = index.where(F.col("word").isin(wanted)).groupBy("block").agg(F.collect_list(F.struct("word", "postings")).alias("lists"))
    return lists.where(F.size("lists") == len(wanted))


def _places(index: DataFrame, words: Sequence[str]) -> DataFrame:
    """(doc, places: map word -> places) of the documents with all words."""
    per_word = common_blocks(index, words).select("block", F.explode("lists").alias("l"))
    per_doc = per_word.select("block", "l.word", F.explode("l.postings").alias("p"))
    docs = per_doc.groupBy("block", "p.doc").agg(F.map_from_entries(F.collect_list(F.struct("word", "p.places"))).alias("places"))
    return docs.where(F.size("places") == len(_wanted(words)))


def search_all(index: DataFrame, words: Sequence[str]) -> DataFrame:
    """Documents that have every word: (doc, n), n: how often they stand there."""
    found = _places(index, words)
    n = F.aggregate(F.map_values("places"), F.lit(0).cast("bigint"), lambda acc, x: acc + F.size(x))
    return found.select("doc", n.alias("n"))


def search_phrase(index: DataFrame, phrase: Sequence[str]) -> DataFrame:
    """Documents in which the words stand one after the other: (doc, n), n:
    places where the phrase starts (overlapping ones count each)."""
    words = [w.lower() for w in phrase]
    found = _places(index, words)

    def from_first(k: int) -> Column:  # places of the k-th word, moved to where the phrase would start
        return F.transform(F.col("places")[words[k]], lambda p: p - k)

    starts = from_first(0)
    for k in range(1, len(words)):
        starts = F.array_intersect(starts, from_first(k))
    return found.select("doc", F.size(starts).cast("bigint").alias("n")).where(F.col("n") > 0)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index at ``path`` as of now."""
    return PostingsTable(path).read(spark)
