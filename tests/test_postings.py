"""Stored postings: batches, merges, AND and phrase queries, blocks opened."""

import random
import re

from pyspark.sql import functions as F

from vidpulse.streaming import postings as P
from vidpulse.streaming.postings import PostingsTable, search_all, search_phrase

WORDS = ["the", "of", "a", "Live", "video", "stream", "it's"]


def _texts(n, seed=1):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(12))) + rng.choice(["", ".", "!?"])) for k in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "  ... "), (n + 3, "of " * 3000), (5 * P.BLOCK + 7, "the video OF the Stream"), (-3, "the of"), (10**15, "the of the of")]
    return rows


def _words(text):
    return [w.lower() for w in re.findall("[A-Za-z]+", text or "")]


def _rows(df):
    return sorted(map(tuple, df.select("doc", "n").collect()))


def _brute_all(rows, words):
    return sorted((k, sum(x in words for x in _words(t))) for k, t in rows if set(words) <= set(_words(t)))


def _brute_phrase(rows, words):
    n = lambda w: sum(w[i:i + len(words)] == words for i in range(len(w)))
    return sorted((k, n(_words(t))) for k, t in rows if n(_words(t)))


QUERIES = [["the"], ["the", "of"], ["of", "of"], ["live", "video", "stream"], ["it", "s"], ["s", "it"], ["the", "of", "the"], ["absent"], ["the", "absent"]]


def test_searches_over_batches_and_merges(spark, scratch):
    rows = _texts(400)
    table = PostingsTable(scratch, merge_every=2, level_rows=30, fanout=2, file_rows=20)
    for batch_id in range(5):
        own = spark.createDataFrame([r for r in rows if r[0] % 5 == batch_id], "doc long, comment string")
        table.add(own, batch_id)
        table.add(own, batch_id)  # delivered again
    index = table.read(spark)
    for words in QUERIES:
        assert _rows(search_all(index, words)) == _brute_all(rows, words), words
        assert _rows(search_phrase(index, words)) == _brute_phrase(rows, words), words
    assert _rows(search_phrase(index, ["The", "VIDEO"])) == _brute_phrase(rows, ["the", "video"])
    assert max(r.n for r in index.select(F.size("postings").alias("n")).collect()) <= P.BLOCK


def test_a_common_word_is_many_rows(spark):
    texts = spark.range(3 * P.BLOCK).select(F.col("id").alias("doc"), F.lit("the word").alias("comment"))
    rows = P.postings(texts).select("word", "block", F.size("postings").alias("n")).collect()
    assert sorted(tuple(r) for r in rows) == sorted((w, b, P.BLOCK) for w in ("the", "word") for b in range(3))


def test_blocks_without_a_word_are_not_opened(spark, scratch):
    """Only blocks that all words have are opened: 'rare' stands in one of twenty."""
    n = 20 * 1000
    texts = spark.range(n).select((F.col("id") % 20 * P.BLOCK + F.col("id") / 20).cast("long").alias("doc"),
                                  F.when(F.col("id") == 47, "the rare word").otherwise("the word").alias("comment"))
    table = PostingsTable(scratch, merge_every=None)
    table.add(texts, 0)
    table.merge(spark)
    index = table.read(spark)
    assert index.where("word = 'the'").count() == 20
    assert [r.block for r in P.common_blocks(index, ["the", "rare"]).select("block").collect()] == [7]
    assert P.common_blocks(index, ["the", "absent"]).count() == 0
    found = search_phrase(index, ["the", "rare"])
    assert found.count() == 1
    assert "In(word, [rare,the])" in found._jdf.queryExecution().executedPlan().toString().replace("In(word, [the,rare])", "In(word, [rare,the])")
