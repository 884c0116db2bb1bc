"""Sentence sentiment with a word lexicon.

Scores come from a (word, score) lexicon instead of an external NLP model:
sentence class = 2 + clamp(round(mean score of its matched words), -2, 2),
i.e. 0 (very negative) .. 4 (very positive); no matched word -> class 2.

Sentences are first counted per (video, window, sentence) (map-side partial
aggregation), so a sentence repeated by a hot video is scored once per
window and shuffled as one counted row.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidpulse.operators.text import LIST_CHUNK, chunked_lists, windowed, windowed_sentence_counts
from vidpulse.session import checkpointed

NEUTRAL = 2
#: Text bytes of the sentences whose words are numbered together, about.
BLOCK_BYTES = 8 << 20
#: ``functions.text.word_array`` on lower-cased bytes (only ASCII is lower-cased there).
_WORD = re.compile(rb"[a-z]+")


def sentence_class(score_sum: Column, matched: Column) -> Column:
    """2 + clamp(round(mean score), -2, 2); neutral without matched words."""
    mean = score_sum / matched
    cls = F.lit(NEUTRAL) + F.greatest(F.lit(-2), F.least(F.lit(2), F.round(mean, 0).cast("bigint")))
    return F.when(matched > 0, cls).otherwise(F.lit(NEUTRAL)).cast("bigint")


def word_scores(rows: DataFrame, lexicon: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns of every row with ``_s``, the sum of the scores of the
    words in its ``sentence`` (null without any), and ``_c``, how many scored.

    Sentences go in blocks of about ``BLOCK_BYTES``: a block's words are
    numbered, and only its distinct words meet the lexicon (a shuffle by word,
    where a word comes once a block however frequent it is).  Their scores go
    back to the block, whose sentences hold word numbers.  The blocks are
    stored once, as both sides must see the same numbers.
    """
    kept = [T.StructField(f.name, f.dataType) for f in rows.select(*keep).schema]
    sums = lexicon.groupBy("word").agg(F.sum(F.col("score")).alias("_s"), F.count("score").alias("_c"))
    if isinstance(sums.schema["_s"].dataType, T.DecimalType):
        sums = sums.withColumn("_s", F.col("_s").cast("double"))
    added = {"_block": T.LongType(), "_code": T.IntegerType(), "_word": T.StringType(), "_codes": T.ArrayType(T.IntegerType())}
    coded = checkpointed(rows.select(F.col("sentence").cast("binary").alias("_text"), *keep).mapInArrow(
        _numbered, T.StructType([*[T.StructField(*f) for f in added.items()], *kept])))
    words = coded.where(F.col("_word").isNotNull()).select(F.col("_block").alias("_of"), "_code", F.col("_word").alias("word")).join(sums, "word").select("_of", "_code", "_s", "_c")
    sentences = coded.where(F.col("_word").isNull()).select("_block", "_codes", *keep)
    out = T.StructType([*kept, T.StructField("_s", sums.schema["_s"].dataType), T.StructField("_c", T.LongType())])
    return sentences.groupBy("_block").cogroup(words.groupBy("_of")).applyInArrow(_summed, out)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sentences: a row per distinct word of the block with its
    number, and a row per sentence with the numbers of its words."""
    block, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        step = max(1, int(batch.num_rows * BLOCK_BYTES / max(1, batch.column(0).nbytes)))
        for at in range(0, batch.num_rows, step):
            held.append(batch.slice(at, step))
            size += held[-1].column(0).nbytes
            if size >= BLOCK_BYTES:
                yield from _block(block, held)
                block, held, size = block + 1, [], 0
    if held:
        yield from _block(block, held)


def _block(block: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    names = ["_block", "_code", "_word", "_codes", *batches[0].schema.names[1:]]
    for batch in batches:
        codes = [[*map(numbers.__getitem__, _WORD.findall(t.lower()))] if t else [] for t in batch.column(0).to_pylist()]
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.array(codes, pa.list_(pa.int32())), *batch.columns[1:]], names=names)
    n = len(numbers)
    yield pa.RecordBatch.from_arrays(
        [pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([w.decode() for w in numbers], pa.string()), pa.nulls(n, pa.list_(pa.int32())),
         *[pa.nulls(n, f.type) for f in batches[0].schema][1:]], names=names)


def _summed(sentences: pa.Table, words: pa.Table) -> pa.Table:
    """Score sum and number of scored words per sentence of one block."""
    lists = sentences["_codes"].combine_chunks()
    codes, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    rows, table = np.repeat(np.arange(len(sizes)), sizes), words["_code"].to_numpy()
    most = max(codes.max(initial=-1), table.max(initial=-1)) + 1
    sums = []
    for name in ("_s", "_c"):
        of_word = np.zeros(most)
        of_word[table] = words[name].fill_null(0).to_numpy()
        sums.append(np.bincount(rows, weights=of_word[codes], minlength=len(sizes)))
    s = pa.array(sums[0], mask=sums[1] == 0).cast(words.schema.field("_s").type)
    columns = [sentences[c] for c in sentences.column_names if c not in ("_block", "_codes")]
    return pa.table([*columns, s, pa.array(sums[1]).cast(pa.int64())], names=[*[c for c in sentences.column_names if c not in ("_block", "_codes")], "_s", "_c"])


def sentiment_histogram(per_sentence: DataFrame, lexicon: DataFrame | None, key: str = "video_id",
                        scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, window_start, sentence, n) -> sentences per (key, window, class).

    With a lexicon the words' scores come from ``word_scores``.
    ``scorer`` replaces the lexicon: sentence column -> class column (0-4).
    """
    if scorer is not None:
        hist = per_sentence.select(key, "window_start", scorer(F.col("sentence")).cast("bigint").alias("sentiment_class"), "n")
    else:
        scored = word_scores(per_sentence.select(key, "window_start", "n", "sentence"), lexicon, [key, "window_start", "n"])
        hist = scored.select(key, "window_start", sentence_class(F.col("_s"), F.col("_c")).alias("sentiment_class"), "n")
    return hist.groupBy(key, "window_start", "sentiment_class").agg(F.sum("n").cast("bigint").alias("n"))


def scored_sentences(sentences: DataFrame, lexicon: DataFrame | None, scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """``sentences`` with their ``sentiment_class``."""
    if scorer is not None:
        return sentences.withColumn("sentiment_class", scorer(F.col("sentence")).cast("bigint"))
    scored = word_scores(sentences, lexicon, sentences.columns)
    return scored.withColumn("sentiment_class", sentence_class(F.col("_s"), F.col("_c"))).drop("_s", "_c")


def score_list_chunks(sentences: DataFrame, lexicon: DataFrame | None, length: str = "60 seconds", key: str = "video_id",
                      size: int = LIST_CHUNK, scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """The sentence classes of each video and window, in order of time and
    place, in chunks (``text.chunked_lists``)."""
    scored = windowed(scored_sentences(sentences, lexicon, scorer), length)
    return chunked_lists(scored, [key, "window_start"], ["ts", "pos", "sentence"], "sentiment_class", size)


def sentence_sentiment(sentences: DataFrame, lexicon: DataFrame | None, length: str = "60 seconds",
                       key: str = "video_id", scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Sentences per (video, window, class): the per-window score list as
    a histogram.  Output: key, window_start, sentiment_class, n."""
    return sentiment_histogram(windowed_sentence_counts(sentences, length, key), lexicon, key, scorer)


def mean_sentiment(histogram: DataFrame, key: str = "video_id", min_items: int = 1) -> DataFrame:
    """Mean class per (video, window), rounded half-up to 2 decimals (exact
    integer arithmetic on the class sum), and the sentence count.  Windows
    with fewer than ``min_items`` sentences are not published (2 gives the
    original publish guard, which dropped single-sentence lists)."""
    g = histogram.groupBy(key, "window_start").agg(
        F.sum(F.col("sentiment_class") * F.col("n")).cast("bigint").alias("_s"),
        F.sum("n").cast("bigint").alias("n"),
    )
    score = F.expr("(200 * _s + n) div (2 * n)") / F.lit(100.0)
    return g.where(F.col("n") >= min_items).select(key, "window_start", score.alias("score"), "n")
