"""Comment text operators: sentences, tokens, word counts, top words, index.

Text stays in JVM expressions (regex extract / explode).  Grouped outputs
are counts, never collected bags: a video's token list for a window is its
sentence rows and their token counts, or a list in chunks of bounded size
(``chunked_lists``), so no group is collected into one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.functions.text import clean_comment, has_content, sentence_array, token_array, word_array
from vidpulse.operators.counts import window_start_col
from vidpulse.operators.prefix import running_sum

COMMENT_WINDOW = "60 seconds"
#: Items of a stored list that one row holds.
LIST_CHUNK = 10_000

StopWords = Sequence[str] | DataFrame | None  # a fixed list, a (word) table, or no filtering


def comment_sentences(comments: DataFrame, key: str = "video_id", text: str = "comment",
                      ts: str = "ts") -> DataFrame:
    """One row per sentence: clean, drop blank comments, split, trim, drop
    blank sentences.  Output: key, ts, pos (place in the comment), sentence."""
    cleaned = comments.where(has_content(F.col(text))).select(key, ts, clean_comment(F.col(text)).alias("_clean"))
    sent = cleaned.select(key, ts, F.posexplode(sentence_array(F.col("_clean"))).alias("pos", "_s"))
    return sent.select(key, ts, "pos", F.trim("_s").alias("sentence")).where(F.col("sentence") != "")


def newest_window_comments(comments: DataFrame, length: str = COMMENT_WINDOW, key: str = "video_id",
                           text: str = "comment", ts: str = "ts") -> DataFrame:
    """The comments of each key's newest window that has a sentence: older
    windows go before their text is split into sentences or words."""
    has_sentence = F.exists(sentence_array(clean_comment(F.col(text))), lambda s: F.trim(s) != "")
    newest = windowed(comments.where(has_sentence), length, ts).groupBy(key).agg(F.max("window_start").alias("window_start"))
    return windowed(comments, length, ts).join(newest, [key, "window_start"], "left_semi").drop("window_start")


def sentence_counts(sentences: DataFrame, key: str = "video_id") -> DataFrame:
    return sentences.groupBy(key, "sentence").agg(F.count(F.lit(1)).alias("n"))


def windowed(df: DataFrame, length: str = COMMENT_WINDOW, ts: str = "ts") -> DataFrame:
    """Attach the tumbling comment window start."""
    return df.withColumn("window_start", window_start_col(df, F.window(ts, length).start, ts))


def token_stats(sentences: DataFrame, length: str = COMMENT_WINDOW, key: str = "video_id") -> DataFrame:
    """Per (video, window): number of tokenized sentences and tokens; the
    sizes of the per-window token lists."""
    w = windowed(sentences, length)
    return w.groupBy(key, "window_start").agg(
        F.count(F.lit(1)).alias("n_sentences"),
        F.sum(F.size(token_array(F.col("sentence")))).cast("bigint").alias("n_tokens"),  # sentences are never null
    )


def windowed_sentence_counts(sentences: DataFrame, length: str = COMMENT_WINDOW, key: str = "video_id") -> DataFrame:
    """(key, window_start, sentence, n): sentence rows pre-aggregated per
    window.  Repeated comments of a hot video collapse map-side; every
    comment statistic below can start from this table."""
    return windowed(sentences, length).groupBy(key, "window_start", "sentence").agg(F.count(F.lit(1)).alias("n"))


def word_counts_from_sentences(per_sentence: DataFrame, stop_words: StopWords,
                               key: str = "video_id") -> DataFrame:
    """Word counts per (video, window) from sentence counts.  Sentence
    splitting never cuts a letter run, so a comment's words are exactly the
    words of its sentences; the result equals ``word_counts``."""
    words = per_sentence.select(key, "window_start", F.explode(word_array(F.col("sentence"))).alias("word"), "n")
    words = without_stop_words(words, stop_words)
    return words.groupBy(key, "window_start", "word").agg(F.sum("n").cast("bigint").alias("n"))


def chunked_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, size: int = LIST_CHUNK) -> DataFrame:
    """The list of ``value`` per key in ``order``, as rows of at most ``size``
    items: keys, chunk (from 0), items.

    A place in the list is a running sum over range partitions, so the list of
    a hot key comes from many tasks and is many rows; the chunks of a key in
    order are its list.  ``order`` should be total (rows that are equal in it
    are interchangeable).
    """
    row = F.struct("place", F.col(value).alias("item"))
    placed = running_sum(df.select(*keys, *order, value).withColumn("_row", F.monotonically_increasing_id()), [*order, "_row"], keys, out="place")
    chunks = placed.groupBy(*keys, F.floor((F.col("place") - 1) / size).alias("chunk")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return chunks.select(*keys, "chunk", F.transform("rows", lambda r: r["item"]).alias("items"))


def token_list_chunks(comments: DataFrame, length: str = COMMENT_WINDOW, key: str = "video_id", size: int = LIST_CHUNK) -> DataFrame:
    """The tokens that each video's comments have in a window, in order of
    time, sentence and place, in chunks."""
    sentences = windowed(comment_sentences(comments, key), length)
    tokens = sentences.select(key, "window_start", "ts", "pos", F.posexplode(token_array(F.col("sentence"))).alias("at", "token"))
    return chunked_lists(tokens, [key, "window_start"], ["ts", "pos", "at", "token"], "token", size)


def sentence_tokens(sentences: DataFrame, length: str = COMMENT_WINDOW, key: str = "video_id") -> DataFrame:
    """Token list of every sentence with its window: one row per sentence,
    so no group is collected."""
    w = windowed(sentences, length)
    return w.select(key, "window_start", "sentence", token_array(F.col("sentence")).alias("tokens"))


def comment_words(comments: DataFrame, key: str = "video_id", text: str = "comment", ts: str = "ts") -> DataFrame:
    """One row per lower-case word occurrence: key, ts, word."""
    return comments.select(key, ts, F.explode(word_array(F.col(text))).alias("word"))


def without_stop_words(words: DataFrame, stop_words: StopWords) -> DataFrame:
    """Drop stop words.  A fixed list becomes a hash-set filter inside the
    scan stage (no join); a table is anti-joined (Spark's byte threshold
    decides on a broadcast)."""
    if stop_words is None:
        return words
    if isinstance(stop_words, DataFrame):
        return words.join(stop_words.select("word"), "word", "left_anti")
    return words.where(~F.col("word").isin(list(stop_words)))


def word_counts(comments: DataFrame, stop_words: StopWords, length: str = COMMENT_WINDOW,
                key: str = "video_id", text: str = "comment") -> DataFrame:
    """Word frequency per (video, window) without stop words."""
    words = without_stop_words(windowed(comment_words(comments, key, text), length), stop_words)
    return words.groupBy(key, "window_start", "word").agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, k: int = 5, keys: Sequence[str] = ("video_id", "window_start")) -> DataFrame:
    """Top ``k`` words per group by (n desc, word asc).

    ``row_number() <= k`` is planned with a window group limit, which keeps
    only k rows per group on the map side before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), F.col("word").asc())
    ranked = counts.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return ranked.where(F.col("rank") <= k).select(*keys, "rank", "word", "n")


def top_words_text(top: DataFrame, keys: Sequence[str] = ("video_id", "window_start")) -> DataFrame:
    """Render the top words of each group as ``[('w', n), ...]`` (at most k
    rows per group are collected)."""
    g = top.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("_t"))
    items = F.transform("_t", lambda x: F.format_string("('%s', %d)", x["word"], x["n"]))
    return g.select(*keys, F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")).alias("words"))


def comment_index(comments: DataFrame, key: str = "video_id", text: str = "comment") -> DataFrame:
    """Inverted index of comment words: (word, video_id, n); stop words kept."""
    return comment_words(comments, key, text).groupBy("word", key).agg(F.count(F.lit(1)).alias("n"))


def comment_search(index: DataFrame, words: Sequence[str]) -> DataFrame:
    """Look words up in the index (equality filter on ``word``)."""
    wanted = [w.lower() for w in words]
    return index.where(F.col("word").isin(wanted))
