"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the fixture views of ``vidpulse.sources.fixtures`` over the whole
``events``, ``conversations`` and (volume) ``documents`` tables.  The test
events are sparse (about
10 000 over 30 days at sf0.01), so reaction windows are scaled from seconds
to hours: 10 s -> 6 h tumbling, 30 s / 10 s -> 6 h / 2 h sliding.  Comment
windows keep 60 s.  Outputs are flat scalar columns.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.operators import boxes, counts, learned, misc, routing, sampling, sentiment, text, viewers
from vidpulse.plans import comment_stats, dashboard
from vidpulse.sources import envelope
from vidpulse.schema import SENTIMENT_WORD_CAPACITY, STOP_WORDS
from vidpulse.session import checkpointed, scratch_path
from vidpulse.sources.fixtures import derive_lexicon, lv_comments, lv_documents, lv_events, numbered_comments

TUMBLING = "6 hours"
SLIDING, SLIDE = "6 hours", "2 hours"
COMMENT_WINDOW = text.COMMENT_WINDOW
COMMENT_SLIDE = "20 seconds"
TOP_K = 5
SEARCH_WORDS = ["la", "der", "und", "the", "que", "est"]

#: Items per row of the stored lists (few, as the comments are short).
CHUNK = 20
#: Comment searches: words that must all be there, and phrases.
SEARCH_ALL = [["the", "of", "to"], ["der", "und"], ["la"], ["the", "und"]]
SEARCH_PHRASES = [["the", "of"], ["the", "the", "the"], ["de", "la"], ["und", "der"], ["to", "the", "of"]]
#: Areas that the box queries ask for: whole cells, parts of cells, an edge on
#: a place, over the date line, and one without any place.
BOXES = {
    "wide": boxes.Box(24.0, -124.0, 37.0, -95.0),
    "narrow": boxes.Box(30.11, -101.37, 31.93, -70.003),
    "edge": boxes.Box(24.26, -102.54, 50.0, -102.54),
    "date_line": boxes.Box(-10.0, 170.0, 40.0, -110.0),
    "sea": boxes.Box(-20.0, 0.0, 10.0, 30.0),
}

Query = Callable[[SparkSession, str], DataFrame]


def _ev(spark, d, *types):
    """Fixture events; with ``types`` the type filter reaches the scan."""
    return lv_events(spark, d, list(types) if types else None)


def _cm(spark, d):
    return lv_comments(spark, d)


def likes_tumbling(spark, d):
    return counts.typed_window_counts(_ev(spark, d, "like"), "like", TUMBLING)


def dislikes_tumbling(spark, d):
    return counts.typed_window_counts(_ev(spark, d, "dislike"), "dislike", TUMBLING)


def sliding_counts(spark, d):
    return counts.sliding_counts(_ev(spark, d, *counts.REACTION_TYPES), SLIDING, SLIDE)


def sliding_counts_zero(spark, d):
    sliding = counts.sliding_counts(_ev(spark, d, *counts.REACTION_TYPES), SLIDING, SLIDE)
    return counts.fill_zero_windows(sliding, SLIDE)


def comment_sliding_counts(spark, d):
    """Comments per video in 60 s windows sliding by 20 s (comments alone)."""
    return counts.window_counts(_cm(spark, d), COMMENT_WINDOW, COMMENT_SLIDE)


def net_viewer_change(spark, d):
    return counts.net_viewer_change(_ev(spark, d, "play", "leave"), SLIDING, SLIDE)


def running_totals(spark, d):
    return counts.running_totals(routing.with_comments(_ev(spark, d), _cm(spark, d)))


def concurrent_views(spark, d):
    return viewers.concurrent_views(_ev(spark, d, "play", "leave"))


def play_running_count(spark, d):
    return viewers.running_count(_ev(spark, d, "play"), "play")


def leave_running_count(spark, d):
    return viewers.running_count(_ev(spark, d, "leave"), "leave")


def viewer_timeline(spark, d):
    return viewers.viewer_timeline(_ev(spark, d, "play", "leave"), extra=("ts", "user_id", "latitude", "longitude"))


def latest_start(spark, d):
    return viewers.latest_record(_ev(spark, d, "start_video"), "start_video")


def latest_end(spark, d):
    return viewers.latest_record(_ev(spark, d, "end_video"), "end_video")


def latest_likes(spark, d):
    return counts.latest_window(counts.typed_window_counts(_ev(spark, d, "like"), "like", TUMBLING))


def likes_as_of(spark, d):
    """Likes of every video in the newest like window of the whole input
    (0 for videos quiet in it) - the 'as of now' form of recent likes."""
    c = checkpointed(counts.typed_window_counts(_ev(spark, d, "like"), "like", TUMBLING))
    return counts.latest_window_as_of(c, c.select(F.max("window_start")).scalar())


def routed_counts(spark, d):
    return routing.routed_counts(routing.with_comments(_ev(spark, d), _cm(spark, d)))


def envelope_roundtrip(spark, d):
    ev = _ev(spark, d)
    wire = envelope.encode_envelope(ev.withColumn("timestamp", envelope.sim_timestamp(F.col("ts"))))
    back = envelope.parse_events(wire.select("value"))
    return back.select("event_id", "ts", "user_id", "video_id", "event_type", "latitude", "longitude")


def comment_sentences(spark, d):
    return text.sentence_counts(text.comment_sentences(_cm(spark, d)))


def token_lists(spark, d):
    return text.token_stats(text.comment_sentences(_cm(spark, d)), COMMENT_WINDOW)


def sentence_tokens(spark, d):
    """Token list of every sentence with its window, as text."""
    tokens = text.sentence_tokens(text.comment_sentences(_cm(spark, d)), COMMENT_WINDOW)
    return tokens.withColumn("tokens", F.array_join("tokens", " "))


def word_counts(spark, d):
    return text.word_counts(_cm(spark, d), STOP_WORDS, COMMENT_WINDOW)


def top_words(spark, d):
    return text.top_words(text.word_counts(_cm(spark, d), STOP_WORDS, COMMENT_WINDOW), TOP_K)


def _histogram(spark, d):
    cm = _cm(spark, d)
    return sentiment.sentence_sentiment(text.comment_sentences(cm), derive_lexicon(cm), COMMENT_WINDOW)


def sentence_sentiment(spark, d):
    return _histogram(spark, d)


def mean_sentiment(spark, d):
    return sentiment.mean_sentiment(_histogram(spark, d))


def keep_probability(spark, d):
    return sampling.window_keep_probability(_cm(spark, d))


def sampled_sentences(spark, d):
    cm = _cm(spark, d)
    probs = sampling.window_keep_probability(cm)
    return sampling.sampled_counts(sampling.adaptive_sample(text.comment_sentences(cm), probs))


def sampled_sentiment(spark, d):
    """Mean sentiment over the adaptively sampled sentences (score only
    what the capacity allows)."""
    return comment_stats.comment_sentiment(_cm(spark, d), None, SENTIMENT_WORD_CAPACITY)


def document_top_words(spark, d):
    """Top 5 words of every whole document (long texts, stop words removed)."""
    return text.top_words(text.word_counts(lv_documents(spark, d), STOP_WORDS, COMMENT_WINDOW), TOP_K)


def document_sentiment(spark, d):
    """Mean sentiment of every document over all of its sentences."""
    return comment_stats.comment_sentiment(lv_documents(spark, d), None)


def _dash(spark, d):
    cm = _cm(spark, d)
    return dashboard.dashboard_inputs(_ev(spark, d), cm, STOP_WORDS, None, TUMBLING)


def map_features(spark, d):
    return dashboard.map_features(_dash(spark, d))


def popup_text(spark, d):
    return dashboard.popup_text(_dash(spark, d))


def unlocated_videos(spark, d):
    return viewers.unlocated_videos(_ev(spark, d, "play", "start_video"))


def events_sorted(spark, d):
    return misc.events_sorted(_ev(spark, d))


def dedup_events(spark, d):
    ev = _ev(spark, d)
    redelivered = ev.unionByName(ev)  # every event delivered twice (at-least-once)
    return misc.dedup_events(redelivered).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def geo_cells(spark, d):
    return misc.geo_cells(_ev(spark, d, "play", "like"), TUMBLING)


def comment_index(spark, d):
    return text.comment_index(_cm(spark, d))


def comment_search(spark, d):
    return text.comment_search(text.comment_index(_cm(spark, d)), SEARCH_WORDS)


def likes_tumbling_stream(spark, d):
    from vidpulse.streaming.jobs import run_reaction_counts_once

    return run_reaction_counts_once(spark, d, "like", TUMBLING)


def totals_bucketed_stream(spark, d):
    from vidpulse.streaming.jobs import run_bucketed_totals_once

    return run_bucketed_totals_once(spark, d)


def sampled_sentiment_stream(spark, d):
    from vidpulse.streaming.jobs import run_comment_sentiment_once

    return run_comment_sentiment_once(spark, d, SENTIMENT_WORD_CAPACITY)


def sliding_counts_stream(spark, d):
    from vidpulse.streaming.jobs import run_sliding_counts_once

    return run_sliding_counts_once(spark, d, SLIDING, SLIDE)


def totals_stream(spark, d):
    from vidpulse.streaming.jobs import run_totals_once

    return run_totals_once(spark, d)


def totals_levelled_stream(spark, d):
    from vidpulse.streaming.jobs import run_totals_levelled_once

    return run_totals_levelled_once(spark, d)


def word_counts_levelled_stream(spark, d):
    from vidpulse.streaming.jobs import run_word_counts_levelled_once

    return run_word_counts_levelled_once(spark, d, STOP_WORDS)


def sliding_counts_zero_stream(spark, d):
    from vidpulse.streaming.jobs import run_sliding_counts_once

    return run_sliding_counts_once(spark, d, SLIDING, SLIDE, zeros=True)


def play_running_count_stream(spark, d):
    from vidpulse.streaming.stateful import run_play_count_once

    return run_play_count_once(spark, d)


def viewer_timeline_stream(spark, d):
    from vidpulse.streaming.stateful import run_viewer_timeline_once

    return run_viewer_timeline_once(spark, d)


def viewer_lows(spark, d):
    return viewers.viewer_lows(_ev(spark, d, "play", "leave"))


def _postings(spark, d):
    """An index of all comments, built in four batches and merged on the way."""
    from vidpulse.streaming.postings import PostingsTable

    table = PostingsTable(scratch_path(spark, "postings"), merge_every=2)
    comments = numbered_comments(spark, d)
    for k in range(4):
        table.add(comments.where(F.pmod(F.xxhash64("doc"), F.lit(4)) == k), k)
    return table.read(spark)


def _searches(spark, d, search, wanted):
    index = _postings(spark, d)
    out = [search(index, words).select(F.lit(" ".join(words)).alias("query"), F.col("doc").alias("comment_id"), "n") for words in wanted]
    return functools.reduce(DataFrame.unionAll, out)


def all_words_search(spark, d):
    """Comments that have all words of a query, from the stored index."""
    from vidpulse.streaming.postings import search_all

    return _searches(spark, d, search_all, SEARCH_ALL)


def phrase_search(spark, d):
    """Comments with a phrase, from the stored index."""
    from vidpulse.streaming.postings import search_phrase

    return _searches(spark, d, search_phrase, SEARCH_PHRASES)


def token_list_chunks(spark, d):
    """Token lists per (video, window) in chunks, as text."""
    chunks = text.token_list_chunks(_cm(spark, d), COMMENT_WINDOW, size=CHUNK)
    return chunks.select("video_id", "window_start", "chunk", F.array_join("items", " ").alias("tokens"))


def score_list_chunks(spark, d):
    """Sentence classes per (video, window) in chunks, as text."""
    cm = _cm(spark, d)
    chunks = sentiment.score_list_chunks(text.comment_sentences(cm), derive_lexicon(cm), COMMENT_WINDOW, size=CHUNK)
    return chunks.select("video_id", "window_start", "chunk", F.array_join(F.col("items").cast("array<string>"), " ").alias("classes"))


def dedup_events_stream(spark, d):
    from vidpulse.streaming.jobs import run_dedup_once

    return run_dedup_once(spark, d)


def learned_sentiment(spark, d):
    """Sentences per class of a model that is fitted on the comments' sentences
    with their lexicon classes, which stand in for labels."""
    cm = _cm(spark, d)
    sentences = checkpointed(text.comment_sentences(cm))
    labelled = sentiment.scored_sentences(sentences, derive_lexicon(cm))
    model = learned.fit(labelled, label="sentiment_class")
    return sentiment.sentence_sentiment(sentences, None, COMMENT_WINDOW, scorer=learned.scorer(model))


def _places(spark, d):
    path = scratch_path(spark, "places")
    boxes.write_places(_ev(spark, d), path)
    return boxes.read_places(spark, path)


def box_search(spark, d):
    """Events of the narrow box, from a layout sorted by place."""
    return boxes.search(_places(spark, d), BOXES["narrow"]).select("event_id", "video_id", "event_type", "latitude", "longitude")


def box_counts(spark, d):
    """Plays and likes per box and video."""
    return boxes.box_counts(_places(spark, d), BOXES)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        # reaction windows and counts
        likes_tumbling, dislikes_tumbling, sliding_counts, sliding_counts_zero, comment_sliding_counts,
        net_viewer_change, running_totals, concurrent_views,
        # per-record running state and newest records
        play_running_count, leave_running_count, viewer_timeline, latest_start, latest_end, latest_likes,
        likes_as_of, events_sorted, unlocated_videos,
        # ingest: routing, wire format, dedup, geo cells
        routed_counts, envelope_roundtrip, dedup_events, geo_cells,
        # comment text, sentiment, load shedding
        comment_sentences, token_lists, sentence_tokens, word_counts, top_words, sentence_sentiment, mean_sentiment,
        keep_probability, sampled_sentences, sampled_sentiment, comment_index, comment_search,
        document_top_words, document_sentiment,
        # dashboard
        map_features, popup_text,
        # the same answers through Structured Streaming
        likes_tumbling_stream, sliding_counts_stream, totals_stream, totals_bucketed_stream,
        sampled_sentiment_stream, totals_levelled_stream, word_counts_levelled_stream,
        sliding_counts_zero_stream, play_running_count_stream, viewer_timeline_stream,
        # when counts went below zero; areas; stored postings
        viewer_lows, box_search, box_counts, all_words_search, phrase_search,
        # lists per key in chunks, exact dedup on a stream, a learned sentence class
        token_list_chunks, score_list_chunks, dedup_events_stream, learned_sentiment,
    ]
}
