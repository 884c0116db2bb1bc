"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement runs on the raw tables (``events``, ``conversations``)
registered as views and rebuilds the fixture views as CTEs.  Column names
and types follow the Spark outputs (counts BIGINT, window starts TIMESTAMP).
"""

from __future__ import annotations

from vidpulse.operators.learned import BUCKETS, CLASSES
from vidpulse.plans.registry import BOXES, CHUNK, SEARCH_ALL, SEARCH_PHRASES, SEARCH_WORDS, TOP_K
from vidpulse.schema import NO_SENTIMENT_TEXT, NO_WORDS_TEXT, STOP_WORDS, TOPIC_OF_TYPE

LV_EVENTS = """lv_events AS (
  SELECT e.event_id, e.ts, e.event_id % 997 AS user_id, e.user_id AS video_id,
         CASE WHEN e.event_type = 'signup' AND e.event_id % 2 = 0 THEN 'start_video'
              WHEN e.event_type = 'signup' THEN 'end_video'
              WHEN e.event_type = 'view' THEN 'play'
              WHEN e.event_type = 'error' THEN 'leave'
              WHEN e.event_type = 'click' THEN 'like'
              WHEN e.event_type = 'purchase' THEN 'dislike' END AS event_type,
         24 + CAST(json_extract_string(e.props, '$.k') AS DOUBLE) * 26 / 100 AS latitude,
         -124 + CAST((CAST(json_extract_string(e.props, '$.k') AS BIGINT) * 37) % 100 AS DOUBLE) * 58 / 100 AS longitude
  FROM events e)"""

LV_COMMENTS = """lv_comments AS (
  SELECT conv_id AS video_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn * 20) AS ts, text AS comment
  FROM conversations)"""

LV_DOCUMENTS = """lv_comments AS (
  SELECT doc_id AS video_id, TIMESTAMP '2024-01-01 00:00:00' AS ts, text AS comment FROM documents)"""

LV_STOP_WORDS = "lv_stop_words AS (SELECT * FROM (VALUES {}) t(word))".format(
    ", ".join(f"('{w}')" for w in STOP_WORDS)
)

CLEAN = "regexp_replace(comment, '[^A-Za-z?!.]+', ' ', 'g')"

SENTENCES = f"""sentences AS (
  SELECT video_id, ts, pos, time_bucket(INTERVAL '60 seconds', ts) AS window_start, trim(s) AS sentence
  FROM (SELECT video_id, ts, unnest(parts) AS s, generate_subscripts(parts, 1) - 1 AS pos
        FROM (SELECT video_id, ts, regexp_extract_all(c, '[^.?!]+[.?!]*') AS parts FROM (SELECT video_id, ts, {CLEAN} AS c FROM lv_comments) WHERE trim(c) <> ''))
  WHERE trim(s) <> '')"""

WORDS = f"""words AS (
  SELECT video_id, ts, time_bucket(INTERVAL '60 seconds', ts) AS window_start,
         unnest(regexp_extract_all(lower({CLEAN}), '[a-z]+')) AS word
  FROM lv_comments)"""

LEXICON = """lv_lexicon AS (SELECT DISTINCT word, CAST(length(word) % 5 - 2 AS BIGINT) AS score FROM words)"""

WORD_COUNTS = """word_counts AS (
  SELECT video_id, window_start, word, count(*) AS n FROM words
  WHERE word NOT IN (SELECT word FROM lv_stop_words) GROUP BY video_id, window_start, word)"""

TOP = f"""top AS (
  SELECT video_id, window_start,
         CAST(row_number() OVER (PARTITION BY video_id, window_start ORDER BY n DESC, word ASC) AS BIGINT) AS rank,
         word, n
  FROM word_counts QUALIFY rank <= {TOP_K})"""

HISTOGRAM = """per_sentence AS (
  SELECT video_id, window_start, sentence, count(*) AS c FROM {src} GROUP BY ALL),
distinct_sentence AS (SELECT DISTINCT sentence FROM per_sentence),
sentence_words AS (
  SELECT sentence, unnest(regexp_extract_all(lower(sentence), '[a-z]+')) AS word FROM distinct_sentence),
scored AS (
  SELECT sw.sentence, sum(l.score) AS s, count(*) AS c FROM sentence_words sw JOIN lv_lexicon l USING (word)
  GROUP BY sw.sentence),
classes AS (
  SELECT d.sentence,
         CAST(2 + greatest(-2, least(2, CAST(round(coalesce(sc.s / sc.c, CAST(0 AS DOUBLE))) AS BIGINT))) AS BIGINT)
           AS sentiment_class
  FROM distinct_sentence d LEFT JOIN scored sc USING (sentence)),
histogram AS (
  SELECT p.video_id, p.window_start, cl.sentiment_class, CAST(sum(p.c) AS BIGINT) AS n
  FROM per_sentence p JOIN classes cl USING (sentence) GROUP BY ALL)"""

MEAN = """mean_sent AS (
  SELECT video_id, window_start, ((200 * s + n) // (2 * n)) / CAST(100 AS DOUBLE) AS score, n
  FROM (SELECT video_id, window_start, CAST(sum(sentiment_class * n) AS BIGINT) AS s, CAST(sum(n) AS BIGINT) AS n
        FROM histogram GROUP BY ALL)
  WHERE n >= 1)"""

HISTOGRAM_ALL = HISTOGRAM.format(src="sentences")
HISTOGRAM_SAMPLED = HISTOGRAM.format(src="sampled")

PROBS = f"""probs AS (
  SELECT window_start, words,
         CASE WHEN words > 5000 THEN CAST(5000 AS DOUBLE) / words ELSE CAST(1 AS DOUBLE) END AS prob
  FROM (SELECT time_bucket(INTERVAL '60 seconds', ts) AS window_start,
               CAST(sum(len(regexp_extract_all(lower({CLEAN}), '[a-z]+'))) AS BIGINT) AS words
        FROM lv_comments GROUP BY ALL))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _typed_tumbling(kind: str) -> str:
    return (
        _with(LV_EVENTS)
        + f"""SELECT video_id, time_bucket(INTERVAL '6 hours', ts) AS window_start, count(*) AS n
FROM lv_events WHERE event_type = '{kind}' GROUP BY ALL"""
    )


SLIDING_CTE = """sliding AS (
  SELECT video_id, event_type, time_bucket(INTERVAL '2 hours', ts) - i * INTERVAL '2 hours' AS window_start,
         count(*) AS n
  FROM lv_events, (SELECT unnest([0, 1, 2]) AS i) steps
  WHERE event_type IN ('like', 'dislike', 'play', 'leave')
  GROUP BY ALL)"""

TIMELINE = """timeline AS (
  SELECT event_id, video_id, ts,
         CAST(sum(CASE WHEN event_type = 'play' THEN 1 ELSE -1 END)
              OVER (PARTITION BY video_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS BIGINT) AS viewers
  FROM lv_events WHERE event_type IN ('play', 'leave'))"""

CONCURRENT_CTE = """concurrent AS (
  SELECT video_id, plays, leaves, plays - leaves AS views, plays - leaves < 0 AS out_of_order
  FROM (SELECT video_id, count(*) FILTER (WHERE event_type = 'play') AS plays,
               count(*) FILTER (WHERE event_type = 'leave') AS leaves
        FROM lv_events WHERE event_type IN ('play', 'leave') GROUP BY video_id)
  WHERE plays >= 1)"""


def _latest_record(kind: str) -> str:
    return (
        _with(LV_EVENTS)
        + f"""SELECT video_id, ts, user_id, latitude, longitude FROM lv_events WHERE event_type = '{kind}'
QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ts DESC, event_id DESC) = 1"""
    )


def _running(kind: str) -> str:
    return (
        _with(LV_EVENTS)
        + f"""SELECT event_id, video_id,
       count(*) OVER (PARTITION BY video_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS running
FROM lv_events WHERE event_type = '{kind}'"""
    )


def _topic_case() -> str:
    whens = " ".join(f"WHEN '{t}' THEN '{topic}'" for t, topic in TOPIC_OF_TYPE.items())
    return f"CASE event_type {whens} END"


DASHBOARD_CTES = [
    LV_EVENTS, LV_COMMENTS, LV_STOP_WORDS, SENTENCES, WORDS, LEXICON, WORD_COUNTS, TOP, HISTOGRAM_ALL, MEAN,
    CONCURRENT_CTE,
    """loc AS (
  SELECT video_id, latitude, longitude FROM lv_events WHERE event_type = 'start_video'
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ts DESC, event_id DESC) = 1)""",
    """lk AS (
  SELECT video_id, arg_max(n, window_start) AS n
  FROM (SELECT video_id, time_bucket(INTERVAL '6 hours', ts) AS window_start, count(*) AS n
        FROM lv_events WHERE event_type = 'like' GROUP BY ALL) GROUP BY video_id)""",
    """dk AS (
  SELECT video_id, arg_max(n, window_start) AS n
  FROM (SELECT video_id, time_bucket(INTERVAL '6 hours', ts) AS window_start, count(*) AS n
        FROM lv_events WHERE event_type = 'dislike' GROUP BY ALL) GROUP BY video_id)""",
    """newest AS (SELECT video_id, max(window_start) AS window_start FROM sentences GROUP BY video_id)""",
    """top_text AS (
  SELECT video_id, window_start,
         '[' || string_agg('(''' || word || ''', ' || CAST(n AS VARCHAR) || ')', ', ' ORDER BY rank) || ']' AS words
  FROM top GROUP BY ALL)""",
    """wtext AS (
  SELECT nw.video_id, coalesce(tt.words, '[]') AS words
  FROM newest nw LEFT JOIN top_text tt USING (video_id, window_start))""",
    """snt AS (SELECT video_id, arg_max(score, window_start) AS score FROM mean_sent GROUP BY video_id)""",
    """dash AS (
  SELECT c.video_id, loc.latitude AS lat, loc.longitude AS lon, c.views, c.plays,
         CAST(coalesce(lk.n, 0) AS BIGINT) AS likes, CAST(coalesce(dk.n, 0) AS BIGINT) AS dislikes,
         wtext.words, snt.score AS sentiment,
         least(c.views / CAST(5000 AS DOUBLE), CAST(1 AS DOUBLE)) AS size
  FROM concurrent c JOIN loc USING (video_id)
  LEFT JOIN lk USING (video_id) LEFT JOIN dk USING (video_id)
  LEFT JOIN wtext USING (video_id) LEFT JOIN snt USING (video_id))""",
]

_CORNERS = [(-1.5, -1.0), (-1.5, 1.0), (1.5, 1.0), (1.5, -1.0)]


def _map_features() -> str:
    corners = []
    for i, (dx, dy) in enumerate(_CORNERS, start=1):
        corners.append(f"lat + CAST({dy} AS DOUBLE) * size AS c{i}_lat")
        corners.append(f"lon + CAST({dx} AS DOUBLE) * size AS c{i}_lon")
    level = "CAST(greatest(0, least(356, floor(356 * (likes - 1) / 100))) AS BIGINT)"
    color = (
        f"CASE WHEN {level} < 179 THEN '#' || lower(hex(66 + {level})) || '66f4' "
        f"ELSE '#f466' || lower(hex(422 - {level})) END AS color"
    )
    return (
        _with(*DASHBOARD_CTES)
        + "SELECT video_id, lat, lon, views, plays, likes, dislikes, words, sentiment, size, "
        + ", ".join(corners)
        + f", {color} FROM dash"
    )


def _popup_text() -> str:
    return _with(*DASHBOARD_CTES) + f"""SELECT video_id,
  'Concurent viewers: ' || CAST(views AS VARCHAR) AS label_views,
  'Total viewers: ' || CAST(plays AS VARCHAR) AS label_total,
  'Recent likes: ' || CAST(likes AS VARCHAR) AS label_likes,
  'Recent dislikes: ' || CAST(dislikes AS VARCHAR) AS label_dislikes,
  'Top popular words: ' || coalesce(words, '{NO_WORDS_TEXT}') AS label_words,
  'Sentiment score: ' || coalesce(CAST(sentiment AS VARCHAR), '{NO_SENTIMENT_TEXT}') AS label_sentiment
FROM dash"""


SAMPLED = """sampled AS (
  SELECT s.* FROM sentences s JOIN probs p USING (window_start)
  WHERE CAST('0x' || substr(md5(CAST(s.video_id AS VARCHAR) || '|' || CAST(s.ts AS VARCHAR) || '|' || CAST(s.pos AS VARCHAR)
                               || '|' || s.sentence), 1, 8) AS BIGINT)
        / CAST(4294967296 AS DOUBLE) >= CAST(1 AS DOUBLE) - p.prob)"""


def _in_box(name: str) -> str:
    box = BOXES[name]
    both = "OR" if box.west > box.east else "AND"
    number = lambda x: f"CAST('{x}' AS DOUBLE)"
    return (f"latitude >= {number(box.south)} AND latitude <= {number(box.north)} "
            f"AND (longitude >= {number(box.west)} {both} longitude <= {number(box.east)})")


def _box_counts() -> str:
    return _with(LV_EVENTS) + "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS box, video_id, count(*) FILTER (WHERE event_type = 'play') AS plays,
  count(*) FILTER (WHERE event_type = 'like') AS likes
FROM lv_events WHERE event_type IN ('play', 'like') AND {_in_box(name)} GROUP BY video_id""" for name in BOXES)


LEARNED = f"""grams AS (
  SELECT s.video_id, s.window_start, s.sentence, s.id,
         unnest(list_concat([''], w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g
  FROM (SELECT *, row_number() OVER () AS id, regexp_extract_all(lower(sentence), '[a-z]+') AS w FROM sentences) s),
hashed AS (
  SELECT * EXCLUDE (g), CASE WHEN g = '' THEN -1 ELSE CAST('0x' || substr(md5(g), 1, 3) AS BIGINT) END AS bucket FROM grams),
counted AS (SELECT c.sentiment_class AS class, bucket, count(*) AS n FROM hashed JOIN classes c USING (sentence) GROUP BY ALL),
class_rows AS (SELECT unnest(range(0, {CLASSES})) AS class),
sizes AS (
  SELECT r.class, coalesce(sum(n) FILTER (WHERE bucket >= 0), 0) AS grams, coalesce(sum(n) FILTER (WHERE bucket = -1), 0) AS sentences
  FROM class_rows r LEFT JOIN counted USING (class) GROUP BY r.class),
used AS (SELECT DISTINCT bucket FROM hashed),
weights AS (
  SELECT z.class, u.bucket,
         CASE WHEN u.bucket = -1
              THEN CAST(round(1000 * ln((z.sentences + 1) / CAST((SELECT sum(sentences) FROM sizes) + {CLASSES} AS DOUBLE))) AS BIGINT)
              ELSE CAST(round(1000 * ln((coalesce(c.n, 0) + 1) / CAST(z.grams + {BUCKETS} AS DOUBLE))) AS BIGINT) END AS weight
  FROM sizes z CROSS JOIN used u LEFT JOIN counted c ON c.class = z.class AND c.bucket = u.bucket),
sums AS (SELECT id, video_id, window_start, class, sum(weight) AS score FROM hashed JOIN weights USING (bucket) GROUP BY ALL),
learned AS (
  SELECT video_id, window_start, class FROM sums QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, class) = 1)"""

COMMENT_WORDS = r"""comment_words AS (
  SELECT conv_id * 1048576 + turn AS comment_id, list_transform(regexp_extract_all(text, '[A-Za-z]+'), lambda x: lower(x)) AS w
  FROM conversations)"""


def _all_words() -> str:
    one = lambda words: f"""SELECT '{' '.join(words)}' AS query, comment_id,
  CAST(len(list_filter(w, lambda x: x IN ({', '.join(f"'{x}'" for x in words)}))) AS BIGINT) AS n
FROM comment_words WHERE list_has_all(w, {words})"""  # noqa: E731
    return _with(COMMENT_WORDS) + "\nUNION ALL\n".join(map(one, SEARCH_ALL))


def _phrases() -> str:
    one = lambda words: f"""SELECT * FROM (SELECT '{' '.join(words)}' AS query, comment_id,
  CAST(len(list_filter(range(1, len(w) + 1), lambda i: w[i:i + {len(words) - 1}] = {words})) AS BIGINT) AS n
FROM comment_words) WHERE n > 0"""  # noqa: E731
    return _with(COMMENT_WORDS) + "\nUNION ALL\n".join(map(one, SEARCH_PHRASES))


def oracle_sql() -> dict[str, str]:
    sampled_sentiment = (
        _with(LV_COMMENTS, SENTENCES, WORDS, LEXICON, PROBS, SAMPLED, HISTOGRAM_SAMPLED, MEAN) + "SELECT * FROM mean_sent"
    )
    search = ", ".join(f"'{w}'" for w in SEARCH_WORDS)
    totals = _with(LV_EVENTS, LV_COMMENTS) + """SELECT video_id,
  count(*) FILTER (WHERE event_type = 'like') AS likes,
  count(*) FILTER (WHERE event_type = 'dislike') AS dislikes,
  count(*) FILTER (WHERE event_type = 'play') AS plays,
  count(*) FILTER (WHERE event_type = 'leave') AS leaves,
  count(*) FILTER (WHERE event_type = 'comment') AS comments
FROM (SELECT video_id, event_type FROM lv_events UNION ALL SELECT video_id, 'comment' AS event_type FROM lv_comments)
GROUP BY video_id"""
    unique_events = _with(LV_EVENTS) + """SELECT event_type, count(*) AS n FROM (
  SELECT DISTINCT * FROM (SELECT * FROM lv_events UNION ALL SELECT * FROM lv_events))
GROUP BY event_type"""
    likes = _typed_tumbling("like")
    sliding_zero = _with(LV_EVENTS, SLIDING_CTE) + """, firsts AS (
  SELECT video_id, event_type, min(window_start) AS first_start FROM sliding GROUP BY ALL),
last_start AS (SELECT max(window_start) AS last_start FROM sliding),
grid AS (
  SELECT video_id, event_type, unnest(generate_series(first_start, last_start, INTERVAL '2 hours')) AS window_start
  FROM firsts, last_start)
SELECT g.video_id, g.event_type, g.window_start, CAST(coalesce(s.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN sliding s USING (video_id, event_type, window_start)"""
    return {
        "likes_tumbling": likes,
        "dislikes_tumbling": _typed_tumbling("dislike"),
        "sliding_counts": _with(LV_EVENTS, SLIDING_CTE) + "SELECT video_id, event_type, window_start, n FROM sliding",
        "sliding_counts_zero": sliding_zero,
        "comment_sliding_counts": _with(LV_COMMENTS) + """SELECT video_id,
  time_bucket(INTERVAL '20 seconds', ts) - i * INTERVAL '20 seconds' AS window_start, count(*) AS n
FROM lv_comments, (SELECT unnest([0, 1, 2]) AS i) steps GROUP BY ALL""",
        "net_viewer_change": _with(LV_EVENTS) + """SELECT video_id,
  time_bucket(INTERVAL '2 hours', ts) - i * INTERVAL '2 hours' AS window_start,
  CAST(sum(CASE WHEN event_type = 'play' THEN 1 ELSE -1 END) AS BIGINT) AS net
FROM lv_events, (SELECT unnest([0, 1, 2]) AS i) steps
WHERE event_type IN ('play', 'leave') GROUP BY ALL""",
        "running_totals": totals,
        "concurrent_views": _with(LV_EVENTS, CONCURRENT_CTE) + "SELECT * FROM concurrent",
        "play_running_count": _running("play"),
        "leave_running_count": _running("leave"),
        "viewer_timeline": _with(LV_EVENTS) + """SELECT event_id, video_id, ts, user_id, latitude, longitude,
  CAST(sum(CASE WHEN event_type = 'play' THEN 1 ELSE -1 END)
       OVER (PARTITION BY video_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS viewers
FROM lv_events WHERE event_type IN ('play', 'leave')""",
        "latest_start": _latest_record("start_video"),
        "latest_end": _latest_record("end_video"),
        "latest_likes": _with(LV_EVENTS) + """SELECT video_id, max(window_start) AS window_start,
  arg_max(n, window_start) AS n
FROM (SELECT video_id, time_bucket(INTERVAL '6 hours', ts) AS window_start, count(*) AS n
      FROM lv_events WHERE event_type = 'like' GROUP BY ALL) GROUP BY video_id""",
        "likes_as_of": _with(LV_EVENTS) + """, lw AS (
  SELECT video_id, time_bucket(INTERVAL '6 hours', ts) AS window_start, count(*) AS n
  FROM lv_events WHERE event_type = 'like' GROUP BY ALL)
SELECT k.video_id, CAST(coalesce(cur.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT video_id FROM lw) k
LEFT JOIN (SELECT video_id, n FROM lw WHERE window_start = (SELECT max(window_start) FROM lw)) cur USING (video_id)""",
        "routed_counts": _with(LV_EVENTS, LV_COMMENTS) + f"""SELECT topic, count(*) AS n FROM (
  SELECT {_topic_case()} AS topic
  FROM (SELECT event_type FROM lv_events UNION ALL SELECT 'comment' AS event_type FROM lv_comments))
WHERE topic IS NOT NULL GROUP BY topic""",
        "envelope_roundtrip": _with(LV_EVENTS) + "SELECT event_id, ts, user_id, video_id, event_type, latitude, longitude FROM lv_events",
        "comment_sentences": _with(LV_COMMENTS, SENTENCES)
        + "SELECT video_id, sentence, count(*) AS n FROM sentences GROUP BY ALL",
        "token_lists": _with(LV_COMMENTS, SENTENCES) + """SELECT video_id, window_start, count(*) AS n_sentences,
  CAST(sum(len(regexp_extract_all(sentence, '[A-Za-z]+|[.?!]'))) AS BIGINT) AS n_tokens
FROM sentences GROUP BY ALL""",
        "sentence_tokens": _with(LV_COMMENTS, SENTENCES) + """SELECT video_id, window_start, sentence,
  array_to_string(regexp_extract_all(sentence, '[A-Za-z]+|[.?!]'), ' ') AS tokens FROM sentences""",
        "word_counts": _with(LV_COMMENTS, LV_STOP_WORDS, WORDS, WORD_COUNTS) + "SELECT * FROM word_counts",
        "top_words": _with(LV_COMMENTS, LV_STOP_WORDS, WORDS, WORD_COUNTS, TOP) + "SELECT * FROM top",
        "sentence_sentiment": _with(LV_COMMENTS, SENTENCES, WORDS, LEXICON, HISTOGRAM_ALL) + "SELECT * FROM histogram",
        "mean_sentiment": _with(LV_COMMENTS, SENTENCES, WORDS, LEXICON, HISTOGRAM_ALL, MEAN) + "SELECT * FROM mean_sent",
        "sampled_sentiment": sampled_sentiment,
        "sampled_sentiment_stream": sampled_sentiment,
        "keep_probability": _with(LV_COMMENTS, PROBS) + "SELECT * FROM probs",
        "sampled_sentences": _with(LV_COMMENTS, SENTENCES, PROBS, SAMPLED)
        + "SELECT video_id, window_start, count(*) AS n FROM sampled GROUP BY ALL",
        "document_top_words": _with(LV_DOCUMENTS, LV_STOP_WORDS, WORDS, WORD_COUNTS, TOP) + "SELECT * FROM top",
        "document_sentiment": _with(LV_DOCUMENTS, SENTENCES, WORDS, LEXICON, HISTOGRAM_ALL, MEAN) + "SELECT * FROM mean_sent",
        "map_features": _map_features(),
        "popup_text": _popup_text(),
        "unlocated_videos": _with(LV_EVENTS) + """SELECT video_id, first_play, first_start FROM (
  SELECT video_id, min(ts) FILTER (WHERE event_type = 'play') AS first_play,
         min(ts) FILTER (WHERE event_type = 'start_video') AS first_start
  FROM lv_events WHERE event_type IN ('play', 'start_video') GROUP BY video_id)
WHERE first_play IS NOT NULL AND (first_start IS NULL OR first_start > first_play)""",
        "events_sorted": _with(LV_EVENTS)
        + "SELECT event_id, ts, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS pos FROM lv_events",
        "dedup_events": unique_events,
        "dedup_events_stream": unique_events,
        "geo_cells": _with(LV_EVENTS) + """SELECT CAST(floor(latitude / 2) AS BIGINT) AS cell_lat,
  CAST(floor(longitude / 2) AS BIGINT) AS cell_lon, time_bucket(INTERVAL '6 hours', ts) AS window_start,
  count(*) FILTER (WHERE event_type = 'play') AS plays, count(*) FILTER (WHERE event_type = 'like') AS likes
FROM lv_events WHERE event_type IN ('play', 'like') GROUP BY ALL""",
        "comment_index": _with(LV_COMMENTS, WORDS) + "SELECT word, video_id, count(*) AS n FROM words GROUP BY ALL",
        "comment_search": _with(LV_COMMENTS, WORDS)
        + f"SELECT word, video_id, count(*) AS n FROM words WHERE word IN ({search}) GROUP BY ALL",
        "likes_tumbling_stream": likes,
        "sliding_counts_stream": _with(LV_EVENTS, SLIDING_CTE) + "SELECT video_id, event_type, window_start, n FROM sliding",
        "totals_stream": totals,
        "totals_levelled_stream": totals,
        "sliding_counts_zero_stream": sliding_zero,
        "play_running_count_stream": _running("play"),
        "viewer_timeline_stream": _with(LV_EVENTS, TIMELINE) + "SELECT event_id, video_id, viewers FROM timeline",
        "viewer_lows": _with(LV_EVENTS, TIMELINE) + """SELECT video_id, min(viewers) AS lowest,
  first(ts ORDER BY viewers, ts) AS lowest_at, min(ts) FILTER (WHERE viewers < 0) AS negative_at
FROM timeline GROUP BY video_id""",
        "box_search": _with(LV_EVENTS) + f"SELECT event_id, video_id, event_type, latitude, longitude FROM lv_events WHERE {_in_box('narrow')}",
        "box_counts": _box_counts(),
        "learned_sentiment": _with(LV_COMMENTS, SENTENCES, WORDS, LEXICON, HISTOGRAM_ALL, LEARNED)
        + "SELECT video_id, window_start, CAST(class AS BIGINT) AS sentiment_class, count(*) AS n FROM learned GROUP BY ALL",
        "token_list_chunks": _with(LV_COMMENTS, SENTENCES) + f"""SELECT video_id, window_start, place // {CHUNK} AS chunk, string_agg(token, ' ' ORDER BY place) AS tokens
FROM (SELECT video_id, window_start, token, row_number() OVER (PARTITION BY video_id, window_start ORDER BY ts, pos, nth, token) - 1 AS place
      FROM (SELECT video_id, window_start, ts, pos, unnest(t) AS token, generate_subscripts(t, 1) AS nth
            FROM (SELECT *, regexp_extract_all(sentence, '[A-Za-z]+|[.?!]') AS t FROM sentences)))
GROUP BY ALL""",
        "score_list_chunks": _with(LV_COMMENTS, SENTENCES, WORDS, LEXICON, HISTOGRAM_ALL) + f"""SELECT video_id, window_start, place // {CHUNK} AS chunk,
  string_agg(CAST(sentiment_class AS VARCHAR), ' ' ORDER BY place) AS classes
FROM (SELECT s.video_id, s.window_start, c.sentiment_class,
             row_number() OVER (PARTITION BY s.video_id, s.window_start ORDER BY s.ts, s.pos, s.sentence) - 1 AS place
      FROM sentences s JOIN classes c USING (sentence))
GROUP BY ALL""",
        "all_words_search": _all_words(),
        "phrase_search": _phrases(),
        "word_counts_levelled_stream": _with(LV_COMMENTS, LV_STOP_WORDS, WORDS, WORD_COUNTS) + "SELECT * FROM word_counts",
        "totals_bucketed_stream": totals,
    }
