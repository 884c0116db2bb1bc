"""Schemas, topic names and fixed word lists."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire form of one event line (newline-delimited JSON).  ``timestamp`` is the
# simulator's unitless clock; ``comment`` is absent on non-comment events.
# ``event_id`` is optional: wire lines carry none, the fixture tables do.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("video_id", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("comment", T.StringType()),
        T.StructField("event_id", T.LongType()),
    ]
)

# Columns of a parsed event frame used by every operator.
EVENT_COLUMNS = ["event_id", "ts", "user_id", "video_id", "event_type", "latitude", "longitude"]

# The seven event types and the topic each one is routed to.
EVENT_TYPES = ["start_video", "end_video", "play", "leave", "like", "dislike", "comment"]
TOPIC_OF_TYPE = {
    "comment": "comments_topic",
    "start_video": "start_topic",
    "end_video": "end_topic",
    "dislike": "dislike_topic",
    "like": "like_topic",
    "play": "play_topic",
    "leave": "leave_topic",
}

# Seconds of wall time per unit of the simulator clock when the
# producer replays at its default density (0.1 unit per second).
SECONDS_PER_SIM_UNIT = 10.0

# Stop words removed before the top-word report (the NLTK
# English list plus dashboard-specific words), distinct, in natural order.
STOP_WORDS = [
    "all", "just", "being", "over", "both", "through", "yourselves",
    "its", "before", "o", "hadn", "herself", "ll", "had", "should", "to", "only", "won",
    "under", "ours", "has", "do", "them", "his", "very", "they", "not", "during", "now",
    "him", "nor", "d", "did", "didn", "this", "she", "each", "further", "where", "few",
    "because", "doing", "some", "hasn", "are", "our", "ourselves", "out", "what", "for",
    "while", "re", "does", "above", "between", "mustn", "t", "be", "we", "who", "were",
    "here", "shouldn", "hers", "by", "on", "about", "couldn", "of", "against", "s", "isn",
    "or", "own", "into", "yourself", "down", "mightn", "wasn", "your", "from", "her", "their",
    "aren", "there", "been", "whom", "too", "wouldn", "themselves", "weren", "was", "until",
    "more", "himself", "that", "but", "don", "with", "than", "those", "he", "me", "myself", "ma",
    "these", "up", "will", "below", "ain", "can", "theirs", "my", "and", "ve", "then", "is", "am",
    "it", "doesn", "an", "as", "itself", "at", "have", "in", "any", "if", "again", "no", "when",
    "same", "how", "other", "which", "you", "shan", "needn", "haven", "after", "most", "such",
    "why", "a", "off", "i", "m", "yours", "so", "y", "the", "having", "once",
    "wrappedarray", "comment", "like", "film", "movie", "think", "br", "one", "would", "much",
    "txt", "even", "u", "thought", "k", "really", "know", "get", "n", "good", "bad", "made",
]

# Dashboard texts (the viewer label keeps its original spelling).
NO_WORDS_TEXT = "Comments yet to come"
NO_SENTIMENT_TEXT = "Sentiment score yet to come"
LABEL_PREFIXES = [
    "Concurent viewers: ",
    "Total viewers: ",
    "Recent likes: ",
    "Recent dislikes: ",
    "Top popular words: ",
    "Sentiment score: ",
]

# Map marker geometry and colour scale.
VIEWS_FOR_FULL_SIZE = 5000.0
CORNER_OFFSETS = [(-1.5, -1.0), (-1.5, 1.0), (1.5, 1.0), (1.5, -1.0)]  # (d_lon, d_lat)
COLOR_MIN, COLOR_MAX = 1, 100
COLOR_LEVELS = 356

# Comment sampling capacity (words per comment window).
SENTIMENT_WORD_CAPACITY = 5000
