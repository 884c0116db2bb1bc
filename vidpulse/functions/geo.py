"""Map marker expressions: size, rectangle corners, colour ramp, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vidpulse.schema import (
    COLOR_LEVELS,
    COLOR_MAX,
    COLOR_MIN,
    CORNER_OFFSETS,
    LABEL_PREFIXES,
    NO_SENTIMENT_TEXT,
    NO_WORDS_TEXT,
    VIEWS_FOR_FULL_SIZE,
)


def marker_size(views: Column) -> Column:
    """min(views / 5000, 1); not floored, so negative views (out-of-order
    logs) give a mirrored rectangle as on the original map."""
    return F.least(views / F.lit(VIEWS_FOR_FULL_SIZE), F.lit(1.0))


def corner_columns(lat: Column, lon: Column, size: Column) -> list[Column]:
    """c1_lat, c1_lon, ..., c4_lat, c4_lon for the four rectangle corners."""
    cols = []
    for i, (dx, dy) in enumerate(CORNER_OFFSETS, start=1):
        cols.append((lat + F.lit(dy) * size).alias(f"c{i}_lat"))
        cols.append((lon + F.lit(dx) * size).alias(f"c{i}_lon"))
    return cols


def color_level(value: Column) -> Column:
    """floor(356 * (value - 1) / 100), clamped to 0..356."""
    raw = F.floor(F.lit(COLOR_LEVELS) * (value - F.lit(COLOR_MIN)) / F.lit(COLOR_MAX))
    return F.greatest(F.lit(0), F.least(F.lit(COLOR_LEVELS), raw)).cast("bigint")


def color_ramp(value: Column) -> Column:
    """Blue (#4266f4) to magenta (#f466f4) to red (#f46642)."""
    lvl = color_level(value)
    low = F.concat(F.lit("#"), F.lower(F.hex(F.lit(66) + lvl)), F.lit("66f4"))
    high = F.concat(F.lit("#f466"), F.lower(F.hex(F.lit(422) - lvl)))
    return F.when(lvl < 179, low).otherwise(high)


def popup_labels(views: Column, plays: Column, likes: Column, dislikes: Column,
                 words: Column, sentiment: Column) -> list[Column]:
    """The six click-popup strings."""
    values = [
        views.cast("string"),
        plays.cast("string"),
        likes.cast("string"),
        dislikes.cast("string"),
        F.coalesce(words, F.lit(NO_WORDS_TEXT)),
        F.coalesce(sentiment.cast("string"), F.lit(NO_SENTIMENT_TEXT)),
    ]
    names = ["label_views", "label_total", "label_likes", "label_dislikes", "label_words", "label_sentiment"]
    return [F.concat(F.lit(p), v).alias(n) for p, v, n in zip(LABEL_PREFIXES, values, names)]
