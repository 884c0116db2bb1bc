"""The map dashboard on live data: the same rows as ``dashboard.map_features``
assembled from the newest snapshots of the serving tables that
``streaming.jobs.start_all`` maintains (no stream-stream joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.operators.counts import latest_window
from vidpulse.operators.text import top_words_text
from vidpulse.plans.dashboard import KEY, DashboardInputs, map_features, popup_text, videos_from_serving
from vidpulse.streaming.jobs import read_comment_views
from vidpulse.streaming.sinks import UpsertTable


def live_inputs(spark: SparkSession, tables: dict[str, UpsertTable], k: int = 5,
                since: str | None = None) -> DashboardInputs:
    """Newest facts per video.  Words are ranked and sentiment averaged for
    each video's newest comment window only; ``since`` (a date) also keeps
    older folders from being listed."""
    totals = tables["totals"].read(spark)
    plays = totals.select(KEY, F.col("plays").alias("n")).where(F.col("n") > 0)
    leaves = totals.select(KEY, F.col("leaves").alias("n"))
    likes = latest_window(tables["recent_likes"].read(spark, since))
    dislikes = latest_window(tables["recent_dislikes"].read(spark, since))
    videos = videos_from_serving(plays, leaves, tables["video_start"].read(spark), likes, dislikes)

    newest = tables["comment_tokens"].read(spark, since).groupBy(KEY).agg(F.max("window_start").alias("window_start"))
    views = read_comment_views(spark, tables, k, since, newest)
    text = top_words_text(views["comment_words"])
    words = newest.join(text, [KEY, "window_start"], "left").select(
        KEY, F.coalesce("words", F.lit("[]")).alias("words"))
    return DashboardInputs(videos=videos, words=words, sentiment=views["comment_sentiment"].select(KEY, "score"))


def live_map_features(spark: SparkSession, tables: dict[str, UpsertTable], k: int = 5,
                      since: str | None = None) -> DataFrame:
    return map_features(live_inputs(spark, tables, k, since))


def live_popup_text(spark: SparkSession, tables: dict[str, UpsertTable], k: int = 5,
                    since: str | None = None) -> DataFrame:
    return popup_text(live_inputs(spark, tables, k, since))


def register_serving_views(spark: SparkSession, tables: dict[str, UpsertTable]) -> list[str]:
    """Temp views over the newest state of every serving table (named like
    the tables) for ``spark.sql``."""
    for name, t in tables.items():
        t.read(spark).createOrReplaceTempView(name)
    return list(tables)


def main(argv: list[str] | None = None) -> None:
    """python -m vidpulse.plans.live --serving ROOT [--out PATH] [--popup]

    Build the map table (or the popup texts) from the serving tables under
    ROOT and write it as parquet to PATH, or print the first rows."""
    import argparse

    from vidpulse.session import build_session
    from vidpulse.streaming.jobs import serving_tables

    p = argparse.ArgumentParser(description="Dashboard table from the serving tables")
    p.add_argument("--serving", required=True)
    p.add_argument("--out")
    p.add_argument("--popup", action="store_true", help="popup texts instead of map features")
    p.add_argument("--since", help="read windows from this date on")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = build_session(a.master)
    tables = serving_tables(a.serving)
    df = (live_popup_text if a.popup else live_map_features)(spark, tables, since=a.since)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(20, truncate=False)


if __name__ == "__main__":
    main()
