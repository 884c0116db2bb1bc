"""Run every serving-table stream of the dashboard in one application.

    python -m vidpulse.streaming.app --events DIR --comments DIR --out ROOT
    python -m vidpulse.streaming.app --kafka HOST:PORT --out ROOT

File sources take newline-delimited JSON event lines (``--events``; comment
events are taken from the same folder unless ``--comments`` names a separate
one).  With ``--kafka`` each output subscribes to its own topics.  Malformed
records are counted in the ``bad_records`` table.
``--archive`` also writes the raw events (parquet by topic and date), the
input of ``plans.replay``.  ``--once`` processes what is there and stops
(availableNow); otherwise the queries run on a processing-time trigger
until one of them stops.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from vidpulse.operators.routing import comments_of, route_events
from vidpulse.operators.misc import dedup_events, dedup_forever
from vidpulse.schema import SECONDS_PER_SIM_UNIT, STOP_WORDS, TOPIC_OF_TYPE
from vidpulse.session import build_session, checkpoint_root
from vidpulse.sources.events import kafka_options, read_event_lines, read_kafka, read_raw_lines
from vidpulse.streaming.jobs import await_any, start_all, start_bad_record_count, with_event_time
from vidpulse.streaming.sinks import archive_sink


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--events", help="folder of JSON event lines")
    p.add_argument("--comments", help="separate folder of comment event lines (default: from --events)")
    p.add_argument("--kafka", help="bootstrap servers; read all topics")
    p.add_argument("--lexicon", required=True, help="parquet table (word, score)")
    p.add_argument("--out", help="root folder of the serving tables (default: under spark.checkpoint.dir)")
    p.add_argument("--window", default="10 seconds", help="reaction window")
    p.add_argument("--trigger", default="10 seconds", help="processing-time trigger")
    p.add_argument("--capacity", type=int, help="words per comment window before sampling (default: no sampling)")
    p.add_argument("--exact-windows", action="store_true",
                   help="comment statistics per closed event-time window (one window of latency)")
    p.add_argument("--dedup", metavar="DELAY", help="drop re-delivered events that come within this delay, e.g. '10 minutes', or 'forever'")
    p.add_argument("--seconds-per-unit", type=float, default=SECONDS_PER_SIM_UNIT, help="seconds per unit of the event clock")
    p.add_argument("--totals-seed", help="parquet table of totals per video to go on from")
    p.add_argument("--archive", help="also archive the raw events here (parquet by topic and date)")
    p.add_argument("--once", action="store_true", help="process available input and stop")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)

    spark = build_session(a.master)
    root = a.out or f"{checkpoint_root(spark)}/serving"

    def source(types: list[str]):
        """Events of these types: from their topics, or from the event lines."""
        if a.kafka:
            found = read_kafka(spark, a.kafka, [TOPIC_OF_TYPE[t] for t in types], seconds_per_unit=a.seconds_per_unit)
        else:
            path = a.comments if a.comments and types == ["comment"] else a.events
            found = read_event_lines(spark, path, streaming=True, seconds_per_unit=a.seconds_per_unit)
            found = found.where(F.col("event_type").isin(types))
        if a.dedup == "forever":
            return dedup_forever(found)
        return dedup_events(with_event_time(found, a.dedup), watermark=a.dedup) if a.dedup else found

    comments = comments_of(source(["comment"])).select("video_id", "ts", "comment")
    trigger = {"availableNow": True} if a.once else {"processingTime": a.trigger}
    lexicon = spark.read.parquet(a.lexicon)
    seed = spark.read.parquet(a.totals_seed) if a.totals_seed else None
    queries, tables = start_all(source, comments, root, lexicon, STOP_WORDS, a.window, trigger, a.capacity,
                                a.exact_windows, seed)
    if a.kafka:
        raw = spark.readStream.format("kafka").options(**kafka_options(a.kafka)).load()
    else:
        raw = read_raw_lines(spark, a.events, streaming=True)
    q, tables["bad_records"] = start_bad_record_count(raw, root, trigger, envelope=bool(a.kafka))
    queries.append(q)
    if a.archive:
        archived = route_events(source(list(TOPIC_OF_TYPE)))
        queries.append(archive_sink(archived, a.archive, f"{root}/_checkpoints/archive", trigger))
    if a.once:
        for q in queries:
            q.awaitTermination()
    else:
        await_any(spark)
    return tables


if __name__ == "__main__":
    main()
