"""Message envelope: ``[video_id, "<event json>\\n"]`` and event parsing.

Parsing uses ``from_json`` with a fixed schema, never string positions, so
commas, braces or field names inside comments cannot shift fields.
Malformed values decode to null and are filtered (and can be counted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.schema import EVENT_SCHEMA, SECONDS_PER_SIM_UNIT

ENVELOPE_TYPE = "array<string>"


def event_time(sim_ts: Column, base: str = "1970-01-01 00:00:00",
               seconds_per_unit: float = SECONDS_PER_SIM_UNIT) -> Column:
    """Simulator clock -> zone-less event time: base + timestamp * unit, to
    the nearest microsecond."""
    micros = F.round(sim_ts * F.lit(seconds_per_unit * 1_000_000)).cast("bigint")
    return (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)")))


def sim_timestamp(ts: Column, base: str = "1970-01-01 00:00:00",
                  seconds_per_unit: float = SECONDS_PER_SIM_UNIT) -> Column:
    """Inverse of ``event_time`` (zone-less ``ts``)."""
    micros = (ts - F.lit(base).cast("timestamp_ntz")).cast("interval second").cast("decimal(20,6)") * 1_000_000
    return micros.cast("double") / F.lit(seconds_per_unit * 1_000_000)


def envelope_key_text(value: Column) -> Column:
    """Message key read from the text of the value, without parsing JSON:
    the leading integer of ``[id, ...]`` (null when absent)."""
    k = F.regexp_extract(value.cast("string"), r"^\[\s*(\d+)", 1)
    return F.when(k != "", k)


def sim_time_bucket(sim_ts: Column, per_unit: int = 10) -> Column:
    """Replay pacing bucket of the simulator clock: floor(t * n) / n."""
    return F.floor(sim_ts * per_unit) / F.lit(float(per_unit))


def decode_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """value (string or binary) -> key, payload.  Junk -> null columns."""
    arr = F.from_json(F.col(value).cast("string"), ENVELOPE_TYPE)
    return df.withColumn("_env", arr).select(
        "*", F.col("_env")[0].alias("key"), F.col("_env")[1].alias("payload")
    ).drop("_env")


def parse_payload(df: DataFrame, payload: str = "payload", base: str = "1970-01-01 00:00:00",
                  seconds_per_unit: float = SECONDS_PER_SIM_UNIT) -> DataFrame:
    """payload json -> typed event columns (+ ``ts``); rows that do not parse
    or have no event type / video are dropped.

    The JSON is parsed exactly once: a plain ``where`` on the parsed fields
    would be pushed below the projection and re-parse the payload for each
    tested field.  Filtering a one-element array and exploding it keeps the
    parse in one place (a generator is not crossed by filter pushdown).
    """
    ev = F.from_json(F.col(payload), EVENT_SCHEMA)
    valid = F.filter(F.array(ev), lambda e: e["event_type"].isNotNull() & e["video_id"].isNotNull())
    rest = [c for c in df.columns]
    out = df.select(*rest, F.explode(valid).alias("_ev")).select(
        *rest,
        *[F.col(f"_ev.{f.name}").alias(f.name) for f in EVENT_SCHEMA.fields],
    )
    return out.withColumn("ts", event_time(F.col("timestamp"), base, seconds_per_unit))


def parse_events(df: DataFrame, value: str = "value", base: str = "1970-01-01 00:00:00",
                 seconds_per_unit: float = SECONDS_PER_SIM_UNIT) -> DataFrame:
    """Envelope value -> parsed event rows (P1-P3)."""
    return parse_payload(decode_envelope(df, value), "payload", base, seconds_per_unit)


def encode_payload(df: DataFrame) -> Column:
    """Event columns -> json line (null ``comment`` is left out)."""
    present = [f.name for f in EVENT_SCHEMA.fields if f.name in df.columns]
    return F.concat(F.to_json(F.struct(*present)), F.lit("\n"))


def encode_envelope(df: DataFrame, key: str = "video_id") -> DataFrame:
    """Add ``key`` (string) and ``value`` = ``[key, "<json>\\n"]``."""
    payload = encode_payload(df)
    quoted = F.expr("substring(to_json(array(_payload)), 2)")  # '"...escaped..."]'
    return (
        df.withColumn("_payload", payload)
        .withColumn("key", F.col(key).cast("string"))
        .withColumn("value", F.concat(F.lit("["), F.col("key"), F.lit(", "), quoted))
        .drop("_payload")
    )


def _is_bad(payload: Column) -> Column:
    ev = F.from_json(payload, EVENT_SCHEMA)
    return ev["event_type"].isNull() | ev["video_id"].isNull()


def bad_record_count(df: DataFrame, value: str = "value", envelope: bool = True) -> DataFrame:
    """(source, n): rows whose ``value`` the readers drop, because it is not
    a valid event (in an envelope, or as a plain JSON line), per topic where
    the rows have one."""
    rows = decode_envelope(df, value) if envelope else df.withColumn("payload", F.col(value))
    source = F.col("topic") if "topic" in df.columns else F.lit("lines")
    return rows.groupBy(source.alias("source")).agg(F.count_if(_is_bad(F.col("payload"))).alias("n"))
