"""Stream transforms. Each is a plain DataFrame -> DataFrame function, so
the same code runs on a streaming DataFrame and on a batch one (tests compare
the two)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.text import split_on_space
from kestrel.functions.time import ntz_as_utc, utc_text

# Default text the relay puts before every message value; pass ``prefix`` to
# use another one.
RELAY_PREFIX = "relay:"


def words(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.select(F.explode(split_on_space(F.col(col))).alias("word"))


def word_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """Word counts; on a stream in update/complete mode this is the running
    total per word over the whole stream."""
    return words(lines, col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def with_event_time(df: DataFrame, ts_col: str = "ts", out: str = "event_time",
                    delay: str | None = "1 hour") -> DataFrame:
    """Event-time column as a UTC instant (``timestamp_ntz`` is rejected by
    ``withWatermark``) plus a watermark of ``delay`` so window state can be
    dropped once no more rows can arrive for it. Rows later than that are dropped:
    a replay of a stored table, whose files come in any order, passes None."""
    df = df.withColumn(out, ntz_as_utc(F.col(ts_col)))
    return df.withWatermark(out, delay) if delay else df


def window_counts(df: DataFrame, key: str, length: str, slide: str | None = None,
                  time_col: str = "event_time") -> DataFrame:
    """Rows per (window, key): tumbling when ``slide`` is None, else sliding
    (each row counted in every window that covers it). Window bounds are UTC
    text. Zero-count windows never appear."""
    w = F.window(time_col, length, slide) if slide else F.window(time_col, length)
    return (df.groupBy(w.alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(utc_text("w.start").alias("window_start"),
                    utc_text("w.end").alias("window_end"), key, "n"))


def relay(messages: DataFrame, prefix: str = RELAY_PREFIX, value_col: str = "value") -> DataFrame:
    """Prefix every message value; the key is dropped and a NULL value is
    written as the text ``null``."""
    return messages.select(
        F.concat(F.lit(prefix), F.coalesce(F.col(value_col).cast("string"), F.lit("null"))).alias("value"))


def offset_ranges(batch: DataFrame) -> DataFrame:
    """Offset range of a batch per (topic, partition): first offset and one
    past the last."""
    return (batch.groupBy("topic", "partition")
            .agg(F.min("offset").alias("from_offset"),
                 (F.max("offset") + 1).alias("until_offset")))


def resume_positions(ledger: DataFrame, earliest: DataFrame) -> DataFrame:
    """Start offset per (topic, partition) for a restart: the saved position
    (largest ``until_offset`` recorded), moved up to the earliest retained
    offset when older data has expired; -1 (latest) when nothing is saved.

    ``earliest`` has (topic, partition, earliest_offset)."""
    saved = ledger.groupBy("topic", "partition").agg(F.max("until_offset").alias("saved"))
    j = saved.join(earliest, ["topic", "partition"], "full")
    start = (F.when(F.col("saved").isNull(), F.lit(-1).cast("bigint"))
             .when(F.col("earliest_offset").isNull(), F.col("saved"))
             .otherwise(F.greatest("saved", "earliest_offset")))
    return j.select("topic", "partition", start.alias("start_offset"))


def starting_offsets_json(positions: DataFrame) -> DataFrame:
    """One row with the Kafka ``startingOffsets`` JSON for the positions
    (one entry per partition, so the row stays small)."""
    per_topic = (positions.groupBy("topic")
                 .agg(F.map_from_entries(F.collect_list(F.struct(
                     F.col("partition").cast("string"), F.col("start_offset")))).alias("m")))
    return per_topic.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "m"))))
                         .alias("starting_offsets"))
