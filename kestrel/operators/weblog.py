"""CDN access-log analytics: top IPs, distinct IPs, distinct visitors per
video, traffic per hour.

Input is a text-line DataFrame with one ``value`` column (``spark.read.text``
shape). Every aggregate is a built-in with partial (map-side) aggregation, so
a hot IP or video only costs one partial row per task before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions import weblog as W
from kestrel.operators.ranking import top_k


def parse_log(lines: DataFrame, year: str = W.DEFAULT_LOG_YEAR) -> DataFrame:
    """Parse once into (ip, video, hour, bytes, is_video, has_size). Columns
    that a caller does not select are pruned by the optimizer, so unused
    regexes never run."""
    v = F.col("value")
    return lines.select(
        W.extract_ip(v).alias("ip"),
        F.when(W.is_video_line(v), W.extract_video(v)).alias("video"),
        F.when(W.has_status_and_size(v), W.extract_hour(v, year)).alias("hour"),
        F.when(W.has_status_and_size(v), W.extract_size(v)).alias("bytes"),
    )


def ip_hits(lines: DataFrame, k: int = 10) -> DataFrame:
    """Requests per IP, the ``k`` most frequent (ties by IP). Lines without an
    IP are skipped instead of failing the job.

    The NULL group is dropped after the aggregation through an aggregate
    (``count(ip) = 0`` only there): a filter on the grouping column itself
    would be pushed below the projection and evaluate the regex twice."""
    counts = (lines.select(W.extract_ip(F.col("value")).alias("ip"))
              .groupBy("ip").agg(F.count(F.lit(1)).alias("hits"), F.count("ip").alias("_n"))
              .where(F.col("_n") > 0).drop("_n"))
    return top_k(counts, [F.desc("hits"), F.asc("ip")], k)


def unresolved_lines(lines: DataFrame) -> DataFrame:
    """Count of lines without any IP (the reference would abort on them)."""
    return (lines.where(W.extract_ip(F.col("value")).isNull())
            .agg(F.count(F.lit(1)).alias("lines_without_ip")))


def unique_ips(lines: DataFrame) -> DataFrame:
    """Number of distinct IPs (one row)."""
    return (lines.select(W.extract_ip(F.col("value")).alias("ip"))
            .agg(F.countDistinct("ip").alias("unique_ips")))


def video_ips(lines: DataFrame, k: int = 10) -> DataFrame:
    """Distinct visiting IPs per video, the ``k`` videos with most visitors.
    Distinct is planned as (video, ip) dedup then count, so one popular video
    is spread over the shuffle by its IPs. NULL IPs are not counted; a video
    seen only without IPs is dropped after the aggregation."""
    v = F.col("value")
    per_video = (lines.where(W.is_video_line(v))
                 .select(W.extract_video(v).alias("video"), W.extract_ip(v).alias("ip"))
                 .groupBy("video").agg(F.countDistinct("ip").alias("ips"))
                 .where(F.col("ips") > 0))
    return top_k(per_video, [F.desc("ips"), F.asc("video")], k)


def hour_flow(lines: DataFrame, year: str = W.DEFAULT_LOG_YEAR) -> DataFrame:
    """Bytes served per hour of day for 200/206/304 responses, with whole GiB.
    Lines whose hour or size does not parse are left out (count them with
    :func:`unparsed_flow_lines`). Ordered by hour.

    One pass, each pattern evaluated once per line: the size is NULL unless
    the status/size pattern matches and fits a bigint, so grouping by hour and
    keeping only hours with counted sizes equals filtering the lines first."""
    v = F.col("value")
    parsed = lines.select(W.extract_hour(v, year).alias("hour"), W.extract_size(v).alias("bytes"))
    # count(hour) is 0 only for the NULL hour; filtering on it (not on the
    # grouping column) keeps the hour regex from being pushed into a filter
    return (parsed.groupBy("hour")
            .agg(F.sum("bytes").alias("bytes"), F.count("bytes").alias("requests"),
                 F.count("hour").alias("_nh"))
            .where((F.col("_nh") > 0) & (F.col("requests") > 0))
            .withColumn("gib", F.expr(f"bytes div {W.GIB}"))
            .select("hour", "bytes", "gib", "requests")
            .orderBy("hour"))


def unparsed_flow_lines(lines: DataFrame, year: str = W.DEFAULT_LOG_YEAR) -> DataFrame:
    v = F.col("value")
    return (lines.where(W.has_status_and_size(v))
            .where(W.extract_hour(v, year).isNull() | W.extract_size(v).isNull())
            .agg(F.count(F.lit(1)).alias("unparsed_lines")))
