"""Deterministic derivations of the reference's inputs from the generated
tables. Each derivation is plain column arithmetic over a scan, so its work
grows with the table and the scan keeps column pruning and pushdown.

The same derivations are written as DuckDB SQL in :mod:`kestrel.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.functions.time import ntz_as_utc
from kestrel.sources.tables import table

# --- fixed values for the synthetic log layouts -----------------------------
LOG_YEAR_TEXT = "2017"                 # year written into every CDN log line
LOG_VIDEO_FILES = 40                   # video file = event_id mod 40
ADS_PROVINCES = 7                      # province = user_id mod 7
ADS_CITIES = 3                         # city = user_id mod 3
ADS_ADS = 25                           # ad = event_id mod 25
BASKET_ITEMS = 20                      # basket item = partkey mod 20
# -----------------------------------------------------------------------------


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def log_ip(user_id: F.Column) -> F.Column:
    """IPv4 text ``10.a.b.c`` made of the low three bytes of the user id."""
    return F.concat(F.lit("10."),
                    _s(F.shiftright(user_id, 16) % 256), F.lit("."),
                    _s(F.shiftright(user_id, 8) % 256), F.lit("."),
                    _s(user_id % 256))


def cdn_line() -> F.Column:
    """The CDN access-log line of an event:
    ``ip HIT ms [dd/Mon/2017:HH:mm:ss +0800] "GET url HTTP/1.1" status bytes "-" "agent"``.
    Views and clicks request ``<event_id mod 40>.mp4``; other events a page."""
    et = F.col("event_type")
    url = (F.when(et.isin("view", "click"),
                  F.concat(F.lit("http://cdn.example/video/"),
                           _s(F.col("event_id") % LOG_VIDEO_FILES), F.lit(".mp4")))
           .otherwise(F.concat(F.lit("http://cdn.example/"), et, F.lit(".html"))))
    status = (F.when(et == "error", F.lit("404"))
              .when(et == "view", F.lit("206"))
              .otherwise(F.lit("200")))
    size = F.floor(F.col("value") * 1000).cast("bigint")
    return F.concat(
        log_ip(F.col("user_id")), F.lit(" HIT "), _s(F.col("event_id") % 1000),
        F.lit(" ["), F.date_format("ts", f"dd/MMM/'{LOG_YEAR_TEXT}':HH:mm:ss"), F.lit(" +0800] \"GET "),
        url, F.lit(" HTTP/1.1\" "), status, F.lit(" "), _s(size),
        F.lit(" \"-\" \"Mozilla/5.0\""))


def cdn_log_lines(events: DataFrame) -> DataFrame:
    """One line per event (``value`` column, text-scan shape)."""
    return events.select(cdn_line().alias("value"))


def damaged_cdn_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of which those of signups have lost their address and those of
    purchases bear another year, so that their hour does not parse."""
    kind, line = F.col("event_type"), cdn_line()
    text = (F.when(kind == "signup", F.regexp_replace(line, "^[0-9.]+", "-"))
            .when(kind == "purchase", F.replace(line, F.lit(f"/{LOG_YEAR_TEXT}:"), F.lit("/1999:"))).otherwise(line))
    return table(spark, sf_dir, "events").select(text.alias("value"))


def cdn_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdn_log_lines(table(spark, sf_dir, "events"))


def ad_click_lines(events: DataFrame) -> DataFrame:
    """Space-delimited ad-click lines ``timestamp province city uid adid``
    (epoch seconds first), the layout the ad ranking job parses."""
    line = F.concat_ws(" ",
                       _s(F.unix_seconds(ntz_as_utc("ts"))),
                       _s(F.col("user_id") % ADS_PROVINCES),
                       _s(F.col("user_id") % ADS_CITIES),
                       _s(F.col("user_id")),
                       _s(F.col("event_id") % ADS_ADS))
    return events.select(line.alias("value"))


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_click_lines(table(spark, sf_dir, "events"))


def damaged_ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-click lines of which those of error events have lost their last field
    and those of purchases hold a word in a number's place."""
    events = table(spark, sf_dir, "events")
    whole = F.array(_s(F.unix_seconds(ntz_as_utc("ts"))), _s(F.col("user_id") % ADS_PROVINCES),
                    _s(F.col("user_id") % ADS_CITIES), _s(F.col("user_id")), _s(F.col("event_id") % ADS_ADS))
    text = (F.when(F.col("event_type") == "error", F.concat_ws(" ", F.slice(whole, 1, 4)))
            .when(F.col("event_type") == "purchase", F.concat(F.concat_ws(" ", F.slice(whole, 1, 4)), F.lit(" none")))
            .otherwise(F.concat_ws(" ", whole)))
    return events.select(text.alias("value"))


def part_graph_edges(lineitem: DataFrame) -> DataFrame:
    """Edges part -> next part of the same order (weight ``l_quantity``).
    The window is partitioned by order key; an order has a handful of lines,
    so every window partition is small however large the table."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    return (lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
            .withColumn("dst", F.lead("l_partkey").over(w))
            .where(F.col("dst").isNotNull())
            .select(F.col("l_partkey").alias("src"), F.col("dst"),
                    F.col("l_quantity").alias("weight")))


def part_graph(spark: SparkSession, sf_dir: str):
    from kestrel.operators.graph import PropertyGraph
    vertices = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_size").alias("age"))
    return PropertyGraph(vertices, part_graph_edges(table(spark, sf_dir, "lineitem")))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One basket per order: the distinct ``partkey mod 20`` items as strings."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", (F.col("l_partkey") % BASKET_ITEMS).cast("string").alias("item"))
    # collect_set is partially aggregated per task; an order has a bounded
    # number of lines, so each basket is small.
    return (li.groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_set("item")).alias("items")))


def date_dimension(dates: DataFrame, col: str = "d") -> DataFrame:
    """Calendar attributes, one row per distinct day in ``col`` (S6 layout).
    The row count is bounded by the number of calendar days spanned."""
    d = F.to_date(F.col(col))
    days = dates.select(d.alias("d")).where(F.col("d").isNotNull()).distinct()
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("dateid"),
        (F.year("d") * 100 + F.month("d")).alias("years"),
        F.year("d").alias("theyear"),
        F.month("d").alias("month"),
        F.dayofmonth("d").alias("day"),
        F.dayofweek("d").alias("weekday"),
        F.weekofyear("d").alias("week"),
        F.quarter("d").alias("quarter"),
        F.least(F.floor((F.dayofmonth("d") - 1) / 10) + 1, F.lit(3)).cast("int").alias("period"),
        F.when(F.dayofmonth("d") <= 15, 1).otherwise(2).alias("halfmonth"),
    )


def stock_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stock, detail, dates) in the reference's record layouts, from
    orders and lineitem."""
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    stock = orders.select(
        F.col("o_orderkey").cast("string").alias("ordernumber"),
        F.col("o_custkey").cast("string").alias("locationid"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dateid"))
    detail = lineitem.select(
        F.col("l_orderkey").cast("string").alias("ordernumber"),
        F.col("l_linenumber").alias("rownum"),
        F.col("l_partkey").cast("string").alias("itemid"),
        F.col("l_quantity").cast("int").alias("number"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"))
    dates = date_dimension(orders.select(F.col("o_orderdate").alias("d")))
    return stock, detail, dates
