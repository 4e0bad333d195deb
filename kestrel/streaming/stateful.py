"""Stream state that the built-in stateful operators do not keep: windows moved on by
adding the newest and taking off the oldest pane, state per key under a caller's update
rule with the whole state emitted every batch, and contiguous positions per partition.

State is a table of the batch that wrote it (``<base>/state/batch_id=<id>``): batch b is
made from the state of b - 1 and its own rows, so a batch that is replayed after a
failure, or run by a restarted query, writes the same state again. Rows of a batch are
aggregated before they meet the state (partially in each task), so a hot key costs one
row a task, and nothing is ever held in one process."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.functions.time import utc_text


def _path(base: str, name: str, batch_id: int) -> str:
    return f"{base}/{name}/batch_id={batch_id}"


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _previous(spark: SparkSession, base: str, batch_id: int) -> DataFrame | None:
    """The state that the batch before left (none before the first batch)."""
    path = _path(base, "state", batch_id - 1)
    system, hadoop = _folder(spark, path)
    return spark.read.parquet(path) if batch_id > 0 and system.exists(hadoop) else None


def _keep(state: DataFrame, base: str, batch_id: int) -> DataFrame:
    """Writes the batch's state and reads it back. The state before the last is given up:
    the last one still serves a replay of this batch."""
    spark = state.sparkSession
    path = _path(base, "state", batch_id)
    state.write.mode("overwrite").parquet(path)
    system, old = _folder(spark, _path(base, "state", batch_id - 2))
    system.delete(old, True)
    return spark.read.parquet(path)


# --- windows with an inverse --------------------------------------------------
def pane_counts(df: DataFrame, key: str, slide: int, time_col: str = "event_time") -> DataFrame:
    """(pane, key, n): rows per pane of ``slide`` seconds; one pane a row."""
    seconds = F.unix_seconds(time_col)
    return df.groupBy((seconds - F.pmod(seconds, F.lit(slide))).alias("pane"), key).agg(F.count(F.lit(1)).alias("n"))


def running_windows(panes: DataFrame, key: str, length: int, slide: int) -> DataFrame:
    """(key, start, n): count of every window of ``length`` seconds that moves by
    ``slide``. A pane is added where it becomes a window's newest and taken off after
    it was the oldest, so a window is the one before plus and minus one pane, and a key
    whose count has fallen to 0 has no windows until its next pane. Panes of a key are
    as many as its slides in time, whatever the number of rows."""
    if length % slide:
        raise ValueError(f"a window of {length} s is not a number of slides of {slide} s")
    added = panes.select(key, F.col("pane").alias("at"), F.col("n").alias("change"))
    removed = panes.select(key, (F.col("pane") + length).alias("at"), (-F.col("n")).alias("change"))
    changes = added.unionByName(removed).groupBy(key, "at").agg(F.sum("change").alias("change"))
    order = Window.partitionBy(key).orderBy("at")
    run = changes.select(key, "at", F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
                         F.lead("at").over(order).alias("next")).where("n > 0")
    steps = F.explode(F.sequence(F.col("at"), F.col("next") - slide, F.lit(slide)))
    return run.select(key, "n", steps.alias("at")).select(key, (F.col("at") + slide - length).alias("start"), "n")


def window_bounds(windows: DataFrame, key: str, length: int) -> DataFrame:
    """Window bounds as UTC text, like :func:`transforms.window_counts`."""
    text = lambda s: utc_text(F.timestamp_seconds(s))
    return windows.select(text(F.col("start")).alias("window_start"), text(F.col("start") + length).alias("window_end"), key, "n")


def inverse_windows(base: str, key: str, length: int, slide: int, time_col: str = "event_time",
                    retain: int | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler: keeps the panes as state and writes the windows that the
    batch changed under ``base/data``. Rows may come in any order. ``retain``: seconds
    behind the newest pane after which a pane's windows are final and its state goes."""
    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        fresh = pane_counts(df, key, slide, time_col)
        before = _previous(spark, base, batch_id)
        panes = fresh if before is None else before.unionByName(fresh).groupBy("pane", key).agg(F.sum("n").alias("n"))
        if retain is not None:
            newest = panes.agg(F.max("pane").alias("_newest"))  # one row
            panes = panes.join(F.broadcast(newest), F.col("pane") + length + retain > F.col("_newest")).drop("_newest")
        panes = _keep(panes, base, batch_id)
        touched = running_windows(fresh, key, length, slide).select(F.col(key).alias("_key"), F.col("start").alias("_start"))
        changed = running_windows(panes, key, length, slide).join(
            touched, F.col(key).eqNullSafe(F.col("_key")) & (F.col("start") == F.col("_start")), "left_semi")
        window_bounds(changed, key, length).write.mode("overwrite").parquet(_path(base, "data", batch_id))
    return handle


# --- state under a caller's rule ----------------------------------------------
def update_state(state: DataFrame | None, batch: DataFrame, key: str, merge: Column,
                 update: Callable[[Column, Column], Column]) -> DataFrame:
    """(key, state) after a batch. ``merge`` (an aggregate over the batch's columns) gives
    a key's new value, ``update(value, old)`` its new state: the value is null for a key
    without rows in the batch, the old state for a new key; a null result removes the
    key. Every key is visited every batch."""
    fresh = batch.groupBy(key).agg(merge.alias("value"))
    kind = fresh.schema["value"].dataType
    if state is None:
        both = fresh.withColumn("old", F.lit(None).cast(kind))
    else:
        old = state.select(key, F.lit(None).cast(kind).alias("value"), F.col("state").alias("old"))
        new = fresh.select(key, "value", F.lit(None).cast(state.schema["state"].dataType).alias("old"))
        both = old.unionByName(new).groupBy(key).agg(F.first("value", ignorenulls=True).alias("value"),
                                                     F.first("old", ignorenulls=True).alias("old"))
    return both.select(key, update(F.col("value"), F.col("old")).alias("state")).where("state IS NOT NULL")


def state_updates(base: str, key: str, merge: Column, update: Callable[[Column, Column], Column]) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler of :func:`update_state`: the whole state is written under
    ``base/data`` in every batch."""
    def handle(df: DataFrame, batch_id: int) -> None:
        state = _keep(update_state(_previous(df.sparkSession, base, batch_id), df, key, merge, update), base, batch_id)
        state.write.mode("overwrite").parquet(_path(base, "data", batch_id))
    return handle


# --- positions ----------------------------------------------------------------
def contiguous_ranges(base: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler: the batch's output by ``write``, then its range of positions
    per topic and partition under ``base/ledger``; a range begins where the last one of
    its partition ended (0 at first), whichever batch that was."""
    def handle(df: DataFrame, batch_id: int) -> None:
        write(df, batch_id)
        rows = df.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"))
        before = _previous(df.sparkSession, base, batch_id)
        held = rows.select("topic", "partition", "n", F.lit(0).cast("long").alias("until_offset"))
        if before is not None:
            held = held.unionByName(before.select("topic", "partition", F.lit(0).cast("long").alias("n"), "until_offset"))
        ranges = (held.groupBy("topic", "partition").agg(F.max("until_offset").alias("from_offset"), F.sum("n").alias("n"))
                  .withColumn("until_offset", F.col("from_offset") + F.col("n")))
        state = _keep(ranges, base, batch_id)
        state.where("n > 0").select("topic", "partition", "from_offset", "until_offset").write.mode("overwrite").parquet(
            _path(base, "ledger", batch_id))
    return handle
