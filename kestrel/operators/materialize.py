"""Materialising intermediate results in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from kestrel.session import scratch_path


def materialize(df: DataFrame, name: str = "round", metric: Column | None = None):
    """Write ``df`` as parquet under the folder named by ``spark.checkpoint.dir``
    and read it back. Cuts lineage and the logical plan (a checkpointed
    frame keeps its origin plan for statistics, so loops that use the previous
    round twice would double that chain every round); survives executor loss
    and needs no unpersist. Machine-local checkpoints are never used.

    With ``metric`` (an aggregate Column) its value is observed during the
    same write, saving a separate job; returns ``(frame, value)`` then."""
    from pyspark.sql import Observation
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = None
    if metric is not None:
        obs = Observation()
        df = df.observe(obs, metric.alias("m"))
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._kestrel_path = path  # lets a loop release the folder once it is superseded
    if obs is None:
        return out
    return out, obs.get.get("m")


def release(df: DataFrame | None) -> None:
    """Delete the folder behind a frame returned by :func:`materialize`, once
    nothing reads it any more (e.g. the previous round of a loop, after the
    next round has been written from it). Other frames are left alone."""
    path = getattr(df, "_kestrel_path", None) if df is not None else None
    if not path:
        return
    jvm = df.sparkSession._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = df.sparkSession._jsc.hadoopConfiguration()
    hpath.getFileSystem(conf).delete(hpath, True)
