"""Sinks: text, catalog tables, JDBC (append/overwrite) and Kafka builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.session import scratch_path


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One line per row from a single string column (S18). Fails when the
    path exists unless another ``mode`` is given."""
    df.write.mode(mode).option("lineSep", "\n").text(path)


def replace_table(spark: SparkSession, name: str, df: DataFrame,
                  path: str | None = None) -> DataFrame:
    """Replace a catalog table by ``df`` (S17); returns the table. The data is
    written first, to ``path`` or a fresh folder of the shared root; only then is
    the catalog entry dropped and created over it, so a failed write leaves the old
    table, and ``df`` may read the table it replaces."""
    path = path or scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.catalog.createTable(name, path, "parquet")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 1000) -> None:
    """Batched JDBC write from every partition (S15 append, S16 overwrite)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url, table, mode=mode, properties=props)


def kafka_writer(df: DataFrame, bootstrap: str, topic: str):
    """Streaming writer of a ``value`` column to a Kafka topic (S23). The
    Kafka connector jar must be on the classpath; not exercised here."""
    return (df.selectExpr("CAST(value AS STRING) AS value").writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap).option("topic", topic))
