"""Stream sources and sinks, and runners that drive a stream to completion
into a table folder under the shared checkpoint root.

Sinks write with ``foreachBatch`` into files keyed by batch id, so a batch
that is replayed after a failure overwrites its own output (idempotent);
the checkpoint holds source offsets and state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import scratch_path


def file_stream(spark: SparkSession, directory: str, file_glob: str, schema: T.StructType,
                fmt: str = "parquet", max_files_per_trigger: int = 1) -> DataFrame:
    """Files in ``directory`` matching ``file_glob`` as a stream, one file per
    micro-batch by default."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("pathGlobFilter", file_glob).load(directory))


def table_stream(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
                 batches: int = 4) -> DataFrame:
    """A stored table replayed as a file stream in about ``batches`` micro-batches.
    The part files of a folder are streamed as they are, in any order; a table
    that is one file is first dealt into that many files of the shared root."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    stored = spark.read.parquet(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").count()
    if files <= 1:
        part = stored.select(*columns) if columns else stored
        path, files = scratch_path(spark, f"replay-{name}"), batches
        part.repartition(batches).write.parquet(path)
        stored = part
    df = file_stream(spark, path, "*.parquet", stored.schema, max_files_per_trigger=max(1, -(-files // batches)))
    return df.select(*columns) if columns else df


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a socket (``value`` column). Not exercised in tests."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "latest") -> DataFrame:
    """Kafka topic as (key, value, topic, partition, offset) strings/longs.
    ``starting_offsets`` may be the JSON from
    :func:`kestrel.streaming.transforms.starting_offsets_json`; after the first
    run the checkpoint decides. Needs the Kafka connector on the classpath."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
           .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"),
                      "topic", "partition", "offset")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                output_mode: str = "append", available_now: bool = True,
                processing_time: str | None = None):
    """Start ``stream`` with ``handle(batch_df, batch_id)`` per micro-batch.
    With ``available_now`` the call returns once all present input is done."""
    w = (stream.writeStream.outputMode(output_mode).foreachBatch(handle)
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


class Stopped(RuntimeError):
    """Raised inside a stream to end it between two batches."""


def run_some(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, batches: int,
             output_mode: str = "append") -> bool:
    """Run at most ``batches`` micro-batches of ``stream`` and stop it as a failure would:
    the next batch has its offsets planned but is neither handled nor committed. A later
    run with the same checkpoint and handler goes on with that batch. True if it stopped
    before the end of the input."""
    seen: set[int] = set()

    def limited(df: DataFrame, batch_id: int) -> None:
        if len(seen | {batch_id}) > batches:
            raise Stopped(f"stopped before batch {batch_id}")
        handle(df, batch_id)
        seen.add(batch_id)

    try:
        run_batches(stream, limited, checkpoint, output_mode)
    except StreamingQueryException as e:
        if "Stopped" not in str(e):
            raise
        return True
    return False


def read_from(log: DataFrame, positions: DataFrame, until: DataFrame | None = None, unsaved: str = "latest") -> DataFrame:
    """Rows of a stored ``log`` (topic, partition, offset, ...) from the start offset of
    each partition on: ``positions`` has (topic, partition, start_offset), as
    :func:`transforms.resume_positions` gives them; -1 stands for the end of the log.
    ``until`` (topic, partition, until_offset) ends a run before those offsets.
    Partitions without a position are left out, or read whole with ``unsaved="earliest"``.

    The positions (one row a partition of a topic) become one predicate, which reaches
    the scan: what lies before them is skipped by file statistics where the log is
    sorted. Rows without a topic or partition belong to none and are not read."""
    here = lambda r: (F.col("topic") == r["topic"]) & (F.col("partition") == r["partition"])
    starts = positions.collect()
    ends = {(r["topic"], r["partition"]): r["until_offset"] for r in until.collect()} if until is not None else {}
    terms = []
    for r in starts:
        if r["start_offset"] >= 0:
            term = here(r) & (F.col("offset") >= r["start_offset"])
            end = ends.get((r["topic"], r["partition"]))
            terms.append(term if end is None else term & (F.col("offset") < end))
    if unsaved == "earliest":
        terms.append(~_any_of([here(r) for r in starts]))
    return log.where(_any_of(terms))


def _any_of(terms: list) -> Column:
    """Disjunction as a balanced tree, so that many terms do not nest deeply."""
    if len(terms) <= 1:
        return terms[0] if terms else F.lit(False)
    half = len(terms) // 2
    return _any_of(terms[:half]) | _any_of(terms[half:])


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler: write the batch under ``path/batch_id=<id>``,
    replacing that folder if the batch is replayed."""
    def handle(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return handle


def run_to_folder(spark: SparkSession, stream: DataFrame, name: str,
                  output_mode: str = "append", out: str | None = None) -> str:
    """Drive ``stream`` to the end of its input into a fresh folder under the
    shared checkpoint root; returns the data folder."""
    base = out or scratch_path(spark, name)
    run_batches(stream, batch_writer(f"{base}/data"), f"{base}/checkpoint", output_mode)
    return f"{base}/data"


def read_batches(spark: SparkSession, data: str, schema: T.StructType) -> DataFrame:
    """All batches written by :func:`batch_writer` (``batch_id`` column)."""
    full = T.StructType(list(schema.fields) + [T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(data)


def latest_per_key(batches: DataFrame, keys: list[str], value_cols: list[str]) -> DataFrame:
    """Final state from update-mode output: for every key, the values of the
    last batch that emitted it (partial aggregation with ``max_by``)."""
    return batches.groupBy(*keys).agg(
        *[F.max_by(c, "batch_id").alias(c) for c in value_cols])
