"""Batched writes with one transaction a partition (a Python data source writer).

A *target* says what a transaction is: ``begin(partition)`` opens one in the task and
returns an object with ``add(batch)`` (an Arrow batch of at most ``batch_rows`` rows),
``commit()`` (returns a small picklable receipt) and ``rollback()``. When every task has
committed, ``publish(receipts)`` runs once on the driver; when any has failed for good,
``discard(receipts)``. A task that is run again opens a new transaction; only the
receipts of the attempts that Spark accepted are published, so a lost executor or a
doubled task leaves no row twice.

Targets are made by functions and pickled by value: workers need not import this
library. Defined results: an empty partition commits an empty transaction; an empty
table publishes nothing but the schema; nulls and repeated rows are kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "kestrel_partitions"


def write_partitions(df: DataFrame, target, batch_rows: int = 1000) -> None:
    """Write every partition of ``df`` to ``target`` in one transaction each."""

    class Receipt(WriterCommitMessage):
        def __init__(self, value):
            self.value = value

    class Writer(DataSourceArrowWriter):
        def write(self, iterator):
            from pyspark import TaskContext
            transaction = target.begin(TaskContext.get().partitionId())
            try:
                for batch in iterator:
                    for at in range(0, batch.num_rows, batch_rows):
                        transaction.add(batch.slice(at, batch_rows))
                return Receipt(transaction.commit())
            except BaseException:
                transaction.rollback()
                raise

        def commit(self, messages):
            target.publish([m.value for m in messages if m is not None])

        def abort(self, messages):
            target.discard([m.value for m in messages if m is not None])

    class Sink(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def writer(self, schema, overwrite):
            return Writer()

    df.sparkSession.dataSource.register(Sink)
    df.write.format(FORMAT).mode("append").save()


def folder_target(path: str, schema: DataFrame):
    """Target of parquet files in a shared folder: a transaction is a file written in a
    hidden staging folder, one row group a batch. Publishing drops the files of attempts
    that were not accepted and moves the folder into place by one rename, as
    ``<path>/write_id=<id>``; readers see all of a write or nothing of it.
    ``schema`` is the frame to be written (its columns are stored when it has no rows)."""
    write_id = uuid.uuid4().hex[:12]
    root = path.rstrip("/")
    empty = schema.limit(0).toArrow().schema

    def locate(where):
        from pyarrow import fs
        return fs.FileSystem.from_uri("/" + where[5:].lstrip("/") if where.startswith("file:") else where)

    class Transaction:
        def __init__(self, partition):
            import pyarrow.parquet as pq
            self.system, folder = locate(f"{root}/_staging-{write_id}")
            self.system.create_dir(folder, recursive=True)
            self.name = f"part-{partition:05d}-{uuid.uuid4().hex[:12]}.parquet"
            self.place, self.rows = f"{folder}/{self.name}", 0
            self.file = self.system.open_output_stream(self.place, compression=None)
            self.writer = pq.ParquetWriter(self.file, empty)

        def add(self, batch):
            self.writer.write_batch(batch.cast(empty))
            self.rows += batch.num_rows

        def commit(self):
            self.writer.close()
            self.file.close()
            return {"name": self.name, "rows": self.rows}

        def rollback(self):
            self.writer.close()
            self.file.close()
            self.system.delete_file(self.place)

    class Target:
        def begin(self, partition):
            return Transaction(partition)

        def publish(self, receipts):
            from pyarrow import fs
            system, folder = locate(f"{root}/_staging-{write_id}")
            kept = {r["name"] for r in receipts}
            for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if info.base_name not in kept:
                    system.delete_file(info.path)
            if kept:
                system.move(folder, locate(f"{root}/write_id={write_id}")[1])

        def discard(self, receipts):
            from pyarrow import fs
            system, folder = locate(f"{root}/_staging-{write_id}")
            if system.get_file_info(folder).type == fs.FileType.Directory:
                system.delete_dir(folder)

    return Target()
