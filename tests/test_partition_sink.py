import os

import pytest
from pyspark.sql import functions as F

from kestrel.functions import aggregates as A
from kestrel.session import scratch_path
from kestrel.sources.partition_sink import folder_target, write_partitions
from kestrel.streaming import runners as R


def _files(path):
    path = path.removeprefix("file:")
    return sorted(n for _, _, names in os.walk(path) for n in names if n.endswith(".parquet"))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_partition_is_one_transaction(spark):
    df = spark.range(0, 2500, 1, 5).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.col("id"))).alias("v"))
    df = df.union(df.where("id < 3"))
    path = scratch_path(spark, "sink")
    write_partitions(df, folder_target(path, df), batch_rows=100)
    back = spark.read.parquet(path)
    assert _rows(back.select("id", "v")) == _rows(df)
    assert len(_files(path)) == df.rdd.getNumPartitions()
    write_partitions(df, folder_target(path, df))  # appends
    assert spark.read.parquet(path).count() == 2 * df.count()


def test_batches_hold_at_most_batch_rows(spark, tmp_path):
    note = str(tmp_path / "sizes")

    def target():
        class Transaction:
            sizes = ()

            def add(self, batch):
                self.sizes += (batch.num_rows,)

            def commit(self):
                return self.sizes

            def rollback(self):
                pass

        class Target:
            def begin(self, partition):
                return Transaction()

            def publish(self, receipts):
                with open(note, "w") as out:
                    out.write(repr(receipts))

        return Target()

    write_partitions(spark.range(0, 1000, 1, 2), target(), batch_rows=300)
    with open(note) as f:
        sizes = eval(f.read())
    assert sorted(sum(s) for s in sizes) == [500, 500] and all(max(s) <= 300 for s in sizes)


def test_a_failed_task_leaves_nothing(spark):
    df = spark.range(0, 400, 1, 4).select(F.when(F.col("id") == 399, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).cast("long").alias("id"))
    path = scratch_path(spark, "sink-failed")
    with pytest.raises(Exception, match="bad row"):
        write_partitions(df, folder_target(path, spark.range(1)))
    assert not _files(path)


def test_an_empty_table_can_be_read_back(spark):
    df = spark.range(0).select("id", F.lit("x").alias("v"))
    path = scratch_path(spark, "sink-empty")
    write_partitions(df.repartition(2), folder_target(path, df))
    assert spark.read.schema(df.schema).parquet(path).count() == 0


LOG = [(t, p, o) for t, p, n in (("a", 0, 10), ("a", 1, 5), ("b", 0, 7)) for o in range(n)]


def _log(spark):
    path = scratch_path(spark, "log")
    spark.createDataFrame(LOG, "topic string, partition int, offset long").coalesce(1).sortWithinPartitions(
        "topic", "partition", "offset").write.parquet(path)
    return spark.read.parquet(path)


def test_reading_on_from_positions(spark):
    log = _log(spark)
    at = lambda rows: spark.createDataFrame(rows, "topic string, partition int, start_offset long")
    starts = {("a", 0): 4, ("b", 0): -1}
    got = R.read_from(log, at([(*k, v) for k, v in starts.items()]))
    assert _rows(got) == [("a", 0, o) for o in range(4, 10)]
    got = R.read_from(log, at([(*k, v) for k, v in starts.items()]), unsaved="earliest")
    assert _rows(got) == sorted([("a", 0, o) for o in range(4, 10)] + [("a", 1, o) for o in range(5)], key=repr)
    ends = spark.createDataFrame([("a", 0, 6)], "topic string, partition int, until_offset long")
    assert _rows(R.read_from(log, at([("a", 0, 4)]), until=ends)) == [("a", 0, 4), ("a", 0, 5)]
    assert R.read_from(log, at([])).count() == 0
    assert R.read_from(log, at([]), unsaved="earliest").count() == 22


def test_positions_reach_the_scan(spark):
    at = spark.createDataFrame([("a", 0, 4), ("b", 0, 2)], "topic string, partition int, start_offset long")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)  # the filters are cut short in plans otherwise
    plan = R.read_from(_log(spark), at)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(offset,4)" in pushed and "EqualTo(topic,b)" in pushed


def test_counts_observed_while_another_result_is_written(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4), ("z", 5)], "k string, n int")
    watched, counts = A.observed_counts(df, "k", ["a", "b", "c"])
    path = scratch_path(spark, "watched")
    watched.where("n > 2").write.parquet(path)
    assert counts() == {"a": 2, "b": 1, "c": 0, None: 2}
    assert spark.read.parquet(path).count() == 3
    watched, counts = A.observed_counts(df.limit(0), "k", ["a"])
    assert watched.count() == 0 and counts() == {"a": 0, None: 0}
