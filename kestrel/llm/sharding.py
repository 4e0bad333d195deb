"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters the records uniformly: seeded hashes deal each to a bucket sized
to fit in memory. Pass 2 loads one bucket a task, Fisher-Yates shuffles it
(``shuffle`` of the bucket's sorted array), numbers its records from the bucket's
offset, and writes them to their shard.

Laws. ``key``: the shard is the one of largest seeded hash of (id, shard), so id
and shard count alone decide and one more shard takes rows only into itself; the
buckets subdivide shards. ``rows``: buckets subdivide all records, and a record's
place in the shuffled whole, modulo the shard count, is its shard, so counts
differ by at most one.

A task holds several buckets (``task_bytes`` of text on average, ``max_tasks`` tasks at
most), and a bucket's array is sorted before it is shuffled, so the order does not
depend on how rows arrive or on retried tasks. Records of one id are spread over the
buckets of their shard by a hash of their text, and identical records, where there are
more than ``copies`` of them, by their number: they are counted (with partial
aggregation) and dealt out again one by one. Bucket offsets, one row a bucket, are
joined on the bucket.

Defined results: a null id is a key like any other; null text has size 1 and the
checksum of nothing; repeated rows keep a slot each; an empty table gives an empty
result; columns named like the added ones are replaced, others are kept (they must
be orderable)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize

ADDED = ["law", "shard", "slot", "grown_shard"]


def key_shard(key: Column, shards: int, seed: int = 42) -> Column:
    """The shard of largest hash of (key, shard); a tie goes to the larger shard."""
    scores = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                         lambda s: F.struct(F.xxhash64(F.lit(seed), key, s).alias("h"), s.alias("s")))
    return F.array_max(scores)["s"].cast("int")


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text and one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shuffled(docs: DataFrame, shards: int, law: str = "key", key: str = "doc_id", text: str = "text", seed: int = 42,
             bucket_bytes: int = 4 << 20, task_bytes: int = 16 << 20, max_tasks: int = 20_000, copies: int = 1000) -> DataFrame:
    """``docs`` with law, shard, slot (gapless from 0 in each shard) and
    grown_shard (``key``: the shard with one more, else null). ``bucket_bytes``:
    text bytes of a bucket on average; one text must fit in a task."""
    if law not in ("key", "rows"):
        raise ValueError(f"unknown law {law!r}")
    docs = docs.drop(*ADDED)
    names = docs.columns
    by_key = law == "key"
    total = docs.agg(F.sum(size_of(F.col(text)))).first()[0] or 0
    fan = max(1, -(-total // (bucket_bytes * (shards if by_key else 1))))
    group = key_shard(F.col(key), shards, seed) if by_key else F.lit(0)
    docs = _numbered(docs, key, text, copies)
    spread = F.xxhash64(F.lit(seed + 1), key, F.xxhash64(text), "_copy")
    bucket = group * fan + F.pmod(spread, F.lit(fan))
    buckets = fan * (shards if by_key else 1)
    tasks = min(buckets, max_tasks, max(-(-total // task_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    counts = docs.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    shard_of = F.floor(F.col("bucket") / fan)
    ahead = Window.partitionBy(shard_of).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))

    record = F.struct(F.xxhash64(F.lit(seed + 2), key, text).alias("order"), F.struct(*names).alias("row"))
    dealt = docs.select(bucket.alias("bucket"), record.alias("record"))
    dealt = dealt.repartition(tasks, "bucket")
    loaded = dealt.groupBy("bucket").agg(F.sort_array(F.collect_list("record")).alias("bag"))
    loaded = loaded.sortWithinPartitions("bucket")  # one generator shuffles the buckets of a task, in this order
    mixed = loaded.select("bucket", F.shuffle("bag", seed).alias("bag"))
    placed = (mixed.join(offsets, "bucket")
              .select("bucket", "first", F.posexplode("bag").alias("at", "record"))
              .select("record.row.*", shard_of.cast("int").alias("shard"), (F.col("first") + F.col("at")).alias("slot")))
    if by_key:
        shard, slot, grown = F.col("shard"), F.col("slot"), key_shard(F.col(key), shards + 1, seed)
    else:
        shard, slot = (F.col("slot") % shards).cast("int"), F.floor(F.col("slot") / shards)
        grown = F.lit(None).cast("int")
    return placed.select(*names, F.lit(law).alias("law"), shard.alias("shard"), slot.cast("long").alias("slot"),
                         grown.alias("grown_shard"))


def _numbered(docs: DataFrame, key: str, text: str, copies: int) -> DataFrame:
    """``docs`` with ``_copy``: 0, but a running number among more than ``copies`` rows
    that are alike in all columns. Only rows whose id and text occur that often are
    counted whole; most tables have none."""
    docs = docs.drop("_copy")
    often = (docs.groupBy(F.col(key).alias("_k"), F.xxhash64(text).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > copies))
    often = materialize(often, "often")
    if often.isEmpty():
        return docs.withColumn("_copy", F.lit(0).cast("long"))
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.xxhash64(text) == F.col("_t"))
    rest = docs.join(often, same, "left_anti").withColumn("_copy", F.lit(0).cast("long"))
    alike = docs.join(often, same, "left_semi").groupBy(*docs.columns).agg(F.count(F.lit(1)).alias("_n"))
    return rest.unionByName(alike.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_n"))


def write(placed: DataFrame, folder: str) -> DataFrame:
    """Write ``shuffled`` records as Parquet under ``folder``/shard=N, each bucket in
    slot order, and return the written records."""
    placed.write.partitionBy("shard").parquet(folder)
    return placed.sparkSession.read.schema(placed.schema).parquet(folder)
