import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from kestrel.llm import sharding
from kestrel.llm.common import scratch_path


def place(df, shards=4, **options):
    return sharding.shuffled(df, shards, bucket_bytes=200, **options)


def rows_of(n=200):
    return [(k, f"text {k % 17} " * (k % 5), "s") for k in range(n)]


@pytest.mark.parametrize("law", ["key", "rows"])
def test_slots_are_gapless_and_rows_whole(docs, law):
    got = place(docs(rows_of()), law=law).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(200))
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) == set(range(4))
    if law == "rows":
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order != sorted(order)


def test_key_law_moves_rows_only_into_the_new_shard(docs):
    a = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in place(docs(rows_of())).collect()}
    b = {r["doc_id"]: r["shard"] for r in place(docs(rows_of()), shards=5).collect()}
    assert all(g == b[i] and (g == s or g == 4) for i, (s, g) in a.items())
    assert any(g != s for s, g in a.values())


def test_order_does_not_depend_on_arrival(docs):
    a = sorted((r["doc_id"], r["slot"]) for r in place(docs(rows_of())).collect())
    b = sorted((r["doc_id"], r["slot"]) for r in place(docs(rows_of()[::-1]).repartition(7)).collect())
    assert a == b


def test_no_python_and_one_exchange_of_the_records(docs):
    plan = place(docs(rows_of()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_written_shards_read_back(spark, docs):
    placed = place(docs(rows_of()))
    back = sharding.write(placed, scratch_path(spark, "shards-test"))
    assert sorted(tuple(r) for r in back.select(*placed.columns).collect()) == sorted(tuple(r) for r in placed.collect())


def test_odd_rows_and_empty(odd, docs):
    got = place(odd).select("doc_id", "shard", "slot", "score", sharding.size_of(F.col("text")).alias("n"), "text",
                            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc")).collect()
    assert len(got) == 9 and all(r["n"] == len((r["text"] or "").encode()) + 1 for r in got)
    assert all(r["crc"] == zlib.crc32((r["text"] or "").encode()) and r["score"] == "x" for r in got)
    assert len({(r["shard"], r["slot"]) for r in got}) == 9
    assert place(docs([])).count() == 0 and place(docs([]), law="rows").count() == 0
    with pytest.raises(ValueError):
        place(odd, law="weight")


def brute(rows, shards, seed=42):
    """Shard and grown shard of every id by Spark's xxhash64, one row at a time."""
    return {r["id"]: (r["s"], r["g"]) for r in rows.select(
        F.col("doc_id").alias("id"), sharding.key_shard(F.col("doc_id"), shards, seed).alias("s"),
        sharding.key_shard(F.col("doc_id"), shards + 1, seed).alias("g")).distinct().collect()}


def test_a_third_of_rows_alike_is_dealt_over_buckets(spark, docs):
    rows = [(k, f"text {k}", "s") for k in range(300)] + [(None, None, "s")] * 150
    df = docs(rows)
    placed = sharding.shuffled(df, 4, bucket_bytes=100, copies=20)
    got = placed.collect()
    assert len(got) == 450 and sum(r["doc_id"] is None for r in got) == 150
    want = brute(df, 4)
    assert all((r["shard"], r["grown_shard"]) == want[r["doc_id"]] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    mine = sorted(r["slot"] for r in got if r["doc_id"] is None)
    assert mine != list(range(mine[0], mine[0] + 150))  # among the others, not in one run
    again = sharding.shuffled(df.repartition(5), 4, bucket_bytes=100, copies=20).collect()
    key = lambda r: (str(r["doc_id"]), r["slot"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_tasks_are_bounded_and_offsets_are_not_broadcast_by_hint(docs):
    placed = sharding.shuffled(docs(rows_of()), 4, bucket_bytes=50, max_tasks=6)
    assert "hashpartitioning(bucket" in placed._jdf.queryExecution().executedPlan().toString()
    assert "RepartitionByExpression" in placed._jdf.queryExecution().optimizedPlan().toString()
    assert ", 6" in placed._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" not in placed._jdf.queryExecution().analyzed().toString()


def hashed(seed, *values):
    """Spark's xxhash64 of ints (4 bytes), longs (given as (value,), 8 bytes) and strings, nulls left out."""
    h = 42
    for v in (seed, *values):
        if v is None or v == (None,):
            continue
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(8, "little", signed=True) if isinstance(v, tuple) \
            else v.to_bytes(4, "little", signed=True)
        h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def shard_by_hand(key, shards, seed=42):
    return max((hashed(seed, (key,), s), s) for s in range(shards))[1]


@pytest.mark.parametrize("shards,bucket_bytes", [(4, 200), (3, 90), (1, 1 << 20)])
def test_shards_buckets_and_slots_equal_a_second_program(docs, shards, bucket_bytes):
    rows = rows_of(300) + [(None, None, "s"), (None, "unnamed", "s"), (-7, "", "s"), (5, "text 5 " * 2, "t")]
    got = sharding.shuffled(docs(rows), shards, bucket_bytes=bucket_bytes).collect()
    total = sum(len((t or "").encode()) + 1 for _, t, _ in rows)
    fan = max(1, -(-total // (bucket_bytes * shards)))
    want: dict = {}
    for key, text, source in rows:
        shard = shard_by_hand(key, shards)
        inner = hashed(text) if text is not None else 42
        want.setdefault((shard, hashed(43, (key,), (inner,), (0,)) % fan), []).append((key, text, source))
    by = {(r["shard"], r["slot"]): (r["doc_id"], r["text"], r["source"]) for r in got}
    assert len(by) == len(got) == len(rows)
    assert all(r["grown_shard"] == shard_by_hand(r["doc_id"], shards + 1) for r in got)
    moved = 0
    for shard in range(shards):
        at = 0
        for bucket in range(fan):  # buckets one after another, each holding its rows in some order
            mine = want.get((shard, bucket), [])
            placed = [by[shard, at + k] for k in range(len(mine))]
            assert sorted(map(str, placed)) == sorted(map(str, mine))
            moved += sum(a != b for a, b in zip(placed, sorted(mine, key=str)))
            at += len(mine)
    assert moved > len(rows) // 2
