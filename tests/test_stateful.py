import random

import pytest
from pyspark.sql import functions as F

from kestrel.operators import graph as G
from kestrel.streaming import runners as R
from kestrel.streaming import stateful as S
from kestrel.streaming import transforms as ST

SLIDE, LENGTH = 600, 1800


def _events(n=200, seed=3):
    rng = random.Random(seed)
    return [(rng.choice("aab"), rng.randint(0, 40) * 300 + (20_000 if rng.random() < 0.2 else 0)) for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("event_time"))


def _brute(rows):
    out = {}
    for k, s in rows:
        newest = s - s % SLIDE
        for w in range(newest - LENGTH + SLIDE, newest + 1, SLIDE):
            out[k, w] = out.get((k, w), 0) + 1
    return out


def test_windows_by_adding_and_taking_off_panes(spark):
    rows = _events()
    panes = S.pane_counts(_frame(spark, rows), "k", SLIDE)
    got = {(r["k"], r["start"]): r["n"] for r in S.running_windows(panes, "k", LENGTH, SLIDE).collect()}
    assert got == _brute(rows)  # no window of a key whose count fell to 0
    with pytest.raises(ValueError):
        S.running_windows(panes, "k", 1000, SLIDE)


def test_no_row_is_copied_per_window(spark):
    panes = S.pane_counts(_frame(spark, _events()), "k", SLIDE)
    plan = panes._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def test_batches_in_any_order_and_replayed(spark, tmp_path):
    rows = _events()
    random.Random(1).shuffle(rows)
    handle = S.inverse_windows(str(tmp_path), "k", LENGTH, SLIDE)
    for b in range(4):
        for _ in range(2 if b == 2 else 1):  # batch 2 again after a failure
            handle(_frame(spark, rows[50 * b:50 * b + 50]), b)
    final = R.latest_per_key(spark.read.parquet(f"{tmp_path}/data"), ["window_start", "k"], ["n"])
    whole = S.window_bounds(S.running_windows(S.pane_counts(_frame(spark, rows), "k", SLIDE), "k", LENGTH, SLIDE), "k", LENGTH)
    assert sorted(map(tuple, final.select("window_start", "k", "n").collect())) == sorted(
        map(tuple, whole.select("window_start", "k", "n").collect()))
    first = spark.read.parquet(f"{tmp_path}/data").where("batch_id = 0").count()
    assert first == len(_brute(rows[:50]))


def test_old_panes_leave_the_state(spark, tmp_path):
    handle = S.inverse_windows(str(tmp_path), "k", LENGTH, SLIDE, retain=SLIDE)
    handle(_frame(spark, [("a", 0), ("a", 600)]), 0)
    handle(_frame(spark, [("a", 60_000)]), 1)
    assert [r["pane"] for r in spark.read.parquet(f"{tmp_path}/state/batch_id=1").collect()] == [60_000]


def test_update_rule_removal_and_full_emission(spark, tmp_path):
    """Totals of every batch equal a running sum; a key at 0 goes, comes back anew, and
    keys without rows in a batch are emitted again."""
    batches = [[("a", 2), ("b", 1), ("c", 5)], [("a", -2), ("b", 1)], [("a", 7)], []]
    total = lambda v, o: F.coalesce(v, F.lit(0)) + F.coalesce(o, F.lit(0))
    handle = S.state_updates(str(tmp_path), "k", F.sum("v"), lambda v, o: F.when(total(v, o) != 0, total(v, o)))
    want, seen = {}, []
    for b, rows in enumerate(batches):
        handle(spark.createDataFrame(rows, "k string, v long"), b)
        for k, v in rows:
            want[k] = want.get(k, 0) + v
        want = {k: v for k, v in want.items() if v}
        got = {r["k"]: r["state"] for r in spark.read.parquet(f"{tmp_path}/data/batch_id={b}").collect()}
        seen.append(got)
        assert got == want
    assert "a" not in seen[1] and seen[1]["c"] == 5 and seen[3] == {"a": 7, "b": 2, "c": 5}


def test_update_rule_may_tell_new_keys_and_idle_ones(spark):
    first = S.update_state(None, spark.createDataFrame([("a", 3)], "k string, v long"), "k", F.max("v"),
                           lambda v, o: F.when(o.isNull(), v * 10).when(v.isNull(), o - 1).otherwise(v + o))
    assert [tuple(r) for r in first.collect()] == [("a", 30)]
    rule = lambda v, o: F.when(o.isNull(), v * 10).when(v.isNull(), o - 1).otherwise(v + o)
    second = S.update_state(first, spark.createDataFrame([("b", 1), (None, 2)], "k string, v long"), "k", F.max("v"), rule)
    assert sorted(map(str, second.collect())) == sorted(["Row(k='a', state=29)", "Row(k='b', state=10)", "Row(k=None, state=20)"])


def test_a_stopped_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    spark.range(90).selectExpr("cast(id % 7 as string) value").repartition(6).write.parquet(f"{tmp_path}/in")
    stream = R.file_stream(spark, f"{tmp_path}/in", "*.parquet", spark.read.parquet(f"{tmp_path}/in").schema)
    counts = ST.word_counts(stream)
    write = R.batch_writer(f"{tmp_path}/data")
    assert R.run_some(counts, write, f"{tmp_path}/cp", 2, "update")
    half = spark.read.parquet(f"{tmp_path}/data").select("batch_id").distinct().count()
    assert half == 2
    R.run_batches(counts, write, f"{tmp_path}/cp", "update")
    final = R.latest_per_key(spark.read.parquet(f"{tmp_path}/data"), ["word"], ["n"])
    assert {r["word"]: r["n"] for r in final.collect()} == {str(k): len(range(k, 90, 7)) for k in range(7)}
    assert not R.run_some(counts, write, f"{tmp_path}/cp", 2, "update")  # nothing left


def test_positions_follow_each_other(spark, tmp_path):
    handle = S.contiguous_ranges(str(tmp_path), R.batch_writer(f"{tmp_path}/data"))
    for b, rows in enumerate([[("x", 0)] * 3 + [("y", 1)], [("y", 1)] * 2, [("x", 0)]]):
        handle(spark.createDataFrame(rows, "topic string, partition int"), b)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/ledger").select(
        "batch_id", "topic", "from_offset", "until_offset").collect())
    assert got == [(0, "x", 0, 3), (0, "y", 0, 1), (1, "y", 1, 3), (2, "x", 3, 4)]


def _graph(spark, seed=5, n=40, m=120):
    rng = random.Random(seed)
    edges = [(rng.randrange(n), 3 if rng.random() < 0.3 else rng.randrange(n), rng.randint(1, 9)) for _ in range(m)]
    vertices = spark.range(n).toDF("id")
    return G.PropertyGraph(vertices, spark.createDataFrame(edges, "src long, dst long, weight long")), edges, n


def test_pagerank_by_vertex_matches_plain_python_and_its_front_falls(spark):
    g, edges, n = _graph(spark)
    got, senders = G.pagerank_by_vertex(g, tol=0.001)
    deg = {}
    for s, *_ in edges:
        deg[s] = deg.get(s, 0) + 1
    rank, change, front = {v: 0.15 for v in range(n)}, {v: 0.15 for v in range(n)}, []
    while any(c > 0.001 and v in deg for v, c in change.items()):
        front.append(sum(c > 0.001 and v in deg for v, c in change.items()))
        new = {}
        for s, d, _ in edges:
            if change.get(s, 0) > 0.001:
                new[d] = new.get(d, 0.0) + 0.85 * change[s] / deg[s]
        for v, c in new.items():
            rank[v] += c
        change = new
    assert senders == front and senders[-1] < senders[0]
    assert {r["id"]: pytest.approx(r["rank"]) for r in got.collect()} == rank


@pytest.mark.parametrize("direction", ["out", "in", "both"])
def test_vertex_program_directions(spark, direction):
    g, edges, n = _graph(spark, seed=6, m=50)
    got, _ = G.vertex_program(g, F.lit(None).cast("long"), F.col("state"), F.min, lambda s, m: F.least(s, m),
                              direction=direction, initial=F.col("id"))
    want = {v: v for v in range(n)}
    for _ in range(n):
        for s, d, _ in edges:
            if direction in ("out", "both"):
                want[d] = min(want[d], want[s])
            if direction in ("in", "both"):
                want[s] = min(want[s], want[d])
    assert {r["id"]: r["state"] for r in got.collect()} == want


def test_vertex_program_receiver_guard_and_round_limit(spark):
    g, edges, n = _graph(spark, seed=7)
    here, through = F.col("id") == 0, F.col("state") + F.col("weight")
    guard = F.when(F.col("other").isNull() | (through < F.col("other")), through)
    run = lambda **o: G.vertex_program(g, F.when(here, F.lit(0).cast("long")), guard, F.min,
                                       lambda s, m: F.least(s, m), active=here, receiver=True, **o)
    dist = {0: 0}
    for _ in range(n):
        for s, d, w in edges:
            if s in dist:
                dist[d] = min(dist.get(d, 10 ** 9), dist[s] + w)
    assert {r["id"]: r["state"] for r in run()[0].collect() if r["state"] is not None} == dist
    near, rounds = run(max_rounds=1, strict=False)
    assert rounds == 1 and {r["id"] for r in near.collect() if r["state"] is not None} == {0, *(d for s, d, _ in edges if s == 0)}
    with pytest.raises(G.NotConverged):
        run(max_rounds=1)
    with pytest.raises(ValueError):
        run(direction="up")
