from pyspark.sql import functions as F

from kestrel.operators import layout, ml
from kestrel.operators.materialize import materialize


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_materialize_observes_metric(spark):
    df = spark.range(100).select("id", (F.col("id") % 4 == 0).alias("flag"))
    out, n = materialize(df, "t", F.sum(F.col("flag").cast("long")))
    assert n == 25 and out.count() == 100
    assert "FileScan parquet" in _plan(out)


def test_seeded_random_split_is_repeatable(spark):
    df = spark.range(1000)
    a = sorted(r[0] for r in ml.random_split(df, [0.7, 0.3], seed=7)[1].collect())
    b = sorted(r[0] for r in ml.random_split(df, [0.7, 0.3], seed=7)[1].collect())
    assert a == b and 200 < len(a) < 400


def test_partition_summary(spark):
    df = spark.createDataFrame([(k,) for k in range(20)], "k int")
    s = layout.partition_summary(layout.partition_by_key(df, "k", 4), "k")
    got = sorted((r["partition"], r["rows"], r["min_key"], r["max_key"]) for r in s.collect())
    assert got == [(0, 5, 0, 16), (1, 5, 1, 17), (2, 5, 2, 18), (3, 5, 3, 19)]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=40), st.integers(1, 7))
def test_partition_law(spark, keys, n):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    for r in layout.partition_layout(layout.partition_by_key(df, "k", n)).collect():
        assert r["partition"] == r["k"] % n     # Python % is the positive modulus


def test_itemsets_are_anti_monotone(spark):
    from itertools import combinations
    rows = [("a b c",), ("a b",), ("a c",), ("b c d",), ("a b c d",), ("d",)]
    from kestrel.sources import readers
    fi = ml.frequent_itemsets(readers.parse_basket(spark.createDataFrame(rows, "value string")), 0.3)
    freq = {frozenset(r["items"]): r["freq"] for r in fi.collect()}
    for items, f in freq.items():
        for k in range(1, len(items)):
            for sub in combinations(items, k):
                assert freq[frozenset(sub)] >= f


def test_nest_and_tree_printout(spark):
    from kestrel.operators import ranking
    df = spark.createDataFrame([(1, 10, 3)], "province int, adid int, clicks bigint")
    r = ranking.nest(df, ["province"], ["adid", "clicks"]).first()
    assert r["province"] == 1 and r["value"]["adid"] == 10 and r["value"]["clicks"] == 3
    pts = spark.createDataFrame([(float(i % 2), float(i % 2)) for i in range(20)], "label double, x double")
    pts = pts.select("label", ml.as_vector(F.array("x")).alias("features"))
    assert "If (feature 0" in ml.tree_debug_string(ml.tree_fit(pts))


def test_release_deletes_only_materialized_folder(spark):
    import os

    from kestrel.operators.materialize import release
    out = materialize(spark.range(10), "rel")
    path = out._kestrel_path
    local = path.replace("file:", "")
    assert os.path.exists(local)
    release(out)
    assert not os.path.exists(local)
    release(spark.range(3))   # not materialised: nothing happens


def test_checkpoint_folder_comes_from_the_session(spark):
    from kestrel.session import ensure_checkpoint_dir, scratch_path
    root = ensure_checkpoint_dir(spark)
    assert scratch_path(spark, "x").startswith(root.rstrip("/"))


def test_cluster_without_checkpoint_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    from kestrel.session import ensure_checkpoint_dir
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default=None: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))
    given = SimpleNamespace(master="yarn", getCheckpointDir=lambda: "hdfs://given")
    assert ensure_checkpoint_dir(SimpleNamespace(sparkContext=given, conf=conf)) == "hdfs://given"
