"""Queries without a SQL oracle (iterative / ML), checked against brute-force
numpy computations on the sf0.001 tables."""

import duckdb
import numpy as np

import __spark_entry__ as E
from kestrel.operators import graph as G
from kestrel.operators import ml
from kestrel.plans import queries as Q
from kestrel.sources import derived

SF = "/root/testdata/sf0.001"


def _duck(sql):
    con = duckdb.connect()
    for t in ("lineitem", "part", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con.execute(sql).fetchnumpy()


def test_kmeans_assignment_is_nearest_center_and_cost(spark):
    pts = Q._points(spark, SF)
    model = ml.kmeans_fit(pts, k=2, max_iter=20, seed=1)
    centers = np.array([list(c) for c in model.clusterCenters()])
    got = {r["vec_id"]: r["cluster"] for r in model.transform(pts).collect()}
    emb = _duck("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id")
    X = np.array([np.array(e, dtype=np.float64) for e in emb["embedding"]])
    d2 = ((X[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    nearest = d2.argmin(axis=1)
    assert [got[int(v)] for v in emb["vec_id"]] == list(nearest)
    cost = ml.kmeans_cost(model, pts).first()["cost"]
    assert abs(cost - d2.min(axis=1).sum()) < 1e-6 * max(1.0, cost)


def test_linreg_sgd_matches_numpy(spark):
    li = _duck("SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem")
    x, y, w = li["x"].astype(float), li["y"].astype(float), 0.0
    for t in range(1, 101):
        w -= 1e-8 / np.sqrt(t) * np.mean((w * x - y) * x)
    got = E.queries()["linreg_sgd"](spark, SF).first()["coefficient"]
    assert abs(got - w) <= 1e-9 * max(1.0, abs(w))


def test_pagerank_tolerance_top10_matches_numpy(spark):
    g = derived.part_graph(spark, SF)
    edges = np.array([(r["src"], r["dst"]) for r in g.edges.collect()])
    ids = np.array(sorted(r["id"] for r in g.vertices.collect()))
    pos = {v: i for i, v in enumerate(ids)}
    s = np.array([pos[a] for a in edges[:, 0]])
    d = np.array([pos[b] for b in edges[:, 1]])
    outdeg = np.bincount(s, minlength=len(ids)).astype(float)
    rank = np.ones(len(ids))
    for _ in range(100):
        new = 0.15 + 0.85 * np.bincount(d, weights=rank[s] / outdeg[s], minlength=len(ids))
        delta = np.abs(new - rank).max()
        rank = new
        if delta < 0.001:
            break
    got = E.queries()["graph_pagerank_top"](spark, SF).collect()
    order = sorted(range(len(ids)), key=lambda i: (-rank[i], ids[i]))[:10]
    assert [r["id"] for r in got] == [int(ids[i]) for i in order]
    assert np.allclose([r["rank"] for r in got], [rank[i] for i in order], atol=1e-6)
    r, n = G.pagerank(g, max_iter=100, tol=0.001)
    assert n <= 100


def test_als_and_tree_metrics_equal_brute_force(spark):
    als = E.queries()["als_fit_score"](spark, SF).first()
    assert als["rows"] == Q._ratings(spark, SF).count() and als["below_spread"]  # every training pair is scored
    tree = E.queries()["tree_error"](spark, SF).first()
    train, test = ml.hash_split(Q._doc_points(spark, SF), ["doc_id"], 7)
    model = ml.tree_fit(train)
    preds = [(r["label"], r["prediction"]) for r in model.transform(test).collect()]
    assert tree["rows"] == len(preds) and tree["positives"] == sum(a for a, _ in preds)
    wrong = np.mean([a != b for a, b in preds])
    assert abs(ml.error_rate(model.transform(test)).first()["error_rate"] - wrong) < 1e-12
    assert tree["beats_majority"] == (wrong <= min(np.mean([a for a, _ in preds]), 1 - np.mean([a for a, _ in preds])))


def test_document_text_stays_at_the_scan(spark):
    plan = Q._doc_points(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "text#" not in plan[:plan.index("Join")]
