import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.llm import topk

SCHEMA = "vec_id long, embedding array<double>, rank int, w string"


def brute(rows, k, scale=64.0):
    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * scale) for x in v):
            continue
        ok.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for n, (q, a) in enumerate(ok):
        if q % 3 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(ok) if m != n)[:k]
            out += [(q, r + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, i) in enumerate(best)]
    return sorted(out)


def search(spark, rows, k, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)
    found = topk.top_k(df, F.col("vec_id") % 3 == 0, k=k, **options)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


def test_matches_brute_force_with_ties_nulls_and_small_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.choice([-0.5, 0.0, 0.25, 1.0], 6)]) for i in range(60)]
    rows += [(None, [1.0] * 6), (61, None), (62, [float("nan")] * 6), (63, [1.0, None]), (66, [float("inf")]), (69, [1.0, 2.0]),
             (5, [9.0] * 6), (5, [9.0] * 6), (5, [7.0] * 6), (72, [])]
    assert search(spark, rows, 4, block=7, query_block=5) == brute(rows, 4)


def test_exact_beyond_64_bits(spark):
    rows = [(0, [2.0 ** 40, -3.0]), (1, [2.0 ** 18, 1.0]), (2, [2.0 ** 18, 2.0]), (3, [1e-3, 0.5])]
    assert search(spark, rows, 2) == brute(rows, 2)


def test_empty_and_fewer_than_k(spark):
    assert search(spark, [], 3) == []
    assert search(spark, [(0, [1.0])], 3) == []
    assert search(spark, [(0, [1.0]), (1, [2.0])], 3) == [(0, 1, 1, 64 * 128)]


def test_rows_of_one_id_are_queries_and_candidates_each(spark):
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [0.5, 2.0]), (4, [1.0, 1.0]), (4, [1.0, 1.0]), (5, [-1.0, 0.0]), (6, [0.0, 0.0])]
    for k in (1, 3, 10):
        assert search(spark, rows, k) == brute(rows, k)
    assert search(spark, [(3, [1.0])] * 40 + [(4, [2.0])], 3, block=5, query_block=4) == brute([(3, [1.0])] * 40 + [(4, [2.0])], 3)


def test_sparse_rows_of_many_terms(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(45):
        v = np.zeros(3000)
        v[rng.choice(3000, 12)] = rng.choice([-1.0, 0.5, 2.0], 12)
        v[7] = float(i % 2)
        rows.append((i, v.tolist()))
    assert search(spark, rows, 5, block=11, query_block=6) == brute(rows, 5)


def sparse(m):
    term = np.tile(np.arange(m.shape[1]), len(m))[m.ravel() != 0]
    return topk.Sparse(np.append(0, np.cumsum((m != 0).sum(axis=1))), term, m.ravel()[m.ravel() != 0])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=30), st.integers(1, 30))
def test_term_at_a_time_scores_equal_inner_products(rows, tile):
    m = np.array(rows, dtype=np.int32)
    for at, strip in sparse(m).postings(tile):
        for first, posted in sparse(m).postings(tile):
            assert (topk.accumulate(strip, posted) == m[at:at + tile] @ m[first:first + tile].T).all()


@pytest.mark.parametrize("top,kind", [(2.0 ** 10, np.int32), (2.0 ** 20, np.int64), (2.0 ** 40, object)])
def test_sums_are_kept_in_a_kind_that_holds_them(top, kind):
    assert topk.Sparse(np.array([0, 1]), np.array([0]), np.array([top])).integers(top, 4).value.dtype == kind
