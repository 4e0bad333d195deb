import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import vafile
from kestrel.llm.common import importable

SCHEMA = "vec_id long, embedding array<double>, cluster int, w string"


def brute(rows, k, rounds, dims):
    """Plain Python integers, one vector after the other."""
    ok = [(i, [max(-vafile.LIMIT, min(vafile.LIMIT, math.floor(max(-1e300, min(1e300, 256.0 * x))))) for x in v]) for i, v in rows
          if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centroids = [w for _, w in sorted(ok, key=lambda r: (name(r[0]), r[1]))[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        found = [min((apart(w, c), n) for n, c in enumerate(centroids)) for _, w in ok]
        if turn < rounds:
            for n in range(len(centroids)):
                mine = [w for (_, w), (_, c) in zip(ok, found) if c == n]
                if mine:
                    centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    top = (1 << 63) - 1
    inertia = [min(top, sum(d for d, c in found if c == n)) for n in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    whole = min(top, sum(d for d, _ in found)) if ok else 0
    return sorted(((i, c, d, inertia[c], whole, digest[c]) for (i, _), (d, c) in zip(ok, found)), key=repr)


def run(spark, rows, k, rounds, dims, **options):
    importable(spark)
    df = spark.createDataFrame([(i, v, 9, "x") for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vafile.cluster(df, k=k, rounds=rounds, dims=dims, **options).collect()), key=repr)


@pytest.mark.parametrize("bits,block", [(8, 4096), (4, 16), (1, 7)])
def test_matches_brute_force(spark, bits, block):
    rng = np.random.default_rng(bits)
    middles = rng.normal(0, 1, (5, 6))
    rows = [(int(i), [float(x) for x in middles[i % 5] + rng.normal(0, 0.3, 6)]) for i in range(150)]
    assert run(spark, rows, 7, 3, 6, bits=bits, block=block) == brute(rows, 7, 3, 6)


def test_odd_rows(spark):
    rows = [(None, [1.0, 2.0]), (None, [0.5, 0.5]), (1, None), (2, [1.0]), (3, [1.0, 2.0, 3.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1e300, -1e300]), (9, [-5.5, 0.0]), (10, [])]
    rows += [(11, [3.0, 3.0])] * 200  # copies that hold most of the rows
    for k in (1, 3, 40):
        assert run(spark, rows, k, 5, 2) == brute(rows, k, 5, 2)


def test_ties_go_to_the_smaller_centroid_and_empty_ones_stay(spark):
    rows = [(i, [1.0, 1.0]) for i in range(30)] + [(100, [2.0, 2.0])]
    assert run(spark, rows, 6, 2, 2) == brute(rows, 6, 2, 2)


def test_empty_table(spark):
    assert run(spark, [], 4, 2, 3) == [] and run(spark, [(1, None)], 4, 2, 3) == []


def test_repeated_ids_make_the_first_cut_too_narrow(spark):
    rows = spark.range(4000).selectExpr("IF(id < 3990, 7L, id) vec_id", "array(cast(id as int)) w")
    found = vafile.first_centroids(rows, 12, 4000)
    expected = sorted(((hashlib.sha256(f"2:{7 if i < 3990 else i}".encode()).hexdigest(), i) for i in range(4000)))[:12]
    assert found == [[i] for _, i in expected]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 8), st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=40))
def test_intervals_hold_the_distance(bits, rows):
    w = np.array(rows, dtype=np.int64)
    marks = vafile.borders(w, bits)
    cells = vafile.cells_of(w, marks)
    assert (vafile.unpack(vafile.pack(cells, bits), bits, 3) == cells).all()
    centroids = w[:5]
    low, high = vafile.intervals(cells, marks, centroids)
    exact = ((w[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (low <= exact).all() and (exact <= high).all()


def test_full_vectors_are_fetched_only_where_intervals_overlap(spark):
    """Well-separated groups: after the first round hardly a vector is read again."""
    importable(spark)
    rng = np.random.default_rng(4)
    rows = [(int(i), [int(x) for x in (i % 4) * 1000 + rng.integers(-50, 50, 8)]) for i in range(2000)]
    state = vafile.build(spark.createDataFrame(rows, "vec_id long, w array<int>"), 8)
    centroids = [[1000 * g] * 8 for g in range(4)]
    first = vafile.step(state, centroids, 8, 8)
    again = vafile.step(first, centroids, 8, 8)
    read = [sum(r["fetched"] for r in x.collect()) for x in (first, again)]
    assert read[0] == 2000 and read[1] == 0
