import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import quality
from kestrel.llm.common import smallest


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "stone", "river", "light", "window", "garden", "letter"]
    rows, labels = [], []
    for k in range(n):
        body = [rng.choice(words) for _ in range(rng.choice([8, 40, 200]))]
        good = k % 4 != 0
        if not good:
            kind = k // 4 % 3
            body = [w.upper() + "!!" for w in body] if kind == 0 else [body[0]] * len(body) if kind == 1 else " | ".join(body).split()
        rows.append((k, " ".join(body), "s%d" % (k % 3)))
        labels.append((k, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus()
    df = docs(rows, [("score", "string", "x"), ("label", "int", 5), ("predicted", "int", 9)])
    model = quality.quality_model(spark, df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in quality.score(df, model).withColumn("held", quality.held_out("doc_id")).collect()}
    out = [k for k, *_ in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sorted(out) == sorted(k for k, r in got.items() if r["held"])
    right = sum(got[k]["predicted"] == (k % 4 != 0) for k in out)
    assert right >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["label"] == 5 for r in got.values())


def test_labels_of_held_out_rows_are_not_learned(spark, docs):
    rows, labels = corpus()
    df = docs(rows)
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, t) for k, q, t in labels]
    fit = lambda x: quality.quality_model(spark, df, spark.createDataFrame(x, "doc_id long, quality int, toxic int"))
    (a, p), (b, q) = fit(labels), fit(flipped)
    assert p == q and (a == b).all()


def test_scores_do_not_depend_on_source_lang_or_id(spark, docs):
    rows, labels = corpus()
    model = quality.quality_model(spark, docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    moved = docs([(k + 10_000, t, "other") for k, t, _ in rows])
    a = sorted(r["score"] for r in quality.score(docs(rows), model).collect())
    assert a == sorted(r["score"] for r in quality.score(moved, model).collect())


def test_ftrl_matches_a_plain_loop():
    """Sparse updates against the dense textbook recursion."""
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(6, 3, replace=False)), rng.random(3).astype(np.float32), float(rng.integers(2))) for _ in range(40)]
    w, bias = quality.ftrl(rows, epochs=2, alpha=0.5, beta=1.0, l1=0.05, l2=0.1, seed=3)
    z, n = [0.0] * 7, [0.0] * 7
    order = np.random.default_rng(3)

    def value(i):
        if abs(z[i]) <= 0.05:
            return 0.0
        return -(z[i] - np.sign(z[i]) * 0.05) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.1)

    for _ in range(2):
        for k in order.permutation(len(rows)):
            x = {int(i): float(v) for i, v in zip(*rows[k][:2])} | {6: 1.0}
            p = 1 / (1 + np.exp(-sum(value(i) * v for i, v in x.items())))
            for i, v in x.items():
                g, old = (p - rows[k][2]) * v, value(i)
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5
                z[i] += g - sigma * old
                n[i] += g * g
    assert np.allclose(w[:6], [value(i) for i in range(6)], atol=1e-6) and abs(bias - value(6)) < 1e-9
    assert not w[6:].any()


def test_long_texts_are_featurised_in_pieces(monkeypatch):
    text = "Some words, AND more! " * 200
    whole = quality.features(text)
    monkeypatch.setattr(quality, "SEGMENT", 50)
    parts = quality.features(text)
    assert whole[1] == parts[1] and (np.sort(whole[0]) == np.sort(parts[0])).all()


@pytest.mark.parametrize("labels", [[], [(1, None, 0)], [(None, 1, 0)], [(99, 1, 0)], [(2, 1, 0), (2, 1, 0)]])
def test_little_to_learn_from(spark, docs, labels):
    df = docs([(1, "a b", "s"), (2, "c d", "s")])
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.score(df, quality.train(df, marked)).collect()
    assert len(got) == 2 and all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(odd, labels)
    got = quality.score(odd, model)
    assert got.count() == 9 and got.where("score is null or predicted is null").count() == 0
    assert len({r["score"] for r in got.where("text is null or trim(text) = ''").collect()}) <= 2
    assert quality.score(docs([]), model).count() == 0
    assert quality.features(None) [1] == 0 and quality.features("\x85  ")[1] == 0


def test_smallest_takes_at_most_n_by_hash(spark):
    df = spark.range(5000)
    got = smallest(df, F.xxhash64("id"), ["id"], 200)
    order = sorted(df.select("id", F.xxhash64("id").alias("h")).collect(), key=lambda r: r["h"])
    assert [r["id"] for r in got.collect()] == [r["id"] for r in order[:200]]
    assert smallest(df, F.xxhash64("id"), ["id"], 9999).count() == 5000
