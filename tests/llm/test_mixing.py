import random
import re

import pytest
from pyspark.sql import functions as F

from kestrel.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def levels(sizes, weights, budget, epochs):
    """Reshare the excess by weight until no target is above its bound."""
    total, names = budget * sum(sizes.values()), list(sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped = set()
    while True:
        left = total - sum(epochs * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    out = [(k, " ".join("w%d" % rng.randint(0, 9) for _ in range(rng.randint(0, 60))),
            rng.choice(["hot"] * 5 + ["a", "b", None, "Z", "é"])) for k in range(n)]
    return out + [(n + 1, None, "a"), (n + 2, "x " * 3000, "b")]


def plan(docs, rows, **options):
    return mixing.draw(docs(rows), **options).collect()


@pytest.mark.parametrize("weights,budget", [((3, 1, 2), 1.5), ((1,), 0.4), ((1, 50), 2.0)])
def test_targets_quotas_and_limits(docs, weights, budget):
    rows = corpus()
    got = plan(docs, rows, weights=weights, budget=budget, block_words=100)
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    assert {r["doc_id"]: r["size"] for r in got} == size and len(got) == len(rows)
    sources = sorted({s for _, _, s in rows if s is not None}) + [None]
    sizes = {s: sum(size[i] for i, _, x in rows if x == s) for s in sources}
    want = levels(sizes, weights, budget, 2)
    for s in sources:
        mine = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= 0.5
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    cut = [r for r in got if any(p["words"] not in (0, r["size"]) for p in r["parts"])]
    assert len(cut) <= len(sources)  # only a source's last document is cut


def test_reruns_agree_whatever_the_partitioning(docs):
    rows = corpus(2)
    a = sorted((r["doc_id"], r["taken"], str(r["parts"])) for r in mixing.draw(docs(rows), block_words=50).collect())
    b = sorted((r["doc_id"], r["taken"], str(r["parts"]))
               for r in mixing.draw(docs(rows[::-1]).repartition(7), block_words=50).collect())
    assert a == b


def test_splitting_tree_is_exact_and_near_the_hypergeometric_mean(spark):
    quotas = spark.createDataFrame([(1, 4000), (2, 400), (3, 3), (4, 0)], "sid long, quota long")
    got = mixing.split_quotas(quotas, 6).collect()
    by_source, by_shard = {}, {}
    for r in got:
        by_source[r["sid"]] = by_source.get(r["sid"], 0) + r["n"]
        by_shard[r["shard"]] = by_shard.get(r["shard"], 0) + r["n"]
    assert by_source == {1: 4000, 2: 400, 3: 3}
    assert set(by_shard) == set(range(6)) and max(by_shard.values()) - min(by_shard.values()) <= 2
    mine = {(r["sid"], r["shard"]): r["n"] for r in got}
    assert all(abs(mine[1, s] - 4000 / 6) < 60 and abs(mine[2, s] - 400 / 6) < 45 for s in range(6))


def test_mixed_rows_hold_the_words_taken(docs):
    rows = corpus(3, 120)
    taken = {r["doc_id"]: r["taken"] for r in plan(docs, rows, block_words=80, whole=True)}
    mixed = mixing.mix(docs(rows), block_words=80).collect()
    got = {}
    for r in mixed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
        assert 0 <= r["shard"] < 8
    assert got == {i: n for i, n in taken.items() if n}


def test_odd_rows(odd):
    got = mixing.draw(odd).collect()
    assert len(got) == 9 and sum(r["taken"] for r in got) == round(1.5 * sum(r["size"] for r in got))
    assert all(r["taken"] == 0 for r in got if not r["size"])
    mixed = mixing.mix(odd).withColumn("n", mixing.word_count(F.col("text"))).agg(F.sum("n")).first()[0]
    assert mixed == sum(r["taken"] for r in mixing.draw(odd, whole=True).collect())


def test_empty(docs):
    assert mixing.draw(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0
    assert mixing.draw(docs([(1, None, "a"), (2, "", None)])).agg(F.sum("taken")).first()[0] == 0


def test_whole_documents_are_taken_or_left(docs):
    rows = corpus(4) + [(900, "é\tü  " * 700, "long"), (901, "a\n b " * 900, "long")]
    exact = {r["doc_id"]: r for r in plan(docs, rows, block_words=100)}
    got = {r["doc_id"]: r for r in plan(docs, rows, block_words=100, whole=True)}
    assert set(got) == set(exact)
    assert all(p["words"] == r["size"] for r in got.values() for p in r["parts"])
    cut = {i: r for i, r in exact.items() if r["taken"] % max(r["size"], 1)}
    assert cut and {i for i in got if got[i]["taken"] != exact[i]["taken"]} == set(cut)
    for i, r in cut.items():  # nearer of the two totals
        part = r["taken"] % r["size"]
        assert got[i]["taken"] == r["taken"] - part + (r["size"] if 2 * part >= r["size"] else 0)
    texts = {i: t for i, t, _ in rows}
    assert all(r["text"] == texts[r["doc_id"]] for r in mixing.mix(docs(rows), block_words=100).collect())
