import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from kestrel.llm import bpe, mixing, quality, secrets, simhash, tokens
from kestrel.llm.common import importable, table

SF = "/root/testdata/sf0.001"


def run_stage(name, spark, docs):
    return dict(P.STAGES)[name](spark, docs, SF)


def test_stage_order_and_columns(spark):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "tokens"]
    importable(spark)
    docs = table(spark, SF, "documents")
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == P.COLUMNS, name


def test_whole_run_against_brute_force(spark):
    """Every stage's decision repeated from its input with the single-row functions."""
    importable(spark)
    docs = table(spark, SF, "documents")
    start = {r["doc_id"]: r for r in docs.collect()}
    model = quality.quality_model(spark, docs, table(spark, SF, "labels"))
    w, bias = model

    def kept(text):
        columns, runs = quality.features(text)
        z = bias + (quality.SCALE / runs * float(w[columns].sum()) if runs else 0.0)
        return z >= -0.8472978603872037  # a score of 0.3

    one = P.materialize(run_stage("quality", spark, docs), "t")
    first = {r["doc_id"]: r["text"] for r in one.collect()}
    assert first == {k: r["text"] for k, r in start.items() if kept(r["text"])}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert all(k in first for k, q in labels.items() if q == 1)  # clean documents stay

    two = P.materialize(run_stage("near_duplicates", spark, one), "t")
    second = {r["doc_id"]: r["text"] for r in two.collect()}
    prints = {k: simhash.fingerprint(t) for k, t in first.items()}
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    names = sorted(prints)
    for i, a in enumerate(names):
        for b in names[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert second == {k: first[k] for k in names if find(k) == k}

    three = P.materialize(run_stage("secrets", spark, two), "t")
    third = {r["doc_id"]: r for r in three.collect()}
    assert set(third) == set(second) and all(r["n_chars"] == len(r["text"]) for r in third.values())
    known = re.compile(r'AKIA[A-Z2-7]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = ")[0-9a-f]{40}')
    assert all(r["text"] == known.sub(secrets.MASK, second[k]) for k, r in third.items())

    four = P.materialize(run_stage("mixing", spark, three), "t")
    plan = {r["doc_id"]: r for r in mixing.draw(three, whole=True).collect()}
    words = {}
    for r in four.collect():
        assert r["n_chars"] == len(r["text"]) and r["source"] == third[r["doc_id"]]["source"]
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert words == {k: r["taken"] for k, r in plan.items() if r["taken"]}

    path = tokens.default_tokenizer()
    library = tokens.load(path)
    want = []
    for r in four.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, run_stage("tokens", spark, four).collect())) == sorted(want)
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(want)
    assert bpe.decode([], path) == ""


@pytest.mark.parametrize("stage", [n for n, _ in P.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, docs, stage):
    got = run_stage(stage, spark, odd)
    rows = got.collect()
    assert (got.columns == P.COLUMNS) == (stage != "tokens")
    if stage in ("secrets", "tokens"):
        assert len(rows) == 9
    if stage == "near_duplicates":
        texts = [r["text"] for r in rows]
        assert sorted(t for t in texts if t and t.strip()) == sorted({r["text"] for r in odd.collect() if r["text"] and r["text"].strip()})
        assert len(texts) - sum(bool(t and t.strip()) for t in texts) == 1  # one of all empty texts
        assert {r["doc_id"] for r in rows} == {1, 2, 5, 6}
    assert run_stage(stage, spark, docs([])).count() == 0


def test_groups_of_copies_leave_one(spark, docs):
    rng = random.Random(2)
    base = [" ".join("w%d" % rng.randint(0, 999) for _ in range(200)) for _ in range(5)]
    rows = [(k, base[k % 5], "s") for k in range(50)] + [(3, base[3], "s")]
    got = run_stage("near_duplicates", spark, docs(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == [0, 1, 2, 3, 4]


def test_stages_run_in_a_session_that_has_observed(spark, docs):
    """An observation manager in the session must not reach the tasks that score."""
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rng = random.Random(6)
    rows = [(k, " ".join("w%d" % rng.randint(0, 99) for _ in range(30))
             + (" AKIA" + "".join(rng.choice("ABCDEFGH234567") for _ in range(16)) if k % 2 else " %020d" % rng.randrange(10 ** 20)), "s")
            for k in range(60)]
    found = secrets.scan(docs(rows)).collect()
    assert {r["is_secret"] for r in found} == {0, 1}
    assert any(secrets.MASK in r["text"] for r in run_stage("secrets", spark, docs(rows)).collect())
