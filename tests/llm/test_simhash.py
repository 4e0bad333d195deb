import random

import pytest
import xxhash
from pyspark.sql import functions as F

from kestrel.llm import simhash


def brute_fingerprint(text, n=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [words] if len(words) < n else [words[k:k + n] for k in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=3):
    """(id, fingerprint, component) by testing every pair."""
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _, _) in enumerate(rows)), key=str)


def corpus(seed=1, groups=25):
    rng = random.Random(seed)
    rows, k = [], 0
    for _ in range(groups):
        words = ["W%d" % rng.randint(0, 400) for _ in range(rng.choice([1, 2, 5, 80, 300]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 3])):
                copy[rng.randrange(len(copy))] = "edit%d" % rng.randint(0, 99)
            rows.append((k * 7 % 1009, rng.choice(["", " ", "\n"]).join(["", " \t".join(copy)]), "s"))
            k += 1
    return rows


def test_spark_hash_is_the_same_xxh64(spark):
    got = spark.createDataFrame([("a b c",), ("été 漢字",), ("x" * 100,)], "t string").select("t", F.xxhash64("t").alias("h"))
    for r in got.collect():
        assert r["h"] % (1 << 64) == xxhash.xxh64_intdigest(r["t"].encode(), seed=42)


@pytest.mark.parametrize("tile", [4, 2048])
def test_components_match_brute_force(docs, tile):
    rows = corpus() + [(5000, None, None), (5001, "", "a"), (None, " \n", "b"), (5002, "one", "a"), (5002, "one", "a")]
    got = simhash.near_duplicates(docs(rows, [("fp", "string", "x"), ("component_id", "int", 1)]), tile=tile).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == brute(rows)


def test_random_fingerprints_keep_every_link(spark):
    """Chains of single-bit steps, dense balls and far points, by fingerprint."""
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(20):
        x = rng.getrandbits(64)
        for _ in range(15):
            fps.add(x)
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                x ^= 1 << b
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    distinct = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    grouped = {r["node"]: r["root"] for r in simhash.components(simhash.links(simhash.tiles(distinct, 8), 3)).collect()}
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 3:
                parent[find(x)] = find(y)
    sizes = {}
    for x in fps:
        sizes.setdefault(find(x), []).append(x)
    for members in sizes.values():
        roots = {grouped.get(m - (1 << 64) if m >> 63 else m) for m in members}
        assert (roots == {None}) == (len(members) == 1) and len(roots) == 1
    named = {}
    for node, root in grouped.items():
        named.setdefault(root, set()).add(node)
    assert len(named) == sum(len(m) > 1 for m in sizes.values())


def test_links_of_a_dense_group_stay_few(spark):
    base = random.Random(8).getrandbits(63)
    fps = [base ^ (1 << b) for b in range(60)]  # every pair within 2 bits
    n = simhash.links(simhash.tiles(spark.createDataFrame([(x,) for x in fps], "fp bigint"), 16), 3).count()
    assert n < 60 * 20 < 60 * 59 / 2


def test_long_path_contracts(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)], "a bigint, b bigint")
    got = simhash.components(edges).collect()
    assert len(got) == 201 and len({r["root"] for r in got}) == 1


def test_empty(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert [tuple(r) for r in simhash.near_duplicates(docs([(3, None, "a")])).collect()] == [(3, "0" * 16, 3)]


def test_a_hot_class_is_dealt_over_grid_cells(spark):
    """Half of all fingerprints in one class of population counts: no key holds more than
    its square of tile pairs, every pair is met once, and the links are those of brute force."""
    rng = random.Random(8)

    def counts(hi, lo):
        bits = rng.sample(range(32), lo) + [32 + b for b in rng.sample(range(32), hi)]
        return sum(1 << b for b in bits)

    fps = {counts(16, 16) for _ in range(700)} | {rng.getrandbits(64) for _ in range(700)}
    fps |= {f ^ (1 << rng.randrange(64)) for f in list(fps)[:200]}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    tiled = simhash.materialize(simhash.tiles(spark.createDataFrame([(f,) for f in signed], "fp long"), tile=16), "t")
    met = simhash.materialize(simhash.met(tiled, 3, side=4), "t")
    per = met.groupBy("cell").count().agg(F.max("count"), F.count("count")).first()
    assert per[0] <= 4 * 6 * 6 and per[1] > 100  # hashes fill cells unevenly
    pairs = met.select(F.array_min("a").alias("x"), F.array_min("b").alias("y"), "same")
    assert pairs.count() == pairs.distinct().count()
    near = {(min(a, b), max(a, b)) for k, a in enumerate(signed) for b in signed[k + 1:]
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    grouped = {r["node"]: r["root"] for r in simhash.components(simhash.links(tiled)).collect()}
    assert all(grouped[a] == grouped[b] for a, b in near)
    assert set(grouped) == {x for p in near for x in p}
