"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a few
differing bits by an exact tiled comparison.

Fingerprints. A-Z are lower-cased, words are runs of anything but ASCII white
space, shingles are ``shingle`` consecutive words joined by one space (fewer
words: the whole sequence). Bit b is set if over half of the shingles' XXH64
(UTF-8, seed 42) have it. No words: fingerprint 0, linked like any other.

Comparison. Rows become distinct fingerprints first, so a group of copies is one
entry whatever its size. Distinct fingerprints are cut into tiles whose members
agree in the population counts of both 32-bit halves. Two fingerprints within
``radius`` bits differ in those counts by at most ``radius`` together, so a tile
meets only tiles whose counts are that near; all other tile pairs are skipped.
The pairs of two classes are dealt over a grid of cells of ``SIDE`` x ``SIDE`` tiles, so
a class that holds most fingerprints is many keys of like size. A met pair of tiles is compared whole with numpy exclusive-or and bit counts,
and gives a spanning forest of its links (at most one row a fingerprint), which
keeps every connection while a large group of near copies cannot emit its square.

Components. The forests are contracted in rounds on Spark: every node moves to
the neighbour of least seeded hash, edges are renamed and thinned, until no edge
is left. Each round is written to the shared folder.

Defined results: null text counts as empty; repeated rows and null ids keep their
rows (a null id never names a component unless all its rows are null); an empty
table gives an empty result; other columns play no part."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, pieces, release

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACES = bytes([9, 10, 11, 12, 13, 32])
_STEP = 1 << 15
TILE = 2048
SIDE = 16  # tiles a side of a grid cell, the work of one key


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()  # bytes: ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _STEP):
        end = min(n, at + _STEP)
        part = [digest(b" ".join(words[k:k + shingle]), 42) for k in range(at, end)]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(votes * 2 > n)
    return int(sum(1 << int(b) for b in set_bits))


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): one row per input row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            fps = np.array([fingerprint(x, shingle) for x in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], [key, "fp"])

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, fp bigint")


def _halves(fp) -> list[F.Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 32)), F.bit_count(F.col(fp).bitwiseAND(F.lit((1 << 32) - 1)))]


def tiles(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """(hi, lo, no, members): distinct fingerprints by the population counts of
    their halves, cut by hash into tiles of about ``tile``."""
    hi, lo = _halves("fp")
    rows = distinct.select("fp", hi.alias("hi"), lo.alias("lo"))
    cut = (rows.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"))
           .select("hi", "lo", F.ceil(F.col("n") / tile).alias("parts")))  # at most 33 * 33 rows
    return (rows.join(F.broadcast(cut), ["hi", "lo"])
            .groupBy("hi", "lo", F.pmod(F.xxhash64(F.lit(11), "fp"), F.col("parts")).alias("no"))
            .agg(F.sort_array(F.collect_list("fp")).alias("members")))


def _near(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a x b within radius; for one tile, each pair once."""
    left, right = [], []
    step = max(1, (1 << 18) // max(len(b), 1))
    for at in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[at:at + step, None] ^ b[None, :]) <= radius)
        i += at
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        left.append(i)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[int]:
    """Positions of links that form a spanning forest (union-find)."""
    root = list(range(n))
    out = []
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(k)
    return out


def met(tiled: DataFrame, radius: int = 3, side: int = SIDE) -> DataFrame:
    """(cell, same, a, b): every pair of tiles that may hold a link, once; ``cell`` is the
    grid cell, with at most about ``side ** 2`` pairs."""
    steps = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1)
             if abs(x) + abs(y) <= radius and (x, y) >= (0, 0)]
    shift = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])).alias("s")
    grid = tiled.groupBy("hi", "lo").agg(F.ceil(F.count(F.lit(1)) / side).cast("int").alias("g"))
    grid = materialize(grid, "tile-grid")  # at most 33 * 33 rows
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def placed(x: str, y: str, sign: int, mine: str, other: str, columns: list) -> DataFrame:
        own = tiled.select("*", shift)
        meets = [(F.col("hi") + sign * F.col("s.x")).alias("_h"), (F.col("lo") + sign * F.col("s.y")).alias("_l")]
        own = own.select("*", *meets).join(F.broadcast(grid.withColumnsRenamed({"hi": "_h", "lo": "_l", "g": "_g"})), ["_h", "_l"])
        own = own.join(F.broadcast(grid), ["hi", "lo"])
        return own.select(F.struct(F.col(x).alias("hi"), F.col(y).alias("lo")).alias("class"), "s", F.pmod("no", "g").cast("int").alias(mine),
                          every("_g").alias(other), *columns)

    left = placed("_h", "_l", 1, "i", "j", [F.col("no").alias("no1"), F.col("members").alias("a")])
    right = placed("hi", "lo", -1, "j", "i", ["no", F.col("members").alias("b")])
    own = (F.col("s.x") == 0) & (F.col("s.y") == 0)
    return (left.join(right, ["class", "s", "i", "j"]).where(~own | (F.col("no1") <= F.col("no")))
            .select(F.struct("class", "s", "i", "j").alias("cell"), (own & (F.col("no1") == F.col("no"))).alias("same"), "a", "b"))


def links(tiled: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``radius`` bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, a, b in zip(batch.column("same").to_pylist(), batch.column("a"), batch.column("b")):
                x, y = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (a, b))
                i, j = _near(x, y, radius, same)
                if len(i):
                    kept = _forest(i, j if same else j + len(x), len(x) + (0 if same else len(y)))
                    yield pa.RecordBatch.from_arrays([pa.array(x[i[kept]].view(np.int64)),
                                                      pa.array(y[j[kept]].view(np.int64))], ["a", "b"])

    return met(tiled, radius).select("same", "a", "b").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): nodes of each connected component of ``edges(a, b)`` share a
    root. Nodes without an edge are absent."""
    edges = materialize(edges.where("a != b").distinct(), "links")
    maps: list[DataFrame] = []
    level = 0
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c, k=level: F.xxhash64(F.lit(k), c)
        best = F.min(F.struct(rank("b").alias("h"), F.col("b").alias("v"))).alias("m")
        own = F.struct(rank("a").alias("h"), F.col("a").alias("v"))
        moved = (both.groupBy("a").agg(best)
                 .select(F.col("a").alias("node"), F.least(F.col("m"), own)["v"].alias("to")))
        moved = materialize(moved, "moves")
        maps.append(moved)
        to_a = moved.select(F.col("node").alias("a"), F.col("to").alias("x"))
        to_b = moved.select(F.col("node").alias("b"), F.col("to").alias("y"))
        renamed = (edges.join(to_a, "a").join(to_b, "b").where("x != y")
                   .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        fresh = materialize(renamed, "links")
        release(edges)
        edges = fresh
        level += 1
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[-1].select("node", F.col("to").alias("root"))
    for lower in reversed(maps[:-1]):  # nodes of a lower level follow their target's root
        up = out.select(F.col("node").alias("to"), "root")
        out = materialize(lower.join(up, "to", "left").select("node", F.coalesce("root", "to").alias("root")), "roots")
    return out


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text",
                    tile: int = TILE) -> DataFrame:
    """(key, fingerprint, component_id): ``fingerprint`` as 16 lower-case hex
    digits, ``component_id`` the smallest key reachable over links."""
    rows = materialize(fingerprints(docs, shingle, key, text), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min(key).alias("first")), "distinct-fingerprints")
    tiled = materialize(tiles(distinct, tile), "tiles")
    grouped = components(links(tiled, radius))
    release(tiled)
    rooted = materialize(distinct.join(grouped.withColumnRenamed("node", "fp"), "fp", "left"), "rooted")
    # Written, so that both sides of the next join are plain scans: a large component's fingerprints can be split.
    least = materialize(rooted.where("root is not null").groupBy("root").agg(F.min("first").alias("least")), "least")
    named = rooted.join(least, "root", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    named = materialize(named, "components")
    return (rows.join(named, "fp")
            .select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
