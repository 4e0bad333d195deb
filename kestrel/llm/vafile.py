"""Centroid clustering (Lloyd's rounds in exact integers) over a VA-file.

Every vector is compressed to a few-bit cell per dimension. A task writes its vectors
as blocks into one binary file of the shared folder: a block holds the borders of its
cells (from its own vectors, so outliers elsewhere cost nothing), the packed
cells, the full vectors and the ids. A round scans the cells alone: lookup tables of
the squared distance from each cell to each centroid give every vector an interval per
centroid. If one centroid's upper bound lies below all other lower bounds, the vector
is assigned; full vectors are fetched, by ranges of the file, only where intervals
overlap, and of vectors that change their cluster, whose components move from one
running sum to another. A round leaves one small row a block (its assignment and the
sums moved), written to the shared folder; sums are added on Spark, and one row a
centroid reaches the driver.

Integers: components are floor(scale * x). Those beyond +-2**27 count as that bound, so
that distances fit 64 bits; inertias beyond 64 bits are clipped. A centroid's new
component is floor(sum / count), exact.

Defined results: vectors that are null, of another length, or hold null or non-finite
components are left out; a null id is kept and assigned, and starts a centroid only when
there are too few ids (hash order: null last, ties by vector); repeated rows count each;
with fewer vectors than centroids each starts one; an empty table gives an empty result;
other columns are not read."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, release, scratch_path
from kestrel.llm.files import reading, writing

BITS, BLOCK = 8, 4096
LIMIT = 1 << 27
GAP = 64  # rows between two wanted ones that are read along rather than skipped
STATE = "path string, at bigint, n int, clusters binary, fetched bigint, c array<int>, m array<bigint>, s array<array<bigint>>"


def quantised(vectors: DataFrame, scale: float = 256.0, dims: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, w): floor(scale * x) of every valid vector of ``dims`` components."""
    x = F.transform(vector, lambda v: v.cast("double"))
    valid = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    bound = float(LIMIT)
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), v * scale))).cast("int"))
    return (vectors.where(F.col(vector).isNotNull() & (F.size(vector) == dims)).where(valid)
            .select(F.col(key).cast("long").alias("vec_id"), whole.alias("w")))


def first_centroids(rows: DataFrame, k: int, total: int, salt: str = "2:") -> list[list[int]]:
    """The ``k`` vectors of least sha256 of salt and id. A cut on the hash leaves about
    ``k`` rows to sort; where repeated ids make it too narrow, all rows are sorted."""
    keyed = rows.select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "w")
    share = min(1.0, (k + 8 * k ** 0.5 + 8) / max(total, 1))
    edge = format(min((1 << 64) - 1, int(share * (1 << 64))), "016x")
    least = lambda df: df.orderBy(F.col("h").asc_nulls_last(), "w").limit(k).collect()  # noqa: E731  k rows
    found = least(keyed.where(F.substring("h", 1, 16) <= edge))
    if len(found) < min(k, total):
        found = least(keyed)
    return [list(r["w"]) for r in found]


# --- blocks -------------------------------------------------------------------
def pack(cells: np.ndarray, bits: int) -> np.ndarray:
    """Rows of cell numbers as packed bits, each row on whole bytes."""
    return np.packbits(np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits:].reshape(len(cells), -1), axis=1)


def unpack(packed: np.ndarray, bits: int, dims: int) -> np.ndarray:
    flat = np.unpackbits(packed, axis=1)[:, :dims * bits].reshape(-1, dims, bits)
    out = np.zeros(flat.shape[:2], dtype=np.uint8)
    for k in range(bits):
        out = out << np.uint8(1) | flat[:, :, k]
    return out


def borders(w: np.ndarray, bits: int) -> np.ndarray:
    """(dims, 2**bits + 1): cell c of a dimension holds values from border c up to, but
    without, border c + 1. Cells are as wide as the cube root of the density asks, which
    keeps the sum of interval widths small: neither equal widths (wasted on the tails)
    nor quantiles (whose outer cells span the tails)."""
    cells, fine = 1 << bits, 4 << bits
    out = np.empty((w.shape[1], cells + 1), dtype=np.int32)
    for d in range(w.shape[1]):
        low, high = int(w[:, d].min()), int(w[:, d].max()) + 1
        counts, edges = np.histogram(w[:, d], bins=min(fine, high - low), range=(low, high))
        mass = np.concatenate([[0.0], np.cumsum(np.cbrt(counts + 0.25))])
        out[d] = np.ceil(np.interp(np.linspace(0.0, mass[-1], cells + 1), mass, edges))
        out[d, 0], out[d, -1] = low, high
    return out


def cells_of(w: np.ndarray, marks: np.ndarray) -> np.ndarray:
    out = np.empty(w.shape, dtype=np.uint8)
    for d in range(w.shape[1]):
        out[:, d] = np.searchsorted(marks[d, 1:-1], w[:, d], side="right")
    return out


def tables(marks: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(dims, cells, centroids): least and largest squared distance from a cell."""
    low, high = marks[:, :-1, None].astype(np.int64), marks[:, 1:, None].astype(np.int64) - 1
    c = centroids.T[:, None, :].astype(np.int64)
    below, above = low - c, c - high
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    return near * near, far * far


def intervals(cells: np.ndarray, marks: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance of every row to every centroid."""
    near, far = tables(marks, centroids)
    low = np.zeros((len(cells), len(centroids)), dtype=np.int64)
    high = np.zeros_like(low)
    for d in range(cells.shape[1]):
        low += near[d][cells[:, d]]
        high += far[d][cells[:, d]]
    return low, high


class Block:
    """One block of a VA-file, opened for a task."""

    def __init__(self, path: str, at: int, n: int, dims: int, bits: int):
        self.file, self.at, self.n, self.dims, self.bits = reading(path), at, n, dims, bits
        self.marks_size, self.row_size = dims * ((1 << bits) + 1) * 4, -(-dims * bits // 8)
        self.vectors_at = at + self.marks_size + n * self.row_size
        self.ids_at = self.vectors_at + n * dims * 4

    def approximation(self) -> tuple[np.ndarray, np.ndarray]:
        raw = self.file.read_at(self.marks_size + self.n * self.row_size, self.at)
        marks = np.frombuffer(raw, dtype="<i4", count=self.marks_size // 4).reshape(self.dims, -1)
        packed = np.frombuffer(raw, dtype=np.uint8, offset=self.marks_size).reshape(self.n, self.row_size)
        return marks, unpack(packed, self.bits, self.dims)

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """Full vectors of ascending rows, read in runs."""
        out = np.empty((len(rows), self.dims), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(rows) > GAP) + 1).tolist(), len(rows)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                first, last = int(rows[a]), int(rows[b - 1])
                raw = self.file.read_at((last - first + 1) * self.dims * 4, self.vectors_at + first * self.dims * 4)
                out[a:b] = np.frombuffer(raw, dtype="<i4").reshape(-1, self.dims)[rows[a:b] - first]
        return out

    def ids(self) -> pa.Array:
        raw = self.file.read_at(self.n * 9, self.ids_at)
        valid = np.frombuffer(raw, dtype=np.uint8, offset=self.n * 8).astype(bool)
        return pa.array(np.frombuffer(raw, dtype="<i8", count=self.n), mask=~valid)


def build(rows: DataFrame, dims: int, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(path, at, n, ...) of every block written from ``rows(vec_id, w)``, unassigned."""
    folder = scratch_path(rows.sparkSession, "va-file")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def blocks():
            nonlocal held, size
            for b in batches:
                held.append(b)
                size += b.num_rows
                if size >= block:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    for k in range(0, size - size % block, block):
                        yield whole.slice(k, block)
                    held, size = whole.slice(size - size % block).to_batches(), size % block
            if size:
                yield pa.Table.from_batches(held).combine_chunks()

        first = next(filled := blocks(), None)
        if first is None:
            return
        path, at, out = f"{folder}/{uuid.uuid4().hex}", 0, []
        with writing(path) as file:
            while first is not None:
                column = first.column("w").combine_chunks()
                w = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype("<i4")
                marks = borders(w, bits)
                ids = first.column("vec_id").combine_chunks()
                valid = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), dtype=np.uint8)
                raw = b"".join([marks.astype("<i4").tobytes(), pack(cells_of(w, marks), bits).tobytes(), w.tobytes(),
                                ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), valid.tobytes()])
                file.write(raw)
                out.append((path, at, len(w), np.full(len(w), -1, dtype="<i2").tobytes(), 0, [], [], []))
                at += len(raw)
                first = next(filled, None)
        yield _state(out)

    return materialize(rows.mapInArrow(write, STATE), "va-blocks")


def _state(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()),
             pa.list_(pa.list_(pa.int64()))]
    names = ["path", "at", "n", "clusters", "fetched", "c", "m", "s"]
    return pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*rows), kinds)], names)


def assign(part: Block, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of every row (ties: smaller number), and the rows that had to be
    fetched for it, with their vectors."""
    marks, cells = part.approximation()
    low, high = intervals(cells, marks, centroids)
    open_to = low <= high.min(axis=1)[:, None]
    rows = np.flatnonzero(open_to.sum(axis=1) > 1)
    cluster = open_to.argmax(axis=1)
    full = part.vectors(rows)
    for at in range(0, len(rows), 512):
        some = slice(at, at + 512)
        i, c = np.nonzero(open_to[rows[some]])
        exact = np.full((len(full[some]), len(centroids)), np.iinfo(np.int64).max)
        exact[i, c] = ((full[some][i] - centroids[c]) ** 2).sum(axis=1)
        cluster[rows[some]] = exact.argmin(axis=1)
    return cluster, rows, full


def _spread(state: DataFrame) -> DataFrame:
    """The blocks' rows (a few bytes a vector) over all tasks."""
    spark = state.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return state.select("path", "at", "n", "clusters").repartition(parts, "path", "at")


def step(state: DataFrame, centroids: list[list[int]], dims: int, bits: int) -> DataFrame:
    """Every block assigned anew; ``c``, ``m``, ``s``: what the moved vectors change in
    the clusters' counts and sums."""
    table = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, n, old in zip(*(batch.column(k).to_pylist() for k in range(4))):
                part = Block(path, at, n, dims, bits)
                before = np.frombuffer(old, dtype="<i2").astype(np.int64)
                cluster, rows, full = assign(part, table)
                moved = np.flatnonzero(cluster != before)
                more = np.setdiff1d(moved, rows, assume_unique=True)
                rows, full = np.concatenate([rows, more]), np.concatenate([full, part.vectors(more)])
                order = np.argsort(rows, kind="stable")
                rows, full = rows[order], full[order]
                vectors = full[np.searchsorted(rows, moved)]
                counts = np.zeros(len(table) + 1, dtype=np.int64)  # the last: not yet assigned
                sums = np.zeros((len(table) + 1, dims), dtype=np.int64)
                np.add.at(counts, cluster[moved], 1)
                np.add.at(sums, cluster[moved], vectors)
                np.subtract.at(counts, before[moved], 1)
                np.subtract.at(sums, before[moved], vectors)
                used = np.flatnonzero((counts != 0) | sums.any(axis=1))
                used = used[used < len(table)]
                yield _state([(path, at, n, cluster.astype("<i2").tobytes(), len(rows), used.tolist(), counts[used].tolist(),
                               sums[used].tolist())])

    return materialize(_spread(state).mapInArrow(run, STATE), "va-round")


def moved_sums(state: DataFrame, dims: int) -> list[tuple[int, int, list[int]]]:
    """(cluster, count, sums) over all blocks; a row a cluster and dimension."""
    each = state.select(F.explode(F.arrays_zip("c", "m", "s")).alias("x")).select("x.c", "x.m", "x.s")
    long = each.select("c", F.posexplode(F.concat("s", F.array("m"))).alias("d", "v"))
    out: dict[int, list[int]] = {}
    for r in long.groupBy("c", "d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        out.setdefault(r["c"], [0] * (dims + 1))[r["d"]] = int(r["v"])
    return [(c, v[dims], v[:dims]) for c, v in out.items()]


def distances(state: DataFrame, centroids: list[list[int]], dims: int, bits: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector in its cluster."""
    table = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, n, clusters in zip(*(batch.column(k).to_pylist() for k in range(4))):
                part = Block(path, at, n, dims, bits)
                cluster = np.frombuffer(clusters, dtype="<i2").astype(np.int64)
                apart = ((part.vectors(np.arange(n)) - table[cluster]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([part.ids(), pa.array(cluster.astype(np.int32)), pa.array(apart)],
                                                 ["vec_id", "cluster", "distance"])

    return _spread(state).mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def _clipped(total: Column) -> Column:
    return F.least(total, F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: float = 256.0, dims: int = 64, key: str = "vec_id",
            vector: str = "embedding", salt: str = "2:", bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every
    valid vector after ``rounds`` of assignment and update and a last assignment."""
    spark = vectors.sparkSession
    rows = quantised(vectors, scale, dims, key, vector)
    state = build(rows, dims, bits, block)
    total = state.agg(F.sum("n")).first()[0] or 0
    centroids = first_centroids(rows, k, total, salt) if total else []
    counts, sums = [0] * len(centroids), [[0] * dims for _ in centroids]
    for turn in range(rounds + 1 if centroids else 0):
        fresh = step(state, centroids, dims, bits)
        release(state)
        state = fresh
        if turn < rounds:
            for c, m, s in moved_sums(state, dims):
                counts[c] += m
                sums[c] = [x + y for x, y in zip(sums[c], s)]
            centroids = [[x // n for x in s] if n else old for n, s, old in zip(counts, sums, centroids)]
    found = materialize(distances(state, centroids, dims, bits), "va-distances") if centroids else \
        spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint")
    per = {r["cluster"]: int(r["d"]) for r in
           found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # a row a cluster
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    wide = lambda v: F.lit(str(v)).cast("decimal(38,0)")
    each = F.array(*[_clipped(wide(per.get(c, 0))) for c in range(len(centroids))]) if centroids else F.array(F.lit(0).cast("long"))
    names = F.array(*[F.lit(d) for d in digests]) if digests else F.array(F.lit(""))
    return found.select("vec_id", "cluster", "distance", F.get(each, F.col("cluster")).alias("cluster_inertia"),
                        _clipped(wide(sum(per.values()))).alias("inertia"), F.get(names, F.col("cluster")).alias("centroid_sha256"))
