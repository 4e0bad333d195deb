"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors become sparse rows of integer weights (one weight a component, zeros left
out). Candidates are dealt by a hash into blocks, queries too, and every query
block meets every candidate block once, as one row of a grid dealt over all
tasks. In a cell the candidates are posting lists, one per term (component) that a tile
of them holds, built once; the queries' weights of one term scatter its postings
into dense score arrays, tile by tile, term after term. Memory follows the
weights that are not zero, not the number of components. Each cell keeps the k best of a query by a partition
selection, and the cells' lists are merged by rank.

Scores are exact: sums that fit are added in 32 or 64 bits, others as Python
integers (and clipped to 64 bits on output).

Defined results: vectors that are null or hold null or non-finite components (or
components that overflow when scaled) take no part; a missing component of a shorter vector is 0; null ids take no part;
every row counts, rows of equal ids too: each is a query with a list of its own
and a candidate of all rows but itself; rows without weights score 0; ties go to
the smaller id; queries with fewer candidates than k get all; other columns are
not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize

BLOCK = 1 << 14  # candidates of a grid cell
QUERIES = 1 << 12  # queries of a grid cell
TILE, STRIP = 1 << 11, 1 << 7  # score array of the inner loop


def weights(vectors: DataFrame, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, w): of every valid vector the terms whose floor(scale * x) is
    not zero, with that weight. ``row`` tells rows apart once it is written."""
    scaled = F.transform(vector, lambda v: v.cast("double") * scale)
    bad = F.exists(scaled, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform("w", lambda v, i: F.struct(
        i.cast("int").alias("term"), F.when(F.abs(v) < 2.0 ** 52, F.floor(v).cast("double")).otherwise(v).alias("weight")))
    return (vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull())
            .select(F.col(key).cast("long").alias("vec_id"), scaled.alias("w"), bad.alias("bad")).where("not bad")
            .select(F.monotonically_increasing_id().alias("row"), "vec_id", F.filter(whole, lambda e: e.weight != 0).alias("w")))


class Sparse:
    """Sparse rows one after another: ``ends`` of rows in ``term`` and ``value``."""

    def __init__(self, ends, term, value):
        self.ends, self.term, self.value = ends, term, value

    @classmethod
    def read(cls, column) -> Sparse:
        lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        ends = lists.offsets.to_numpy()
        term, value = lists.flatten().flatten()
        return cls(ends - ends[0], term.to_numpy(), value.to_numpy())

    def __len__(self) -> int:
        return len(self.ends) - 1

    def top(self) -> float:
        return float(np.abs(self.value).max(initial=0.0))

    def longest(self) -> int:
        return int(np.diff(self.ends).max(initial=0))

    def integers(self, other: float, terms: int) -> Sparse:
        """The rows in the narrowest kind in which every inner product fits."""
        top = self.top() * other * max(terms, 1)
        if top < 2.0 ** 61:
            value = self.value.astype(np.int32 if top < 2.0 ** 30 else np.int64)
        else:
            value = np.empty(len(self.value), dtype=object)
            value[:] = [int(v) for v in self.value]
        return Sparse(self.ends, self.term, value)

    def postings(self, rows: int):
        """Posting lists of every ``rows`` rows in turn, with their first row."""
        for first in range(0, len(self), rows):
            ends = self.ends[first:first + rows + 1]
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            yield first, Postings(len(ends) - 1, row, self.term[ends[0]:ends[-1]], self.value[ends[0]:ends[-1]])


class Postings:
    """For each of ``terms`` the rows that hold it, ascending, and their weights."""

    def __init__(self, rows, row, term, value):
        order = np.argsort(term, kind="stable")
        self.rows, self.row, self.value = rows, row[order], value[order]
        self.terms, starts = np.unique(term[order], return_index=True)
        self.starts = np.append(starts, len(order))

    def of(self, at: int):
        part = slice(self.starts[at], self.starts[at + 1])
        return self.row[part], self.value[part]


def _spread(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    if len(row) == rows:
        return value
    out = np.zeros(rows, dtype=value.dtype)
    out[row] = value
    return out


def accumulate(queries: Postings, candidates: Postings) -> np.ndarray:
    """Scores (queries x candidates), term at a time."""
    scores = np.zeros((queries.rows, candidates.rows), dtype=np.result_type(queries.value, candidates.value))
    _, asked, held = np.intersect1d(queries.terms, candidates.terms, assume_unique=True, return_indices=True)
    for left, right in zip(asked, held):
        (rows, a), (posted, b) = queries.of(left), candidates.of(right)
        if 2 * len(rows) > queries.rows and 2 * len(posted) > candidates.rows:  # a term of most rows: no gathering
            scores += _spread(rows, a, queries.rows)[:, None] * _spread(posted, b, candidates.rows)
        else:
            scores[np.ix_(rows, posted)] += a[:, None] * b
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, numbers: np.ndarray, own: np.ndarray, k: int):
    """The k best (ids, scores) of each query; ``ids`` ascend, the candidate whose
    row number is the query's own is left out."""
    for line, number in zip(scores, own):
        at, skip = ids, np.flatnonzero(numbers == number)
        if len(skip):
            line, at = np.delete(line, skip), np.delete(ids, skip)
        if len(line) > k:
            edge = np.partition(line, len(line) - k)[len(line) - k]
            above = np.flatnonzero(line > edge)
            ties = np.flatnonzero(line == edge)[:k - len(above)]  # ascending ids
            chosen = np.concatenate([above, ties])
            line, at = line[chosen], at[chosen]
        yield at, line


def _search(left: pa.Table, right: pa.Table, k: int):
    """Rows (query_row, query_id, vec_id, score) of a cell, at most k a query."""
    right = right.sort_by("vec_id")
    own, query_ids = left.column("row").to_numpy(), left.column("vec_id").to_numpy()
    numbers, ids = right.column("row").to_numpy(), right.column("vec_id").to_numpy()
    a, b = Sparse.read(left.column("w")), Sparse.read(right.column("w"))
    terms, tops = min(a.longest(), b.longest()), (a.top(), b.top())
    a, b = a.integers(tops[1], terms), b.integers(tops[0], terms)
    tiles = list(b.postings(TILE))
    for at, strip in a.postings(STRIP):
        kept: list[list] = [[] for _ in range(strip.rows)]
        for first, tile in tiles:
            part = slice(first, first + TILE)
            for row, found in enumerate(_best(accumulate(strip, tile), ids[part], numbers[part], own[at:at + STRIP], k)):
                kept[row].append(found)
        for row, lists in enumerate(kept):
            found = np.concatenate([x[0] for x in lists])
            score = np.concatenate([x[1] for x in lists])
            if len(found) > k:
                best = np.lexsort((found, -score))[:k] if score.dtype != object else \
                    np.array(sorted(range(len(found)), key=lambda i: (-score[i], found[i]))[:k])
                found, score = found[best], score[best]
            if len(found):
                clipped = [max(-(1 << 63), min((1 << 63) - 1, int(v))) for v in score]
                yield (np.full(len(found), own[at + row]), np.full(len(found), query_ids[at + row]), found,
                       np.array(clipped, dtype=np.int64))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, key: str = "vec_id",
          vector: str = "embedding", block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query row;
    ``is_query`` is a condition on ``vec_id``."""
    spark = vectors.sparkSession
    rows = materialize(weights(vectors, scale, key, vector), "weights")
    total, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    spread = min(2 * spark.sparkContext.defaultParallelism, -(-total // 1024))
    across, down = max(1, spread, -(-total // block)), max(1, -(-asked // query_block))

    def dealt(n: int, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select(dealt(across, 3).alias("c"), every(down).alias("q"), "row", "vec_id", "w")
    queries = rows.where(is_query).select(every(across).alias("c"), dealt(down, 5).alias("q"), "row", "vec_id", "w")

    def cell(left, right):
        out = list(_search(left, right, k)) if left.num_rows and right.num_rows else []
        parts = [np.concatenate(x) for x in zip(*out)] or [np.empty(0, np.int64)] * 4
        return pa.table(dict(zip(("query_row", "query_id", "vec_id", "score"), parts)))

    found = (queries.groupBy("c", "q").cogroup(candidates.groupBy("c", "q"))
             .applyInArrow(cell, "query_row bigint, query_id bigint, vec_id bigint, score bigint"))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
