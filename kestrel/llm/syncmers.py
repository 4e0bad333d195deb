"""Document fingerprints of closed syncmers: a k-mer is chosen when the smallest
hash among its inner s-mers stands at its first or last place. The choice depends
on the k-mer alone, so equal passages give equal anchors whatever surrounds them,
and anchors of two documents can be matched by position.

A fingerprint is the whole sequence of anchors of both scales (``SCALES``), scale by
scale, in digits of 6 bits. A coarse anchor takes five: 25 bits of the k-mer's hash and
5 of the distance to the anchor before; a fine one two: 11 bits of hash and one that
tells a distance of 1 from one of 2. Closed syncmers are never farther apart than k - s,
so these bits hold every distance and positions are exact. Every text has both scales,
whatever its length: short texts and passages have few long k-mers, and are found by
the fine ones, of which any five characters hold one. On long texts a fingerprint takes
about 1.7 characters a character. A text without any anchor gets one of its whole text,
an empty text the empty fingerprint. Equal texts have equal fingerprints.

Likeness of two fingerprints is the weight of the multiset of shared anchors over
the weight of their union, over the scales that both have; an anchor weighs the
square of its k, so that short k-mers, which strangers share, decide only where
there are few others. Without a common scale it is 0; two empty fingerprints have
likeness 1. :func:`matches` gives the shared anchors of the coarser scale that has
any, with their positions, along the shift on which most of them agree.

:func:`edited_copies` fingerprints every document, a copy of it whose second half
is replaced by the start of the next document (descending id), and compares. Rows
are range-partitioned by id once and read in order; the first row of the following
partition comes along as a guest row, so no text is shuffled twice.

Defined results: null text counts as empty; null ids sort last, in order of their
texts' hashes (so that they fill ranges of their own); rows of equal id follow in order
of their text; a single row is its own next document; an empty table gives an empty
result; other columns are not read. One text must fit in a task, and rows equal in id
and text share a range."""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import pieces
from kestrel.llm.textnum import SEGMENT, code_points, window_hashes

SCALES = ((32, 9), (4, 2))  # k, s
WEIGHTS = (*(k * k for k, _ in SCALES), 1)  # of an anchor; the last: of a whole text
_BITS = (25, 11, 30)  # of the hash, by scale; the last: of a whole text
_SCALE = np.uint32(3)  # bits of a hash that hold the scale
RECORD = np.dtype([("hash", "u4"), ("gap", "u1")])
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", dtype=np.uint8)
_VALUES = np.zeros(128, dtype=np.uint32)
_VALUES[_DIGITS] = np.arange(64)
_WHOLE, _NEXT = "~", "."  # before a whole text's hash; between the scales


def anchors(cp: np.ndarray, k: int = SCALES[0][0], s: int = SCALES[0][1]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, 32-bit hashes) of the closed syncmers of a text."""
    at, hashes = [], []
    inner = k - s + 1
    for start in range(0, max(len(cp) - k + 1, 0), SEGMENT):
        part = cp[start:start + SEGMENT + k - 1]
        small = window_hashes(part, s)
        least, width = small, 1  # sliding minimum over ``inner`` s-mers by doubling
        while width * 2 <= inner:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < inner:
            least = np.minimum(least[:len(least) - (inner - width)], least[inner - width:])
        n = len(part) - k + 1
        chosen = np.flatnonzero((small[:n] == least) | (small[inner - 1:inner - 1 + n] == least))
        at.append(chosen + start)
        hashes.append((window_hashes(part, k)[chosen] >> np.uint64(32)).astype(np.uint32))
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    return np.concatenate(at), np.concatenate(hashes)


def _tagged(hashes: np.ndarray, scale: int) -> np.ndarray:
    """The upper bits of 32-bit hashes that a scale keeps, above the scale's number."""
    return (hashes >> np.uint32(32 - _BITS[scale]) << np.uint32(2)) | np.uint32(scale)


def fingerprint_of(cp: np.ndarray) -> np.ndarray:
    """Anchor records of a text's code points, scale by scale."""
    parts = []
    for scale, (k, s) in enumerate(SCALES):
        at, hashes = anchors(cp, k, s)
        part = np.empty(len(at), dtype=RECORD)
        part["hash"], part["gap"] = _tagged(hashes, scale), np.diff(at, prepend=0)
        parts.append(part)
    out = np.concatenate(parts)
    if not len(out) and len(cp):
        out = np.zeros(1, dtype=RECORD)
        out["hash"] = _tagged(np.frombuffer(hashlib.blake2b(cp.tobytes(), digest_size=4).digest(), dtype="<u4"), len(SCALES))
    return out


def _digits(values: np.ndarray, width: int) -> str:
    shifts = np.arange(6 * (width - 1), -1, -6, dtype=np.uint32)
    return _DIGITS[values.astype(np.uint32)[:, None] >> shifts & np.uint32(63)].tobytes().decode()


def _numbers(digits: str, width: int) -> np.ndarray:
    shifts = np.arange(6 * (width - 1), -1, -6, dtype=np.uint32)
    return (_VALUES[np.frombuffer(digits.encode(), dtype=np.uint8)].reshape(-1, width) << shifts).sum(axis=1, dtype=np.uint32)


def to_string(records: np.ndarray) -> str:
    if not len(records):
        return ""
    value, scale, gap = records["hash"] >> np.uint32(2), records["hash"] & _SCALE, records["gap"].astype(np.uint32)
    if scale[0] == len(SCALES):
        return _WHOLE + _digits(value, 5)
    coarse = int(np.searchsorted(scale, 1))
    return (_digits(value[:coarse] << np.uint32(5) | gap[:coarse], 5) + _NEXT
            + _digits(value[coarse:] << np.uint32(1) | gap[coarse:] & np.uint32(1), 2))


def from_string(text: str) -> np.ndarray:
    if text.startswith(_WHOLE):
        out = np.zeros(1, dtype=RECORD)
        out["hash"] = _numbers(text[1:], 5) << np.uint32(2) | np.uint32(len(SCALES))
        return out
    long, _, short = text.partition(_NEXT)
    coarse, fine = _numbers(long, 5), _numbers(short, 2)
    out = np.empty(len(coarse) + len(fine), dtype=RECORD)
    out["hash"] = np.concatenate([coarse >> np.uint32(5) << np.uint32(2), fine >> np.uint32(1) << np.uint32(2) | np.uint32(1)])
    gaps = np.where(fine & np.uint32(1), 1, 2)
    gaps[:1] = fine[:1] & np.uint32(1)  # the first anchor is the first or second place
    out["gap"] = np.concatenate([coarse & np.uint32(31), gaps])
    return out


def _multiset(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fine = records["hash"] & _SCALE == 1
    values, counts = np.unique(records["hash"][~fine], return_counts=True)
    short = np.bincount(records["hash"][fine] >> np.uint32(2), minlength=1)
    used = np.flatnonzero(short)
    return (np.concatenate([values, (used << 2 | 1).astype(np.uint32)]), np.concatenate([counts, short[used]]))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weight of the shared anchors over that of all anchors of two multisets
    (values, counts), over the scales both have."""
    if not len(a[0]) and not len(b[0]):
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j])
    by_scale = lambda values, counts: np.bincount(values & _SCALE, counts, len(WEIGHTS))
    x, y, shared = by_scale(*a), by_scale(*b), by_scale(a[0][i], both)
    weight = np.where((x > 0) & (y > 0), WEIGHTS, 0)
    union = float((weight * (x + y - shared)).sum())
    return float((weight * shared).sum()) / union if union else 0.0


def matches(a: str, b: str) -> list[tuple[int, int]]:
    """Positions (in a, in b) of equal anchors of the coarser scale that has any. An
    anchor of ``a`` goes with the anchor of ``b`` that continues the shift of the one
    before it, else with the one at the commonest shift, else with the next unused."""
    x, y = from_string(a), from_string(b)
    for scale in range(len(WEIGHTS)):
        mine, other = x[(x["hash"] & _SCALE) == scale], y[(y["hash"] & _SCALE) == scale]
        here = list(zip(mine["hash"].tolist(), np.cumsum(mine["gap"], dtype=np.int64).tolist()))
        there = list(zip(other["hash"].tolist(), np.cumsum(other["gap"], dtype=np.int64).tolist()))
        where: dict[int, list[int]] = {}
        for h, q in reversed(there):
            where.setdefault(h, []).append(q)
        votes = Counter(where[h][-1] - p for h, p in here if h in where)
        if not votes:
            continue
        common = shift = max(votes, key=lambda v: (votes[v], -abs(v)))
        free, found = set(there), []
        for h, p in here:
            rest = where.get(h, [])
            while rest and (h, rest[-1]) not in free:
                rest.pop()
            if not rest:
                continue
            q = next((p + v for v in (shift, common) if (h, p + v) in free), rest[-1])
            free.discard((h, q))
            found.append((p, q))
            shift = q - p
        return found
    return []


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = [to_string(fingerprint_of(code_points(x or ""))) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], [key, "fingerprint"])

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, fingerprint string")


EDITED = ("doc_id {id}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _range_of(value: F.Column, bounds: list[int]) -> F.Column:
    """How many of the descending ``bounds`` are above ``value``, in two steps of
    about the square root of their number."""
    width = max(1, math.isqrt(len(bounds)))
    groups = [bounds[k:k + width] for k in range(0, len(bounds), width)]
    if not groups:
        return F.lit(0)
    literal = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
    group = F.size(F.filter(literal([g[0] for g in groups], "array<bigint>"), lambda b: b > value)) - 1
    inside = F.size(F.filter(F.get(literal(groups, "array<array<bigint>>"), group), lambda b: b > value))
    return F.when(group < 0, F.lit(0)).otherwise(group * width + inside)


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, guest, doc_id, text) placed in ``parts`` ranges of descending doc_id,
    sorted, with the next range's first row as a guest at the end of each.

    The range bounds (at most one a partition) come from a scan of doc_id alone. Null
    ids fill as many further ranges of their texts' hashes as their share asks for."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [k / parts for k in range(1, parts)] or [0.5]
    bounds, rows, named = docs.agg(F.percentile_approx("doc_id", F.array(*[F.lit(x) for x in steps]), 20 * parts),
                                   F.count(F.lit(1)), F.count("doc_id")).first()
    bounds = sorted({int(b) for b in bounds or []}, reverse=True)
    unnamed = -(-parts * (rows - named) // rows) if rows else 0
    ranges = len(bounds) + 1 + unnamed
    place = F.lit(0).cast("bigint")  # of a row among the null ids
    part = _range_of(F.col("doc_id"), bounds)
    if unnamed:
        step = -(-(1 << 32) // unnamed)
        spot = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 32)
        place = F.when(F.col("doc_id").isNull(), spot).otherwise(place)
        part = F.when(F.col("doc_id").isNull(), (F.lit(len(bounds) + 1) + F.floor(spot / step)).cast("int")).otherwise(part)
    placed = docs.select("doc_id", "text", part.alias("part"), place.alias("place"))
    tops = placed.groupBy("part").agg(F.max("doc_id").alias("top"), F.min("place").alias("place")).collect()
    tops = sorted((r["part"], r["top"], r["place"]) for r in tops)  # one row a partition
    if not tops:
        return docs.limit(0).select(F.lit(0).alias("part"), F.lit(0).alias("guest"), "doc_id", "text")
    # The first row of each range is also a guest of the range before it (the first range's, of the last).
    entries = {t[0]: dict(zip(("at", "top", "place"), (tops[k - 1][0], *t[1:]))) for k, t in enumerate(tops)}
    kind = "array<struct<at:int,top:bigint,place:bigint>>"
    lookup = F.from_json(F.lit(json.dumps([entries.get(n, {}) for n in range(ranges)])), kind)
    entry = F.get(lookup, F.col("part"))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    first = F.col("doc_id").eqNullSafe(entry["top"]) & (F.col("place") == entry["place"])
    places = F.when(first, F.array(own, F.struct(entry["at"].alias("part"), F.lit(1).alias("guest")))).otherwise(F.array(own))
    spread = placed.select("doc_id", "text", "place", F.explode(places).alias("p")).select("p.part", "p.guest", "doc_id", "place", "text")
    return (spread.repartitionById(max(parts, ranges), F.col("part"))
            .sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "place", "text").drop("place"))


def edited_copies(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every document and its edited copy, and their likeness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, size, last = None, [], 0, None
        for b in pieces(batches):
            columns = (b.column(k).to_pylist() for k in range(4))
            for part, guest, doc_id, text in zip(*columns):
                if guest and last == (part, 1):
                    continue  # further rows of the guest's id
                cp = code_points(text or "")
                own = fingerprint_of(cp)
                now = (part, doc_id, cp, own, _multiset(own))
                if held is not None:
                    if held[0] != part:
                        raise RuntimeError("a range has no guest row")
                    out.append(_compared(held, now))
                    size += len(out[-1][3]) + len(out[-1][4])
                held, last = (None if guest else now), (part, guest)
                if size > 1 << 22 or len(out) > 4096:
                    yield _batch(out, b.schema.field(2).type)
                    out, size = [], 0
        if out:
            yield _batch(out, b.schema.field(2).type)

    return with_next(docs, parts).mapInArrow(run, EDITED.format(id=dict(docs.dtypes)["doc_id"]))


def _compared(held, following):
    _, doc_id, cp, own, counts = held
    half = len(cp) // 2
    swapped = np.concatenate([cp[:len(cp) - half], following[2][:half]]) if half else cp
    edited = fingerprint_of(swapped)
    text = swapped.tobytes().decode("utf-32-le", "surrogatepass")
    return (doc_id, len(cp), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), to_string(own),
            to_string(edited), likeness(counts, _multiset(edited)), likeness(counts, following[4]))


def _batch(rows, id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

