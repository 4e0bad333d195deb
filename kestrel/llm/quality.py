"""Quality classifier: hashed word n-gram logistic regression trained with
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot
products.

Features. A text is cut into runs of word characters and runs of other
non-space characters. Every run counts as a word (case folded) and as its shape
(upper, capital, lower, digits, marks, other). Word unigrams, word bigrams,
shape bigrams and the event "same word as before" are hashed into
``2**HASH_BITS`` columns; a column's value is its count divided by the number of
runs, times ``SCALE``, so texts of any length are on one scale.

Training. At most ``max_rows`` labelled rows (those of smallest hashed id; the
bound is a parameter, the result does not depend on the partitioning) are
featurised in parallel and gathered in one task, which runs the sequential FTRL
updates over ``epochs`` seeded passes. The model is at most ``2**HASH_BITS``
weights (4 MB), so broadcasting it is bounded.

Defined results: null and empty texts have no features and get the score of the
bias alone; rows with null ids are scored like any other; with no labelled rows
every score is 0.5; repeated label rows count once each; extra columns are kept
untouched by :func:`score` (the new columns replace columns of the same name)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import materialize, pieces, smallest
from kestrel.llm.textnum import SEGMENT, code_points, mix, span_hashes

HASH_BITS = 20
SCALE = 24.0
_SHIFT = np.uint64(64 - HASH_BITS)
_SPACE, _LOWER, _UPPER, _DIGIT, _MARK = range(5)


def _classes() -> np.ndarray:
    out = np.full(256, _MARK, dtype=np.uint8)
    out[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160]] = _SPACE
    out[ord("a"):ord("z") + 1] = _LOWER
    out[ord("A"):ord("Z") + 1] = _UPPER
    out[ord("0"):ord("9") + 1] = _DIGIT
    out[0xC0:0xDF] = _UPPER
    out[0xDF:0x100] = _LOWER
    out[[0xD7, 0xF7]] = _MARK
    return out


_CLASS = _classes()


def _runs(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hash and shape of every run of one piece of text."""
    kind = _CLASS[np.minimum(cp, 255)]
    kind[cp > 255] = _LOWER
    group = np.where(kind == _SPACE, 0, np.where(kind == _MARK, 2, 1)).astype(np.int8)
    edge = np.flatnonzero(np.diff(group, prepend=np.int8(0), append=np.int8(0)))
    if not len(edge):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    bounds = np.append(edge, len(cp)) if edge[-1] != len(cp) else edge
    start, end = bounds[:-1], bounds[1:]
    live = group[start] > 0
    start, end = start[live], end[live]
    folded = np.where(kind == _UPPER, cp + 32, cp)
    words = span_hashes(folded, start, end)
    counts = np.zeros((3, len(cp) + 1), dtype=np.int32)
    for row, k in enumerate((_UPPER, _LOWER, _DIGIT)):
        np.cumsum(kind == k, out=counts[row, 1:])
    upper, lower, digit = (c[end] - c[start] for c in counts)
    size = end - start
    shape = np.select([group[start] == 2, digit == size, (upper == size) & (size > 1),
                       (upper == 1) & (kind[start] == _UPPER), upper + digit == 0],
                      [6 + np.minimum(size, 3), 1, 2, 3, 4], default=5)
    return words, shape.astype(np.uint64)


def features(text: str | None) -> tuple[np.ndarray, int]:
    """Hashed column of every n-gram of the text, and the number of runs."""
    if not text:
        return np.empty(0, np.int64), 0
    words, shapes = [], []
    cp = code_points(text)
    at = 0
    while at < len(cp):
        end = min(len(cp), at + SEGMENT)
        if end < len(cp):  # cut at a space where the piece has one
            space = np.flatnonzero(cp[at:end] == 32)
            end = at + int(space[-1]) + 1 if len(space) else end
        w, s = _runs(cp[at:end])
        words.append(w)
        shapes.append(s)
        at = end
    word, shape = np.concatenate(words), np.concatenate(shapes)
    if not len(word):
        return np.empty(0, np.int64), 0
    again = np.count_nonzero(word[1:] == word[:-1])
    pair = mix(word[:-1] * np.uint64(31) + word[1:])
    look = mix(shape[:-1] * np.uint64(97) + shape[1:] + np.uint64(1 << 40))
    same = np.full(again, mix(np.array([1 << 50], dtype=np.uint64))[0])
    return (np.concatenate([word, pair, look, same]) >> _SHIFT).astype(np.int64), len(word)


def sparse(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The text's sparse row: distinct columns and their values."""
    columns, runs = features(text)
    index, count = np.unique(columns, return_counts=True)
    return index, (count * (SCALE / max(runs, 1))).astype(np.float32)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 4, alpha: float = 0.3,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, seed: int = 7) -> tuple[np.ndarray, float]:
    """FTRL-proximal logistic regression over sparse rows; (weights, bias)."""
    dims = 1 << HASH_BITS
    z, n = np.zeros(dims + 1), np.zeros(dims + 1)
    rng = np.random.default_rng(seed)

    def weight(index):
        zi, ni = z[index], n[index]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            index, value, label = rows[k]
            index = np.append(index, dims)
            value = np.append(value, 1.0)
            w = weight(index)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha
            z[index] += g - sigma * w
            n[index] += g * g
    w = weight(np.arange(dims + 1))
    return w[:-1].astype(np.float32), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, label: str = "quality",
          epochs: int = 4, seed: int = 7) -> tuple[np.ndarray, float]:
    """Fit on ``labels(doc_id, <label>)`` joined with ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    marked = (labels.select("doc_id", F.col(label).cast("double").alias("label"))
              .where(F.col("label").isin(0.0, 1.0) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.round(F.avg("label")).alias("label")))
    chosen = smallest(marked, F.xxhash64(F.lit(seed), "doc_id"), ["doc_id"], max_rows)
    chosen = materialize(chosen, "quality-rows")  # at most max_rows ids: a bounded broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            rows = [sparse(x) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("label"),
                 pa.array([i.astype(np.int32).tobytes() for i, _ in rows], pa.binary()),
                 pa.array([v.tobytes() for _, v in rows], pa.binary())], ["doc_id", "label", "columns", "values"])

    def fit(table):
        frame = table.sort_by([("doc_id", "ascending"), ("columns", "ascending")]).to_pydict()
        rows = [(np.frombuffer(c, np.int32), np.frombuffer(v, np.float32), y)
                for c, v, y in zip(frame["columns"], frame["values"], frame["label"])]
        w, bias = ftrl(rows, epochs=epochs, seed=seed)
        used = np.flatnonzero(w)
        return pa.table({"column": pa.array(np.append(used, -1), pa.int64()),
                         "weight": pa.array(np.append(w[used].astype(float), bias), pa.float64())})

    rows = found.mapInArrow(rows_of, "doc_id bigint, label double, columns binary, values binary")
    model = rows.groupBy(F.lit(1).alias("one")).applyInArrow(fit, "column bigint, weight double")
    w, bias = np.zeros(1 << HASH_BITS, dtype=np.float32), 0.0
    for at, value in materialize(model, "quality-model").collect():  # at most 2**HASH_BITS rows
        if at < 0:
            bias = value
        else:
            w[at] = value
    return w, bias


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, bias = shared.value
        for texts in batches:
            out = np.empty(len(texts))
            for k, text in enumerate(texts):
                columns, runs = features(text)
                out[k] = bias + (SCALE / runs) * w[columns].sum(dtype=np.float64) if runs else bias
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(out, -35, 35))))

    return (docs.withColumn("score", scored(F.col("text")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def held_out(doc_id) -> F.Column:
    """True on the fifth of documents whose labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def quality_model(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = 20_000):
    return train(docs, labels.where(~held_out("doc_id")), max_rows=max_rows)
