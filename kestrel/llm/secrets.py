"""Secret scans: candidates found by shape, false positives removed by a random
forest that is trained from labelled findings.

Candidates are values of 6 or more characters assigned to a credential word
(``password=...``), whatever they are made of, and runs of 16 or more key characters
that hold a digit, a capital after a small letter or 16 capitals. An assigned value
is taken whole: to its closing quote on the line (a backslash keeps the next
character), else to white space without trailing punctuation (``.,;:)]}>`` and
quotes). Not seen: shorter values and runs, and unassigned runs of small letters
alone. Spans are code-point offsets into the whole text.

The forest sees, for every candidate: its length, its character transitions
(class changes, and the mean log probability of its character pairs under the
corpus dictionary), dictionary coverage (the share of it that dictionary words
cover), its character classes, whether it is assigned and whether to a credential
word, the path it was found under, and its neighbouring words. Path and neighbours enter as smoothed rates of true findings, learned on
one half of the labelled findings; the forest is grown on the other half, so a
rate never contains the label it helps to predict.

The dictionary holds at most ``DICTIONARY`` words, the most frequent ones counted
over all documents. Training takes at most ``max_findings`` labelled findings (those of
smallest hash), so the rates and the forest have a fixed bound.

Defined results: null and empty texts have no candidates; null ids and paths are
kept (a null path has the overall rate); repeated rows give their findings once
each; with no labelled findings, or only one label, every candidate gets that
label's share as its score (0.5 without labels). Other columns play no part."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, pieces, release, scratch_path, smallest

DICTIONARY = 20_000
MASK = "[SECRET]"
_RUN = re.compile(r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{16,}={0,2}")
_ASSIGNED = re.compile(r"(?i)(?:passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth)s?"
                       r"[\"']?[ \t]{0,3}[:=][ \t]{0,3}"
                       r"(?:\"((?:[^\"\\\r\n]|\\.){6,}+)\"|'((?:[^'\\\r\n]|\\.){6,}+)'|[\"']?+(\S{6,}))")
_TRAILING = ".,;:)]}>\"'"
_DENSE = re.compile("[0-9]|[a-z][A-Z]|[A-Z]{16}")
_WORD = re.compile(r"[^\W\d_]{3,16}")
COVERED = 3  # place of the dictionary coverage in ``shape``
_NEAR = 64  # code points looked at on each side for the neighbouring words

FINDING = ("doc_id {id}, text_key bigint, path string, start bigint, end bigint, candidate string, "
           "word_before string, word_after string, assigned boolean, named boolean")


def spans(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, assigned) of every candidate, without overlaps."""
    found = []
    for m in _ASSIGNED.finditer(text):
        a, b = m.span(m.lastindex)
        if m.lastindex == 3:
            b = a + len(m.group(3).rstrip(_TRAILING))
        if b - a >= 6:
            found.append((a, b, True))
    for m in _RUN.finditer(text):
        a, b = m.span()
        if _DENSE.search(text, a, b):
            found.append((a, b, False))
    out: list[tuple[int, int, bool]] = []
    for a, b, x in sorted(found, key=lambda s: (s[0], -s[1], not s[2])):
        if out and a < out[-1][1]:
            last = out[-1]
            out[-1] = (last[0], max(last[1], b), last[2] or x)
        else:
            out.append((a, b, x))
    return out


def candidates(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """One row per candidate of every document."""
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_key"), where.alias("path"), F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            ids, keys, paths = (b.column(k) for k in range(3))
            at, out = [], []
            for k, text in enumerate(b.column(3).to_pylist()):
                for start, end, assigned in spans(text) if text else ():
                    before = text[max(0, start - _NEAR):start].split()
                    after = text[end:end + _NEAR].split()
                    word = next((w.group().lower() for w in map(_WORD.search, reversed(before)) if w), "")
                    after_word = next((w.group().lower() for w in map(_WORD.search, after) if w), "")
                    at.append(k)
                    out.append((start, end, text[start:end], word, after_word,
                                assigned or text[max(0, start - 2):start].rstrip("\"'")[-1:] in ("=", ":"), assigned))
            take = pa.array(at, pa.int64())
            start, end, word, before, after, assigned, named = zip(*out) if out else ([],) * 7
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), keys.take(take), paths.take(take), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                 pa.array(word, pa.string()), pa.array(before, pa.string()), pa.array(after, pa.string()),
                 pa.array(assigned, pa.bool_()), pa.array(named, pa.bool_())],
                ["doc_id", "text_key", "path", "start", "end", "candidate", "word_before", "word_after", "assigned", "named"])

    return rows.mapInArrow(run, FINDING.format(id=dict(docs.dtypes)["doc_id"]))


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[tuple[str, int]]:
    """The ``size`` most frequent words of all documents with their counts. Of the words
    that share the last count that has room, those of least hash fill it up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            words = pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays(list(words), ["word", "n"])

        for b in pieces(batches):
            for text in b.column(0).to_pylist():
                counts.update(w for w in (text or "").lower().split() if 3 <= len(w) <= 16 and w.isalpha())
            if len(counts) > 200_000:  # memory only: partial counts are summed below
                yield flush()
        yield flush()

    words = docs.select("text").mapInArrow(count, "word string, n bigint")
    counted = materialize(words.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    levels = counted.groupBy("n").agg(F.count(F.lit(1)).alias("words"))  # few: most counts are shared by many words
    ahead = Window.orderBy(F.desc("n"))
    so_far = levels.withColumn("so_far", F.sum("words").over(ahead))
    whole = F.when(F.col("so_far") <= size, F.struct("so_far", "n"))
    taken, last = so_far.agg(F.max(whole), F.max(F.when(F.col("so_far") > size, F.col("n")))).first()
    out = [tuple(r) for r in counted.where(F.col("n") >= taken["n"]).collect()] if taken else []  # at most ``size`` short words
    room = size - (taken["so_far"] if taken else 0)
    if last is not None and room:
        out += [tuple(r) for r in smallest(counted.where(F.col("n") == last), F.xxhash64("word"), ["word"], room).collect()]
    out.sort()
    release(counted)
    return out


def _pairs(words: list[tuple[str, int]]) -> np.ndarray:
    """Log probabilities of character pairs in the dictionary (a-z, digit, other)."""
    counts = np.ones((28, 28))
    for word, n in words:
        k = _codes(word)
        np.add.at(counts, (k[:-1], k[1:]), n)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def _codes(text: str) -> np.ndarray:
    return np.array([ord(c) - 97 if "a" <= c <= "z" else 26 if c.isdigit() else 27 for c in text.lower()])


def _coverage(text: str, words: frozenset) -> float:
    """Share of the text covered by dictionary words, longest first at each place."""
    low, at, covered = text.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(min(16, len(low) - at), 2, -1) if low[at:at + n] in words), 0)
        covered += size
        at += size or 1
    return covered / max(len(low), 1)


def shape_features(text: str, assigned: bool, named: bool, words: frozenset, pairs: np.ndarray) -> list[float]:
    n = len(text)
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in text]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    codes = _codes(text)
    chance = float(pairs[codes[:-1], codes[1:]].mean()) if n > 1 else 0.0
    counts = Counter(text)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values()) if n else 0.0
    hexlike = sum(c in "0123456789abcdefABCDEF" for c in text) / max(n, 1)
    return [float(n), changes / max(n - 1, 1), chance, _coverage(text, words), entropy, hexlike,
            *(kinds.count(k) / max(n, 1) for k in range(4)), float(assigned), float(named)]


def with_shape(findings: DataFrame, words: list[tuple[str, int]]) -> DataFrame:
    """Adds ``shape`` (array of doubles): all that depends on the candidate alone,
    and ``common``: whether it is a word of the dictionary."""
    shared = findings.sparkSession.sparkContext.broadcast((frozenset(w for w, _ in words), _pairs(words)))
    schema = findings.schema.simpleString()[7:-1].replace(":", " ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pairs = shared.value
        for b in batches:
            found = [b.column(c).to_pylist() for c in ("candidate", "assigned", "named")]
            rows = [shape_features(t, a, n, known, pairs) for t, a, n in zip(*found)]
            common = [t.lower() in known for t in found[0]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.list_(pa.float64())), pa.array(common, pa.bool_())],
                                             [*b.schema.names, "shape", "common"])

    return findings.mapInArrow(run, f"{schema}, shape array<double>, common boolean")


def _rate(rows: DataFrame, column: str, overall: float, weight: float = 4.0) -> DataFrame:
    """Smoothed rate of true findings per value; at most one row a labelled finding."""
    return (rows.where(F.col(column).isNotNull()).groupBy(column)
            .agg(((F.sum("label") + weight * overall) / (F.count(F.lit(1)) + weight)).alias(f"{column}_rate")))


class Forest:
    """A trained scan: neighbour and path rates, and the forest over all features."""

    RATED = ("path", "word_before", "word_after")

    def __init__(self, labelled: DataFrame, max_findings: int = 20_000, trees: int = 24, depth: int = 8, seed: int = 5):
        """``labelled``: findings with ``shape`` and ``label`` (0 or 1)."""
        marked = (labelled.where("label in (0, 1)")
                  .withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "start", "candidate")))
        chosen = materialize(smallest(marked, F.col("order"), ["doc_id", "start", "text_key"], max_findings), "labelled-findings")
        total, true = chosen.agg(F.count(F.lit(1)), F.sum("label")).first()
        self.overall = float(true) / total if total else 0.5
        self.model, self.rates = None, {}
        if not total or true in (0, total):
            return
        half = F.col("order") % 2 == 0
        self.rates = {c: materialize(_rate(chosen.where(half), c, self.overall), "rates") for c in self.RATED}
        grow = self._features(chosen.where(~half))
        if grow.select("label").distinct().count() < 2:
            grow = self._features(chosen)
        fitted = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth,
                                        seed=seed).fit(materialize_vectors(grow))
        # A fitted model carries its training summary, and with it the session, into the tasks; a stored one does not.
        path = scratch_path(labelled.sparkSession, "forest")
        fitted.write().save(path)
        self.model = RandomForestClassificationModel.load(path)

    def _features(self, findings: DataFrame) -> DataFrame:
        out = findings
        for column, rate in self.rates.items():  # each at most max_findings short rows
            out = out.join(F.broadcast(rate), column, "left")
        rates = [F.coalesce(F.col(f"{c}_rate"), F.lit(self.overall)) for c in self.RATED]
        return out.withColumn("features", array_to_vector(F.concat("shape", F.array(*rates))))

    def score(self, findings: DataFrame, threshold: float = 0.5) -> DataFrame:
        """``findings`` with ``score`` (0 to 1) and ``is_secret``."""
        if self.model is None:
            out = findings.withColumn("score", F.lit(self.overall))
        else:
            out = self.model.transform(self._features(findings))
            out = out.withColumn("score", vector_to_array("probability")[1])
        return out.select(*findings.columns, "score", (F.col("score") >= threshold).cast("int").alias("is_secret"))


def materialize_vectors(df: DataFrame) -> DataFrame:
    return materialize(df.select("features", F.col("label").cast("double").alias("label")), "forest-rows")


#: Tokens whose issuers publish a prefix: cloud, code hosting, chat, payment, mail and package services, web tokens.
_ISSUED = ("^(?:A(?:KIA|SIA|GPA|IDA|ROA|NPA)[A-Z2-7]{16}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}"
           "|glpat-[A-Za-z0-9_-]{16,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|[prs]k_(?:live|test)_[A-Za-z0-9]{10,}"
           "|AIza[A-Za-z0-9_-]{30,}|npm_[A-Za-z0-9]{30,}|hf_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{13,})")
_MIXED = "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]{20,}={0,2}$"
_UUID = "(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$"


def known_format() -> Column:
    """Label of a finding. True by the issuers' formats as a family: a published
    prefix, hex (of any case) or mixed base64 assigned to a credential word, or a
    base64 line after the head of a key block. False by evidence only: digit runs,
    parts of URLs and ids that no credential word names, dictionary words. The
    rest is null: not labelled, left to the forest."""
    word, before, named = F.col("candidate"), F.col("word_before"), F.col("named")
    assigned = named & (word.rlike(r"(?i)^[0-9a-f]{18,}\W*$") & word.rlike("[0-9]") & word.rlike("[A-Fa-f]") | word.rlike(_MIXED))
    block = ~F.col("assigned") & (before == "key") & word.rlike("^[A-Za-z0-9+/]{40,}={0,2}$")
    other = ~named & (word.rlike("^[0-9+/_=-]+$") | before.isin("http", "https", "www") | word.rlike(_UUID)
                      | (F.get("shape", F.lit(COVERED)) >= 0.8))
    return F.when(word.rlike(_ISSUED) | assigned | block, 1).when(other | F.col("common"), 0)


def scan(docs: DataFrame, path: str | None = "source", label: Column | None = None, threshold: float = 0.5,
         max_findings: int = 20_000) -> DataFrame:
    """All candidates of ``docs`` with ``score`` and ``is_secret``. ``label``: the
    labelled findings' label as a column of the finding (null: not labelled); the
    default labels by known formats, outside the held-out fifth of documents."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    label = F.when(F.coalesce(held_out, F.lit(False)), None).otherwise(known_format()) if label is None else label
    found = materialize(with_shape(candidates(docs, path), dictionary(docs)), "findings")
    forest = Forest(found.withColumn("label", label), max_findings)
    return forest.score(found, threshold)


def redact(docs: DataFrame, findings: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with the spans of ``findings`` in ``text`` replaced by ``mask``."""
    cuts = (findings.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
            .agg(F.sort_array(F.collect_set(F.struct("start", "end")), asc=False).alias("_cuts")))
    joined = docs.join(cuts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left")
    masked = F.aggregate("_cuts", F.col("text"), lambda text, s: F.overlay(
        text, F.lit(mask), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return joined.withColumn("text", F.coalesce(masked, "text")).select(*docs.columns)
