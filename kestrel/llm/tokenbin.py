"""Token-ID files: canonical length-limited Huffman codes of ids from global
counts, decoded by table in independent blocks with bit-offset checkpoints.

Writing. Documents are range-partitioned by id and sorted, tokenised once, and
kept as a table of ids. Ids are counted over the whole corpus while it is tokenised (at most one
count a vocabulary entry reaches the driver), the package-merge method gives optimal code
lengths of at most ``limit`` bits, and one canonical code serves all files. Each
task then writes the runs of consecutive rows it holds, one file a run, in
ascending id order.

File: payload (the code bits, most significant first, in 64-bit big-endian
words), then a footer of three arrays (code lengths by id, the bit offset of every
``BLOCK``-th token, and per document its id and token count), then the footer's
length and the magic. A block can be decoded from its checkpoint alone.

Reading. A table of 2**limit entries maps the next bits to (id, length). Blocks
of a file advance in lockstep, one table look-up a token, so the work is numpy's.

Defined results: null and empty texts hold the end id alone; null document ids
sort first; rows with equal ids are ordered by text; an empty table writes no
file; other columns are not read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, pieces, release, scratch_path
from kestrel.llm.files import reading, writing
from kestrel.llm.tokens import default_tokenizer, word_ids

MAGIC = b"KTOKENS1"
BLOCK = 1024  # tokens between checkpoints
LOCKSTEP = 2048  # blocks decoded together
_NULL = -(1 << 63)


# --- code ---------------------------------------------------------------------
def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0: unused id."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64 if counts.max() > 1 << 50 else np.int64)
    row, levels = leaves, [np.ones(len(leaves), dtype=bool)]
    for _ in range(limit - 1):
        even = len(row) // 2 * 2
        merged = np.concatenate([leaves, row[0:even:2] + row[1:even:2]])
        rank = np.argsort(merged, kind="stable")
        row = merged[rank]
        levels.append(rank < len(leaves))
    lengths, need = np.zeros(len(leaves), dtype=np.uint8), 2 * len(leaves) - 2
    for leaf in reversed(levels):
        taken = int(np.count_nonzero(leaf[:need]))
        lengths[:taken] += 1
        need = 2 * (need - taken)
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: by length, then by id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code = last = 0
    used = np.flatnonzero(lengths)
    for k in used[np.lexsort((used, lengths[used]))].tolist():
        code <<= int(lengths[k]) - last
        last = int(lengths[k])
        codes[k] = code
        code += 1
    return codes


def table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, length) by the next ``bits`` bits."""
    bits = int(lengths.max(initial=1))
    ids, sizes = np.zeros(1 << bits, dtype=np.uint32), np.zeros(1 << bits, dtype=np.uint8)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    spans = (1 << (bits - lengths[used].astype(np.int64)))
    filled = int(spans.sum())
    ids[:filled] = np.repeat(used, spans)
    sizes[:filled] = np.repeat(lengths[used], spans)
    return ids, sizes, bits


class Packer:
    """Packs ids into 64-bit words, keeping the unfinished last word."""

    def __init__(self, lengths: np.ndarray):
        self.lengths, self.codes = lengths.astype(np.int64), canonical(lengths)
        self.bit, self.rest, self.tokens = 0, np.uint64(0), 0
        self.checkpoints: list[np.ndarray] = []

    def pack(self, ids: np.ndarray) -> bytes:
        size = self.lengths[ids]
        ends = np.cumsum(size)
        at = ends - size + (self.bit & 63)
        first = -self.tokens % BLOCK
        self.checkpoints.append(at[first::BLOCK] + (self.bit - (self.bit & 63)))
        code = self.codes[ids]
        word, room = at >> 6, 64 - (at & 63)
        over = np.maximum(size - room, 0)
        high = np.where(over > 0, code >> over.astype(np.uint64),
                        code << np.maximum(room - size, 0).astype(np.uint64))
        total = (self.bit & 63) + int(ends[-1])
        words = np.zeros((total >> 6) + 2, dtype=np.uint64)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[starts]] = np.bitwise_or.reduceat(high, starts)
        spill = np.flatnonzero(over)
        words[word[spill] + 1] |= code[spill] << (64 - over[spill]).astype(np.uint64)
        words[0] |= self.rest
        full = total >> 6
        self.rest = words[full]
        self.bit += int(ends[-1])
        self.tokens += len(ids)
        return words[:full].astype(">u8").tobytes()

    def finish(self) -> bytes:
        return np.array([self.rest, 0], dtype=">u8").tobytes()  # a spare word for the last look-up


def unpack(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, decoder) -> np.ndarray:
    """Ids of blocks in order; ``starts``: bit offsets, ``sizes``: tokens of each."""
    ids, lengths, bits = decoder
    out = np.empty((int(sizes.max()), len(starts)), dtype=np.uint32)
    at = starts.astype(np.int64)
    full = int(sizes.min())
    down = np.uint64(64 - bits)
    for step in range(len(out)):
        if step >= full:
            at = np.where(step < sizes, at, 0)  # finished blocks idle on the first bits
        word = at >> 6
        shift = (at & 63).astype(np.uint64)
        look = (words[word] << shift) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - shift))
        entry = (look >> down).astype(np.int64)
        out[step] = ids[entry]
        at = at + lengths[entry]
    if full == len(out):
        return out.T.reshape(-1)
    return np.concatenate([out[:n, k] for k, n in enumerate(sizes.tolist())])


# --- tables -------------------------------------------------------------------
def tokenised(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, parts: int | None = None) -> DataFrame:
    """(part, row, doc_id, ids, counts): ids of each text and the end id, numbered
    in ascending doc_id order within range partitions. A part ends with a row of
    row -1 and no ids, whose ``counts`` (pairs of id and count) are the part's, so
    that counting needs no further pass over the ids."""
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([end_id], dtype="<u4").tobytes()
    # Equal and null ids fill several ranges: the start of a text orders as the text does.
    ordered = (docs.select("doc_id", "text").repartitionByRange(parts, "doc_id", F.substring("text", 1, 32))
               .sortWithinPartitions("doc_id", "text")
               .select(F.spark_partition_id().alias("part"), "doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row, counts, part = word_ids(path), 0, np.zeros(1, dtype=np.int64), None
        names = ["part", "row", "doc_id", "ids", "counts"]
        for b in pieces(batches):
            ids = [x + end for x in words.encode_many(b.column("text").to_pylist())]
            seen = np.bincount(np.frombuffer(b"".join(ids), dtype="<u4"), minlength=len(counts))
            seen[:len(counts)] += counts
            counts, part = seen, b.column("part")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [b.column("part"), pa.array(np.arange(row, row + len(ids))), b.column("doc_id"), pa.array(ids, pa.binary()),
                 pa.nulls(len(ids), pa.binary())], names)
            row += len(ids)
        if part is not None:
            used = np.flatnonzero(counts)
            packed = np.stack([used, counts[used]], axis=1).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([-1], pa.int64()),
                                              pa.nulls(1, b.schema.field("doc_id").type), pa.nulls(1, pa.binary()),
                                              pa.array([packed], pa.binary())], names)
        words.rest()

    return ordered.mapInArrow(run, f"part int, row bigint, doc_id {dict(docs.dtypes)['doc_id']}, ids binary, counts binary")


def id_counts(rows: DataFrame) -> np.ndarray:
    """Counts of every id over all rows; one entry per id up to the largest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("counts").to_pylist():
                pairs = np.frombuffer(raw, dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "n"])

    packed = rows.select("counts").where("counts is not null")
    found = packed.mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["id"] for r in found), default=-1) + 1, dtype=np.int64)
    for r in found:  # one a vocabulary entry
        out[r["id"]] = r["n"]
    return out


def write_files(rows: DataFrame, folder: str, limit: int | None = None) -> DataFrame:
    """Write ``tokenised`` rows as files; (path, part, row, docs, tokens) of each."""
    spark = rows.sparkSession
    counts = id_counts(rows)
    limit = limit or max(8, int(np.count_nonzero(counts)).bit_length() + 2)
    shared = spark.sparkContext.broadcast(code_lengths(counts, limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, part, row, docs, tokens in _write_runs(batches, folder, shared.value):
            yield pa.RecordBatch.from_pydict({"path": [path], "part": pa.array([part], pa.int32()), "row": [row],
                                              "docs": [docs], "tokens": [tokens]})

    files = rows.where("row >= 0").select("part", "row", "doc_id", "ids").mapInArrow(run, "path string, part int, row bigint, docs bigint, tokens bigint")
    return materialize(files, "token-files")


def _write_runs(batches, folder: str, lengths: np.ndarray):
    """One file per run of consecutive rows of a part."""
    rows = (row for b in batches for row in zip(b.column("part").to_numpy().tolist(), b.column("row").to_numpy().tolist(),
                                                b.column("doc_id").to_pylist(), b.column("ids").to_numpy(zero_copy_only=False)))
    held = next(rows, None)
    while held is not None:
        part, first = held[:2]
        path, packer = f"{folder}/tokens-{part:06d}-{first:012d}.ktk", Packer(lengths)
        ids, sizes, waiting, amount = [], [], [], 0
        with writing(path) as out:
            while held is not None and held[0] == part and held[1] == first + len(ids):
                ids.append(_NULL if held[2] is None else held[2])
                sizes.append(len(held[3]) // 4)
                waiting.append(np.frombuffer(held[3], dtype="<u4"))
                amount += sizes[-1]
                held = next(rows, None)
                if amount > 1 << 15:
                    out.write(packer.pack(np.concatenate(waiting)))
                    waiting, amount = [], 0
            if waiting:
                out.write(packer.pack(np.concatenate(waiting)))
            out.write(packer.finish())
            footer = [np.asarray(lengths, dtype="u1"), np.concatenate(packer.checkpoints).astype("<u8"),
                      np.array(ids, dtype="<i8"), np.array(sizes, dtype="<u8")]
            packed = [zlib.compress(x.tobytes(), 6) for x in footer]
            for x in packed:
                out.write(x)
            out.write(np.array([*map(len, packed), sum(map(len, packed))], dtype="<u8").tobytes() + MAGIC)
        yield path, part, first, len(ids), packer.tokens


def _footer(file):
    size = file.size()
    tail = file.read_at(48, size - 48)
    if tail[40:] != MAGIC:
        raise ValueError("not a token file")
    *parts, total = np.frombuffer(tail[:40], dtype="<u8").tolist()
    body, at, out = file.read_at(total, size - 48 - total), 0, []
    for n, kind in zip(parts, ("u1", "<u8", "<i8", "<u8")):
        out.append(np.frombuffer(zlib.decompress(body[at:at + n]), dtype=kind))
        at += n
    return out


def documents_of(path: str) -> Iterator[tuple[int | None, int, bytes]]:
    """(doc_id, tokens before it in the file, ids) of every document of a file."""
    with reading(path) as file:
        lengths, checkpoints, ids, sizes = _footer(file)
        decoder = table(lengths)
        tokens, before, doc, held = int(sizes.sum()), 0, 0, b""
        for first in range(0, len(checkpoints), LOCKSTEP):
            starts = checkpoints[first:first + LOCKSTEP].astype(np.int64)
            last = first + LOCKSTEP >= len(checkpoints)
            base = int(starts[0]) >> 6
            until = None if last else (int(checkpoints[first + LOCKSTEP]) >> 6) + 2
            amount = np.full(len(starts), BLOCK, dtype=np.int64)
            if last:
                amount[-1] = tokens - (len(checkpoints) - 1) * BLOCK
                until = (int(checkpoints[-1]) + int(amount[-1]) * 64 >> 6) + 2  # cut at the file's end below
            raw = file.read_at(min((until - base) * 8, file.size() - base * 8) // 8 * 8, base * 8)
            words = np.frombuffer(raw, dtype=">u8").astype(np.uint64)
            held += unpack(words, starts - base * 64, amount, decoder).astype("<u4").tobytes()
            at = 0
            while doc < len(ids) and len(held) - at >= 4 * int(sizes[doc]):
                size = int(sizes[doc])
                yield (None if ids[doc] == _NULL else int(ids[doc])), before, held[at:at + 4 * size]
                before, at, doc = before + size, at + 4 * size, doc + 1
            held = held[at:]


def read_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document, read back from ``write_files``'s
    files. ``start``: tokens of all documents before it."""
    order = Window.orderBy("part", "row").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    placed = files.withColumn("first", F.coalesce(F.sum("tokens").over(order), F.lit(0))).select("path", "first")
    placed = materialize(placed, "token-file-starts")
    count = max(1, placed.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column("path").to_pylist(), b.column("first").to_pylist()):
                out, size = [], 0
                for doc in documents_of(path):
                    out.append(doc)
                    size += len(doc[2])
                    if size > 1 << 23:
                        yield _rows(out, first)
                        out, size = [], 0
                if out:
                    yield _rows(out, first)

    return placed.repartition(min(count, 1 << 16)).mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def _rows(docs, first: int) -> pa.RecordBatch:
    ids, before, raw = zip(*docs)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([first + x for x in before], pa.int64()),
                                       pa.array(raw, pa.binary())], ["doc_id", "start", "ids"])


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Encode, write, and read back: (doc_id, start, ids)."""
    rows = materialize(tokenised(docs, tokenizer, end_id), "token-ids")
    files = write_files(rows, scratch_path(spark, "token-binary"))
    release(rows)  # the files hold all of it
    return read_files(files)
