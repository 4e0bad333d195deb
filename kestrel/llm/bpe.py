"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its last ``WINDOW`` code points falls in a
fixed class, so equal passages of different documents give equal chunks wherever
they stand. A chunk is encoded once and its ids are reused for every later
document of the task that holds it (within ``CHUNKS_CHARS`` kept characters; a
chunk that was dropped is encoded again, with equal results).

Cuts ignore token boundaries, so ids at a chunk join may be wrong. Every join is
repaired: the last words of the left and the first words of the right side are
re-encoded together, and the new ids are taken once they agree exactly with the
kept ids of the outermost word on both sides. Until they agree the window
doubles; if the kept edges of the chunks do not suffice, the text is encoded whole.

Decoding joins the token strings of the ids as the library does for a vocabulary
without a decoder, and calls the library for any other.

Defined results: null and empty texts have no ids and decode to the empty string;
repeated rows and null ids keep their rows; other columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import pieces
from kestrel.llm.textnum import code_points, segments, window_hashes
from kestrel.llm.tokens import WordIds, default_tokenizer, groups, word_ids

WINDOW = 24
CUT_BITS = 9  # chunks of about 2**CUT_BITS code points
LONGEST = 8192
CHUNKS_CHARS = 5_000_000
EDGE = 4  # words kept one by one at each end of a chunk


def cuts(text: str) -> list[int]:
    """Cut positions, from 0 to the end of the text."""
    cp = code_points(text)
    found = []
    for at, end in segments(len(cp), WINDOW - 1):
        hashes = window_hashes(cp[at:end], WINDOW)
        found.append(np.flatnonzero(hashes >> np.uint64(64 - CUT_BITS) == 0) + at + WINDOW)
    out = [0]
    for cut in [*np.concatenate(found).tolist(), len(cp)]:
        while cut - out[-1] > LONGEST:  # no cut for long: counted from the last one
            out.append(out[-1] + LONGEST)
        if cut > out[-1]:
            out.append(cut)
    return out


Pieces = list[tuple[str, bytes]]  # words and their ids


class Chunk:
    """Ids of a chunk: its first and last ``EDGE`` words one by one, the rest joined."""

    __slots__ = ("head", "middle", "tail")

    def __init__(self, head: list[str], tail: list[str], ids: bytes, base: WordIds):
        self.head, self.tail = list(zip(head, base.words(head))), list(zip(tail, base.words(tail)))
        edges = sum(len(x) for _, x in self.head), sum(len(x) for _, x in self.tail)
        self.middle = ids[edges[0]:len(ids) - edges[1]] if tail else b""

    @staticmethod
    def edges(text: str) -> tuple[list[str], list[str]]:
        """The first and the last ``EDGE`` words; of a shorter text all words and none."""
        head = text.split(None, EDGE)
        rest = head[EDGE].rsplit(None, EDGE) if len(head) > EDGE else []
        return (head[:EDGE], rest[1:]) if len(rest) > EDGE else (head[:EDGE] + rest, [])

    def ends(self) -> Pieces:
        return self.tail or self.head


class ChunkEncoder:
    def __init__(self, path: str):
        self.base = word_ids(path)
        self.kept: dict[str, Chunk] = {}
        self.size = 0
        self.windows: dict[str, bytes] = {}  # ids of the windows around the joins of the current texts

    def encode_many(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text (null: none). The new chunks of a group of texts are
        encoded together, and so are the windows around its joins."""
        for group in groups(texts):
            parts = [[x[a:b] for a, b in pairwise(cuts(x))] if x and self.base.splits(x) else None for x in group]
            if self.size > CHUNKS_CHARS:
                self.kept.clear()
                self.size = 0
            new = list(set().union(*(x for x in parts if x)).difference(self.kept))
            edges = [Chunk.edges(t) for t in new]
            self.base.learn(w for sides in edges for words in sides for w in words)
            for t, (head, tail), ids in zip(new, edges, self.base.encode_many(new)):
                self.kept[t] = Chunk(head, tail, ids, self.base)
                self.size += len(t)
            self.windows = {}
            joins = [self._window(self.kept[a].ends(), self.kept[b].head, not (a[-1].isspace() or b[0].isspace()), 2)
                     for x in parts if x for a, b in pairwise(x) if self.kept[a].head and self.kept[b].head]
            self.base.learn(w for words in joins for w in words)
            texts_of = list(dict.fromkeys(" ".join(words) for words in joins))
            self.windows = dict(zip(texts_of, self.base.whole(texts_of)))
            for text, chunks in zip(group, parts):
                if chunks is None:
                    yield self.base.whole([text])[0] if text else b""
                else:
                    yield self._joined(text, chunks)

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_many([text]))

    def rest(self) -> None:
        """At the end of a task: give back the kept chunks and words."""
        self.kept, self.windows, self.size = {}, {}, 0
        self.base.rest(empty=True)

    @staticmethod
    def _window(left: Pieces, right: Pieces, joined: bool, reach: int) -> list[str]:
        """The last ``reach`` words of one side and the first of the other."""
        a, b = left[-reach:], right[:reach]
        words = [w for w, _ in a] + [w for w, _ in b]
        if joined:
            words[len(a) - 1:len(a) + 1] = [words[len(a) - 1] + words[len(a)]]
        return words

    def _joined(self, text: str, chunks: list[str]) -> bytes:
        done: list[bytes] = []
        last: Pieces = []  # the words before the next join, not yet in ``done``
        apart = True
        before = " "
        for chunk in chunks:
            part = self.kept[chunk]
            apart = apart or before.isspace() or chunk[0].isspace()
            before = chunk[-1]
            if not part.head:
                apart = True  # all white space: the join is between words
                continue
            head = part.head
            if last:
                merged = self._repair(last, head, not apart)
                if merged is None:
                    return self.base.whole([text])[0]
                head = merged
            if part.tail:
                done += [ids for _, ids in head]
                done.append(part.middle)
                last = part.tail
            else:
                last = head
            done += [ids for _, ids in last[:-EDGE]]
            last = last[-EDGE:]
            apart = False
        return b"".join(done + [ids for _, ids in last])

    def _repair(self, left: Pieces, right: Pieces, joined: bool) -> Pieces | None:
        """The words of both sides with the ids around their join re-encoded; None
        if no window of the kept words agrees. ``joined``: the cut went through a
        word, whose halves are one word now."""
        reach = 2
        while True:
            a, b = left[-reach:], right[:reach]
            words = self._window(left, right, joined, reach)
            window = " ".join(words)
            fresh = self.windows.get(window)
            if fresh is None:
                fresh = self.base.whole([window])[0]
            sure_left = len(a) > 1 or not joined  # the outermost word does not touch the cut
            sure_right = len(b) > 1 or not joined
            if (not sure_left or fresh.startswith(a[0][1])) and (not sure_right or fresh.endswith(b[-1][1])) \
                    and (sure_left or len(left) == 1) and (sure_right or len(right) == 1):
                ids = self.base.words(words)
                if b"".join(ids) != fresh:  # ids that depend on more than a word stay in one piece
                    ids = [fresh] + [b""] * (len(words) - 1)
                return left[:-reach] + list(zip(words, ids)) + right[reach:]
            if reach >= max(len(left), len(right)):
                return None
            reach *= 2


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


@lru_cache(maxsize=2)
def _strings(path: str) -> tuple[list[str], list[str], bool]:
    """Token string and decimal string of every id; whether decoding is a plain join."""
    tokenizer = word_ids(path).tokenizer
    size = max(tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1
    return ([tokenizer.id_to_token(k) or "" for k in range(size)], [str(k) for k in range(size)], tokenizer.decoder is None)


def decode(ids: list[int], path: str) -> str:
    tokens, _, plain = _strings(path)
    if plain:
        return " ".join([tokens[k] for k in ids])
    return word_ids(path).tokenizer.decode(ids, skip_special_tokens=False)


def encode(docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): ids of each whole text as little-endian unsigned 32-bit bytes."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path)
        for b in pieces(batches):
            ids = list(encoder.encode_many(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], [key, "ids"])
        encoder.rest()

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, ids binary")


def decoded(encoded: DataFrame, tokenizer: str | None = None, key: str = "doc_id") -> DataFrame:
    """(key, text): the decoded text of :func:`encode`'s rows, special tokens kept."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            texts = [decode(np.frombuffer(x, dtype="<u4").tolist(), path) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(key, "ids").mapInArrow(run, f"{key} {dict(encoded.dtypes)[key]}, text string")


def round_trip(docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): every whole text encoded and
    decoded again, in one pass."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (_, decimal, _) = chunk_encoder(path), _strings(path)
        for b in pieces(batches):
            n, by_ids, by_text = [], [], []
            for raw in encoder.encode_many(b.column(1).to_pylist()):
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                n.append(len(ids))
                by_ids.append(hashlib.sha256(" ".join([decimal[k] for k in ids]).encode()).hexdigest())
                by_text.append(hashlib.sha256(decode(ids, path).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"])
        encoder.rest()

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    kind = dict(docs.dtypes)[key]
    return rows.mapInArrow(run, f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
