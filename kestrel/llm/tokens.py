"""Tokenizer loading and word reuse shared by the token operators.

A tokenizer that drops white space before its merges (its pre-tokenizer never
spans white space) gives the same ids for a text as for its white-space-separated
words one after the other, so ids of words are kept per Python worker, up to a
fixed number of words."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import os
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from kestrel.llm.textnum import span_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
TABLE_WORDS = 1_200_000
WORDS_KEPT = 100_000  # in each of two generations
CALL_WORDS = 2000  # words of one call to the library, which keeps some hundred bytes a token until it returns
_STOPS = ".,!?;:*%$&#@()[]{}/\\|_=+~^`\"->"  # all but letters, digits, space, apostrophe and "<"
_LAST_PLAIN = "\u012f"  # up to here lower-casing is the same single-character map everywhere
_SEPARATOR_WORDS = ("jekyll", "zebra", "the")  # any word that is one id serves
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def default_tokenizer() -> str:
    """Path of the public word-level vocabulary (49,408 ids)."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """The tokenizer of a file, one per worker process, without truncation or padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def drops_white_space(tokenizer: Tokenizer) -> bool:
    return all(len(tokenizer.encode(f"a{space}b", add_special_tokens=False).ids)
               == len(tokenizer.encode("a", add_special_tokens=False).ids)
               + len(tokenizer.encode("b", add_special_tokens=False).ids)
               and tokenizer.encode(f"a{space}{space}b", add_special_tokens=False).ids
               == tokenizer.encode("a", add_special_tokens=False).ids + tokenizer.encode("b", add_special_tokens=False).ids
               for space in " \n\t  ")


def _bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, words encoded once.

    With a byte-level BPE that lower-cases and cuts at the ends of letter runs, a
    new word of letters (and a tail of marks) is the ids of its lower-case letters,
    which the library's model gives directly, and of its tail of marks. All other new words
    go through the whole tokenizer, many a call."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.by_words = drops_white_space(self.tokenizer)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        ids = lambda x: self.whole([x])[0]
        one = [w for w in _SEPARATOR_WORDS if len(ids(w)) == 4]
        self.separator = one[0] if one and self.by_words else None
        self.separator_id = array("I", ids(self.separator))[0] if self.separator else -1
        self.model = self.tokenizer.model
        self.letters = self._letter_rule()
        self.table = WordTable()

    def _letter_rule(self) -> bool:
        """Whether letters up to U+012F may go to the model alone: by the parts the
        tokenizer is made of, and by trial."""
        parts = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
        cuts = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.bytes_of: dict[int, str] = {}
        if not (self.by_words and steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
                and cuts[0]["invert"] and "[\\p{L}]+" in cuts[0]["pattern"].get("Regex", "").split("|")
                and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"] and parts["model"]["type"] == "BPE"):
            return False
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, ord(_LAST_PLAIN) + 1)}
        plain = [chr(c) for c in range(ord(_LAST_PLAIN) + 1) if chr(c).isalpha()]
        trial = [*plain, "".join(plain), *(a + b for a, b in zip(plain, plain[7:])), "thing", "ANDxyz", "caf\u00c9s"]
        return all(self._letters(w.lower()) == self.whole([w])[0] for w in trial) and all(
            self._letters("word") + self.whole([t])[0] == self.whole(["word" + t])[0] for t in (".", ",", "?!", "...", *_STOPS, _STOPS))

    def _letters(self, word: str) -> bytes:
        """Ids of lower-case letters from the merges alone."""
        if not word.isascii():
            word = word.translate(self.bytes_of)
        return _bytes([t.id for t in self.model.tokenize(word)])

    def whole(self, texts: list[str]) -> list[bytes]:
        return [_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, words: list[str]) -> list[bytes]:
        """The library's ids of each word, by one call with a separator word."""
        if self.separator is None or len(words) < 4:
            return self.whole(words)
        if len(words) > CALL_WORDS:
            return [x for k in range(0, len(words), CALL_WORDS) for x in self._encoded(words[k:k + CALL_WORDS])]
        raw = self.whole([f" {self.separator} ".join(words)])[0]
        ids = np.frombuffer(raw, dtype="<u4")
        at = np.flatnonzero(ids == self.separator_id) * 4
        if len(at) != len(words) - 1:  # a word that holds the separator
            return self.whole(words)
        cuts = at.tolist()
        return [raw[a:b] for a, b in zip([0, *(x + 4 for x in cuts)], [*cuts, len(raw)])]

    def learn(self, words: Iterable[str]) -> None:
        """Have the ids of every word at hand."""
        if len(self.known) > WORDS_KEPT:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new: dict[str, None] = {}
        for word in words:
            if word not in known:
                found = older.get(word)
                if found is None:
                    new[word] = None
                else:
                    known[word] = found
        fresh = list(new)
        known.update(zip(fresh, self._ids_of(fresh)))

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        found = list(map(self.known.get, words))
        if None in found:
            self.learn([w for w, ids in zip(words, found) if ids is None])
            found = list(map(self.known.get, words))
            if None in found:  # dropped with the older words just now
                self.learn(words)
                found = list(map(self.known.get, words))
        return found

    def rest(self, empty: bool = False) -> None:
        """Give back what a waiting worker need not hold; ``empty``: all words."""
        self.older = {}
        if empty:
            self.known = {}
            self.table.clear()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    def splits(self, text: str) -> bool:
        """Whether the ids of the text are those of ``text.split()``: not if it holds
        an information separator, white space to Python but not to a tokenizer."""
        return self.by_words and not any(c in text for c in _SEPARATORS)

    def encode_many(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text (null: none). The distinct words of a group of texts are
        looked up in the word table or learned, and their ids gathered for all places."""
        if not self.by_words:
            yield from (self.whole([x])[0] if x else b"" for x in texts)
            return
        for group in groups(texts):
            split = pc.ascii_split_whitespace(pa.array([x or "" for x in group], pa.large_string()))
            places = split.flatten().dictionary_encode()
            start, size = self.table.find(places.dictionary, self._ids_of)
            at = places.indices.to_numpy()
            each = size[at].astype(np.int64)
            ends = np.zeros(len(at) + 1, dtype=np.int64)
            np.cumsum(each, out=ends[1:])
            out = self.table.pool[np.arange(ends[-1]) + np.repeat(start[at] - ends[:-1], each)]
            bounds = ends[split.offsets.to_numpy()].tolist()
            yield from (out[p:q].tobytes() for p, q in pairwise(bounds))

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of new words, without keeping them. The many short-lived token objects
        would set off the cycle collector again and again, so it rests meanwhile."""
        out, others, letters, tails = [], [], self._letters if self.letters else None, self.tails
        collecting = gc.isenabled()
        gc.disable()
        try:
            for k, word in enumerate(words):
                if letters and (word.isascii() or max(word) <= _LAST_PLAIN):
                    low = word.lower()
                    base = low if low.isalpha() else low.rstrip(_STOPS)
                    if base.isalpha():
                        tail = low[len(base):]
                        if tail not in tails:
                            if len(tails) > 10_000:
                                tails.clear()
                            tails[tail] = self.whole([tail])[0]
                        out.append(letters(base) + tails[tail])
                        continue
                others.append(k)
                out.append(b"")
        finally:
            if collecting:
                gc.enable()
        for k, ids in zip(others, self._encoded([words[k] for k in others])):
            out[k] = ids
        return out


class WordTable:
    """Ids of words in flat arrays, found by a 64-bit hash and compared byte by byte:
    some 40 bytes a word, an eighth of a dictionary's. Of words with one hash the first
    is found; the others are encoded anew each time. It is emptied when it holds
    ``TABLE_WORDS`` words."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hash = [np.empty(0, np.uint64), np.empty(0, np.uint64)]  # large and recent part, each sorted
        self.entry = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int32)
        self.letters, self.written = np.empty(1 << 20, dtype=np.uint8), 0  # the words themselves
        self.word_at, self.word_size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool, self.used = np.empty(1 << 20, dtype="<u4"), 0

    def find(self, words: pa.LargeStringArray, ids_of) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) in ``pool`` of the ids of each distinct word."""
        if len(self.start) > TABLE_WORDS:
            self.clear()
        ends = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset:words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
        first, last = ends[:-1], ends[1:]
        hashes = span_hashes(raw, first, last)
        found = np.full(len(words), -1, dtype=np.int64)
        for keys, entries in zip(self.hash, self.entry):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == hashes)
                hit = hit[self._equal(entries[at[hit]], raw, first[hit], last[hit])]
                found[hit] = entries[at[hit]]
        new = np.flatnonzero(found < 0)
        if len(new):
            ids = ids_of(words.take(pa.array(new)).to_numpy(zero_copy_only=False).tolist())
            found[new] = self._add(hashes[new], raw, first[new], last[new], ids)
        return self.start[found], self.size[found]

    def _equal(self, entries: np.ndarray, raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether the entries' words are the bytes of the spans of ``raw``."""
        size = last - first
        same = self.word_size[entries] == size
        size = np.where(same, size, 0)
        before = np.cumsum(size) - size
        step = np.arange(int(size.sum()))
        differs = raw[step + np.repeat(first - before, size)] != self.letters[step + np.repeat(self.word_at[entries] - before, size)]
        same[np.repeat(np.arange(len(size)), size)[differs]] = False
        return same

    def _add(self, hashes: np.ndarray, raw: np.ndarray, first: np.ndarray, last: np.ndarray, ids: list[bytes]) -> np.ndarray:
        length = last - first
        ahead = np.cumsum(length) - length
        total = int(length.sum())
        while self.written + total > len(self.letters):
            self.letters = np.concatenate([self.letters, np.empty_like(self.letters)])
        self.letters[self.written:self.written + total] = raw[np.arange(total) + np.repeat(first - ahead, length)]
        self.word_at = np.concatenate([self.word_at, self.written + ahead])
        self.word_size = np.concatenate([self.word_size, length])
        self.written += total
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        size = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) >> 2
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used:self.used + len(flat)] = flat
        entry = np.arange(len(self.start), len(self.start) + len(ids))
        self.start = np.concatenate([self.start, self.used + np.cumsum(size, dtype=np.int64) - size])
        self.size = np.concatenate([self.size, size])
        self.used += len(flat)
        part = 0 if len(self.hash[1]) > 1 << 17 else 1
        keys = [hashes] if part else [self.hash[1], hashes]
        entries = [entry] if part else [self.entry[1], entry]
        keys, entries = np.concatenate([self.hash[part], *keys]), np.concatenate([self.entry[part], *entries])
        order = np.argsort(keys, kind="stable")
        self.hash[part], self.entry[part] = keys[order], entries[order]
        if not part:
            self.hash[1], self.entry[1] = np.empty(0, np.uint64), np.empty(0, np.int64)
        return entry


def groups(texts: list[str | None], chars: int = 1 << 20) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``chars`` characters together."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size > chars:
            yield held
            held, size = [], 0
    if held:
        yield held


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
