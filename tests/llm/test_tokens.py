import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.llm import bpe, textnum, tokenbin, tokens
from kestrel.llm.common import scratch_path

PATH = tokens.default_tokenizer()
LIBRARY = tokens.load(PATH)
PIECES = ["a", "b", "é", "é", "́", " ", "\n", "\t", " ", "\x1c", "\x85", " ", "'s", "'", "3", "ß", "İ", "The", "STOP",
          "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "漢字", "\U0001f600", "And ", "!!!", "Σ", "ς", "\x00", "word.", "Word,", "x's.", "jekyll", "..", "ﬁ"]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ids(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


def texts(seed, n, longest):
    rng = random.Random(seed)
    shared = ["".join(rng.choice(PIECES) for _ in range(400)) for _ in range(3)]
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, longest))) + (rng.choice(shared) if rng.random() < 0.3 else "")
            for _ in range(n)]


@pytest.mark.parametrize("make", [tokens.WordIds, bpe.ChunkEncoder])
def test_equal_to_the_library_on_odd_texts(make):
    encoder = make(PATH)
    sample = [*texts(1, 500, 40), *texts(2, 40, 3000), "", None, "w" * 20_000, "été " * 9000]
    for text, raw in zip(sample, encoder.encode_many(sample)):
        assert ids(raw) == (library(text) if text else [])


@pytest.mark.parametrize("make", [tokens.WordIds, bpe.ChunkEncoder])
def test_equal_to_the_library_with_tiny_caches(make, monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_KEPT", 5)
    monkeypatch.setattr(tokens, "CALL_WORDS", 3)
    monkeypatch.setattr(bpe, "CHUNKS_CHARS", 300)
    encoder = make(PATH)
    for text in texts(3, 60, 500):
        assert ids(next(encoder.encode_many([text]))) == library(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120))
def test_equal_to_the_library_on_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    assert ids(bpe.chunk_encoder(PATH).encode(text)) == library(text)
    assert bpe.decode(library(text), PATH) == LIBRARY.decode(library(text), skip_special_tokens=False)


def test_cuts_follow_the_content():
    rng = random.Random(5)
    words = lambda n: " ".join("w%d" % rng.randint(0, 9999) for _ in range(n))
    passage = words(3000)
    a, b = words(500) + passage + words(300), words(77) + passage + words(900)
    chunks = [{x[p:q] for p, q in zip(c, c[1:])} for x in (a, b) for c in [bpe.cuts(x)]]
    inside = {c for c in chunks[0] if c in passage}
    assert len(inside) > 10 and len(inside - chunks[1]) <= 2
    assert "".join(a[p:q] for p, q in zip(bpe.cuts(a), bpe.cuts(a)[1:])) == a


def test_cuts_are_the_same_in_segments(monkeypatch):
    from kestrel.llm import textnum
    text = " ".join(texts(6, 50, 100))
    whole = bpe.cuts(text)
    monkeypatch.setattr(bpe, "segments", lambda n, overlap: textnum.segments(n, overlap, 97))
    assert bpe.cuts(text) == whole


def test_a_tokenizer_that_keeps_white_space_is_encoded_whole():
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    keeps = tokens.load(path)
    for text in ("two  words and\nmore.", " lead", "The the THE"):
        assert ids(bpe.ChunkEncoder(path).encode(text)) == keeps.encode(text, add_special_tokens=False).ids
        assert bpe.decode(keeps.encode(text).ids, path) == keeps.decode(keeps.encode(text).ids, skip_special_tokens=False)


def test_codec_rows(odd, docs):
    got = sorted(map(tuple, bpe.round_trip(odd).collect()), key=str)
    want = []
    for r in odd.select("doc_id", "text").collect():
        found = library(r["text"] or "")
        want.append((r["doc_id"], len(found), hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest(),
                     hashlib.sha256(LIBRARY.decode(found, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(docs([])).count() == 0
    encoded = {r["doc_id"]: ids(r["ids"]) for r in bpe.encode(odd.where("doc_id = 6")).collect()}
    assert encoded == {6: library("\U0001f600 été 漢字 it's 3")}
    assert [r["text"] for r in bpe.decoded(bpe.encode(odd.where("doc_id = 6"))).collect()] == [
        LIBRARY.decode(encoded[6], skip_special_tokens=False)]


# --- files ------------------------------------------------------------------------------
def unlimited_cost(counts):
    import heapq
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=60))
def test_code_lengths(counts):
    counts = np.array(counts)
    used = np.count_nonzero(counts)
    generous = tokenbin.code_lengths(counts, 30)
    assert ((generous > 0) == (counts > 0)).all()
    if used > 1:
        assert int((generous * counts).sum()) == unlimited_cost(counts)
        tight = max(1, int(used - 1).bit_length())
        for limit in (tight, tight + 1):
            limited = tokenbin.code_lengths(counts, limit)
            assert limited.max() <= limit and abs(sum(2.0 ** -int(n) for n in limited if n) - 1) < 1e-9


def test_limited_lengths_are_optimal_against_brute_force():
    from itertools import product
    for counts in ([1, 1, 2, 3, 5, 50], [1, 1, 1, 1, 100], [9, 9, 1, 1]):
        counts = np.array(counts)
        for limit in (3, 4):
            best = min(sum(a * b for a, b in zip(lengths, counts.tolist()))
                       for lengths in product(range(1, limit + 1), repeat=len(counts)) if sum(2.0 ** -n for n in lengths) <= 1)
            assert int((tokenbin.code_lengths(counts, limit) * counts).sum()) == best


def test_too_few_bits_is_an_error():
    with pytest.raises(ValueError):
        tokenbin.code_lengths(np.ones(5), 2)


@pytest.mark.parametrize("n", [1, 2, 1023, 1024, 1025, 5000])
def test_blocks_decode_from_their_checkpoints_alone(n):
    rng = np.random.default_rng(n)
    values = rng.zipf(1.3, n).clip(max=3000).astype(np.uint32)
    lengths = tokenbin.code_lengths(np.bincount(values), 16)
    packer = tokenbin.Packer(lengths)
    raw = b"".join(packer.pack(x) for x in np.array_split(values, min(n, 7))) + packer.finish()
    words = np.frombuffer(raw, dtype=">u8").astype(np.uint64)
    points = np.concatenate(packer.checkpoints)
    assert len(points) == -(-n // tokenbin.BLOCK)
    for k, point in enumerate(points):
        part = values[k * tokenbin.BLOCK:(k + 1) * tokenbin.BLOCK]
        got = tokenbin.unpack(words, np.array([point]), np.array([len(part)]), tokenbin.table(lengths))
        assert (got == part).all()


def check_files(spark, df, monkeypatch=None):
    back = tokenbin.round_trip(spark, df)
    got = {r["start"]: (r["doc_id"], bytes(r["ids"])) for r in back.collect()}
    at = 0
    rows = df.select("doc_id", "text").collect()
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "")):
        want = np.array([*library(r["text"] or ""), 2], dtype="<u4").tobytes()
        assert got[at] == (r["doc_id"], want)
        at += len(want) // 4
    assert len(got) == len(rows)
    return back


def test_files_round_trip(spark, odd, docs):
    check_files(spark, odd)
    back = check_files(spark, docs([(k, t, "s") for k, t in enumerate(texts(9, 120, 200))]))
    for r in back.select("ids", F.crc32("ids").alias("crc")).collect():
        assert r["crc"] == zlib.crc32(bytes(r["ids"]))
    assert tokenbin.round_trip(spark, docs([])).count() == 0


def test_files_with_small_blocks_and_groups(spark, docs, monkeypatch):
    monkeypatch.setattr(tokenbin, "LOCKSTEP", 2)
    rows = docs([(k, f"w{k} " * (k * 40 % 3000), "s") for k in range(40)])
    ids_rows = tokenbin.materialize(tokenbin.tokenised(rows, parts=2), "t")
    files = tokenbin.write_files(ids_rows, scratch_path(spark, "t-files")).collect()
    want = {r["doc_id"]: bytes(r["ids"]) for r in ids_rows.where("row >= 0").collect()}
    counts = np.bincount(np.frombuffer(b"".join(want.values()), dtype="<u4"))
    assert (tokenbin.id_counts(ids_rows) == counts).all()
    got = {}
    for f in files:
        before = 0
        for doc, at, raw in tokenbin.documents_of(f["path"]):
            assert at == before
            before += len(raw) // 4
            got[doc] = raw
    assert got == want


def thue_morse(n, letters):
    return "".join(letters[bin(k).count("1") % 2] for k in range(n))


@pytest.mark.parametrize("make", [lambda p: tokens.WordIds(p), lambda p: bpe.ChunkEncoder(p)])
@pytest.mark.parametrize("size", [1024, 4096])
@pytest.mark.parametrize("flip", [False, True])
def test_words_of_one_hash_keep_their_own_ids(make, size, flip):
    """A power hash modulo 2**64 gives a Thue-Morse word and its complement one value."""
    pair = ["x" + thue_morse(size, "ab") + "x", "x" + thue_morse(size, "ba") + "x"]
    ends = np.array([0, size + 2])
    raw = [np.frombuffer(w.encode(), dtype=np.uint8) for w in pair]
    assert textnum.span_hashes(raw[0], ends[:1], ends[1:]) == textnum.span_hashes(raw[1], ends[:1], ends[1:])
    path = tokens.default_tokenizer()
    library = tokens.load(path)
    encoder = make(path)
    for text in [*(pair[::-1] if flip else pair), " ".join(pair), *pair]:
        found = np.frombuffer(b"".join(encoder.encode_many([text])), dtype="<u4").tolist()
        assert found == library.encode(text, add_special_tokens=False).ids
