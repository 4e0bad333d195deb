import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import syncmers
from kestrel.llm.textnum import code_points, window_hashes


def brute_anchors(text, k, s):
    cp = code_points(text)
    if len(cp) < k:
        return []
    small, large = window_hashes(cp, s).tolist(), window_hashes(cp, k).tolist()
    return [(i, large[i] >> 32) for i in range(len(cp) - k + 1)
            if min(small[i:i + k - s + 1]) in (small[i], small[i + k - s])]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab é\U0001f600", max_size=200), st.sampled_from([(40, 9), (12, 5), (4, 2), (16, 4)]))
def test_anchors_match_the_definition(text, size):
    at, hashes = syncmers.anchors(code_points(text), *size)
    assert list(zip(at.tolist(), hashes.tolist())) == brute_anchors(text, *size)


def test_anchors_are_context_free_and_the_same_in_segments(monkeypatch):
    rng = random.Random(1)
    words = lambda n: " ".join("w%d" % rng.randint(0, 9999) for _ in range(n))
    passage = words(400)
    texts = [words(100) + passage + words(50), passage + words(90)]
    inside = dict(zip(*[x.tolist() for x in syncmers.anchors(code_points(passage))][::-1]))
    for text in texts:
        found = {h: p for p, h in zip(*[x.tolist() for x in syncmers.anchors(code_points(text))])}
        shift = text.index(passage)
        assert all(found[h] == p + shift for h, p in inside.items())
    whole = [syncmers.anchors(code_points(t)) for t in texts]
    monkeypatch.setattr(syncmers, "SEGMENT", 100)
    for t, (at, hashes) in zip(texts, whole):
        a, h = syncmers.anchors(code_points(t))
        assert (a == at).all() and (h == hashes).all()


def test_matches_give_positions():
    rng = random.Random(2)
    a = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    b = "".join(rng.choice("abcdefgh ") for _ in range(500)) + a[300:1500]
    pairs = syncmers.matches(*(syncmers.to_string(syncmers.fingerprint_of(code_points(x))) for x in (a, b)))
    assert len(pairs) > 20 and all(q - p == 200 for p, q in pairs)


def rows_of(seed=3, n=80):
    rng = random.Random(seed)
    out = [(k * 3, "".join(rng.choice("abcdefg é\U0001f600") for _ in range(rng.choice([0, 1, 2, 9, 90, 700]))), "s") for k in range(n)]
    return out + [(n * 3, out[5][1], "s"), (n * 3 + 1, None, None), (-7, "last one of all", "s"), (30, "tie b", "s"), (30, "tie a", "s")]


@pytest.mark.parametrize("parts", [1, 2, 9])
def test_edited_copies_match_brute_force(docs, parts):
    rows = rows_of()
    order = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or ""))
    want = {}
    for k, (i, text, _) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        want[i, text] = (len(text), hashlib.sha256(edited.encode()).hexdigest())
    got = syncmers.edited_copies(docs(rows, [("part", "string", "x"), ("guest", "int", 3)]), parts=parts).collect()
    text_of = {}
    for i, text, _ in rows:
        text_of.setdefault(i, []).append(text or "")
    assert len(got) == len(rows)
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted((i, *v) for (i, _), v in want.items())
    by_text = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if len(text_of[r["doc_id"]]) == 1:
            by_text.setdefault(text_of[r["doc_id"]][0], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    texts = [r for r in got if r["n_chars"] >= 9]
    assert sum(r["near_edited"] > r["near_next"] for r in texts) >= 0.95 * len(texts)


def test_odd_rows(odd, docs):
    got = syncmers.edited_copies(odd).collect()
    assert len(got) == 9
    empty = [r for r in got if r["n_chars"] == 0]
    assert all(r["fingerprint"] == "" and r["near_edited"] == 1.0 for r in empty)
    assert syncmers.edited_copies(docs([])).count() == 0
    alone = syncmers.edited_copies(docs([(4, "all alone in here", "s")])).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"all aloneall alon").hexdigest()
    assert syncmers.fingerprints(odd).count() == 9


def test_likeness_of_copies_and_strangers():
    make = lambda t: syncmers._multiset(syncmers.fingerprint_of(code_points(t)))
    rng = random.Random(4)
    a = " ".join("w%d" % rng.randint(0, 99999) for _ in range(500))
    near = a.replace("w1", "v1", 3)
    other = " ".join("w%d" % rng.randint(0, 99999) for _ in range(500))
    assert syncmers.likeness(make(a), make(a)) == 1.0
    assert syncmers.likeness(make(a), make(near)) > 0.8 > 0.1 > syncmers.likeness(make(a), make(other))
    assert syncmers.likeness(make(""), make("")) == 1.0 and syncmers.likeness(make(""), make(a)) == 0.0


@pytest.mark.parametrize("n", [12, 40, 64, 256, 300])
def test_one_character_more_changes_little_at_any_length(n):
    rng = random.Random(n)
    make = lambda t: syncmers._multiset(syncmers.fingerprint_of(code_points(t)))
    near = []
    for _ in range(200):
        t = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n + 1))
        near.append(syncmers.likeness(make(t[:n]), make(t)))
    assert sum(near) / len(near) > 0.85


@pytest.mark.parametrize("n", [9, 30, 60, 200])
def test_short_passages_are_found_in_longer_documents(n):
    rng = random.Random(n)
    draw = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))
    passage = draw(n)
    text = draw(400) + passage + draw(400)
    own, whole = (syncmers.fingerprint_of(code_points(x)) for x in (passage, text))
    assert set(own["hash"].tolist()) <= set(whole["hash"].tolist())
    pairs = syncmers.matches(syncmers.to_string(own), syncmers.to_string(whole))
    assert pairs and sum(q - p == 400 for p, q in pairs) >= 0.9 * len(pairs)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab é\U0001f600", max_size=300))
def test_a_fingerprint_keeps_every_anchor_and_its_position(text):
    records = syncmers.fingerprint_of(code_points(text))
    back = syncmers.from_string(syncmers.to_string(records))
    assert back.tolist() == records.tolist()
    for scale, (k, s) in enumerate(syncmers.SCALES):
        at = back["gap"][(back["hash"] & 3) == scale].astype(int).cumsum().tolist()
        assert at == [p for p, _ in brute_anchors(text, k, s)]


@pytest.mark.parametrize("n", [1000, 20000])
def test_a_fingerprint_is_not_much_longer_than_its_text(n):
    rng = random.Random(n)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    assert len(syncmers.to_string(syncmers.fingerprint_of(code_points(text)))) < 1.9 * n


@pytest.mark.parametrize("parts", [2, 6])
def test_null_ids_fill_ranges_of_their_own(docs, parts):
    rng = random.Random(8)
    rows = [(k, "named %d" % k, "s") for k in range(60)] + [(None, "unnamed %d %d" % (k, rng.randint(0, 99)), "s") for k in range(60)]
    frame = docs(rows + [(None, None, "s"), (None, None, "s")])
    placed = syncmers.with_next(frame, parts).where("guest = 0 AND doc_id IS NULL").groupBy("part").count().collect()
    assert len(placed) >= parts // 2
    got = syncmers.edited_copies(frame, parts).collect()
    assert len(got) == len(rows) + 2
    # every text is the next document of exactly one row
    halves = lambda t, u: t[:len(t) - len(t) // 2] + u[:len(t) // 2]
    digests = {hashlib.sha256(halves(a[1], b[1]).encode()).hexdigest() for a in rows for b in [*rows, (None, "", "s")]}
    assert all(r["edited_sha256"] in digests for r in got if r["n_chars"])
