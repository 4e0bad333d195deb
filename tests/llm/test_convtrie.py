import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import convtrie
from kestrel.llm.common import importable

SCHEMA = "conv_id long, turn long, role string, text string, depth int, slot string"


def brute(rows):
    """Every node from plain dictionaries of prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, digest, len(text), role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        full[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(full[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    importable(spark)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in convtrie.prefix_trie(df, **options).select(*convtrie.COLUMNS).collect()), key=repr)


def made(seed, convs, turns, words, ids=None):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]) if words > 2 else "user", rng.choice("abcdefgh"[:words]) * rng.randint(1, 2))
            for c in (ids or range(convs)) for t in range(rng.randint(0, turns))]


@pytest.mark.parametrize("parts,size", [(1, 1 << 19), (4, 1 << 19), (5, 1), (3, 6)])
def test_matches_brute_force_however_it_is_cut(spark, parts, size):
    rows = made(1, 250, 6, 3) + [(c, t, "user", "same") for c in range(300, 420) for t in range(4)]
    assert run(spark, rows, parts=parts, size=size) == brute(rows)


def test_hot_conversation_and_long_one(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(500) for t in range(3)] + [(900, t, "user", f"{t}") for t in range(1500)]
    rows += [(901, t, "user", f"{t}") for t in range(1200)]
    assert run(spark, rows, parts=6, size=40) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (1, None, "user", "a"), (1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"),
            (100, 2, "user", ""), (100, 1, "", "user"), (100, 3, "us", "er"), (-7, 0, "user", "\U0001f600é"), (0, 0, "user", "a"),
            (5, 0, "user", "z" * 100_000), (-100, 0, "user", "q")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(None, 0, "user", "a")]) == [] and run(spark, []) == []


def test_a_conversation_without_turns_of_its_own_left(spark):
    ids = [c for c in range(201, 400) if zlib.crc32(str(c).encode()) % 6 >= 2 and c % 100][:30]
    rows = [(c, 0, "user", "only") for c in ids]  # no conversation 200 or 300, and one turn: nothing is left
    found = run(spark, rows)
    assert found == brute(rows) and found[0][:6] == (min(ids), 0, None, len(ids), 0, 1)


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, rows, parts=7) == brute(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=1500), st.randoms())
def test_find_close_and_leaves(pops, rng):
    bits, depth = [1], 1
    for p in pops:
        for _ in range(min(p, depth - 1)):
            bits.append(0)
            depth -= 1
        for _ in range(rng.randint(1, 3)):
            bits.append(1)
            depth += 1
    bits += [0] * depth
    stack, close = [], {}
    for k, b in enumerate(bits):
        if b:
            stack.append(k)
        else:
            close[stack.pop()] = k
    whole = convtrie.Parentheses(np.array(bits, dtype=np.uint8))
    assert whole.find_close(whole.opens).tolist() == [close[k] for k in sorted(close)]
    after, leaves = whole.subtrees()
    pairs = [k for k in range(len(bits) - 1) if bits[k] and not bits[k + 1]]
    assert leaves.tolist() == [sum(o <= k < close[o] for k in pairs) for o in sorted(close)]
    assert after.tolist() == [v + sum(o <= x < close[o] for x in sorted(close)) for v, o in enumerate(sorted(close))]
