"""Prefix trie of conversations in balanced parentheses, built per shard.

A turn becomes a record of fixed width (16 bytes of sha256 over role and text, 4 bytes of
its length in code points), a conversation the string of its records in turn order. The
strings are range-partitioned and sorted with their ids, so a shard holds a contiguous
piece of the trie in depth-first order and is encoded as it streams by: one bit ``1``
where a node opens, ``0`` where it closes. A range min-max tree over blocks of the excess
(opened minus closed) finds the closing bit of every node, which delimits its subtree;
the rank of the pairs ``10`` counts its leaves; cumulative arrays over the nodes in order
give its members and its savings.

Neighbouring shards share only the path to the last string of the one and the first
string of the next: the spines. A shard returns its inner nodes whole, and of its two
spines the parts that do not belong to other spine nodes. The spines of all shards (two
strings a shard, in order) are one small trie, which one task builds by the same encoding
and merges; its sums complete the shared nodes. A group of equal conversations of any
size is a path that many shards share, so it is spread like distinct ones; its member
list is hashed from pieces of one shard each.

A shard ends with its partition or after ``SHARD`` nodes, so memory is bounded whatever
the partition. The records of one conversation (20 bytes a turn) must fit in a task.

Defined results: rows without conv_id are left out; a null role or text is empty; turns
are ordered by number (null first), equal numbers by the record; a conversation whose
rebuilt form has no turns is a member of the root; repeated rows are turns of their own;
an empty table has no nodes; other columns are not read."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialize

WIDTH, DIGEST = 20, 16  # bytes of a record, of which the digest
SHARD = 1 << 19
BITS = 256  # bits of a block of excess
FAR = (1 << 63) - 1
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string")
COLUMNS = [c.split()[0] for c in NODE.split(", ")]
OUT = (f"kind int, {NODE}, shard bigint, slot bigint, first binary, last binary, common int, members array<bigint>, "
       "least array<bigint>, children array<bigint>, leaves array<bigint>, saved array<bigint>, piece string")


# --- sequences ----------------------------------------------------------------
def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): the records of each conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    record = F.concat(F.substring(F.sha2(content.cast("binary"), 256), 1, 2 * DIGEST),
                      F.lpad(F.hex(F.char_length(text)), 2 * (WIDTH - DIGEST), "0"))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.struct("turn", record.alias("r")).alias("t"))
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return listed.select("conv_id", F.unhex(F.array_join(F.transform("ts", lambda t: t["r"]), "")).alias("seq"))


def _records(seq: Column, first: Column | None = None, after: Column | None = None) -> Column:
    if after is not None:
        return F.substring(seq, after * WIDTH + 1, F.greatest(F.octet_length(seq) - after * WIDTH, F.lit(0)))
    return F.substring(seq, F.lit(1), first * WIDTH)


def rebuilt(own: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """Every conversation c with its first ``crc32(c) % heads`` turns taken from the
    conversation c - c % family."""
    own = materialize(own, "sequences")
    base = F.col("conv_id") - F.col("conv_id") % family
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    tops = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("_base"), _records(F.col("seq"), first=F.lit(heads - 1)).alias("_head"))
    both = own.withColumns({"_of": base, "_h": kept.cast("int")}).join(tops, F.col("_of") == F.col("_base"), "left")
    head = F.coalesce(_records(F.col("_head"), first=F.col("_h")), F.lit(b""))
    return both.select("conv_id", F.concat(head, _records(F.col("seq"), after=F.col("_h"))).alias("seq"))


# --- balanced parentheses -----------------------------------------------------
class Parentheses:
    """A closed sequence of balanced parentheses with a range min-max tree."""

    def __init__(self, bits: np.ndarray):
        n = -(-max(len(bits), 1) // BITS) * BITS
        self.bits = bits
        excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        self.excess = np.concatenate([excess, np.full(n - len(bits), FAR)])
        levels = [self.excess.reshape(-1, BITS).min(axis=1)]
        while len(levels[-1]) > 1:
            low = levels[-1] if len(levels[-1]) % 2 == 0 else np.append(levels[-1], FAR)
            levels.append(low.reshape(-1, 2).min(axis=1))
        self.levels = levels  # least excess of a block, of two, of four ...
        self.opens = np.flatnonzero(bits)
        pair = bits[:-1] & (1 - bits[1:]) if len(bits) else bits
        self.pairs = np.concatenate([[0], np.cumsum(pair, dtype=np.int64), [int(pair.sum())]])  # pairs that start before a place

    def _scan(self, at: np.ndarray, goal: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """First place from ``at``, before ``stop``, with excess of at most ``goal`` (-1: none)."""
        out = np.full(len(at), -1, dtype=np.int64)
        left = np.flatnonzero(at < stop)
        at = at.copy()
        while len(left):
            hit = self.excess[at[left]] <= goal[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return out

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The closing place of every opening one: the next with a smaller excess."""
        goal = self.excess[opens] - 1
        block = opens // BITS
        out = self._scan(opens + 1, goal, (block + 1) * BITS)
        rest = np.flatnonzero(out < 0)
        if not len(rest):
            return out
        node, level, need = block[rest], np.zeros(len(rest), dtype=np.int64), goal[rest]
        found = np.zeros(len(rest), dtype=bool)
        for k, row in enumerate(self.levels):  # up, to the first right-hand sibling that goes low enough
            here = np.flatnonzero(~found)
            other = node[here] + 1
            good = (node[here] % 2 == 0) & (other < len(row))
            good[good] = row[other[good]] <= need[here[good]]
            hit = here[good]
            node[hit], level[hit], found[hit] = other[good], k, True
            node[here[~good]] //= 2
        for k in range(len(self.levels) - 1, 0, -1):  # down, to its first block that does
            here = np.flatnonzero(level == k)
            left = node[here] * 2
            node[here] = np.where(self.levels[k - 1][left] <= need[here], left, left + 1)
            level[here] = k - 1
        out[rest] = self._scan(node * BITS, need, (node + 1) * BITS)
        return out

    def subtrees(self) -> tuple[np.ndarray, np.ndarray]:
        """For every node in order: the node after its subtree, and its number of leaves."""
        close = self.find_close(self.opens)
        after = np.arange(len(self.opens)) + (close - self.opens + 1) // 2
        return after, self.pairs[close] - self.pairs[self.opens]


def _over(values: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Sums over every subtree by one cumulative array."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[after] - total[np.arange(len(after))]


class Trie:
    """Nodes of strings that come in ascending order, encoded as they come."""

    def __init__(self):
        self.bits = bytearray()
        self.depth, self.size, self.parent = array("q"), array("q"), array("q")
        self.path: list[int] = []
        self.seq: bytes | None = None

    def descend(self, seq: bytes) -> tuple[list[int], list[int]]:
        """Moves to the node of ``seq``; (nodes closed on the way, the path)."""
        if seq == self.seq:
            return [], self.path
        shared, closed = 0, []
        if self.seq is not None:
            most = min(len(seq), len(self.seq))
            while shared < most and seq[shared:shared + WIDTH] == self.seq[shared:shared + WIDTH]:
                shared += WIDTH
            keep = shared // WIDTH + 1
            closed = self.path[keep:]
            del self.path[keep:]
            self.bits += b"\0" * len(closed)
        else:
            self._open(0)
        for at in range(shared, len(seq), WIDTH):
            self._open(int.from_bytes(seq[at + DIGEST:at + WIDTH], "big"))
        self.seq = seq
        return closed, self.path

    def _open(self, size: int) -> None:
        self.parent.append(self.path[-1] if self.path else -1)
        self.path.append(len(self.depth))
        self.depth.append(len(self.path) - 1)
        self.size.append(size)
        self.bits += b"\1"

    def closed(self) -> Parentheses:
        return Parentheses(np.frombuffer(bytes(self.bits) + b"\0" * len(self.path), dtype=np.uint8))

    def least(self, own: list[int]) -> list[int]:
        """The least of ``own`` over every subtree."""
        out, parent = list(own), self.parent
        for v in range(len(out) - 1, 0, -1):
            if out[v] < out[parent[v]]:
                out[parent[v]] = out[v]
        return out


class Shard:
    """The trie of one shard's strings."""

    def __init__(self, number: int):
        self.number, self.trie = number, Trie()
        self.ends, self.lowest = array("q"), array("q")  # members that end at a node; the smallest of them
        self.listed: dict[int, list[str]] = {}  # member ids of open nodes and of the first path
        self.digests: dict[int, str] = {}
        self.first: list[int] = []
        self.first_seq = b""

    def add(self, conv_id: int, seq: bytes) -> None:
        closed, path = self.trie.descend(seq)
        for v in closed:
            if v in self.listed and v not in self.first_nodes:
                self.digests[v] = hashlib.sha256(",".join(self.listed.pop(v)).encode()).hexdigest()
        if not self.first:
            self.first, self.first_seq, self.first_nodes = list(path), seq, set(path)
        new = len(self.trie.depth) - len(self.ends)
        if new:
            self.ends.extend([0] * new)
            self.lowest.extend([FAR] * new)
        v = path[-1]
        if not self.ends[v]:
            self.lowest[v] = conv_id  # ids of equal strings ascend
        self.ends[v] += 1
        self.listed.setdefault(v, []).append(str(conv_id))

    def rows(self) -> pa.RecordBatch:
        trie = self.trie
        spine = self.first + [v for v in trie.path if v not in self.first_nodes]
        slot = {v: k for k, v in enumerate(spine)}
        common = len(self.first) + len(trie.path) - len(spine)
        after, leaves = trie.closed().subtrees()
        members = _over(np.frombuffer(self.ends, dtype=np.int64), after)
        saved = _over((members - 1) * np.frombuffer(trie.size, dtype=np.int64), after)
        least = trie.least(self.lowest.tolist())
        n = len(least)
        parent = np.frombuffer(trie.parent, dtype=np.int64)
        children = np.bincount(parent[1:], minlength=n)
        on_spine = np.zeros(n, dtype=bool)
        on_spine[spine] = True
        hung = np.flatnonzero(~on_spine & on_spine[parent])  # inner nodes right below a spine
        below = lambda x: np.bincount(parent[hung], x, n).astype(np.int64)
        add = lambda x: (lambda out: (np.add.at(out, parent[hung], x[hung]), out)[1])(np.zeros(n, dtype=np.int64))  # noqa: E731  exact
        apart = [below(np.ones(len(hung))), add(leaves), add(saved)]
        inner = np.flatnonzero(~on_spine)
        least_of = np.array(least, dtype=np.int64)
        top = on_spine[parent[inner]]
        slots = [slot[p] if t else None for p, t in zip(parent[inner].tolist(), top.tolist())]
        depth = np.frombuffer(trie.depth, dtype=np.int64)
        digests = [self.digests.get(v, EMPTY) for v in inner.tolist()]
        nodes = [pa.array(np.zeros(len(inner), dtype=np.int32)), pa.array(least_of[inner]), pa.array(depth[inner]),
                 pa.array(least_of[parent[inner]], mask=top), *(pa.array(x[inner]) for x in (members, children, leaves, saved)),
                 pa.array(digests, pa.string()), pa.array(np.full(len(inner), self.number)), pa.array(slots, pa.int64())]
        names = ["kind", *COLUMNS, "shard", "slot"]
        at = [np.array(x)[spine].tolist() for x in (members, least_of, *apart)]
        others = [{"kind": 1, "shard": self.number, "first": self.first_seq, "last": trie.seq, "common": common,
                   "members": at[0], "least": at[1], "children": at[2], "leaves": at[3], "saved": at[4]}]
        others += [{"kind": 2, "shard": self.number, "slot": slot[v], "piece": ",".join(ids)} for v, ids in sorted(self.listed.items())]
        schema = _schema()
        tables = [pa.Table.from_arrays(nodes, names), pa.Table.from_pylist(others, schema)]
        whole = [pa.table({f.name: t.column(f.name).cast(f.type) if f.name in t.column_names else pa.nulls(len(t), f.type)
                           for f in schema}, schema=schema) for t in tables]
        return pa.concat_tables(whole)


def _schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in OUT.split(", "))])


def shards(seqs: DataFrame, parts: int | None = None, size: int = SHARD) -> DataFrame:
    """Rows of kind 0 (inner nodes), 1 (a shard's spines) and 2 (member lists of spine
    nodes) of ``seqs(conv_id, seq)``."""
    spark = seqs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (seqs.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
               .select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "seq"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, cut = None, 0
        for b in batches:
            for part, conv_id, seq in zip(*(b.column(k).to_pylist() for k in range(3))):
                if shard is not None and len(shard.trie.depth) + sum(shard.ends[v] for v in shard.trie.path) > size:
                    yield from shard.rows().to_batches(max_chunksize=1 << 14)
                    shard, cut = None, cut + 1
                if shard is None:
                    shard = Shard(part << 32 | cut)
                shard.add(conv_id, seq)
        if shard is not None:
            yield from shard.rows().to_batches(max_chunksize=1 << 14)

    return ordered.mapInArrow(run, OUT)


MERGED = f"kind int, {NODE}, node bigint, shard bigint, slot bigint"


def merged(spines: DataFrame) -> DataFrame:
    """The spine nodes of all shards (kind 0, numbered by ``node``), and which node each
    shard's slot is (kind 1). One task: two strings a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, sums, slots = Trie(), [[], [], [], [], []], []  # members, least, children, leaves, saved
        zero = (0, FAR, 0, 0, 0)
        for b in batches:
            for row in b.to_pylist():
                first = list(trie.descend(row["first"])[1])
                last = list(trie.descend(row["last"])[1])
                for s, z in zip(sums, zero):
                    s.extend([z] * (len(trie.depth) - len(s)))
                for k, v in enumerate(first + last[row["common"]:]):
                    slots.append((row["shard"], k, v))
                    for s, name in zip(sums, ("members", "least", "children", "leaves", "saved")):
                        s[v] = min(s[v], row[name][k]) if name == "least" else s[v] + row[name][k]
        if not slots:
            return
        after, _ = trie.closed().subtrees()
        members, least, children, leaves, saved = (np.array(s, dtype=np.int64) for s in sums)
        n, parent = len(members), np.frombuffer(trie.parent, dtype=np.int64)
        children = children + np.bincount(parent[1:], minlength=n)
        leaves = _over(leaves + (children == 0), after)
        saved = _over(saved + (members - 1) * np.frombuffer(trie.size, dtype=np.int64), after)
        of = least[parent]
        shard, slot, node = (np.array(x, dtype=np.int64) for x in zip(*slots))
        kinds = [pa.array(np.zeros(n, dtype=np.int32)), pa.array(least), pa.array(np.frombuffer(trie.depth, dtype=np.int64)),
                 pa.array(of, mask=np.arange(n) == 0), *map(pa.array, (members, children, leaves, saved)), pa.nulls(n, pa.string()),
                 pa.array(np.arange(n)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
        names = ["kind", *COLUMNS, "node", "shard", "slot"]
        m = len(slots)
        places = [pa.array(np.ones(m, dtype=np.int32)), pa.array(least[node]), *(pa.nulls(m, pa.int64()) for _ in range(6)),
                  pa.nulls(m, pa.string()), pa.array(node), pa.array(shard), pa.array(slot)]
        yield pa.RecordBatch.from_arrays(kinds, names)
        yield pa.RecordBatch.from_arrays(places, names)

    return (spines.select("shard", "first", "last", "common", "members", "least", "children", "leaves", "saved")
            .repartition(1).sortWithinPartitions("shard").mapInArrow(run, MERGED))


def digests(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the member lists in ``pieces(node, shard, piece)``, joined in
    order of the shards; a list streams through its hash."""
    ordered = pieces.repartition("node").sortWithinPartitions("node", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for b in batches:
            for n, piece in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if n != node:
                    if digest is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = n, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
        if digest is not None:
            out.append((node, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.string())],
                                         ["node", "ends_sha256"])

    return ordered.select("node", "shard", "piece").mapInArrow(run, "node bigint, ends_sha256 string")


def trie(seqs: DataFrame, parts: int | None = None, size: int = SHARD) -> DataFrame:
    """One row a node of the prefix trie of ``seqs(conv_id, seq)``."""
    built = materialize(shards(materialize(seqs, "rebuilt"), parts, size), "trie-shards")
    shared = materialize(merged(built.where("kind = 1")), "trie-spines")
    places = shared.where("kind = 1").select(F.col("shard").alias("_shard"), F.col("slot").alias("_slot"), "node",
                                             F.col("conv_id").alias("_conv"))
    here = (F.col("shard") == F.col("_shard")) & (F.col("slot") == F.col("_slot"))
    inner = built.where("kind = 0")
    whole = inner.where("slot is null").select(*COLUMNS)
    hung = inner.where("slot is not null").join(places, here).withColumn("parent_conv_id", F.col("_conv")).select(*COLUMNS)
    pieces = built.where("kind = 2").select("shard", "slot", "piece").join(places, here).select("node", "shard", "piece")
    ends = digests(pieces).withColumnsRenamed({"node": "_node", "ends_sha256": "_ends"})
    spine = (shared.where("kind = 0").join(ends, F.col("node") == F.col("_node"), "left")
             .withColumn("ends_sha256", F.coalesce("_ends", F.lit(EMPTY))).select(*COLUMNS))
    return whole.unionByName(hung).unionByName(spine)


def prefix_trie(conversations: DataFrame, family: int = 100, heads: int = 6, parts: int | None = None,
                size: int = SHARD) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(sequences(conversations), family, heads), parts, size)
