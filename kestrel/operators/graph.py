"""Property-graph operators on two DataFrames: ``vertices(id, attrs...)`` and
``edges(src, dst, attrs...)``. Multi-edges and self-loops are kept.

Everything is a join or a grouped aggregate with partial aggregation; no
vertex's neighbourhood is ever collected into one row or one task. Iterative
algorithms run a driver loop of DataFrame rounds; lineage is cut with
reliable checkpoints (``spark.checkpoint.dir``), so a lost executor only
recomputes from the last checkpoint."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.materialize import materialize, release
from kestrel.session import scratch_path

SALTS = 16  # parts over which a receiver's attributes are spread when a message reads them


@dataclass(frozen=True)
class PropertyGraph:
    vertices: DataFrame
    edges: DataFrame

    @property
    def vertex_attrs(self) -> list[str]:
        return [c for c in self.vertices.columns if c != "id"]

    @property
    def edge_attrs(self) -> list[str]:
        return [c for c in self.edges.columns if c not in ("src", "dst")]


def build(vertices: DataFrame, edges: DataFrame, default: dict | None = None) -> PropertyGraph:
    """Graph whose vertex set also holds every edge endpoint; endpoints
    without a vertex row get ``default`` attributes (NULL when not given)."""
    default = default or {}
    endpoints = (edges.select(F.col("src").alias("id"))
                 .union(edges.select(F.col("dst").alias("id"))).distinct())
    missing = endpoints.join(vertices.select("id"), "id", "left_anti")
    fill = [F.lit(default.get(f.name)).cast(f.dataType).alias(f.name)
            for f in vertices.schema.fields if f.name != "id"]
    return PropertyGraph(vertices.unionByName(missing.select("id", *fill)), edges)


def _prefixed(vertices: DataFrame, prefix: str) -> DataFrame:
    return vertices.select(*[F.col(c).alias(f"{prefix}_{c}") for c in vertices.columns])


def triplets(g: PropertyGraph) -> DataFrame:
    """Each edge with its source attributes (``src_*``) and destination
    attributes (``dst_*``). Two shuffle joins keyed by endpoint."""
    s = _prefixed(g.vertices, "src")
    d = _prefixed(g.vertices, "dst")
    return (g.edges.join(s, g.edges.src == s.src_id, "left").drop("src_id")
            .join(d, F.col("dst") == d.dst_id, "left").drop("dst_id"))


def map_vertices(g: PropertyGraph, **cols: Column) -> PropertyGraph:
    return PropertyGraph(g.vertices.withColumns(cols), g.edges)


def map_edges(g: PropertyGraph, **cols: Column) -> PropertyGraph:
    return PropertyGraph(g.vertices, g.edges.withColumns(cols))


def map_triplets(g: PropertyGraph, **cols: Column) -> PropertyGraph:
    """New edge attributes computed from both endpoints' attributes."""
    t = triplets(g)
    keep = g.edges.columns
    return PropertyGraph(g.vertices, t.select(*keep, *[c.alias(n) for n, c in cols.items()]))


def subgraph(g: PropertyGraph, vertex_pred: Column, edge_pred: Column | None = None) -> PropertyGraph:
    """Vertices satisfying ``vertex_pred``; edges whose both endpoints survive
    (two semi-joins) and that satisfy ``edge_pred``."""
    v = g.vertices.where(vertex_pred)
    ids = v.select("id")
    e = g.edges if edge_pred is None else g.edges.where(edge_pred)
    e = (e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
         .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi"))
    return PropertyGraph(v, e.select(*g.edges.columns))


def reverse(g: PropertyGraph) -> PropertyGraph:
    e = g.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *g.edge_attrs)
    return PropertyGraph(g.vertices, e)


def in_degrees(g: PropertyGraph) -> DataFrame:
    return g.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))


def out_degrees(g: PropertyGraph) -> DataFrame:
    return g.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def degrees(g: PropertyGraph) -> DataFrame:
    """Every vertex with its in- and out-degree (0 when it has none)."""
    return (g.vertices.join(in_degrees(g), "id", "left").join(out_degrees(g), "id", "left")
            .fillna(0, ["in_degree", "out_degree"]))


def in_neighbors(g: PropertyGraph) -> DataFrame:
    """In-neighbours of every vertex in long form: one row per (vertex,
    in-edge) with the neighbour's id and attributes (``nbr_*``); a vertex
    without in-edges appears once with NULL neighbour columns.

    Built as (in-edges joined to neighbour attributes) ∪ (vertices with no
    in-edge). Edges are always the probe side of the joins, so AQE can split
    a hub's edges over several tasks; the anti-join only sees one row per
    destination."""
    nb = _prefixed(g.vertices, "nbr")
    ins = (g.edges.select(F.col("dst").alias("id"), F.col("src").alias("nbr_id"))
           .join(nb, "nbr_id", "left"))
    receivers = g.edges.select(F.col("dst").alias("id")).distinct()
    lonely = g.vertices.select("id").join(receivers, "id", "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in nb.schema.fields]
    return ins.select("id", *nb.columns).unionByName(lonely.select("id", *empty))


def _sent(g: PropertyGraph, sides: tuple[str, ...], to: str) -> DataFrame:
    """Edges with the attributes of ``sides`` only, never partitioned on the
    receiving endpoint: its attributes are joined over salts, so that a hub's
    edges meet the partial aggregate from many tasks."""
    t = g.edges
    other = "src" if to == "dst" else "dst"
    if to in sides:
        spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        near = _prefixed(g.vertices, to).withColumn("_part", spread)
        salt = F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")
        t = (t.withColumn("_salt", salt)
             .join(near, (F.col(to) == F.col(f"{to}_id")) & (F.col("_salt") == F.col("_part")), "left")
             .drop(f"{to}_id", "_part", "_salt"))
    if other in sides:
        t = t.join(_prefixed(g.vertices, other), F.col(other) == F.col(f"{other}_id"), "left").drop(f"{other}_id")
    return t


def aggregate_messages(g: PropertyGraph, message: Callable[[DataFrame], Column],
                       aggs: dict[str, Callable[[Column], Column]],
                       to: str = "dst", sides: tuple[str, ...] = ("src", "dst")) -> DataFrame:
    """Send ``message(edges with endpoint attributes)`` along every edge to its
    ``to`` endpoint and merge per receiver with built-in aggregates (partial
    aggregation on the map side). ``sides`` names the endpoints whose attributes
    the message reads; the others are not joined. Only vertices that receive a
    message appear."""
    t = _sent(g, sides, to)
    msgs = t.select(F.col(to).alias("id"), message(t).alias("msg")).where(F.col("msg").isNotNull())
    return msgs.groupBy("id").agg(*[fn(F.col("msg")).alias(n) for n, fn in aggs.items()])


def oldest_follower(g: PropertyGraph, name: str = "name", age: str = "age") -> DataFrame:
    """For every vertex: text naming its oldest in-neighbour (ties by lowest
    id), or saying it has none."""
    t = _sent(g, ("src",), "dst")
    best = (t.groupBy(F.col("dst").alias("id"))
            .agg(F.max_by(F.col(f"src_{name}"),
                          F.struct(F.col(f"src_{age}"), -F.col("src"))).alias("follower")))
    j = g.vertices.select("id", name).join(best, "id", "left")
    txt = (F.when(F.col("follower").isNull(),
                  F.concat(F.col(name), F.lit(" does not have any follower.")))
           .otherwise(F.concat(F.col("follower"), F.lit(" is the oldest follower of "), F.col(name))))
    return j.select("id", txt.alias("text"))


def balanced_vertices(g: PropertyGraph) -> DataFrame:
    """Vertices with as many edges in as out."""
    return degrees(g).where("in_degree = out_degree")


# ----------------------------------------------------------------------------- iterative

class NotConverged(RuntimeError):
    """A loop ran out of rounds before its result was final."""


def _checkpoint(df: DataFrame, metric: Column | None = None):
    """Materialise one round (see :func:`kestrel.operators.materialize.materialize`)."""
    return materialize(df, "round", metric)


SPREAD = 4  # files, at least, that the edges of one sender may fill
FILE_EDGES = 1 << 20  # edges that one task sorts and writes, about


def _part_of(sender: Column, kind, parts: int) -> Column:
    """Folder of a sender; the cast makes equal ids of edges and vertices hash alike."""
    return F.pmod(F.xxhash64(sender.cast(kind)), F.lit(parts))


def _indexed_edges(edges: DataFrame, kind, rows: int | None = None) -> tuple[DataFrame, int]:
    """Edges (``_from``, ``_to``, ...) written in folders by ``_part``, sorted by sender,
    and the number of folders (at most the 32,768 bits of a bitmap). The tasks that sort
    them grow in number with the edges (``rows``, counted when not given), not in size:
    the files of a folder, by a hash of the receiver, are dealt evenly to the tasks."""
    spark = edges.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 15)
    tasks = max(parts, -(-(edges.count() if rows is None else rows) // FILE_EDGES))
    spread = max(SPREAD, -(-tasks // parts))
    path = scratch_path(spark, "edges")
    file = F.col("_part") * spread + F.pmod(F.xxhash64("_to"), F.lit(spread))
    (edges.where("_from IS NOT NULL").withColumn("_part", _part_of(F.col("_from"), kind, parts).cast("int"))
     .where("_part IS NOT NULL").repartitionById(tasks, F.pmod(file, F.lit(tasks)).cast("int"))
     .sortWithinPartitions("_part", "_from").write.partitionBy("_part").parquet(path))
    out = spark.read.schema(T.StructType([*edges.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(path)
    out._kestrel_path = path
    return out, parts


def _edges_from(edges: DataFrame, parts: int, bits: bytes) -> DataFrame:
    """The edges in the folders whose bits are set."""
    wanted = [k for k in range(parts) if bits[k // 8] >> k % 8 & 1]
    return (edges.where(F.col("_part").isin(wanted)) if len(wanted) < parts else edges).drop("_part")


def vertex_program(g: PropertyGraph, start: Column, send: Column, merge: Callable[[Column], Column],
                   program: Callable[[Column, Column], Column], active: Column | None = None,
                   max_rounds: int = 10_000, direction: str = "out", initial: Column | None = None,
                   receiver: bool = False, strict: bool = True) -> tuple[DataFrame, int]:
    """General vertex program. Every vertex starts with state ``start`` (a Column
    over the vertex attributes; NULL: no state yet), changed by ``program(start,
    initial)`` where ``initial`` (a Column over them too) gives it a message before the
    first round. In each round the vertices whose state changed send ``send`` (a Column
    over ``state``, ``src``, ``dst`` and the edge attributes; NULL: no message) along
    their out-edges, or with ``direction`` along their in-edges or ``both``; with
    ``receiver`` the message may also read ``other``, the receiver's state. Messages to
    a vertex are merged with the aggregate ``merge``, and ``program(state, message)``
    gives its new state. ``active`` limits the first senders. Ends when no state
    changes and returns (id, state) and the number of rounds. When ``max_rounds``
    leave a state changing it raises :class:`NotConverged`, or, unless ``strict``,
    returns the states of that round.

    The edges are written once, in folders by a hash of their sender (each of several
    files, so that a hub's edges are not one file). The folders that the frontier needs
    are observed, as bits, while the round is written: a round reads only those, and a
    small frontier a small part of the edges.

    A round is one join of the frontier with these edges (Catalyst broadcasts it
    from its measured bytes, else both sides are shuffled and AQE splits a hot
    sender) and one grouped aggregate that merges the messages, partially in
    each task, with the old states. Rounds are written to the shared folder and
    the changes counted during that write."""
    if direction not in ("out", "in", "both"):
        raise ValueError(f"unknown direction {direction!r}")
    raw, rows = _checkpoint(g.edges, F.count(F.lit(1)))
    ways = [raw.select(F.col(a).alias("_from"), F.col(b).alias("_to"), F.lit(way == "out").alias("_out"), *g.edge_attrs)
            for way, a, b in (("out", "src", "dst"), ("in", "dst", "src")) if direction in (way, "both")]
    ends = {c: F.when(F.col("_out") == (c == "src"), F.col("_from")).otherwise(F.col("_to")).cast(raw.schema[c].dataType)
            for c in ("src", "dst")}
    kind_of = g.vertices.schema["id"].dataType
    edges, parts = _indexed_edges(ways[0] if len(ways) == 1 else ways[0].unionByName(ways[1]), kind_of, rows * len(ways))
    release(raw)
    frontier = F.struct(F.count(F.when(F.col("changed"), 1)).alias("n"),
                        F.bitmap_construct_agg(F.when(F.col("changed"), _part_of(F.col("id"), kind_of, parts))).alias("parts"))
    changed = F.lit(True) if active is None else F.coalesce(active, F.lit(False))
    first = start if initial is None else F.when(initial.isNull(), start).otherwise(program(start, initial))
    states, senders = _checkpoint(g.vertices.select("id", first.alias("state"), changed.alias("changed"))
                                  .where(F.col("id").isNotNull()), frontier)
    kind = states.schema["state"].dataType
    rounds = 0
    while senders["n"]:
        if rounds == max_rounds:
            if not strict:
                break
            raise NotConverged(f"{senders['n']} vertices still change after {rounds} rounds")
        rounds += 1
        along = _edges_from(edges, parts, senders["parts"]).join(states.where("changed").select(F.col("id").alias("_from"), "state"), "_from")
        if receiver:  # edges are the probe side, so AQE can split a hub's; the states, one a vertex, are never sent to the driver
            along = along.join(states.select(F.col("id").alias("_to"), F.col("state").alias("other")).hint("shuffle_hash"), "_to")
        sent = (along.withColumns(ends)
                .select(F.col("_to").alias("id"), F.lit(None).cast(kind).alias("state"), send.cast(kind).alias("message"))
                .where(F.col("message").isNotNull()))
        held = states.select("id", "state", F.lit(None).cast(kind).alias("message"), F.lit(True).alias("own"))
        merged = (held.unionByName(sent.withColumn("own", F.lit(False))).groupBy("id")
                  .agg(F.max("state").alias("state"), merge(F.col("message")).alias("message"), F.max("own").alias("own")))
        new = F.when(F.col("message").isNull(), F.col("state")).otherwise(program(F.col("state"), F.col("message")))
        step = (merged.where("own").select("id", new.alias("state"), (~new.eqNullSafe(F.col("state"))).alias("changed")))
        previous = states
        states, senders = _checkpoint(step, frontier)
        release(previous)  # superseded; the new round no longer reads it
    release(edges)
    return states.select("id", "state"), rounds


def shortest_paths(g: PropertyGraph, source, weight: str = "weight",
                   max_rounds: int = 10_000) -> tuple[DataFrame, int]:
    """Single-source shortest distances over non-negative weighted edges: the
    vertex program whose messages are distances through a neighbour, merged and
    kept by minimum. Unreachable vertices get NULL. Returns the distances and the
    number of rounds; raises on negative weights and when rounds run out."""
    w = F.col(weight).cast("double")
    lowest = g.edges.agg(F.min(w)).first()[0]
    if lowest is not None and lowest < 0:
        raise ValueError(f"negative weight {lowest}")
    weighted = PropertyGraph(g.vertices, g.edges.select("src", "dst", w.alias("w")))
    here = F.col("id") == F.lit(source)
    out, rounds = vertex_program(weighted, F.when(here, F.lit(0.0)), F.col("state") + F.col("w"), F.min,
                                 lambda state, message: F.least(state, message), active=here, max_rounds=max_rounds)
    return out.withColumnRenamed("state", "dist"), rounds


def connected_components(g: PropertyGraph, max_rounds: int = 10_000) -> tuple[DataFrame, int]:
    """(id, component): the smallest id reachable over edges in either direction."""
    plain = PropertyGraph(g.vertices, g.edges.select("src", "dst"))
    out, rounds = vertex_program(plain, F.col("id"), F.col("state"), F.min, lambda state, message: F.least(state, message),
                                 max_rounds=max_rounds, direction="both")
    return out.withColumnRenamed("state", "component"), rounds


def pagerank_by_vertex(g: PropertyGraph, tol: float = 0.001, reset_prob: float = 0.15,
                       max_rounds: int = 10_000) -> tuple[DataFrame, list[int]]:
    """PageRank to a tolerance per vertex, by passing on changes. Every vertex starts
    with rank and change ``reset_prob``; while its last change exceeds ``tol`` it sends
    change / out-degree along its out-edges, and a receiver's next change is
    (1 - reset) times the sum, added to its rank. Vertices without a message, or with a
    change within ``tol``, are at rest until the next message. Returns (id, rank) and the
    number of senders of each round, which falls as vertices come to rest.

    The edges are written once, in as many buckets by ``src`` as the cluster has
    cores: a round shuffles only the senders to them, and each bucket merges its
    shares before they are shuffled, at most one row per receiver and bucket. A round
    writes only the receivers' changes; ranks are summed once, at the end, over the
    changes of all rounds."""
    spark = g.vertices.sparkSession
    edges, table = _bucketed_edges(g.edges.select("src", "dst"))
    try:
        return _pass_changes_on(g.vertices, edges, tol, reset_prob, max_rounds)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        release(edges)


def _bucketed_edges(edges: DataFrame) -> tuple[DataFrame, str]:
    """Edges as a table bucketed by ``src`` in the shared folder, and its name."""
    spark = edges.sparkSession
    path = scratch_path(spark, "kestrel_edges")
    name = path.rpartition("/")[2].replace("-", "_")
    buckets = spark.sparkContext.defaultParallelism
    edges.write.bucketBy(buckets, "src").option("path", path).saveAsTable(name, format="parquet")
    out = spark.table(name)
    out._kestrel_path = path
    return out, name


def _pass_changes_on(vertices: DataFrame, edges: DataFrame, tol: float, reset_prob: float,
                     max_rounds: int) -> tuple[DataFrame, list[int]]:
    degree = _checkpoint(edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("deg")))
    sends = F.count(F.when((F.col("change") > tol) & F.col("deg").isNotNull(), 1))
    first = vertices.select("id").where(F.col("id").isNotNull()).distinct().withColumn("change", F.lit(reset_prob))
    changes, n = _checkpoint(first.join(degree, "id", "left"), sends)
    rounds, senders = [changes], []
    while n:
        if len(senders) == max_rounds:
            raise NotConverged(f"{n} vertices still change after {max_rounds} rounds")
        senders.append(n)
        front = changes.where(F.col("change") > tol).where("deg IS NOT NULL").select(
            F.col("id").alias("src"), (F.col("change") / F.col("deg")).alias("share"))
        got = (edges.join(front.hint("shuffle_hash"), "src").groupBy(F.col("dst").alias("id"))
               .agg((F.sum("share") * (1 - reset_prob)).alias("change")))
        changes, n = _checkpoint(got.join(degree.hint("shuffle_hash"), "id", "left"), sends)
        rounds.append(changes)
    spark = vertices.sparkSession
    paths = [r._kestrel_path for r in rounds]
    whole = spark.read.schema(changes.schema).parquet(*paths).groupBy("id").agg(F.sum("change").alias("rank"))
    known = rounds[0].select("id")  # messages to ids without a vertex do not make one
    out = _checkpoint(known.join(whole, "id"))
    for frame in (*rounds, degree):
        release(frame)
    return out, senders


def pagerank(g: PropertyGraph, max_iter: int = 20, tol: float | None = None,
             reset_prob: float = 0.15) -> tuple[DataFrame, int]:
    """Unnormalised PageRank: rank = reset + (1 - reset) * Σ rank(src)/outdeg(src),
    starting from 1.0 everywhere. Runs ``max_iter`` rounds, or with ``tol`` until
    the largest change is below it, and raises :class:`NotConverged` when the
    rounds run out first. Returns (id, rank) and the number of rounds run.

    The division by the out-degree is on the vertex side: a round writes one row
    per vertex with its rank and its share (rank / out-degree), and the next round
    joins the raw edges with that table. Both sides of the join are plain scans,
    so Catalyst broadcasts the shares when their bytes allow and AQE can split a
    hot sender otherwise. The shares are merged by one grouped aggregate, partial
    in each task, and the largest change is observed during the round's write."""
    edges = _checkpoint(g.edges.select("src", "dst"))
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("deg"))
    vertices = _checkpoint(g.vertices.select("id").distinct().join(degree, "id", "left"))
    share = F.col("rank") / F.col("deg")
    state = vertices.select("id", "deg", F.lit(1.0).alias("rank")).withColumn("share", share)
    last = None
    for done in range(1, max_iter + 1):
        sent = (edges.join(state.where("share is not null").select(F.col("id").alias("src"), "share"), "src")
                .select(F.col("dst").alias("id"), F.lit(None).cast("long").alias("deg"),
                        F.lit(None).cast("double").alias("old"), F.col("share").alias("part"), F.lit(False).alias("own")))
        held = state.select("id", "deg", F.col("rank").alias("old"), F.lit(0.0).alias("part"), F.lit(True).alias("own"))
        merged = (held.unionByName(sent).groupBy("id")
                  .agg(F.max("deg").alias("deg"), F.max("old").alias("old"), F.sum("part").alias("sum"), F.max("own").alias("own"))
                  .where("own"))
        rank = F.lit(reset_prob) + F.lit(1 - reset_prob) * F.col("sum")
        step = merged.select("id", "deg", rank.alias("rank"), F.abs(rank - F.col("old")).alias("delta"))
        state, delta = _checkpoint(step.withColumn("share", share), F.max("delta"))
        release(last)
        last = state
        if tol is not None and (delta is None or delta < tol):
            break
    else:
        done = max_iter
        if tol is not None:
            raise NotConverged(f"largest change {delta} after {done} rounds, not below {tol}")
    release(vertices)
    return state.select("id", "rank"), done
