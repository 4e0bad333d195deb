"""Mixing sources to target weights by a multivariate-hypergeometric splitting
tree, in DataFrame functions only.

Targets. Sources share ``budget`` times all words by weight; a target stops at
``epochs`` times its source's size and the excess is reshared by weight until none
is above (the water level at which the shares meet the budget).

Blocks. A source's documents are dealt by a seeded hash into blocks of about
``block_words`` words. Every pass over a source (at most ``epochs``) permutes its
blocks by a seeded hash. A source takes its passes in order up to its target: whole
blocks first, then whole documents of the block that the target falls in. With
``whole`` the document in which the target falls is taken or left whole, whichever
total is nearer the target (a tie takes it); without, only its first words are taken,
so the words taken are the rounded target.

Splitting tree. The blocks taken give each source an exact quota. The quotas are
split recursively between the halves of the output shards: a node's slots are
drawn without replacement in seeded order, so the counts of each half follow the
multivariate hypergeometric law and add up exactly. A shard then draws its
quotas as disjoint ranges of each source's permuted blocks, and its documents are
shuffled locally by a seeded hash.

No group is gathered in one task: positions come from :func:`common.ranked`, joins
on a source are dealt over salts, and documents meet blocks on (source, block).

Defined results: null and empty texts have size 0 and are never taken; a null
source is a source (last in order); repeated rows are dealt like distinct ones;
null ids are keys like any other; an empty table gives an empty result; other
columns are kept, columns named like the added ones are replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, ranked

WORD = r"[^\x20\x09-\x0D]+"
SALTS = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple = (3, 1, 2), budget: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """``sources(source, source_size)``, one row each, with weight and target.

    Weights repeat in code-point order, null last. With sources in order of
    epochs * size / weight, the level is the largest budget left over weight left
    that does not exceed a source's own bound; sources below the level are capped."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                        (place % len(weights) + 1).cast("int")))
    bound = F.col("source_size") * epochs
    by_bound = Window.orderBy(bound / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = weighed.select(
        "*", (F.sum("source_size").over(everything) * budget - F.coalesce(F.sum(bound).over(before), F.lit(0.0))).alias("_budget"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("_weight"))
    capped = bound * F.col("_weight") <= F.col("_budget") * F.col("weight")
    level = F.max(F.when(~capped, F.col("_budget") / F.col("_weight"))).over(everything)
    return left.select("source", "source_size", "weight",
                       F.when(capped | level.isNull(), bound).otherwise(F.least(level * F.col("weight"), bound)).alias("target"))


def split_quotas(quotas: DataFrame, shards: int, seed: int = 9) -> DataFrame:
    """``quotas(sid, quota)`` split over shards: (sid, shard, n), exact in every
    source; shards get equal totals up to one."""
    slots = quotas.where("quota > 0").select("sid", F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota"))).alias("unit"))
    nodes = slots.select("sid", "unit", F.lit(0).alias("low"), F.lit(shards).alias("high"))
    level = 0
    while (1 << level) < shards:
        node = ["low", "high"]
        key = F.xxhash64(F.lit(seed + level), "sid", "unit", "low")
        sizes = nodes.groupBy(*node).agg(F.count(F.lit(1)).alias("total")).withColumnsRenamed({"low": "l", "high": "h"})
        drawn = ranked(nodes, node, key, ["sid", "unit"])
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        share = F.round(F.col("total") * (middle - F.col("low")) / (F.col("high") - F.col("low")))
        goes_left = F.col("position") < share
        nodes = (drawn.join(F.broadcast(sizes), (F.col("low") == F.col("l")) & (F.col("high") == F.col("h")))  # a row a node
                 .select("sid", "unit",
                         F.when(goes_left | (middle == F.col("low")), F.col("low")).otherwise(middle).alias("low"),
                         F.when(goes_left & (middle > F.col("low")), middle).otherwise(F.col("high")).alias("high")))
        nodes = materialize(nodes, "split")
        level += 1
    return nodes.groupBy("sid", F.col("low").alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def draw(docs: DataFrame, weights: tuple = (3, 1, 2), budget: float = 1.5, epochs: int = 2, shards: int = 8,
         block_words: int = 20_000, seed: int = 9, text: str = "text", key: str = "doc_id",
         source: str = "source", whole: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, text_key and
    ``parts``: an array of (pass, shard, words) for every pass that takes some of
    it. ``words`` is the document's size, unless the target falls inside it and
    ``whole`` is off."""
    sized = materialize(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"),
                                    word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("text_key")), "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    levels = (targets(per_source, weights, budget, epochs)
              .withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("fan", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words))))
    levels = materialize(levels, "targets")

    salted = levels.select(F.col("source").alias("_source"), "sid", "fan", "source_size", "target",
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    rows = (sized.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int"))
            .join(salted, F.col("source").eqNullSafe(F.col("_source")) & (F.col("salt") == F.col("_salt")))
            .withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_key"), F.col("fan")))
            .select("doc_id", "text_key", "source", "size", "sid", "block", "source_size", "target"))
    rows = materialize(rows, "dealt")

    blocks = rows.where("size > 0").groupBy("sid", "block").agg(F.sum("size").alias("words"))
    passes = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("pass")
    order = ranked(blocks.select("*", passes), ["sid", "pass"], F.xxhash64(F.lit(seed + 1), "pass", "sid", "block"),
                   ["block"], F.col("words"))
    limits = levels.select(F.col("sid").alias("_sid"), F.col("source_size").alias("_size"),
                           F.round("target").cast("long").alias("_target"))
    ahead = F.col("pass") * F.col("_size") + F.col("before")
    taken = (order.join(limits, F.col("sid") == F.col("_sid"))
             .select("sid", "block", "pass", "position",
                     F.greatest(F.lit(0), F.least("words", F.col("_target") - ahead)).alias("words_taken"))
             .where("words_taken > 0"))
    taken = materialize(taken, "blocks-taken")

    # Disjoint ranges of a source's taken blocks, in permuted order, fill its shards.
    quotas = taken.groupBy("sid").agg(F.count(F.lit(1)).alias("quota"))
    split = split_quotas(quotas, shards, seed)
    firsts = taken.groupBy("sid", "pass").agg(F.count(F.lit(1)).alias("n"))
    by_pass = Window.partitionBy("sid").orderBy("pass").rowsBetween(Window.unboundedPreceding, -1)
    starts = firsts.select("sid", "pass", F.coalesce(F.sum("n").over(by_pass), F.lit(0)).alias("start"))
    by_shard = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = split.select("sid", "shard", F.sum("n").over(by_shard).alias("end")).groupBy("sid").agg(
        F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("ends"))  # one entry a shard
    drawn = (taken.join(starts, ["sid", "pass"]).join(ends, "sid")
             .select("sid", "block", "pass", "words_taken",
                     F.get(F.filter("ends", lambda e: e["end"] > F.col("start") + F.col("position")), 0)["shard"].alias("shard")))
    plan = drawn.groupBy("sid", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard", "words_taken"))).alias("draws"))  # one entry a pass

    none = F.array().cast("array<struct<pass:int,shard:int,words:bigint>>")
    inside = Window.partitionBy("sid", "block").orderBy(F.xxhash64(F.lit(seed + 2), "doc_id", "text_key"), "doc_id",
                                                        "text_key", "size")
    ran = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.where("size > 0").withColumn("ran", ran).join(plan, ["sid", "block"], "left")

    def words(draw: Column) -> Column:
        inside = F.greatest(F.lit(0), F.least(F.col("size"), draw["words_taken"] - F.col("ran")))
        return F.when(2 * inside >= F.col("size"), F.col("size")).otherwise(F.lit(0)) if whole else inside

    parts = F.filter(F.transform("draws", lambda d: F.struct(
        d["pass"].alias("pass"), d["shard"].alias("shard"), words(d).alias("words"))),
        lambda p: p["words"] > 0)
    shown = ["doc_id", "text_key", "source", "size", "source_size", "target"]
    placed = placed.select(*shown, F.coalesce(parts, none).alias("parts"))
    placed = placed.unionByName(rows.where("size = 0").select(*shown, none.alias("parts")))  # never taken, in no block
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + p["words"])
    return placed.withColumn("taken", total)


def mix(docs: DataFrame, seed: int = 9, text: str = "text", key: str = "doc_id", source: str = "source",
        **options) -> DataFrame:
    """The mixed rows: every column of ``docs``, a row for each pass that takes the
    document (always whole), with ``shard`` and the seeded ``order`` of the row in its shard."""
    docs = docs.drop("shard", "order")
    plan = (draw(docs, seed=seed, text=text, key=key, source=source, whole=True, **options).where("taken > 0")
            .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("source").alias("_source"))
            .agg(F.flatten(F.collect_list("parts")).alias("_parts"), F.count(F.lit(1)).alias("_rows")))
    plan = materialize(plan, "mix-plan")
    same = (F.col(key).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_key"))
            & F.col(source).eqNullSafe(F.col("_source")))
    rows = docs.join(plan, same)
    if not plan.where("_rows > 1").isEmpty():  # rows of one id, text and source: the first stands for all their parts
        one = Window.partitionBy("_id", "_key", "_source").orderBy(*[c for c in docs.columns if c not in (key, text, source)], F.lit(0))
        rows = rows.withColumn("_copy", F.row_number().over(one)).where("_copy = 1").drop("_copy")
    rows = rows.select(*docs.columns, F.explode("_parts").alias("_part"))
    return rows.select(*docs.columns, F.col("_part.shard").alias("shard"),
                       F.xxhash64(F.lit(seed + 3), key, "_part.pass").alias("order"))
