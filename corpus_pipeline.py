"""Training-data pipeline: STAGES run in order over ``documents``, each written as
Parquet and read again as the next stage's input.

1. quality: documents the classifier rejects go (trained on the labels outside
   the held-out fifth; documents with a score of 0.3 or more stay).
2. near_duplicates: of each SimHash component (3-word shingles, 3 bits) one
   document stays, that of smallest doc_id (null ids last, then by text hash).
3. secrets: spans that the secret scan calls true are masked in the text.
4. mixing: documents are drawn to the target weights of their sources; a document
   drawn in two passes has two rows. Documents stay whole: the last one that a
   source's quota reaches is taken or left, whichever total is nearer the target.
5. tokens: every text is encoded and decoded; the result is (doc_id, n_tokens,
   ids_sha256, decoded_sha256) per row of stage 4.

Stages 1 to 4 return the columns of ``documents`` (``n_chars`` follows the text);
other columns of their input are dropped, whatever their names. Null and empty
texts, null ids, repeated rows and empty tables pass through with the results the
operators define: an empty text scores as the classifier's bias says, all empty
texts are one SimHash group, and the mixing takes no text without words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, mixing, secrets, simhash
from kestrel.llm import quality as quality_op
from kestrel.llm.common import importable, materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # the stages hash, learn and draw in ways DuckDB has no functions for


def _length() -> Column:
    return F.coalesce(F.char_length("text").cast("long"), F.col("n_chars").cast("long")).alias("n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    model = quality_op.quality_model(spark, docs, table(spark, sf_dir, "labels"))
    return quality_op.score(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = docs.select(*COLUMNS)
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))
    groups = simhash.near_duplicates(docs.select(named.alias("row"), "text"), shingle=3, radius=3, key="row")
    first = (groups.where("row = component_id").groupBy(F.col("row.id").alias("_id"), F.col("row.key").alias("_key"))
             .agg(F.count(F.lit(1)).alias("_rows")))
    first = materialize(first, "pipeline-kept")
    kept = docs.join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left_semi")
    if not first.where("_rows > 1").isEmpty():  # repeated rows of one id and text
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = docs.select(*COLUMNS)
    found = secrets.scan(docs, path="source").where("is_secret = 1")
    masked = secrets.redact(docs, materialize(found.select("doc_id", "text_key", "start", "end"), "pipeline-secrets"))
    return masked.select("doc_id", "text", "lang", "source", _length())


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    mixed = mixing.mix(docs.select(*COLUMNS), weights=(3, 1, 2), budget=1.5, epochs=2, shards=8)
    return mixed.select("doc_id", "text", "lang", "source", _length())


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return bpe.round_trip(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mixing_stage),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
