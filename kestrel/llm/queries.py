"""Registered queries of the subpackage: (spark, sf_dir) -> DataFrame, and the
equal DuckDB SQL where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, convtrie, linerules, mixing, quality, secrets, sharding, simhash, syncmers, tokenbin, topk, vafile, warc
from kestrel.llm.common import importable, scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = query
        return query
    return deco


@register("op1_secret_scan")
def op1(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"), path="source")
    return found.select("doc_id", "start", "end", "candidate", "score", "is_secret")


@register("op2_topk_search")
def op2(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


ORACLE["op2_topk_search"] = """
WITH e AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64.0 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.n <> c.n
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20
"""


@register("op3_warc_normaliser")
def op3(spark, sf_dir):
    back = warc.archive(spark, table(spark, sf_dir, "pages"), least=100)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op3_warc_normaliser"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT digest, min(page_id) AS first FROM p WHERE bytes >= 100 GROUP BY digest
)
SELECT p.page_id, p.bytes::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN p.page_id <> f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.bytes >= 100
"""


@register("op4_source_mixing")
def op4(spark, sf_dir):
    plan = mixing.draw(table(spark, sf_dir, "documents"), weights=(3, 1, 2), budget=1.5, epochs=2, shards=8, whole=True)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@register("op5_token_binary")
def op5(spark, sf_dir):
    back = tokenbin.round_trip(spark, table(spark, sf_dir, "documents"), end_id=2)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@register("op6_bpe_codec")
def op6(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@register("op7_simhash_dedup")
def op7(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


@register("op9_quality_classifier")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.quality_model(spark, docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


@register("op8_syncmer_fingerprints")
def op8(spark, sf_dir):
    return syncmers.edited_copies(table(spark, sf_dir, "documents"))


@register("op10_shuffle_shards")
def op10(spark, sf_dir):
    placed = sharding.shuffled(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8, law="key")
    written = sharding.write(placed, scratch_path(spark, "shards"))
    return written.select("doc_id", sharding.size_of(F.col("text")).alias("size"),
                          F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
                          "law", "shard", "slot", "grown_shard")


@register("op13_line_rules")
def op13(spark, sf_dir):
    cleaned = linerules.clean(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", *linerules.MEASURES, "base_failed", "kept", "lost_chars")


def _line_rules_sql() -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    word, count = text(linerules.WORD), lambda x, p: f"len(regexp_extract_all({x}, {p}))"
    notice = " OR ".join(f"contains(lower(line), {text(p)})" for p in linerules.BOILERPLATE)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {word}) AS words FROM documents
), measured AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols FROM d
), lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), counted AS (SELECT r, line, {count('line', word)} AS n FROM lines
), judged AS (
  SELECT r, line, n, CASE WHEN {count('line', text(linerules.SEPARATORS))} * 5 > n
      OR regexp_matches(line, {text(linerules.MENU)}) OR {notice}
      OR {count('line', text(linerules.MARK_RUNS))} * 5 > n
      OR (NOT regexp_matches(line, {text(linerules.SENTENCE_END)})
          AND {count('line', text(linerules.SENTENCE_MARK))} * {linerules.PROSE} < n)
    THEN length(regexp_replace(line, {text(linerules.SPACE)}, '', 'g')) ELSE 0 END AS lost
  FROM counted WHERE n > 0
), by_line AS (
  SELECT r, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines, sum(lost)::BIGINT AS lost_chars FROM judged GROUP BY r
), placed AS (
  SELECT r, unnest(range(len(words) - 2)) AS place, words FROM d WHERE len(words) > 2
), windows AS (
  SELECT r, place, count(*) OVER (PARTITION BY r, words[place + 1], words[place + 2], words[place + 3]) AS n FROM placed
), covered AS (
  SELECT r, count(DISTINCT place + k)::BIGINT AS n_repeat_words FROM windows, (SELECT unnest(range(3)) AS k) WHERE n > 1 GROUP BY r
), joined AS (
  SELECT m.*, coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(l.lost_chars, 0) AS lost_chars,
         coalesce(c.n_repeat_words, 0) AS n_repeat_words
  FROM measured m LEFT JOIN by_line l USING (r) LEFT JOIN covered c USING (r)
), based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM joined)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost_chars <= 40 * word_chars AS kept, lost_chars FROM based
"""


ORACLE["op13_line_rules"] = _line_rules_sql()


@register("op11_va_clusters")
def op11(spark, sf_dir):
    return vafile.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256.0, dims=64, salt="2:")


def _va_clusters_sql(k: int = 40, rounds: int = 5) -> str:
    bound = vafile.LIMIT
    parts = [f"""v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(greatest(-{bound}.0, least({bound}.0, 256.0 * x::DOUBLE)))) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR) NULLS LAST, w) - 1 AS c, w AS m FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR) NULLS LAST, w) <= {k}
)"""]
    for t in range(rounds + 1):
        parts.append(f"""p{t} AS (
  SELECT v.r, c, list_dot_product(w, w) - 2 * list_dot_product(w, m) + list_dot_product(m, m) AS d FROM v CROSS JOIN c{t}
), a{t} AS (
  SELECT r, c, d FROM p{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if t < rounds:
            parts.append(f"""e{t} AS (
  SELECT c, i, floor(sum(v.w[i]) / count(*)) AS x FROM a{t} JOIN v USING (r), (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i
), c{t + 1} AS (
  SELECT c{t}.c, coalesce(n.m, c{t}.m) AS m FROM c{t} LEFT JOIN (SELECT c, list(x ORDER BY i) AS m FROM e{t} GROUP BY c) n USING (c)
)""")
    t = rounds
    return f"""WITH {', '.join(parts)}, s AS (SELECT c, sum(d)::BIGINT AS total FROM a{t} GROUP BY c)
SELECT v.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, s.total AS cluster_inertia,
       (SELECT sum(total)::BIGINT FROM s) AS inertia,
       sha256(array_to_string(list_transform(m.m, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{t} a JOIN v USING (r) JOIN s USING (c) JOIN c{t} m USING (c)"""


ORACLE["op11_va_clusters"] = _va_clusters_sql()


@register("op12_conversation_trie")
def op12(spark, sf_dir):
    return convtrie.prefix_trie(table(spark, sf_dir, "conversations"), family=100, heads=6).select(*convtrie.COLUMNS)


# DuckDB has no crc32: the checksum's eight shifts a byte are folded over the decimal's bytes.
ORACLE["op12_conversation_trie"] = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '') AS k
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'k': k, 'n': length(text)} ORDER BY turn NULLS FIRST, sha256(k)) AS ts FROM rows GROUP BY conv_id
), marked AS (
  SELECT conv_id, ts, conv_id - conv_id % 100 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))),
    4294967295::BIGINT) % 6 AS h FROM own
), rebuilt AS (
  SELECT m.conv_id, list_concat(list_slice(coalesce(b.ts, []), 1, h), list_slice(m.ts, h + 1, len(m.ts))) AS ts
  FROM marked m LEFT JOIN own b ON b.conv_id = m.base
), prefixes AS (
  SELECT conv_id, d, list_slice(ts, 1, d) AS p, d = len(ts) AS ends FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY p, d
), below AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), whole AS (SELECT n.*, coalesce(b.n_children, 0) AS n_children FROM nodes n LEFT JOIN below b USING (p)
), up AS (
  SELECT list_slice(p, 1, k) AS p, sum((n_children = 0)::BIGINT) AS n_leaves,
         sum(CASE WHEN d > 0 THEN (n_convs - 1) * p[d].n ELSE 0 END) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS k FROM whole) GROUP BY 1
)
SELECT w.conv_id, w.d::BIGINT AS depth, q.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs,
       w.n_children::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM whole w JOIN up u ON u.p = w.p LEFT JOIN nodes q ON w.d > 0 AND q.p = list_slice(w.p, 1, w.d - 1)
"""
