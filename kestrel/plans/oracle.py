"""DuckDB SQL equal in meaning to each registered query (the correctness
oracle). Tables are the pre-registered views of the generated parquet files.
Derivations mirror :mod:`kestrel.sources.derived` exactly."""

from __future__ import annotations

from kestrel.functions.weblog import IP_PATTERN, SIZE_PATTERN, hour_pattern

LOG_CTE = r"""log AS (
  SELECT '10.' || CAST((user_id >> 16) % 256 AS VARCHAR) || '.' || CAST((user_id >> 8) % 256 AS VARCHAR)
         || '.' || CAST(user_id % 256 AS VARCHAR)
         || ' HIT ' || CAST(event_id % 1000 AS VARCHAR)
         || ' [' || strftime(ts, '%d/%b/2017:%H:%M:%S') || ' +0800] "GET '
         || CASE WHEN event_type IN ('view', 'click')
                 THEN 'http://cdn.example/video/' || CAST(event_id % 40 AS VARCHAR) || '.mp4'
                 ELSE 'http://cdn.example/' || event_type || '.html' END
         || ' HTTP/1.1" '
         || CASE WHEN event_type = 'error' THEN '404' WHEN event_type = 'view' THEN '206' ELSE '200' END
         || ' ' || CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR)
         || ' "-" "Mozilla/5.0"' AS value
  FROM events)"""

IP_RE, SIZE_RE, HOUR_RE = IP_PATTERN, SIZE_PATTERN, hour_pattern()

ORACLE: dict[str, str] = {}

ORACLE["ip_hits"] = f"""
WITH {LOG_CTE},
ips AS (SELECT nullif(regexp_extract(value, '{IP_RE}', 0), '') AS ip FROM log)
SELECT ip, count(*) AS hits FROM ips WHERE ip IS NOT NULL
GROUP BY ip ORDER BY hits DESC, ip ASC LIMIT 10
"""

ORACLE["unique_ips"] = f"""
WITH {LOG_CTE}
SELECT count(DISTINCT nullif(regexp_extract(value, '{IP_RE}', 0), '')) AS unique_ips FROM log
"""

ORACLE["video_ips"] = f"""
WITH {LOG_CTE},
v AS (SELECT regexp_extract(value, '([0-9]+)\\.mp4', 0) AS video,
             nullif(regexp_extract(value, '{IP_RE}', 0), '') AS ip
      FROM log WHERE regexp_full_match(value, '^.*([0-9]+)\\.mp4.*$'))
SELECT video, count(DISTINCT ip) AS ips FROM v WHERE ip IS NOT NULL
GROUP BY video ORDER BY ips DESC, video ASC LIMIT 10
"""

ORACLE["hour_flow"] = f"""
WITH {LOG_CTE},
p AS (SELECT nullif(regexp_extract(value, '{HOUR_RE}', 2), '') AS hour,
             TRY_CAST(nullif(regexp_extract(value, '{SIZE_RE}', 2), '') AS BIGINT) AS bytes
      FROM log WHERE regexp_full_match(value, '{SIZE_RE}'))
SELECT hour, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(bytes) // 1073741824 AS BIGINT) AS gib,
       count(*) AS requests
FROM p WHERE hour IS NOT NULL AND bytes IS NOT NULL GROUP BY hour ORDER BY hour
"""

ORACLE["word_count"] = r"""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS v FROM documents),
toks AS (SELECT unnest(CASE WHEN v = '' THEN ['']
                            WHEN rtrim(v, ' ') = '' THEN []::VARCHAR[]
                            ELSE string_split(rtrim(v, ' '), ' ') END) AS word FROM lines)
SELECT word, count(*) AS n FROM toks GROUP BY word
"""

_AD_COUNTS = """c AS (SELECT CAST(user_id % 7 AS INTEGER) AS province, CAST(event_id % 25 AS INTEGER) AS adid,
                    count(*) AS clicks FROM events GROUP BY 1, 2)"""

for _name, _dir in (("ad_rank_top", "DESC"), ("ad_rank_bottom", "ASC")):
    ORACLE[_name] = f"""
WITH {_AD_COUNTS},
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY province ORDER BY clicks {_dir}, adid) AS INTEGER) AS rank FROM c)
SELECT province, adid, clicks, rank,
       CAST(province AS VARCHAR) || '-' || CAST(adid AS VARCHAR) || '-' || CAST(clicks AS VARCHAR) AS label
FROM r WHERE rank <= 3
"""

ORACLE["star_sales"] = """
WITH stock AS (SELECT CAST(o_orderkey AS VARCHAR) AS ordernumber, strftime(o_orderdate, '%Y-%m-%d') AS dateid FROM orders),
detail AS (SELECT CAST(l_orderkey AS VARCHAR) AS ordernumber, l_extendedprice * (1 - l_discount) AS amount FROM lineitem),
dates AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dateid, CAST(year(o_orderdate) AS INTEGER) AS theyear FROM orders)
SELECT c.theyear, count(DISTINCT a.ordernumber) AS orders, round(sum(b.amount), 2) AS amount
FROM stock a JOIN detail b ON a.ordernumber = b.ordernumber JOIN dates c ON a.dateid = c.dateid
GROUP BY c.theyear ORDER BY c.theyear
"""

_PROPS = "SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
ORACLE["json_filter"] = f"SELECT * FROM ({_PROPS}) WHERE k > 21"
ORACLE["sql_filter"] = ORACLE["json_filter"]

ORACLE["int_average"] = """
SELECT l_returnflag, CAST(sum(CAST(trunc(l_quantity) AS INTEGER)) // count(l_quantity) AS BIGINT) AS avg_qty
FROM lineitem GROUP BY l_returnflag
"""

ORACLE["udaf_average"] = """
SELECT c_mktsegment, round(avg(c_acctbal), 6) AS average FROM customer GROUP BY c_mktsegment
"""

ORACLE["typed_average"] = """
SELECT round(avg(CAST(trunc(c_acctbal) AS BIGINT)), 6) AS average_salary FROM customer
"""

ORACLE["value_histogram"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"

ORACLE["row_index"] = """
SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part
"""

ORACLE["partition_layout"] = "SELECT o_orderkey, CAST(o_orderkey % 5 AS INTEGER) AS partition FROM orders"

G_CTE = """v AS MATERIALIZED (SELECT p_partkey AS id, p_name AS name, p_size AS age FROM part),
e AS MATERIALIZED (SELECT src, dst, weight FROM (
        SELECT l_partkey AS src,
               lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS dst,
               l_quantity AS weight FROM lineitem) WHERE dst IS NOT NULL)"""

ORACLE["graph_build"] = f"""
WITH {G_CTE},
ep AS (SELECT src AS id FROM e UNION SELECT dst FROM e)
SELECT id, name, age FROM v
UNION ALL SELECT id, 'missing', 0 FROM ep WHERE id NOT IN (SELECT id FROM v)
"""

ORACLE["graph_filters"] = f"""
WITH {G_CTE}
SELECT 'vertices' AS metric, count(*) AS n FROM v
UNION ALL SELECT 'vertices_age_gt_30', count(*) FROM v WHERE age > 30
UNION ALL SELECT 'edges', count(*) FROM e
UNION ALL SELECT 'edges_src_gt_dst', count(*) FROM e WHERE src > dst
"""

ORACLE["graph_triplets"] = f"""
WITH {G_CTE}
SELECT e.src, s.name AS src_name, e.dst, d.name AS dst_name, e.weight
FROM e LEFT JOIN v s ON e.src = s.id LEFT JOIN v d ON e.dst = d.id WHERE e.weight > 5
"""

ORACLE["graph_map"] = f"""
WITH {G_CTE}
SELECT e.src, e.dst, e.weight, e.weight * 2 AS weight_x2, (s.age + 10) + (d.age + 10) AS age_sum
FROM e LEFT JOIN v s ON e.src = s.id LEFT JOIN v d ON e.dst = d.id
"""

ORACLE["graph_subgraph"] = f"""
WITH {G_CTE}
SELECT src, dst, weight FROM e
WHERE src IN (SELECT id FROM v WHERE age >= 30) AND dst IN (SELECT id FROM v WHERE age >= 30)
"""

ORACLE["graph_reverse"] = f"WITH {G_CTE} SELECT dst AS src, src AS dst, weight FROM e"

ORACLE["graph_degrees"] = f"""
WITH {G_CTE}
SELECT v.id, v.name,
       coalesce((SELECT count(*) FROM e WHERE e.dst = v.id), 0) AS in_degree,
       coalesce((SELECT count(*) FROM e WHERE e.src = v.id), 0) AS out_degree
FROM v
"""

ORACLE["graph_neighbors"] = f"""
WITH {G_CTE}
SELECT v.id, n.id AS nbr_id, n.name AS nbr_name, n.age AS nbr_age
FROM v LEFT JOIN e ON e.dst = v.id LEFT JOIN v n ON n.id = e.src
"""

ORACLE["graph_messages"] = f"""
WITH {G_CTE}
SELECT e.dst AS id, count(s.age) AS msgs, CAST(sum(s.age) AS BIGINT) AS age_sum
FROM e JOIN v s ON e.src = s.id GROUP BY e.dst
"""

ORACLE["graph_oldest_follower"] = f"""
WITH {G_CTE},
best AS (SELECT e.dst AS id, arg_max(s.name, (s.age, -s.id)) AS follower FROM e JOIN v s ON e.src = s.id GROUP BY e.dst)
SELECT v.id, CASE WHEN best.follower IS NULL THEN v.name || ' does not have any follower.'
                  ELSE best.follower || ' is the oldest follower of ' || v.name END AS text
FROM v LEFT JOIN best ON v.id = best.id
"""


# Runs until no distance falls (a keyed recursion: one row per vertex).
ORACLE["graph_sssp"] = f"""
WITH RECURSIVE {G_CTE},
d(id, dist) USING KEY (id) AS (
  SELECT CAST(5 AS BIGINT), 0.0::DOUBLE FROM v WHERE id = 5
  UNION
  SELECT n.id, n.dist
  FROM (SELECT e.dst AS id, min(p.dist + e.weight) AS dist FROM e JOIN d p ON e.src = p.id GROUP BY e.dst) n
  LEFT JOIN recurring.d o ON o.id = n.id WHERE o.id IS NULL OR n.dist < o.dist
)
SELECT v.id, d.dist FROM v LEFT JOIN d ON v.id = d.id
"""

ORACLE["graph_sssp_guarded"] = ORACLE["graph_sssp"]

ORACLE["graph_lowest_reached"] = f"""
WITH RECURSIVE {G_CTE},
c(id, lowest) USING KEY (id) AS (
  SELECT id, id FROM v
  UNION
  SELECT n.id, n.lowest
  FROM (SELECT e.src AS id, min(p.lowest) AS lowest FROM e JOIN c p ON e.dst = p.id GROUP BY e.src) n
  JOIN recurring.c o ON o.id = n.id WHERE n.lowest < o.lowest
)
SELECT id, lowest FROM c
"""

ORACLE["graph_balanced"] = f"""
WITH {G_CTE},
n AS (SELECT v.id, (SELECT count(*) FROM e WHERE e.dst = v.id) AS in_degree,
             (SELECT count(*) FROM e WHERE e.src = v.id) AS out_degree FROM v)
SELECT id, in_degree, out_degree FROM n WHERE in_degree = out_degree
"""

ORACLE["graph_components_all"] = f"""
WITH RECURSIVE {G_CTE},
b AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
c(id, component) USING KEY (id) AS (
  SELECT id, id FROM v
  UNION
  SELECT n.id, n.component
  FROM (SELECT b.dst AS id, min(p.component) AS component FROM b JOIN c p ON b.src = p.id GROUP BY b.dst) n
  JOIN recurring.c o ON o.id = n.id WHERE n.component < o.component
)
SELECT id, component FROM c
"""


ORACLE["graph_components"] = ORACLE["graph_components_all"].rstrip().removesuffix("SELECT id, component FROM c") + \
    "SELECT component, count(*) AS vertices FROM c GROUP BY component"

# Changes are passed on, round by round, by the vertices whose last change exceeds the tolerance.
ORACLE["graph_pagerank_by_vertex"] = f"""
WITH RECURSIVE {G_CTE},
od AS MATERIALIZED (SELECT src, count(*) AS deg FROM e GROUP BY src),
r(k, id, change) AS (
  SELECT 0, id, 0.15::DOUBLE FROM v
  UNION ALL
  SELECT max(r.k) + 1, e.dst, 0.85 * sum(r.change / od.deg)
  FROM r JOIN od ON od.src = r.id JOIN e ON e.src = r.id WHERE r.change > 0.001 GROUP BY e.dst
)
SELECT v.id, round(sum(r.change), 6) AS rank FROM r JOIN v USING (id) GROUP BY v.id
"""


def _pagerank_sql(iters: int = 10) -> str:
    parts = [G_CTE,
             "od AS MATERIALIZED (SELECT src, count(*) AS deg FROM e GROUP BY src)",
             "ew AS MATERIALIZED (SELECT e.src, e.dst, od.deg FROM e JOIN od ON e.src = od.src)",
             "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM v)"]
    for i in range(1, iters + 1):
        parts.append(
            f"r{i} AS MATERIALIZED (SELECT v.id, 0.15 + 0.85 * coalesce(c.s, 0.0) AS rank FROM v LEFT JOIN "
            f"(SELECT ew.dst AS id, sum(r.rank / ew.deg) AS s FROM ew JOIN r{i-1} r ON ew.src = r.id "
            f"GROUP BY ew.dst) c ON v.id = c.id)")
    return ("WITH " + ",\n".join(parts)
            + f"\nSELECT r.id, v.name, round(r.rank, 6) AS rank FROM r{iters} r JOIN v ON r.id = v.id")


ORACLE["graph_pagerank"] = _pagerank_sql()

# Runs until the largest change of a round is below the tolerance.
ORACLE["graph_pagerank_top"] = f"""
WITH RECURSIVE {G_CTE},
od AS MATERIALIZED (SELECT src, count(*) AS deg FROM e GROUP BY src),
r(k, id, rank, delta) AS (
  SELECT 0, id, 1.0::DOUBLE, CAST('infinity' AS DOUBLE) FROM v
  UNION ALL
  SELECT n.k + 1, n.id, n.rank, n.delta FROM (
    SELECT v.k, v.id, 0.15 + 0.85 * coalesce(c.s, 0.0) AS rank,
           abs(0.15 + 0.85 * coalesce(c.s, 0.0) - v.rank) AS delta, max(v.delta) OVER () AS worst
    FROM r v LEFT JOIN (SELECT e.dst AS id, sum(p.rank / od.deg) AS s
                        FROM e JOIN od ON e.src = od.src JOIN r p ON e.src = p.id GROUP BY e.dst) c ON v.id = c.id
  ) n WHERE n.worst >= 0.001
)
SELECT r.id, v.name AS title, round(r.rank, 6) AS rank FROM r JOIN v USING (id)
WHERE k = (SELECT max(k) FROM r) ORDER BY rank DESC, id LIMIT 10
"""

_FMT = "'%Y-%m-%d %H:%M:%S'"
ORACLE["tumbling_counts"] = f"""
WITH b AS (SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS ws, event_type FROM events)
SELECT strftime(ws, {_FMT}) AS window_start, strftime(ws + INTERVAL 6 HOURS, {_FMT}) AS window_end,
       event_type, count(*) AS n
FROM b GROUP BY ws, event_type
"""

ORACLE["sliding_counts"] = f"""
WITH b AS (SELECT time_bucket(INTERVAL '3 hours', ts, TIMESTAMP '1970-01-01') AS s, event_type FROM events),
w AS (SELECT s AS ws, event_type FROM b UNION ALL SELECT s - INTERVAL 3 HOURS, event_type FROM b)
SELECT strftime(ws, {_FMT}) AS window_start, strftime(ws + INTERVAL 6 HOURS, {_FMT}) AS window_end,
       event_type, count(*) AS n
FROM w GROUP BY ws, event_type
"""

ORACLE["sliding_inverse"] = ORACLE["sliding_counts"]

ORACLE["stateful_balance"] = """
SELECT user_id, sum(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN -1 ELSE 0 END)::BIGINT AS balance
FROM events GROUP BY user_id HAVING balance <> 0
"""

ORACLE["offset_batches"] = """
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, true AS contiguous,
       count(*) AS until_offset, count(*) AS n
FROM events GROUP BY 1, 2
"""

_CONV_WORDS = r"""lines AS (SELECT unnest(string_split(text, chr(10))) AS v FROM conversations),
toks AS (SELECT unnest(CASE WHEN v = '' THEN ['']
                            WHEN rtrim(v, ' ') = '' THEN []::VARCHAR[]
                            ELSE string_split(rtrim(v, ' '), ' ') END) AS word FROM lines)"""

ORACLE["stream_word_count"] = f"""
WITH {_CONV_WORDS}
SELECT word, count(*) AS n FROM toks GROUP BY word
"""

ORACLE["running_totals"] = f"WITH {_CONV_WORDS} SELECT word, count(*) AS n FROM toks GROUP BY word"

ORACLE["recovered_totals"] = ORACLE["running_totals"]

ORACLE["stream_relay"] = "SELECT 'relay:' || coalesce(text, 'null') AS value FROM conversations"

ORACLE["offset_ledger"] = """
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
       min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
FROM events GROUP BY 1, 2
"""

ORACLE["offset_resume"] = """
WITH t AS (SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS off, ts FROM events),
saved AS (SELECT topic, partition, max(off) + 1 AS saved FROM t
          WHERE ts < (SELECT min(ts) FROM t) + INTERVAL 20 DAY GROUP BY 1, 2),
earliest AS (SELECT topic, partition, min(off) AS earliest FROM t
             WHERE ts >= (SELECT max(ts) FROM t) - INTERVAL 7 DAY GROUP BY 1, 2)
SELECT coalesce(s.topic, e.topic) AS topic, coalesce(s.partition, e.partition) AS partition,
       CASE WHEN s.saved IS NULL THEN -1 WHEN e.earliest IS NULL THEN s.saved
            ELSE greatest(s.saved, e.earliest) END AS start_offset
FROM saved s FULL OUTER JOIN earliest e ON s.topic = e.topic AND s.partition = e.partition
"""

ORACLE["offset_continue"] = """
WITH t AS (SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS off FROM events),
half AS (SELECT topic, partition, (min(off) + max(off)) // 2 AS cut FROM t GROUP BY 1, 2),
cut AS (SELECT topic, partition, off, off < cut AS early FROM t JOIN half USING (topic, partition))
SELECT topic, partition, count(*) AS n, count(DISTINCT off) AS offsets, count(*) FILTER (WHERE early) AS first_run,
       min(off) FILTER (WHERE NOT early) AS resumed_at
FROM cut GROUP BY 1, 2
"""

ORACLE["observed_histogram"] = """
SELECT event_type, count(*) AS n, (SELECT count(*) FROM events WHERE event_type = 'purchase') AS written
FROM events GROUP BY 1
"""

ORACLE["partition_sink"] = """
SELECT o_orderkey, o_custkey, o_totalprice::DOUBLE AS price FROM orders
"""

ORACLE["linreg_fit"] = """
SELECT round(sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity), 4) AS coefficient FROM lineitem
"""

ORACLE["mse_eval"] = """
WITH b AS (SELECT sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity) AS w FROM lineitem)
SELECT count(*) AS rows, round(avg(power(l_extendedprice - b.w * l_quantity, 2)), 1) AS mse FROM lineitem, b
"""

ORACLE["table_round_trip"] = "SELECT * FROM nation"

ORACLE["text_round_trip"] = ORACLE["word_count"]


def _itemsets_sql(min_support: float) -> str:
    """Grows itemsets by one item a round until none is frequent."""
    return f"""
WITH RECURSIVE b AS MATERIALIZED (SELECT DISTINCT l_orderkey AS o, CAST(l_partkey % 20 AS VARCHAR) AS item FROM lineitem),
need AS MATERIALIZED (SELECT ceil({min_support} * count(DISTINCT o)) AS n FROM b),
grown(o, items, last_item) AS (
  SELECT o, item, item FROM (SELECT *, count(*) OVER (PARTITION BY item) AS f FROM b) WHERE f >= (SELECT n FROM need)
  UNION ALL
  SELECT o, items || ' ' || item, item
  FROM (SELECT g.o, g.items, b.item, count(*) OVER (PARTITION BY g.items, b.item) AS f
        FROM grown g JOIN b ON g.o = b.o AND b.item > g.last_item) WHERE f >= (SELECT n FROM need)
)
SELECT items, count(*) AS freq FROM grown GROUP BY items
"""


ORACLE["frequent_itemsets"] = _itemsets_sql(0.01)
ORACLE["basket_file_itemsets"] = _itemsets_sql(0.05)

# --- fits: what holds for every correct fit, whatever its random start ------------
ORACLE["kmeans_assign"] = "SELECT vec_id, true AS nearest, true AS known_cluster FROM embeddings"
ORACLE["kmeans_cost"] = "SELECT count(*) AS points, true AS is_least, true AS below_one_cluster FROM embeddings"
ORACLE["model_round_trip"] = "SELECT count(*) AS vectors, CAST(0 AS BIGINT) AS mismatches FROM embeddings"
ORACLE["tree_error"] = """
WITH p AS (SELECT doc_id, l.quality FROM labels l JOIN documents d USING (doc_id)
           WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 >= 7)
SELECT count(*) AS rows, CAST(sum(quality) AS BIGINT) AS positives, true AS beats_majority FROM p
"""
ORACLE["als_fit_score"] = """
SELECT count(*) AS rows, true AS below_spread
FROM (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
ORACLE["linreg_sgd"] = """
WITH RECURSIVE s AS (SELECT avg(l_quantity * l_quantity) AS g, avg(l_quantity * l_extendedprice) AS b FROM lineitem),
w(t, v) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT t + 1, v - 1e-8 / sqrt(t + 1) * (s.g * v - s.b) FROM w, s WHERE t < 100
)
SELECT round(v, 9) AS coefficient FROM w WHERE t = 100
"""

# --- SQL-named and two-function averages, damaged lines ------------------------------
ORACLE["sql_named_average"] = "SELECT c_nationkey, round(avg(c_acctbal), 6) AS average FROM customer GROUP BY c_nationkey"
ORACLE["take_any"] = "SELECT least(10, count(*)) AS taken FROM orders"
ORACLE["log_dropped_lines"] = """
SELECT count(*) FILTER (event_type = 'signup') AS lines_without_ip,
       count(*) FILTER (event_type = 'purchase') AS unparsed_lines FROM events
"""
ORACLE["fold_average"] = ORACLE["int_average"]
ORACLE["ad_line_check"] = """
SELECT CASE WHEN event_type IN ('error', 'purchase') THEN 'bad' ELSE 'parsed' END AS kind, count(*) AS lines
FROM events GROUP BY 1
"""

# --- file forms ------------------------------------------------------------------------
ORACLE["json_file_filter"] = ORACLE["json_filter"]
ORACLE["json_file_average"] = ORACLE["typed_average"]
ORACLE["csv_file_sales"] = ORACLE["star_sales"]
ORACLE["tab_file_graph"] = ORACLE["graph_messages"]
ORACLE["vector_file_norm"] = """
SELECT CAST(len(embedding) AS INTEGER) AS dims, count(*) AS vectors,
       round(sum(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 4) AS sq_norm
FROM embeddings GROUP BY 1
"""
ORACLE["rating_file_average"] = """
SELECT user, count(*) AS items, round(sum(r), 4) AS total
FROM (SELECT o_custkey AS user, l_partkey, sum(l_quantity) AS r
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY user
"""
ORACLE["libsvm_file_labels"] = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, count(*) AS rows, round(sum(l_quantity), 2) AS quantity
FROM lineitem GROUP BY 1
"""
