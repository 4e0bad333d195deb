"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the generated tables (or data Spark derives from them) in
full. Most return a lazy plan; those that write files, run streams, loop over
rounds or fit models run jobs while they build their result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import aggregates as A
from kestrel.operators import graph as G
from kestrel.operators import layout, ml, ranking, sales, text, weblog
from kestrel.operators.materialize import materialize
from kestrel.session import scratch_path
from kestrel.sources import derived, partition_sink, readers, schemas, writers
from kestrel.sources.tables import table
from kestrel.streaming import runners as R
from kestrel.streaming import stateful as SF
from kestrel.streaming import transforms as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- web log (F1-F3, P4, P5, A1-A4, O1-O3) -----------------------------------
@register("ip_hits")
def q_ip_hits(spark, sf_dir):
    return weblog.ip_hits(derived.cdn_log(spark, sf_dir), k=10)


@register("unique_ips")
def q_unique_ips(spark, sf_dir):
    return weblog.unique_ips(derived.cdn_log(spark, sf_dir))


@register("video_ips")
def q_video_ips(spark, sf_dir):
    return weblog.video_ips(derived.cdn_log(spark, sf_dir), k=10)


@register("hour_flow")
def q_hour_flow(spark, sf_dir):
    return weblog.hour_flow(derived.cdn_log(spark, sf_dir))


@register("log_dropped_lines")
def q_log_dropped_lines(spark, sf_dir):
    """Lines the log queries leave out: without an address, without an hour."""
    lines = derived.damaged_cdn_log(spark, sf_dir)
    return weblog.unresolved_lines(lines).crossJoin(weblog.unparsed_flow_lines(lines))  # one row each


# --- text (S1, P7, A1) ---------------------------------------------------------
@register("word_count")
def q_word_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    return text.word_count(text.document_lines(docs))


# --- ad clicks: parse, count, rank per province (S4, P10, P11, W1) ------------
def _ad_counts(spark, sf_dir):
    good, _bad = readers.parse_delimited(derived.ad_clicks(spark, sf_dir), schemas.AD_CLICK, " ")
    return good.groupBy("province", "adid").agg(F.count(F.lit(1)).alias("clicks"))


def _ad_rank(spark, sf_dir, ascending):
    ranked = ranking.rank_per_group(_ad_counts(spark, sf_dir), ["province"], "clicks", 3,
                                    ascending=ascending, tie_break=["adid"])
    return ranked.withColumn("label", F.concat_ws("-", "province", "adid", "clicks"))


@register("ad_rank_top")
def q_ad_rank_top(spark, sf_dir):
    return _ad_rank(spark, sf_dir, ascending=False)


@register("ad_rank_bottom")
def q_ad_rank_bottom(spark, sf_dir):
    return _ad_rank(spark, sf_dir, ascending=True)


@register("ad_line_check")
def q_ad_line_check(spark, sf_dir):
    """Lines parsed and lines set aside as bad, counted in one scan."""
    lines = derived.damaged_ad_clicks(spark, sf_dir)
    good, bad = readers.parse_delimited(lines, schemas.AD_CLICK, " ")
    return (good.select(F.lit("parsed").alias("kind")).unionByName(bad.select(F.lit("bad").alias("kind")))
            .groupBy("kind").agg(F.count(F.lit(1)).alias("lines")))


# --- star schema (S5, S6, J1, A6, O4) -------------------------------------------
@register("star_sales")
def q_star_sales(spark, sf_dir):
    stock, detail, dates = derived.stock_tables(spark, sf_dir)
    return sales.yearly_sales(stock, detail, dates)


# --- JSON field filter, column API and SQL text (S2, P2, P3) ------------------
def _event_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "props")
    parsed = F.from_json("props", "k bigint")
    return ev.select("event_id", "user_id", parsed.getField("k").alias("k"))


@register("json_filter")
def q_json_filter(spark, sf_dir):
    return _event_props(spark, sf_dir).where(F.col("k") > 21)


@register("sql_filter")
def q_sql_filter(spark, sf_dir):
    return spark.sql("SELECT * FROM {props} WHERE k > 21", props=_event_props(spark, sf_dir))


@register("sql_named_average")
def q_sql_named_average(spark, sf_dir):
    """``average`` called by its SQL name (a SQL function over built-in
    aggregates, so groups are aggregated partially in each task)."""
    A.register_average_udaf(spark, "kestrel_average")
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    averages = spark.sql("SELECT c_nationkey, kestrel_average(sum(c_acctbal), count(c_acctbal)) AS average "
                         "FROM {c} GROUP BY c_nationkey", c=c)
    return averages.select("c_nationkey", F.round("average", 6).alias("average"))


@register("fold_average")
def q_fold_average(spark, sf_dir):
    """(sum, count) folded per key by two functions, then divided (integers)."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("bigint").alias("q"))
    return A.fold_by_key(li, ["l_returnflag"], "q", "named_struct('s', 0L, 'n', 0L)",
                         lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["n"] + 1).alias("n")),
                         lambda a, b: F.struct((a["s"] + b["s"]).alias("s"), (a["n"] + b["n"]).alias("n")),
                         lambda acc: F.floor(acc["s"] / acc["n"]).cast("bigint"), out="avg_qty")


# --- user-defined aggregates (A5, A7, A8, A9, U1-U4) --------------------------
@register("int_average")
def q_int_average(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return (li.select("l_returnflag", F.col("l_quantity").cast("int").alias("q"))
            .groupBy("l_returnflag").agg(A.int_average("q").alias("avg_qty")))


@register("take_any")
def q_take_any(spark, sf_dir):
    """Any ten orders, counted where they are found in the table again."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.limit(10).join(orders, "o_orderkey", "left_semi").agg(F.count(F.lit(1)).alias("taken"))


@register("udaf_average")
def q_udaf_average(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return (c.groupBy("c_mktsegment")
            .agg(F.round(A.average("c_acctbal"), 6).alias("average")))


@register("typed_average")
def q_typed_average(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    emp = c.select(F.col("c_name").alias("name"),
                   F.col("c_acctbal").cast("bigint").alias("salary"))
    emp = emp.to(schemas.EMPLOYEE)  # enforce the typed record layout
    return emp.agg(F.round(A.average("salary"), 6).alias("average_salary"))


@register("value_histogram")
def q_value_histogram(spark, sf_dir):
    return A.histogram(table(spark, sf_dir, "events"), "event_type")


@register("observed_histogram")
def q_observed_histogram(spark, sf_dir):
    """Counts per kind of event, observed while the purchases are written elsewhere."""
    kinds = ["view", "signup", "click", "error", "purchase"]
    watched, counts = A.observed_counts(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_type", kinds)
    path = scratch_path(spark, "purchases")
    watched.where("event_type = 'purchase'").write.parquet(path)
    seen = counts()
    written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("written"))
    kind = F.explode(F.array(*[F.struct(F.lit(k).alias("event_type"), F.lit(n).cast("bigint").alias("n"))
                               for k, n in seen.items() if k is not None or n]))
    return written.select(kind.alias("k"), "written").select("k.event_type", "k.n", "written")


@register("partition_sink")
def q_partition_sink(spark, sf_dir):
    """Every partition of the orders written in batches, in one transaction each, and read back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("price"))
    path = scratch_path(spark, "partition_sink")
    partition_sink.write_partitions(orders, partition_sink.folder_target(path, orders), batch_rows=5000)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "price")


# --- layout (P8, P9, X1, U5) ------------------------------------------------------
@register("row_index")
def q_row_index(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return layout.with_row_index(p, ["p_partkey"], "idx")


@register("partition_layout")
def q_partition_layout(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return layout.partition_layout(layout.partition_by_key(o, "o_orderkey", 5))


# --- graph (G1-G15, J3-J6, A13-A15) ----------------------------------------------


def _g(spark, sf_dir):
    return derived.part_graph(spark, sf_dir)


@register("graph_build")
def q_graph_build(spark, sf_dir):
    g = _g(spark, sf_dir)
    return G.build(g.vertices, g.edges, {"name": "missing", "age": 0}).vertices


@register("graph_filters")
def q_graph_filters(spark, sf_dir):
    g = _g(spark, sf_dir)

    def metrics(df, everything, name, condition):
        counted = df.agg(F.count(F.lit(1)).alias(everything), F.count(F.when(condition, 1)).alias(name))
        return counted.unpivot([], [everything, name], "metric", "n")

    return (metrics(g.vertices, "vertices", "vertices_age_gt_30", F.col("age") > 30)
            .unionByName(metrics(g.edges, "edges", "edges_src_gt_dst", F.col("src") > F.col("dst"))))


@register("graph_triplets")
def q_graph_triplets(spark, sf_dir):
    t = G.triplets(_g(spark, sf_dir)).where(F.col("weight") > 5)
    return t.select("src", "src_name", "dst", "dst_name", "weight")


@register("graph_map")
def q_graph_map(spark, sf_dir):
    g = G.map_vertices(_g(spark, sf_dir), age=F.col("age") + 10)
    g = G.map_edges(g, weight_x2=F.col("weight") * 2)
    g = G.map_triplets(g, age_sum=F.col("src_age") + F.col("dst_age"))
    return g.edges


@register("graph_subgraph")
def q_graph_subgraph(spark, sf_dir):
    return G.subgraph(_g(spark, sf_dir), F.col("age") >= 30).edges


@register("graph_reverse")
def q_graph_reverse(spark, sf_dir):
    return G.reverse(_g(spark, sf_dir)).edges


@register("graph_degrees")
def q_graph_degrees(spark, sf_dir):
    return G.degrees(_g(spark, sf_dir)).select("id", "name", "in_degree", "out_degree")


@register("graph_neighbors")
def q_graph_neighbors(spark, sf_dir):
    return G.in_neighbors(_g(spark, sf_dir))


@register("graph_messages")
def q_graph_messages(spark, sf_dir):
    return G.aggregate_messages(_g(spark, sf_dir), lambda t: t["src_age"],
                                {"msgs": F.count, "age_sum": F.sum}, sides=("src",))


@register("graph_balanced")
def q_graph_balanced(spark, sf_dir):
    return G.balanced_vertices(_g(spark, sf_dir)).select("id", "in_degree", "out_degree")


@register("graph_components_all")
def q_graph_components_all(spark, sf_dir):
    """Components over all edges of the graph."""
    return G.connected_components(_g(spark, sf_dir))[0]


@register("graph_components")
def q_graph_components(spark, sf_dir):
    """The components of the whole graph with their sizes."""
    found = G.connected_components(_g(spark, sf_dir))[0]
    return found.groupBy("component").agg(F.count(F.lit(1)).alias("vertices"))


@register("graph_oldest_follower")
def q_graph_oldest_follower(spark, sf_dir):
    return G.oldest_follower(_g(spark, sf_dir))


@register("graph_sssp")
def q_graph_sssp(spark, sf_dir):
    dist, _ = G.shortest_paths(_g(spark, sf_dir), 5, "weight")
    return dist


@register("graph_sssp_guarded")
def q_graph_sssp_guarded(spark, sf_dir):
    """Shortest distances by a program whose message is sent only where it is below the
    receiver's own distance."""
    g = _g(spark, sf_dir)
    here, through = F.col("id") == F.lit(5), F.col("state") + F.col("weight").cast("double")
    send = F.when(F.col("other").isNull() | (through < F.col("other")), through)
    out, _ = G.vertex_program(g, F.when(here, F.lit(0.0)), send, F.min, lambda state, message: F.least(state, message),
                              active=here, receiver=True)
    return out.select("id", F.col("state").alias("dist"))


@register("graph_lowest_reached")
def q_graph_lowest_reached(spark, sf_dir):
    """The smallest id that each vertex reaches along out-edges: messages go against the
    edges, and the initial message gives every vertex its own id."""
    out, _ = G.vertex_program(_g(spark, sf_dir), F.lit(None).cast("long"), F.col("state"), F.min,
                              lambda state, message: F.least(state, message), direction="in", initial=F.col("id"))
    return out.select("id", F.col("state").alias("lowest"))


@register("graph_pagerank")
def q_graph_pagerank(spark, sf_dir):
    g = _g(spark, sf_dir)
    ranks, _ = G.pagerank(g, max_iter=10)
    return ranks.join(g.vertices.select("id", "name"), "id").select(
        "id", "name", F.round("rank", 6).alias("rank"))


@register("graph_pagerank_top")
def q_graph_pagerank_top(spark, sf_dir):
    g = _g(spark, sf_dir)
    ranks, _ = G.pagerank(g, max_iter=100, tol=0.001)
    titled = g.vertices.select("id", F.col("name").alias("title")).join(ranks, "id", "left") \
        .fillna(0.0, ["rank"])
    rounded = titled.withColumn("rank", F.round("rank", 6))
    return ranking.top_k(rounded, [F.desc("rank"), F.asc("id")], 10)


@register("graph_pagerank_by_vertex")
def q_graph_pagerank_by_vertex(spark, sf_dir):
    ranks, _ = G.pagerank_by_vertex(_g(spark, sf_dir), tol=0.001)
    return ranks.select("id", F.round("rank", 6).alias("rank"))


# --- streaming (S20-S23, T1-T8) ----------------------------------------------------

_WINDOW_SCHEMA = T.StructType([T.StructField("window_start", T.StringType()),
                               T.StructField("window_end", T.StringType()),
                               T.StructField("event_type", T.StringType()),
                               T.StructField("n", T.LongType())])


def _window_query(spark, sf_dir, name, slide):
    # No watermark: files of a stored table come in any order and no row may be dropped.
    ev = ST.with_event_time(R.table_stream(spark, sf_dir, "events", ["ts", "event_type"]), delay=None)
    counts = ST.window_counts(ev, "event_type", "6 hours", slide)
    data = R.run_to_folder(spark, counts, name, output_mode="update")
    return R.latest_per_key(R.read_batches(spark, data, _WINDOW_SCHEMA),
                            ["window_start", "window_end", "event_type"], ["n"])


@register("tumbling_counts")
def q_tumbling_counts(spark, sf_dir):
    return _window_query(spark, sf_dir, "tumbling_counts", None)


@register("sliding_counts")
def q_sliding_counts(spark, sf_dir):
    return _window_query(spark, sf_dir, "sliding_counts", "3 hours")


@register("sliding_inverse")
def q_sliding_inverse(spark, sf_dir):
    """The sliding counts by adding the newest and taking off the oldest pane."""
    base = scratch_path(spark, "sliding_inverse")
    ev = ST.with_event_time(R.table_stream(spark, sf_dir, "events", ["ts", "event_type"]), delay=None)
    R.run_batches(ev, SF.inverse_windows(base, "event_type", 6 * 3600, 3 * 3600), f"{base}/checkpoint")
    return R.latest_per_key(R.read_batches(spark, f"{base}/data", _WINDOW_SCHEMA),
                            ["window_start", "window_end", "event_type"], ["n"])


@register("stateful_balance")
def q_stateful_balance(spark, sf_dir):
    """A balance per user kept by an update rule (clicks add, views take off, a balance
    of 0 is removed): the whole state that the last batch emits."""
    base = scratch_path(spark, "stateful_balance")
    step = F.sum(F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", -1).otherwise(0))
    total = lambda value, old: F.coalesce(value, F.lit(0)) + F.coalesce(old, F.lit(0))
    update = lambda value, old: F.when(total(value, old) != 0, total(value, old))
    ev = R.table_stream(spark, sf_dir, "events", ["user_id", "event_type"])
    R.run_batches(ev, SF.state_updates(base, "user_id", step, update), f"{base}/checkpoint")
    kind = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("state", T.LongType())])
    emitted = R.read_batches(spark, f"{base}/data", kind)
    last = emitted.agg(F.max("batch_id")).first()[0]
    return emitted.where(F.col("batch_id") == last).select("user_id", F.col("state").alias("balance"))


def _conversation_lines(spark, sf_dir):
    conv = R.table_stream(spark, sf_dir, "conversations", ["text"])
    return text.document_lines(conv)


_WORD_SCHEMA = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


@register("stream_word_count")
def q_stream_word_count(spark, sf_dir):
    base = scratch_path(spark, "stream_word_count")
    write = R.batch_writer(f"{base}/data")

    def per_batch(df, batch_id):  # counts of this batch only, no state kept
        write(ST.word_counts(df), batch_id)

    R.run_batches(_conversation_lines(spark, sf_dir), per_batch, f"{base}/checkpoint")
    per = R.read_batches(spark, f"{base}/data", _WORD_SCHEMA)
    return per.groupBy("word").agg(F.sum("n").alias("n"))  # the batches' counts add up to the table's


@register("running_totals")
def q_running_totals(spark, sf_dir):
    counts = ST.word_counts(_conversation_lines(spark, sf_dir))
    data = R.run_to_folder(spark, counts, "running_totals", output_mode="update")
    return R.latest_per_key(R.read_batches(spark, data, _WORD_SCHEMA), ["word"], ["n"])


@register("recovered_totals")
def q_recovered_totals(spark, sf_dir):
    """Running totals of a stream that is stopped after two batches and finished by a
    second run from its checkpoint, which holds offsets and state."""
    base = scratch_path(spark, "recovered_totals")
    counts = ST.word_counts(_conversation_lines(spark, sf_dir))
    write = R.batch_writer(f"{base}/data")
    R.run_some(counts, write, f"{base}/checkpoint", batches=2, output_mode="update")
    R.run_batches(counts, write, f"{base}/checkpoint", "update")
    return R.latest_per_key(R.read_batches(spark, f"{base}/data", _WORD_SCHEMA), ["word"], ["n"])


@register("stream_relay")
def q_stream_relay(spark, sf_dir):
    msgs = R.table_stream(spark, sf_dir, "conversations", ["text"]).withColumnRenamed("text", "value")
    data = R.run_to_folder(spark, ST.relay(msgs), "stream_relay")
    return R.read_batches(spark, data, T.StructType([T.StructField("value", T.StringType())])).drop("batch_id")


_LEDGER_SCHEMA = T.StructType([T.StructField("topic", T.StringType()),
                               T.StructField("partition", T.IntegerType()),
                               T.StructField("from_offset", T.LongType()),
                               T.StructField("until_offset", T.LongType())])


def _topic_records(df):
    """events as topic records: topic = event type, partition = user_id mod 4,
    offset = event id."""
    return df.select(F.col("event_type").alias("topic"),
                     (F.col("user_id") % 4).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"), "ts")


def _run_ledger(spark, stream, name):
    base = scratch_path(spark, name)
    write = R.batch_writer(f"{base}/ledger")

    def record(df, batch_id):  # offsets of this batch, stored after its output
        write(ST.offset_ranges(df), batch_id)

    R.run_batches(stream, record, f"{base}/checkpoint")
    return R.read_batches(spark, f"{base}/ledger", _LEDGER_SCHEMA)


@register("offset_ledger")
def q_offset_ledger(spark, sf_dir):
    columns = ["event_type", "user_id", "event_id", "ts"]
    ledger = _run_ledger(spark, _topic_records(R.table_stream(spark, sf_dir, "events", columns)), "offset_ledger")
    return (ledger.groupBy("topic", "partition")  # the range that all batches cover
            .agg(F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")))


@register("offset_batches")
def q_offset_batches(spark, sf_dir):
    """The ledger batch by batch: ranges committed with their batch's output follow each
    other without a gap, and together are the table."""
    base = scratch_path(spark, "offset_batches")
    columns = ["event_type", "user_id", "event_id", "ts"]
    stream = _topic_records(R.table_stream(spark, sf_dir, "events", columns))
    R.run_batches(stream, SF.contiguous_ranges(base, R.batch_writer(f"{base}/data")), f"{base}/checkpoint")
    ledger = R.read_batches(spark, f"{base}/ledger", _LEDGER_SCHEMA)
    order = Window.partitionBy("topic", "partition").orderBy("batch_id")  # a row a batch
    follows = F.col("from_offset") == F.coalesce(F.lag("until_offset").over(order), F.lit(0))
    ranges = (ledger.withColumn("follows", follows).groupBy("topic", "partition")
              .agg(F.min("follows").alias("contiguous"), F.max("until_offset").alias("until_offset")))
    schema = T.StructType([T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType())])
    written = R.read_batches(spark, f"{base}/data", schema).groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"))
    return ranges.join(written, ["topic", "partition"]).select("topic", "partition", "contiguous", "until_offset", "n")


@register("offset_resume")
def q_offset_resume(spark, sf_dir, saved_days=20, kept_days=7):
    """Ledger saved by a run over the first ``saved_days`` days; retention keeps the
    last ``kept_days`` days of the topic; restart positions from both."""
    ev = table(spark, sf_dir, "events")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    cut_s, keep_s = ev.agg(F.date_format(F.min("ts") + F.expr(f"INTERVAL {saved_days} DAYS"), fmt),
                           F.date_format(F.max("ts") - F.expr(f"INTERVAL {kept_days} DAYS"), fmt)).first()
    cut, keep = F.to_timestamp_ntz(F.lit(cut_s)), F.to_timestamp_ntz(F.lit(keep_s))
    columns = ["event_type", "user_id", "event_id", "ts"]
    stream = _topic_records(R.table_stream(spark, sf_dir, "events", columns)).where(F.col("ts") < cut)
    ledger = _run_ledger(spark, stream, "offset_resume")
    earliest = (_topic_records(ev).where(F.col("ts") >= keep)
                .groupBy("topic", "partition").agg(F.min("offset").alias("earliest_offset")))
    return ST.resume_positions(ledger, earliest)


@register("offset_continue")
def q_offset_continue(spark, sf_dir):
    """Two runs over a stored topic: the first stops half-way in every partition, the
    second reads on from the positions in the ledger. Their outputs together."""
    base = scratch_path(spark, "offset_continue")
    records = _topic_records(table(spark, sf_dir, "events").select("event_type", "user_id", "event_id", "ts"))
    place = ["topic", "partition", "offset"]
    records.select(*place).repartitionByRange(*place).sortWithinPartitions(*place).write.parquet(f"{base}/log")
    log = spark.read.parquet(f"{base}/log")
    ends = log.groupBy("topic", "partition").agg(F.min("offset").alias("earliest_offset"), F.max("offset").alias("last"))
    ends = materialize(ends, "topic_ends")  # one row a partition
    half = ends.select("topic", "partition", F.expr("(earliest_offset + last) div 2").alias("until_offset"))
    first = R.read_from(log, ends.withColumnRenamed("earliest_offset", "start_offset"), until=half)
    R.batch_writer(f"{base}/data")(first, 0)
    ST.offset_ranges(spark.read.parquet(f"{base}/data/batch_id=0")).write.parquet(f"{base}/ledger")
    saved = ST.resume_positions(spark.read.parquet(f"{base}/ledger"), ends.select("topic", "partition", "earliest_offset"))
    saved = saved.where("start_offset >= 0")  # a partition that the first run had no row of starts anew
    R.batch_writer(f"{base}/data")(R.read_from(log, saved, unsaved="earliest"), 1)
    schema = T.StructType([log.schema[c] for c in place])
    return (R.read_batches(spark, f"{base}/data", schema).groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("offsets"), F.count_if(F.col("batch_id") == 0).alias("first_run"),
                 F.min(F.when(F.col("batch_id") == 1, F.col("offset"))).alias("resumed_at")))


# --- machine learning (M1-M11, S9, S11, S12, S24, A11, A12, J2) --------------------


def _points(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", ml.as_vector("embedding").alias("features"))


@register("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    pts = _points(spark, sf_dir)
    model = ml.kmeans_fit(pts, k=2, max_iter=20, seed=1)
    # Which cluster a point gets depends on the fit's random start; that it is the nearest one does not.
    return ml.nearest_center(model, pts).select("vec_id", (F.col("sq") <= F.col("least") + 1e-9).alias("nearest"),
                                                F.col("cluster").between(0, 1).alias("known_cluster"))


@register("kmeans_cost")
def q_kmeans_cost(spark, sf_dir):
    """The cost equals the summed least squared distances, and two clusters cost
    less than one (the spread about the mean)."""
    pts = _points(spark, sf_dir)
    model = ml.kmeans_fit(pts, k=2, max_iter=20, seed=1)
    least = ml.nearest_center(model, pts).agg(F.count(F.lit(1)).alias("points"), F.sum("least").alias("least"))
    spread = pts.agg(Summarizer.metrics("variance", "count").summary(F.col("features")).alias("s")).select(
        (F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda a, v: a + v) * (F.col("s.count") - 1)).alias("single"))
    costs = least.crossJoin(ml.kmeans_cost(model, pts)).crossJoin(spread)  # one row each
    return costs.select("points", (F.abs(F.col("cost") - F.col("least")) <= 1e-6 * F.col("cost")).alias("is_least"),
                        (F.col("cost") < F.col("single")).alias("below_one_cluster"))


@register("model_round_trip")
def q_model_round_trip(spark, sf_dir):
    from pyspark.ml.clustering import KMeansModel

    pts = _points(spark, sf_dir)
    path = scratch_path(spark, "kmeans_model")
    model = ml.kmeans_fit(pts, k=2, max_iter=20, seed=1)
    model.write().overwrite().save(path)
    both = KMeansModel.load(path).setPredictionCol("reloaded").transform(model.transform(pts))
    return both.agg(F.count(F.lit(1)).alias("vectors"),
                    F.count(F.when(F.col("cluster") != F.col("reloaded"), 1)).alias("mismatches"))


def _doc_points(spark, sf_dir):
    """Labelled documents with whole-text features: length, line count and the
    shares of upper-case, digit and non-letter characters (JVM built-ins)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    t = F.col("text")
    n = F.greatest(F.length(t), F.lit(1)).cast("double")

    def share(pattern):
        return F.length(F.regexp_replace(t, pattern, "")).cast("double") / n

    feats = F.array(F.col("n_chars").cast("double"), F.size(F.split(t, "\n")).cast("double"),
                    share("[^A-Z]"), share("[^0-9]"), share("[a-zA-Z ]"))
    points = docs.select("doc_id", feats.alias("x"))  # five numbers a document; the text stays at the scan
    return (labels.join(points, "doc_id")
            .select("doc_id", F.col("quality").cast("double").alias("label"), ml.as_vector("x").alias("features")))


@register("tree_error")
def q_tree_error(spark, sf_dir):
    """Test rows, how many are labelled 1, and whether the tree errs less often
    than calling every row by the commoner label."""
    points = materialize(_doc_points(spark, sf_dir), "tree_points")   # the fit scans it once per level
    train, test = ml.hash_split(points, ["doc_id"], 7)
    model = ml.tree_fit(train, max_depth=5, max_bins=32, impurity="gini")
    predicted = model.transform(test)
    counts = test.agg(F.sum("label").cast("bigint").alias("positives"))
    rare = F.least(F.col("positives") / F.col("rows"), 1 - F.col("positives") / F.col("rows"))
    return (ml.error_rate(predicted).crossJoin(counts)
            .select("rows", "positives", (F.col("error_rate") <= rare).alias("beats_majority")))


def _ratings(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.sum("l_quantity").alias("rating")))


@register("als_fit_score")
def q_als_fit_score(spark, sf_dir):
    """Pairs scored, and whether the factors' squared error is below that of the
    mean rating."""
    ratings = materialize(_ratings(spark, sf_dir), "ratings")
    indexed = materialize(ml.with_int_ids(ratings), "ratings_indexed")   # read by fit and scoring
    model = ml.als_fit(indexed, rank=50, max_iter=10, reg=0.01, seed=0, user="user_id", item="item_id")
    predicted = model.transform(indexed).select("user", "item", "prediction")
    scored = ml.score_against(ratings, predicted)
    spread = ratings.agg(F.var_pop("rating").alias("spread"))
    return (ml.mse(scored, "rating", "prediction").crossJoin(spread)
            .select("rows", (F.col("mse") < F.col("spread")).alias("below_spread")))


@register("frequent_itemsets")
def q_frequent_itemsets(spark, sf_dir):
    fi = ml.frequent_itemsets(derived.baskets(spark, sf_dir), 0.01)
    return fi.select(F.array_join(F.array_sort("items"), " ").alias("items"),
                     F.col("freq").alias("freq"))


def _price_points(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_extendedprice").alias("label"), "l_quantity",
                     ml.as_vector(F.array("l_quantity")).alias("features"))


@register("linreg_fit")
def q_linreg_fit(spark, sf_dir):
    model = ml.linreg_fit(_price_points(spark, sf_dir))
    coef = float(model.coefficients[0])
    return spark.range(1).select(F.round(F.lit(coef), 4).alias("coefficient"))


@register("mse_eval")
def q_mse_eval(spark, sf_dir):
    pts = _price_points(spark, sf_dir)
    model = ml.linreg_fit(pts)
    return ml.mse(model.transform(pts), "label", "prediction").select(
        "rows", F.round("mse", 1).alias("mse"))


@register("linreg_sgd")
def q_linreg_sgd(spark, sf_dir):
    w = ml.linreg_gd(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice",
                     iters=100, step=1e-8)
    return spark.range(1).select(F.round(F.lit(w), 9).alias("coefficient"))


# --- round trips through sinks (S17, S18) ---------------------------------------------


@register("table_round_trip")
def q_table_round_trip(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    path = scratch_path(spark, "kestrel_nation")
    name = path.rpartition("/")[2].replace("-", "_")  # a name of its own: runs do not meet
    return writers.replace_table(spark, name, nation, path=path)


@register("text_round_trip")
def q_text_round_trip(spark, sf_dir):
    counts = text.word_count(text.document_lines(table(spark, sf_dir, "documents").select("text")))
    path = scratch_path(spark, "word_count_text")
    writers.write_text(text.word_count_lines_text(counts), path)
    return text.parse_word_count_lines(readers.read_text(spark, path))


# --- file forms of the sources: written as text, read back (S2, S3, S5-S12) -----------
@register("json_file_filter")
def q_json_file_filter(spark, sf_dir):
    path = scratch_path(spark, "props_json")
    _event_props(spark, sf_dir).write.json(path)
    return readers.read_json(spark, path).where(F.col("k") > 21).select("event_id", "user_id", "k")


@register("json_file_average")
def q_json_file_average(spark, sf_dir):
    path = scratch_path(spark, "employees_json")
    c = table(spark, sf_dir, "customer")
    c.select(F.col("c_name").alias("name"), F.col("c_acctbal").cast("bigint").alias("salary")).write.json(path)
    return readers.read_json(spark, path, schemas.EMPLOYEE).agg(F.round(A.average("salary"), 6).alias("average_salary"))


@register("csv_file_sales")
def q_csv_file_sales(spark, sf_dir):
    frames = []
    for df, schema in zip(derived.stock_tables(spark, sf_dir), (schemas.STOCK, schemas.STOCK_DETAIL, schemas.DATE_DIM)):
        path = scratch_path(spark, "stock_csv")
        df.select(*schema.names).write.csv(path)
        frames.append(readers.read_delimited(spark, path, schema))
    return sales.yearly_sales(*frames)


@register("tab_file_graph")
def q_tab_file_graph(spark, sf_dir):
    """Tab-separated vertex and edge lists, then messages along the edges."""
    g = _g(spark, sf_dir)
    v, e = scratch_path(spark, "vertices_tab"), scratch_path(spark, "edges_tab")
    g.vertices.select(*schemas.VERTEX.names).write.option("sep", "\t").csv(v)
    g.edges.select(*schemas.EDGE.names).write.option("sep", "\t").csv(e)
    read = G.PropertyGraph(readers.read_delimited(spark, v, schemas.VERTEX, sep="\t"),
                           readers.read_delimited(spark, e, schemas.EDGE, sep="\t"))
    return G.aggregate_messages(read, lambda t: t["src_age"], {"msgs": F.count, "age_sum": F.sum}, sides=("src",))


@register("vector_file_norm")
def q_vector_file_norm(spark, sf_dir):
    path = scratch_path(spark, "vectors_text")
    e = table(spark, sf_dir, "embeddings")
    line = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), " ")
    writers.write_text(e.select(line.alias("value")), path)
    return (readers.parse_vector(readers.read_text(spark, path))
            .select(F.size(vector_to_array("features")).alias("dims"),
                    F.aggregate(vector_to_array("features"), F.lit(0.0), lambda acc, v: acc + v * v).alias("sq"))
            .groupBy("dims").agg(F.count(F.lit(1)).alias("vectors"), F.round(F.sum("sq"), 4).alias("sq_norm")))


@register("rating_file_average")
def q_rating_file_average(spark, sf_dir):
    path = scratch_path(spark, "ratings_csv")
    _ratings(spark, sf_dir).select(*schemas.RATING.names).write.csv(path)
    read = readers.read_delimited(spark, path, schemas.RATING)
    return read.groupBy("user").agg(F.count(F.lit(1)).alias("items"), F.round(F.sum("rating"), 4).alias("total"))


@register("basket_file_itemsets")
def q_basket_file_itemsets(spark, sf_dir):
    path = scratch_path(spark, "baskets_text")
    writers.write_text(derived.baskets(spark, sf_dir).select(F.array_join("items", " ").alias("value")), path)
    fi = ml.frequent_itemsets(readers.parse_basket(readers.read_text(spark, path)), 0.05)
    return fi.select(F.array_join(F.array_sort("items"), " ").alias("items"), "freq")


@register("libsvm_file_labels")
def q_libsvm_file_labels(spark, sf_dir):
    """Labelled points as LibSVM text: rows and summed first feature per label."""
    path = scratch_path(spark, "points_libsvm")
    li = table(spark, sf_dir, "lineitem")
    label = F.when(F.col("l_returnflag") == "R", F.lit("1")).otherwise(F.lit("0"))
    line = F.concat(label, F.lit(" 1:"), F.col("l_quantity").cast("string"), F.lit(" 2:"), F.col("l_extendedprice").cast("string"))
    writers.write_text(li.select(line.alias("value")), path)
    points = readers.read_libsvm(spark, path, num_features=2)
    return (points.groupBy(F.col("label").cast("int").alias("label"))
            .agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum(vector_to_array("features")[0]), 2).alias("quantity")))


FLAGSHIP = "star_sales"
