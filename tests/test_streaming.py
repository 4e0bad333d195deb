import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.text import split_on_space
from kestrel.streaming import runners as R
from kestrel.streaming import transforms as ST

LINE_SCHEMA = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("line", T.StringType())])
LINES = [(dt.datetime(2024, 1, 1, 0, 0, 1), "a b a"), (dt.datetime(2024, 1, 1, 0, 0, 4), "a"),
         (dt.datetime(2024, 1, 1, 0, 0, 8), "b ")]


def _write_files(spark, folder, rows_per_file, schema):
    for i, rows in enumerate(rows_per_file):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/f{i:03d}")
    return folder


def _stream(spark, folder, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


def test_running_totals_and_per_batch(spark, tmp_path):
    src = _write_files(spark, str(tmp_path / "in"), [[r] for r in LINES], LINE_SCHEMA)
    counts = ST.word_counts(_stream(spark, src, LINE_SCHEMA), "line")
    data = R.run_to_folder(spark, counts, "t", output_mode="update", out=str(tmp_path / "out"))
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    final = R.latest_per_key(R.read_batches(spark, data, schema), ["word"], ["n"])
    assert {r["word"]: r["n"] for r in final.collect()} == {"a": 3, "b": 2}
    batches = R.read_batches(spark, data, schema).select("batch_id").distinct().count()
    assert batches == 3


def test_sliding_window_counts(spark, tmp_path):
    src = _write_files(spark, str(tmp_path / "in"), [LINES], LINE_SCHEMA)
    s = ST.with_event_time(_stream(spark, src, LINE_SCHEMA), delay="10 seconds")
    w = s.select("event_time", F.explode(split_on_space(F.col("line"))).alias("word"))
    counts = ST.window_counts(w, "word", "6 seconds", "3 seconds")
    data = R.run_to_folder(spark, counts, "w", output_mode="update", out=str(tmp_path / "out"))
    schema = T.StructType([T.StructField("window_start", T.StringType()),
                           T.StructField("window_end", T.StringType()),
                           T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    final = R.latest_per_key(R.read_batches(spark, data, schema), ["window_start", "word"], ["n"])
    got = sorted((r["window_start"][11:], r["word"], r["n"]) for r in final.collect())
    assert got == sorted([("23:59:57", "a", 2), ("23:59:57", "b", 1), ("00:00:00", "a", 3),
                          ("00:00:00", "b", 1), ("00:00:03", "a", 1), ("00:00:03", "b", 1),
                          ("00:00:06", "b", 1)])
    # the batch form of the same transform gives the same counts
    batch = spark.createDataFrame(LINES, LINE_SCHEMA)
    bw = ST.with_event_time(batch, delay=None).select(
        "event_time", F.explode(split_on_space(F.col("line"))).alias("word"))
    bgot = sorted((r["window_start"][11:], r["word"], r["n"])
                  for r in ST.window_counts(bw, "word", "6 seconds", "3 seconds").collect())
    assert bgot == got


def test_relay_restart_adds_no_batch(spark, tmp_path):
    schema = T.StructType([T.StructField("value", T.StringType())])
    src = _write_files(spark, str(tmp_path / "in"), [[("x",), (None,), ("y",)]], schema)
    out = str(tmp_path / "out")
    data = R.run_to_folder(spark, ST.relay(_stream(spark, src, schema)), "r", out=out)
    first = sorted(r["value"] for r in R.read_batches(spark, data, schema).collect())
    assert first == ["relay:null", "relay:x", "relay:y"]
    R.run_to_folder(spark, ST.relay(_stream(spark, src, schema)), "r", out=out)
    assert R.read_batches(spark, data, schema).count() == 3


def test_offset_ranges_and_resume(spark):
    recs = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 3), ("u", 0, 1)],
                                 "topic string, partition int, offset bigint")
    ledger = ST.offset_ranges(recs)
    got = sorted(tuple(r) for r in ledger.collect())
    assert got == [("t", 0, 5, 10), ("t", 1, 3, 4), ("u", 0, 1, 2)]
    earliest = spark.createDataFrame([("t", 0, 7), ("t", 1, 50), ("v", 0, 4)],
                                     "topic string, partition int, earliest_offset bigint")
    pos = {(r[0], r[1]): r[2] for r in ST.resume_positions(ledger, earliest).collect()}
    assert pos == {("t", 0): 10, ("t", 1): 50, ("u", 0): 2, ("v", 0): -1}
    js = ST.starting_offsets_json(ST.resume_positions(ledger, earliest)).first()[0]
    import json
    assert json.loads(js)["t"] == {"0": 10, "1": 50}


def test_late_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    files = [[(t0 + dt.timedelta(seconds=1), "a")],
             [(t0 + dt.timedelta(minutes=10), "b")],      # advances the watermark
             [(t0 + dt.timedelta(minutes=10, seconds=1), "b")],
             [(t0 + dt.timedelta(minutes=10, seconds=2), "b")],
             [(t0 + dt.timedelta(seconds=2), "a")]]       # far behind the watermark
    src = _write_files(spark, str(tmp_path / "in"), files, LINE_SCHEMA)
    s = ST.with_event_time(_stream(spark, src, LINE_SCHEMA), delay="10 seconds")
    counts = ST.window_counts(s.withColumnRenamed("line", "word"), "word", "6 seconds")
    data = R.run_to_folder(spark, counts, "late", output_mode="update", out=str(tmp_path / "out"))
    schema = T.StructType([T.StructField("window_start", T.StringType()),
                           T.StructField("window_end", T.StringType()),
                           T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    final = R.latest_per_key(R.read_batches(spark, data, schema), ["window_start", "word"], ["n"])
    got = {(r["window_start"][11:], r["word"]): r["n"] for r in final.collect()}
    assert got[("00:00:00", "a")] == 1          # the late "a" is not counted
    assert got[("00:10:00", "b")] == 3


def test_replayed_batch_overwrites_its_own_output(spark, tmp_path):
    schema = T.StructType([T.StructField("value", T.StringType())])
    write = R.batch_writer(str(tmp_path / "data"))
    batch = spark.createDataFrame([("x",), ("y",)], schema)
    write(batch, 0)
    write(batch, 0)          # the same batch again after a failure
    write(batch.limit(1), 1)
    got = R.read_batches(spark, str(tmp_path / "data"), schema)
    assert got.count() == 3
    assert sorted(r[0] for r in got.select("batch_id").distinct().collect()) == [0, 1]


def _stored(spark, folder, name, df, files):
    df.repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_replay_of_a_folder_table_loses_no_row(spark, tmp_path):
    """Many unordered part files, several batches, every row counted."""
    from kestrel.plans import queries as Q
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    folder = _stored(spark, tmp_path, "events", events, 7)
    _stored(spark, tmp_path, "conversations", conv, 5)
    for key in ("tumbling_counts", "sliding_counts", "stream_word_count", "running_totals", "stream_relay",
                "offset_ledger", "offset_resume"):
        a = sorted(map(tuple, Q.QUERIES[key](spark, folder).collect()))
        b = sorted(map(tuple, Q.QUERIES[key](spark, "/root/testdata/sf0.001").collect()))
        assert a == b, key
    assert sum(r["n"] for r in Q.QUERIES["tumbling_counts"](spark, folder).collect()) == events.count()


def test_a_single_file_is_replayed_in_several_batches(spark, tmp_path):
    stream = R.table_stream(spark, "/root/testdata/sf0.001", "events", ["event_id"], batches=3)
    data = R.run_to_folder(spark, stream, "replay", out=str(tmp_path / "out"))
    got = R.read_batches(spark, data, T.StructType([T.StructField("event_id", T.LongType())]))
    assert got.select("batch_id").distinct().count() == 3 and got.count() == 1000
