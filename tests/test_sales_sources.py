import json
import os

from pyspark.sql import functions as F

from kestrel.operators import sales, text
from kestrel.sources import readers, schemas, writers


def test_yearly_sales_fixture(spark):
    stock = spark.createDataFrame([("o1", "L1", "d1"), ("o2", "L1", "d1"), ("o3", "L2", "d2"),
                                   ("o4", "L2", "d9"), ("o5", "L3", "d2")], schemas.STOCK)
    detail = spark.createDataFrame([("o1", 1, "i1", 1, 2.0, 10.0), ("o1", 2, "i2", 1, 2.0, 5.0),
                                    ("o1", 3, "i3", 1, 2.0, 1.0), ("o2", 1, "i1", 1, 2.0, 4.0),
                                    ("o3", 1, "i1", 1, 2.0, 7.5), ("o4", 1, "i9", 1, 2.0, 100.0)],
                                   schemas.STOCK_DETAIL)
    dates = spark.createDataFrame([("d1", 201701, 2017, 1, 1, 1, 1, 1, 1, 1),
                                   ("d2", 201801, 2018, 1, 2, 2, 1, 1, 1, 1)], schemas.DATE_DIM)
    got = [tuple(r) for r in sales.yearly_sales(stock, detail, dates).collect()]
    # o1 has three detail rows (counted once), o5 has no detail, o4 has an unknown date
    assert got == [(2017, 2, 20.0), (2018, 1, 7.5)]


def test_json_sources(spark, tmp_path):
    p = tmp_path / "people.json"
    p.write_text('{"name":"Ada"}\n{"name":"Ben", "age":44}\n{"name":"Cleo", "age":20}\n')
    people = readers.read_json(spark, str(p))
    assert [r["name"] for r in people.where(F.col("age") > 21).collect()] == ["Ben"]
    people.createOrReplaceTempView("people")
    assert [r[0] for r in spark.sql("SELECT name FROM people WHERE age > 21").collect()] == ["Ben"]
    typed = readers.read_json(spark, str(p), schemas.PEOPLE)
    assert typed.schema == schemas.PEOPLE and typed.count() == 3


def test_delimited_vector_basket_libsvm(spark, tmp_path):
    e = tmp_path / "edges.tsv"
    e.write_text(" 1\t 2 \n2\t3\n")
    edges = readers.read_delimited(spark, str(e), _schema("src bigint, dst bigint"), sep="\t")
    assert [tuple(r) for r in edges.orderBy("src").collect()] == [(1, 2), (2, 3)]
    pts = readers.parse_vector(spark.createDataFrame([("0.25 0.5 1.5",)], "value string"))
    assert list(pts.first()[0]) == [0.25, 0.5, 1.5]
    b = readers.parse_basket(spark.createDataFrame([("a b a",)], "value string"))
    assert sorted(b.first()[0]) == ["a", "b"]
    lib = tmp_path / "d.libsvm"
    lib.write_text("1 1:0.5 3:2.0\n0 2:1.0\n")
    df = readers.read_libsvm(spark, str(lib), num_features=3)
    assert [r["label"] for r in df.collect()] == [1.0, 0.0]


def _schema(ddl):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(ddl)


def test_text_sink_fails_if_exists(spark, tmp_path):
    counts = text.word_count(spark.createDataFrame([("a a",)], "value string"))
    out = str(tmp_path / "wc")
    writers.write_text(text.word_count_lines_text(counts), out)
    assert readers.read_text(spark, out).first()[0] == "(a,2)"
    try:
        writers.write_text(text.word_count_lines_text(counts), out)
        raise AssertionError("second write should fail")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)


def test_jdbc_range_append_overwrite(spark):
    # Embedded in-memory Derby lives inside this JVM only (local mode).
    url = "jdbc:derby:memory:kestrel_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    src = spark.range(20).select(F.col("id").cast("int").alias("id"),
                                 F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    writers.write_jdbc(src, url, "PEOPLE", mode="overwrite", properties=props)
    got = readers.read_jdbc_range(spark, url, "PEOPLE", "id", 1, 10, 3, props)
    assert sorted(r["ID"] if "ID" in r else r["id"] for r in got.collect()) == list(range(1, 11))
    more = spark.createDataFrame([(100, "x1"), (101, "x2"), (102, "x3")], "id int, name string")
    writers.write_jdbc(more, url, "PEOPLE", mode="append", properties=props)
    assert spark.read.jdbc(url, "PEOPLE", properties=props).count() == 23
    writers.write_jdbc(more, url, "PEOPLE", mode="overwrite", properties=props)
    assert spark.read.jdbc(url, "PEOPLE", properties=props).count() == 3


def test_replace_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    t = writers.replace_table(spark, "kestrel_t", df, path=str(tmp_path / "t"))
    assert t.count() == 1
    t = writers.replace_table(spark, "kestrel_t", df.union(df), path=str(tmp_path / "t2"))
    assert t.count() == 2
    assert json.loads(json.dumps(os.listdir(tmp_path)))


def test_text_sink_keeps_words_with_line_terminators(spark, tmp_path):
    words = ["a\rb", "x\u2028y", "p\u0085q", "back\\n slash\\", "c,1)", "", "line\nfeed", "\\\n"]
    counts = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n bigint")
    out = str(tmp_path / "odd")
    writers.write_text(text.word_count_lines_text(counts), out)
    back = text.parse_word_count_lines(readers.read_text(spark, out))
    assert sorted(map(tuple, back.collect())) == sorted((w, k + 1) for k, w in enumerate(words))


def test_large_user_ids_are_not_bad_lines(spark):
    lines = spark.createDataFrame([("1 1 0 9000000000 10",), ("1 1 0 x 10",)], "value string")
    good, bad = readers.parse_delimited(lines, schemas.AD_CLICK, " ")
    assert [r["uid"] for r in good.collect()] == [9_000_000_000] and bad.count() == 1


def test_replaced_table_may_read_itself(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    t = writers.replace_table(spark, "kestrel_self", df, path=str(tmp_path / "a"))
    t = writers.replace_table(spark, "kestrel_self", t.where("k > 1"), path=str(tmp_path / "b"))
    assert [r["k"] for r in t.collect()] == [2]
