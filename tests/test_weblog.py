from pyspark.sql import functions as F

from kestrel.functions import weblog as W
from kestrel.operators import weblog

LINES = [
    '100.79.121.48 HIT 33 [15/Feb/2017:00:00:46 +0800] "GET http://x/videojs/video.mp4 HTTP/1.1" 200 174055 "http://t.com/" "M"',
    '1.2.3.256 HIT 3 [15/Feb/2017:01:02:46 +0800] "GET http://x/141081.mp4 HTTP/1.1" 206 1048576 "-" "M"',
    'noip 404 7',
    '5.5.5.5 HIT 3 [15/Feb/2017:01:09:00 +0800] "GET http://x/141081.mp4 HTTP/1.1" 404 100 "-" "M"',
    '5.5.5.5 HIT 3 [15/Feb/2018:02:09:00 +0800] "GET http://x/141081.mp4 HTTP/1.1" 200 100 "-" "M"',
    '6.6.6.6 HIT 3 [15/Feb/2017:01:09:00 +0800] "GET http://x/2.mp4 HTTP/1.1" 200 99999999999999999999 "-" "M"',
]


def _lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_field_extraction(spark):
    v = F.col("value")
    got = _lines(spark).select(W.extract_ip(v), W.extract_video(v), W.extract_hour(v),
                               F.when(W.has_status_and_size(v), W.extract_size(v))).collect()
    assert tuple(got[0]) == ("100.79.121.48", "", "00", 174055)
    assert tuple(got[1]) == ("1.2.3.25", "141081.mp4", "01", 1048576)
    assert tuple(got[2]) == (None, "", None, None)
    assert got[4][2] is None            # 2018 line: no hour for year 2017
    assert got[5][3] is None            # 20-digit size does not fit a bigint


def test_ip_hits_and_unique(spark):
    df = _lines(spark)
    top = [tuple(r) for r in weblog.ip_hits(df, 2).collect()]
    assert top == [("5.5.5.5", 2), ("1.2.3.25", 1)]
    assert weblog.unique_ips(df).first()[0] == 4
    assert weblog.unresolved_lines(df).first()[0] == 1


def test_video_ips(spark):
    got = {r["video"]: r["ips"] for r in weblog.video_ips(_lines(spark)).collect()}
    assert got == {"141081.mp4": 2, "2.mp4": 1}


def test_hour_flow_drops_unparsed(spark):
    df = _lines(spark)
    got = [tuple(r) for r in weblog.hour_flow(df).collect()]
    assert got == [("00", 174055, 0, 1), ("01", 1048576, 0, 1)]
    assert weblog.unparsed_flow_lines(df).first()[0] == 2
    assert [r[0] for r in weblog.hour_flow(df, year="2018").collect()] == ["02"]
