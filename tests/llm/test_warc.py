import gzip
import hashlib
import random

import pyarrow.fs as pafs

from kestrel.llm import warc
from kestrel.llm.common import importable, scratch_path

SCHEMA = "page_id long, url string, html string, digest string, record string, first long"


def pages(spark, rows):
    importable(spark)
    return spark.createDataFrame([(i, u, h, "x", "y", 1) for i, u, h in rows], SCHEMA).repartition(4)


def brute(rows, least=100):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= least and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        f = first.get(p)
        revisit = f is not None and i is not None and i != f
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/\r\nb", "x" * 200), (2, None, "x" * 200), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
        (None, "u", "x" * 200), (7, "u", "é\r\n\r\nWARC/1.1\r\n" * 30), (8, "u", "é\r\n\r\nWARC/1.1\r\n" * 30),
        (9, "u", "y" * 3_000_000), (1, "again", "x" * 200), (10, "u", "z" * 99), (11, "u", "z" * 99), (12, "u", "z" * 100),
        (0, "u", "z" * 100)]


def test_round_trip_matches_brute_force(spark):
    back = warc.archive(spark, pages(spark, ROWS))
    got = [tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == brute(ROWS)
    payloads = {r["page_id"]: r["payload"] for r in back.collect() if r["record_type"] == "response" and r["page_id"] != 1}
    assert bytes(payloads[9]) == b"y" * 3_000_000 and bytes(payloads[7]).startswith("é\r\n".encode())


def test_empty_table(spark):
    assert warc.archive(spark, pages(spark, [])).count() == 0


def test_archive_is_monolithic_before_and_one_member_per_record_after(spark):
    folder, out = scratch_path(spark, "warc-test"), scratch_path(spark, "warc-test-out")
    warc.write_monolithic(warc.records(pages(spark, ROWS)).coalesce(1), folder)
    done = warc.normalise(spark, folder, out).collect()
    assert sum(r["records"] for r in done) == len(ROWS)
    system = pafs.LocalFileSystem()
    raw = system.open_input_file(done[0]["archive"]).read()
    index = warc.read_index(spark, out).orderBy("offset").collect()
    assert [r["offset"] for r in index] == [sum(x["length"] for x in index[:k]) for k in range(len(index))]
    for r in index:
        record = gzip.decompress(raw[r["offset"]:r["offset"] + r["length"]])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert r["headers"]["WARC-Type"] in ("response", "revisit")
    assert gzip.decompress(raw).count(b"WARC-Record-ID") == len(ROWS)


def test_records_split_at_any_piece_size():
    rng = random.Random(4)
    raw = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, b"\r\n\r\n"[:4] * 0 + b"a" * n)
                   for n in (0, 1, 500, 3))
    for _ in range(20):
        at = sorted(rng.sample(range(len(raw)), 6))
        pieces = [raw[a:b] for a, b in zip([0, *at], [*at, len(raw)])]
        found = list(warc.split_records(iter(pieces)))
        assert b"".join(r for _, r in found) == raw and [int(h["Content-Length"]) for h, _ in found] == [0, 1, 500, 3]
