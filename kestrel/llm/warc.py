"""WARC archives: a monolithic gzip normaliser with a sidecar offset index.

1. Records. Every page becomes a ``response`` record (HTTP header and html), or a
   ``revisit`` of the page of smallest id with the same payload when the payload
   has at least ``least`` bytes. Copies are found on digests alone (partial
   aggregation, then a join dealt over salts), so a payload shared by a third of
   the pages is spread over tasks.
2. Archives. Spark's text writer with the record terminator as line separator
   writes each partition as one gzip stream: a valid but monolithic ``.warc.gz``,
   which can only be read from its start.
3. Normaliser. A task inflates each whole-file stream once, piece by piece,
   rewrites every record as a gzip member of its own, and writes beside the new
   archive a sidecar index (offset, length and headers of each member).
4. Reading. The sidecars are a table; any record is read by seeking to its offset
   and inflating its member alone. Digests are checked against the payload.

Defined results: null html is the empty payload (never a revisit at least > 0);
a null id is written as a response and refers to nothing; repeated rows give a
record each (rows of the smallest id stay responses); null urls leave the target
header out and line breaks in urls are percent-encoded; an empty table gives no
archive; other columns are not read."""

from __future__ import annotations

import hashlib
import json
import posixpath
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, scratch_path
from kestrel.llm.files import reading, streaming, writing

END = b"\r\n\r\n"
SALTS = 16
PIECE = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records(pages: DataFrame, least: int = 100, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(record): header and block of each page's WARC record, without the final
    empty lines."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html")).select(
        "*", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("bytes"))
    copies = (rows.where(F.col("page_id").isNotNull() & (F.col("bytes") >= least)).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    copies = materialize(copies.select(F.col("digest").alias("_digest"), "first"), "copied-payloads")
    dealt = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    found = rows.withColumn("salt", salt).join(
        dealt, (F.col("digest") == F.col("_digest")) & (F.col("salt") == F.col("_salt"))
        & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first")), "left")

    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v)  # noqa: E731  null when v is null: the line is left out
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("page_id"))), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("WARC-Refers-To", F.when(revisit, name(F.col("first")))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", size.cast("string")))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    return found.select(F.concat(head, F.lit("\r\n\r\n"), block).alias("record"))


def write_monolithic(rows: DataFrame, folder: str) -> None:
    """One gzip stream a partition; the line separator is the record terminator."""
    rows.select("record").write.option("compression", "gzip").option("lineSep", END.decode()).text(folder)


def inflated(path: str) -> Iterator[bytes]:
    """The raw pieces of a gzip file of any number of members."""
    with streaming(path) as file:
        inflate, rest = zlib.decompressobj(31), b""
        while True:
            raw = rest or file.read(PIECE)
            if not raw:
                break
            yield inflate.decompress(raw)
            rest = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record with its final empty lines) of each WARC record."""
    held = bytearray()

    def need(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while need(1):
        while (stop := held.find(END)) < 0:
            if not need(len(held) + 1):
                raise ValueError("a record's header has no end")
        lines = held[:stop].decode("utf-8", "surrogateescape").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = stop + len(END) + int(headers["Content-Length"]) + len(END)
        if not need(size) or held[size - len(END):size] != END:
            raise ValueError("a record is cut short")
        yield headers, bytes(held[:size])
        del held[:size]


def normalise_file(path: str, out_path: str, level: int = 6) -> int:
    """Rewrite one archive with a member per record; writes ``out_path`` and its
    sidecar ``out_path``.idx (JSON lines). Returns the number of records."""
    count = at = 0
    with writing(out_path) as out, writing(out_path + ".idx") as index:
        for headers, raw in split_records(inflated(path)):
            pack = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = pack.compress(raw) + pack.flush()
            out.write(member)
            index.write(json.dumps({"offset": at, "length": len(member), "archive": out_path, "headers": headers}).encode() + b"\n")
            at += len(member)
            count += 1
    return count


def normalise(spark: SparkSession, folder: str, out_folder: str) -> DataFrame:
    """Normalise every archive under ``folder``; (archive, records)."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    names = materialize(names, "archives")
    count = max(1, names.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                base = posixpath.basename(path).split(".")[0]
                out = f"{out_folder}/{base}.warc.gz"
                yield pa.RecordBatch.from_pydict({"archive": [out], "records": [normalise_file(path, out)]})

    done = names.repartition(min(count, 1 << 16)).mapInArrow(run, "archive string, records bigint")
    return materialize(done, "normalised")


INDEX = "offset bigint, length bigint, archive string, headers map<string,string>"


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar rows of every archive under ``folder``."""
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(folder)


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload)
    of the index rows, each read from its own member. A revisit has no payload of
    its own; its digest and size are those its headers give."""

    def page(name: str | None) -> int | None:
        name = (name or "")[len("<urn:page:"):-1]
        return int(name) if name.lstrip("-").isdigit() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = name = None
        out, size = [], 0
        for b in batches:
            for path, offset, length in zip(*(b.column(k).to_pylist() for k in range(3))):
                if path != name:
                    if file is not None:
                        file.close()
                    name, file = path, reading(path)
                raw = zlib.decompress(file.read_at(length, offset), 31)
                out.append(parsed(raw, f"{path} at {offset}"))
                size += len(raw)
                if size > 1 << 23 or len(out) > 4096:
                    yield rows_of(out)
                    out, size = [], 0
        if out:
            yield rows_of(out)
        if file is not None:
            file.close()

    def parsed(raw: bytes, where: str) -> tuple:
        headers, record = next(split_records(iter([raw])))
        http, _, payload = record[record.index(END) + len(END):-len(END)].partition(END)
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
        response = headers["WARC-Type"] == "response"
        if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"{where}: the payload does not match its digest")
        return (page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"],
                page(headers.get("WARC-Refers-To")), digest, size, payload if response else None)

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    members = index.select("archive", "offset", "length")
    return members.mapInArrow(run, "page_id bigint, url string, record_type string, refers_to bigint, "
                                 "payload_digest string, payload_bytes bigint, payload binary")


def archive(spark: SparkSession, pages: DataFrame, least: int = 100) -> DataFrame:
    """Write ``pages`` as archives, normalise them, and read all records back."""
    folder, out = scratch_path(spark, "warc-stream"), scratch_path(spark, "warc")
    write_monolithic(records(pages, least), folder)
    written = normalise(spark, folder, out)
    if written.isEmpty():
        return read_records(written.select(F.lit(0).alias("offset"), F.lit(0).alias("length"), "archive"))
    return read_records(read_index(spark, out))
