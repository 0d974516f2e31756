"""WARC archives with revisit records.

One pass reads each page's digest and length into a table in the shared folder; a shuffle of these headers by digest finds the
smallest page of each payload, and a join gives every other page the response that it revisits. Payloads are shuffled once, by
page, to meet their record type, and Spark's text writer puts the records into archive files: a record is header and payload,
and the line separator is the blank-line pair that closes a record, so that the files are plain WARC. Archives are written
to the shared folder and read back record by record, by content length; revisit records are then joined to their responses to
have the full payload's length again.

An archive begins with a warcinfo record; all records carry the date of the writing. It has about ARCHIVE_BYTES of payload: the number of its records goes by the mean length, and records so long that
they could make it SLACK times as large go to archives of their own with fewer records. Spark's writer compresses a file as a
whole, so an archive is one gzip member and not one for each record, and is read from its start.

Defined cases: null html is an empty payload. With payloads shorter than `least_bytes` all records are responses. Rows
that repeat a page_id with the payload of the smallest page_id are responses too. A null page_id revisits any response
with a page_id, and is a response if no other row has the payload. Characters of a url that would end a header line
are percent-encoded, and so are those of a page_id, which may have any type that text can be cast to. Columns other than
page_id, url and html are not read.
"""

from __future__ import annotations

import datetime as dt
import gzip
import io
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, stored, table

END = "\r\n\r\n"
#: Payload bytes of an archive: what it should have, and how many times as much it may have.
ARCHIVE_BYTES = 32 << 20
SLACK = 4


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of SHA-1: each 5 hexadecimal digits are 4 digits of base 32."""
    hexa = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexa, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def headers(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, bytes, digest)."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"), base32_sha1(payload.cast("binary")).alias("digest"))


def revisits(heads: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page, of_digest, refers_to) for each (page_id, digest, bytes) that is to revisit a smaller page of equal payload."""
    slim = heads.select("page_id", "digest", "bytes").where(F.col("bytes") >= least_bytes)
    # a table, so that the join deals out both sides for itself and Spark can split a payload that very many pages have
    first = stored(slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col("refers_to").isNotNull()).select("digest", "refers_to"))
    return slim.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(F.col("page_id").alias("page"), F.col("digest").alias("of_digest"), "refers_to").distinct()


def record(page_id: Column, url: Column, payload: Column, digest: Column, refers_to: Column, date: str) -> Column:
    """One WARC record without its closing blank lines."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    name = lambda id_: F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(id_.cast("string")), F.lit("")), F.lit(">"))
    uri = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    is_revisit = refers_to.isNotNull()
    block = F.when(is_revisit, F.lit("")).otherwise(payload)
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(page_id)), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(is_revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", name(refers_to)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    )


def _with_info(records: DataFrame, most: int, date: str) -> DataFrame:
    """`records` (value) of each task with a warcinfo record before every `most` - 1 of them: files of `most` rows begin with one."""
    at = F.monotonically_increasing_id()
    placed = records.withColumns({"task": F.shiftright(at, 33), "k": at.bitwiseAND(F.lit((1 << 33) - 1))})
    block = "software: helixframe\r\nformat: WARC File Format 1.1\r\n"
    number = F.concat_ws("-", F.col("task").cast("string"), F.floor(F.col("k") / (most - 1)).cast("string"))
    info = F.concat(F.lit("WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:archive:"), number, F.lit(f">\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n{block}"))
    return placed.select(F.explode(F.when(F.col("k") % (most - 1) == 0, F.array(info, "value")).otherwise(F.array("value"))).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> None:
    """Writes `pages` as gzipped archives in which each payload stands once. `date` (UTC, as in WARC-Date) is that of all records; now, if not given."""
    date = date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    heads = headers(pages)
    slim = stored(heads.select("page_id", "digest", "bytes"))
    size = slim.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")).first()
    records = max(1, min(16_384, archive_bytes // max(1, (size["bytes"] or 0) // max(1, size["n"]))))
    long = SLACK * archive_bytes // records
    again = revisits(slim, least_bytes)
    both = heads.join(again, F.col("page_id").eqNullSafe(F.col("page")) & (F.col("digest") == F.col("of_digest")), "left")
    parts = [(F.col("bytes") <= long, records)]
    if (size["most"] or 0) > long:
        parts.append((F.col("bytes") > long, max(1, SLACK * archive_bytes // size["most"])))
    for of, most in parts:
        rows = both.where(of).select(record(F.col("page_id"), F.col("url"), F.col("payload"), F.col("digest"), F.col("refers_to"), date).alias("value"))
        _with_info(rows, most + 1, date).write.mode("append").option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", most + 1).text(path)


def parse_archive(stream: BinaryIO) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Header fields by lower-case name, and the block, of each record of an archive, one at a time."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where {line[:20]!r} stands")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields[b"content-length"]))
        stream.read(len(END))


def read_archives(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """(page_id, url, record_type, refers_to, digest, block) of all records; ids are null where a record has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "refers_to", "digest", "block"]
        text = lambda v: unquote_plus(v[10:-1].decode()) if v and v[10:-1] else None
        for batch in batches:
            for content in batch.column(0):
                data = io.BytesIO(content.as_buffer())
                zipped = data.getbuffer()[:2] == b"\x1f\x8b"
                rows, size = [], 0
                for f, block in parse_archive(io.BufferedReader(gzip.GzipFile(fileobj=data)) if zipped else data):
                    if f[b"warc-type"] == b"warcinfo":
                        continue
                    rows.append((text(f[b"warc-record-id"]), f.get(b"warc-target-uri", b"").decode(), f[b"warc-type"].decode(), text(f.get(b"warc-refers-to")), f[b"warc-payload-digest"].decode().partition(":")[2], block))
                    size += len(block)
                    if size > 8_000_000 or len(rows) >= 5_000:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    found = files.mapInArrow(run, "page_id string, url string, record_type string, refers_to string, digest string, block binary")
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def resolve(records: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to): revisits joined to their responses."""
    slim = records.select("page_id", "url", "record_type", "refers_to", "digest", F.octet_length("block").cast("long").alias("bytes"))
    own = slim.where(F.col("record_type") == "response")
    full = stored(own.where(F.col("page_id").isNotNull()).groupBy(F.col("page_id").alias("of"), F.col("digest").alias("of_digest")).agg(F.max("bytes").alias("of_bytes")))
    again = slim.where(F.col("record_type") == "revisit").join(full, (F.col("refers_to") == F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    shape = lambda df, n: df.select("page_id", "url", n.alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    return shape(own, F.col("bytes")).unionByName(shape(again, F.col("of_bytes")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pages = new_folder(spark, "warc"), table(spark, sf_dir, "pages")
    write_archives(pages, path)
    return resolve(read_archives(spark, path, pages.schema["page_id"].dataType.simpleString())).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
