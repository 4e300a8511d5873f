"""WARC archives with resolved revisits, written and read by Spark jobs.

Headers (payload digest, length, id) are shuffled by digest and length and joined to the first
response of their payload. Only the revisits among them go on to the records, which move once.
Records are written with fresh headers: responses with their payload, revisits with a reference
instead.

A WARC record of a text payload is text: header lines, an empty line, the payload, two line
breaks. Spark's text writer with that double line break as separator therefore writes valid
archives, with its own commit protocol, into any store it can reach. Archives are read back as
whole files, whose size the writer bounds by dealing rows out by payload bytes, and are parsed
by Content-Length, so payloads may hold anything, line breaks and record headers included.

Defined cases: a null payload is empty; a null url is empty and line breaks in one become spaces;
a null id makes a response without a number; rows that repeat an id and a payload are responses
all; an empty table writes no record; extra columns are not archived.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import lean

FILE_BYTES = 16 << 20
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = "1970-01-01T00:00:00Z"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text, from its hexadecimal form: five hexadecimal
    digits are four base32 digits."""
    hexed = F.sha1(F.encode(payload, "UTF-8"))
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digits = []
    for group in range(8):
        number = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            digits.append(F.substring(alphabet, place, F.lit(1)))
    return F.concat(*digits)


_KEY = ["page_id", "payload_digest", "payload_bytes"]


def _rows_of(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) with length and digest of the payload."""
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long"))
    return rows.withColumn("payload_digest", sha1_base32(F.col("html")))


def resolve(pages: DataFrame, min_bytes: int = 0, parts: int | None = None) -> DataFrame:
    """(page_id, url, html) with ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to``: of equal payloads of at least ``min_bytes`` bytes the least id is the
    response.

    Headers alone are grouped and joined; payloads move once, when each meets its reference,
    dealt by id into ``parts`` partitions.
    """
    rows = _rows_of(pages)
    headers = rows.select(*_KEY).filter(F.col("page_id").isNotNull()).distinct()
    headers = headers.filter(F.col("payload_bytes") >= min_bytes)
    payload = ["payload_digest", "payload_bytes"]
    first = headers.groupBy(*payload).agg(F.min("page_id").alias("refers_to"))
    again = headers.join(first, payload).filter("page_id > refers_to")
    if parts:
        rows = rows.repartition(parts, *_KEY)
    joined = rows.join(again.select(*_KEY, "refers_to"), _KEY, "left")
    kind = F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    return joined.select(*rows.columns, kind.alias("record_type"), "refers_to")


def _record(resolved: DataFrame) -> Column:
    """One archive record without the double line break that ends it."""
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    record_id = F.concat(F.lit("<urn:page:"), number, F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, "").otherwise(F.col("html"))
    # Line breaks cannot stand in a header.
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {_EPOCH}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes")),
        F.when(revisit, f"WARC-Profile: {PROFILE}"),
        F.when(
            revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to"), F.lit(">"))
        ),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body)),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body)


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES
) -> None:
    """Writes the records of ``pages`` (page_id, url, html) as archives of about
    ``file_bytes`` bytes of payload each below ``path``."""
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    resolved = resolve(pages, min_bytes, int(files))
    records = resolved.select(_record(resolved).alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


_READ = (
    "page_id long, url string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, body binary"
)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        stop = archive.index(b"\r\n\r\n", at)
        head = archive[at:stop].decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in head[1:])
        begin = stop + 4
        end = begin + int(fields["Content-Length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is longer than it says")
        yield fields, archive[begin:end]
        at = end + 4


def _number(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def _parse(with_body: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer().to_pybytes()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows = []
                for fields, body in parse(data):
                    rows.append(
                        (
                            _number(fields["WARC-Record-ID"]),
                            fields["WARC-Target-URI"],
                            fields["WARC-Type"],
                            fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            int(fields["X-Payload-Length"]),
                            _number(fields.get("WARC-Refers-To")),
                            body if with_body else None,
                        )
                    )
                    if len(rows) == 1000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    return run


_READ_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("refers_to", pa.int64()),
        ("body", pa.binary()),
    ]
)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_READ_ARROW)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _READ_ARROW)]
    return pa.RecordBatch.from_arrays(arrays, schema=_READ_ARROW)


def read_archives(spark: SparkSession, path: str, with_body: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lean(_parse(with_body)), _READ)
