"""Operator 11: WARC archives without repeated payloads, by revisit resolution.

Only headers (identifier, digest, length) are shuffled by payload digest. The
first record of each digest is the response, the others are joined to it and
become revisit records with fresh headers and no payload. Payloads move once,
by row, to the tasks that write them.

The archives are plain files of WARC 1.1 records under gzip, written and read
by Spark's text source with the record's closing blank lines as the line
separator: committed writers make them safe on any file system. A payload may
hold that separator itself, so the reader puts the bytes of a file together
again and cuts them by Content-Length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, staged
from tidemark.llm.spread import spread_join

#: Shorter payloads are stored again rather than referred to.
LEAST_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
_BATCH_BYTES = 8 << 20


def resolve(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The revisits among `headers` (row, page_id, url, payload_digest, payload_bytes).

    Of the records of a digest with at least `least_bytes`, the one with the
    smallest page_id (null last, then the smallest row) is the response. One row
    per other record: row, and the response's refers_row, refers_to, refers_url.
    """
    large = headers.where(F.col("payload_bytes") >= least_bytes)
    first = (large.groupBy("payload_digest")
             .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row", "url")).alias("first"),
                  F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    return (spread_join(large.select("payload_digest", "row"), first, "payload_digest", F.col("row"))
            .where("row <> first.row")
            .select("row", F.col("first.row").alias("refers_row"), F.col("first.page_id").alias("refers_to"),
                    F.col("first.url").alias("refers_url")))


def _record_id(row: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", row.cast("string"), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, nothing for null; control characters and blanks that would end or split it are percent-encoded."""
    safe = value.cast("string")
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), ("\0", "%00")):
        safe = F.replace(safe, F.lit(char), F.lit(code))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, records_per_file: int = 100_000) -> None:
    """Write a WARC record per row of `pages` (page_id, url, html) below `path`, payload the html in UTF-8.

    Null html is an empty payload; a null url or page_id leaves its header out;
    rows that repeat are records of their own, one of which is the response;
    other columns are ignored; an empty table gives archives without records.
    """
    base = staged(pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id"),
                               F.col("url").cast("string").alias("url"),
                               F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
                  .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
                  .withColumn("payload_digest", F.sha2(F.col("payload").cast("binary"), 256)), "pages", "zstd")
    revisits = resolve(base.select("row", "page_id", "url", "payload_digest", "payload_bytes"), least_bytes)
    rows = base.join(revisits, "row", "left")
    now = F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    again = F.col("refers_row").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _record_id(F.col("row"), F.col("payload_digest"))),
        _field("WARC-Date", now),
        _field("WARC-Target-URI", F.col("url")),
        _field("X-Page-Id", F.col("page_id")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        _field("WARC-Profile", F.when(again, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(again, _record_id(F.col("refers_row"), F.col("payload_digest")))),
        _field("WARC-Refers-To-Target-URI", F.col("refers_url")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    (rows.select(F.concat(header, F.lit(END), block).alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record in a stream of bytes that was split at END."""
    sep = END.encode()
    held: list[bytes] = []
    need = None  # (headers, length of the block) of the record being read
    size = 0
    for piece in pieces:
        held += [piece, sep]
        size += len(piece) + len(sep)
        while size:
            if need is None:
                data = b"".join(held).lstrip(b"\r\n")
                at = data.find(sep)
                held, size = [data], len(data)
                if at < 0:
                    break
                lines = data[:at].decode("utf-8").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record where one should start: {lines[0][:80]!r}")
                fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
                if "Content-Length" not in fields:
                    raise ValueError("a WARC record without Content-Length")
                need = fields, int(fields["Content-Length"])
                held, size = [data[at + len(sep):]], len(data) - at - len(sep)
            if size < need[1] + len(sep):
                break
            data = b"".join(held)
            yield need[0], data[:need[1]]
            held, size, need = [data[need[1]:]], len(data) - need[1], None
    if need is not None or b"".join(held).strip(b"\r\n"):
        raise ValueError("an archive ends within a record")


_FIELDS = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()),
                     ("refers_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("payload", pa.binary())])


def _reader(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=_FIELDS)

        for fields, block in parse_records(v for b in batches for v in b.column(0).to_pylist()):
            head = block.find(END.encode()) + len(END)
            payload = block[head:]
            response = fields["WARC-Type"] == "response"
            rows.append({
                "record_id": fields["WARC-Record-ID"], "record_type": fields["WARC-Type"],
                "page_id": fields.get("X-Page-Id"), "url": fields.get("WARC-Target-URI"),
                "refers_id": fields.get("WARC-Refers-To"),
                "payload_bytes": len(payload) if response else None,
                "payload_digest": hashlib.sha256(payload).hexdigest() if response
                else re.sub("^sha256:", "", fields["WARC-Payload-Digest"]),
                "payload": payload if response and payloads else None})
            held += len(payload) if payloads else 0
            if len(rows) >= 512 or held >= _BATCH_BYTES:
                yield out()
                rows, held = [], 0
        if rows:
            yield out()
    return read


def read_archives(spark: SparkSession, path: str, payloads: bool = False, id_type: str = "long") -> DataFrame:
    """The records of the archives below `path`: record_id, record_type, page_id, url, refers_id,
    payload_bytes and payload_digest (both taken from the payload itself for responses; revisits
    have no length and the digest of their header), payload (null unless `payloads`)."""
    prepare(spark)
    pieces = spark.read.schema("value string").option("lineSep", END).text(path).select(F.col("value").cast("binary"))
    records = pieces.mapInArrow(_reader(payloads), "record_id string, record_type string, page_id string, url string, "
                                "refers_id string, payload_bytes long, payload_digest string, payload binary")
    return records.withColumn("page_id", F.col("page_id").cast(id_type))


def resolved_records(records: DataFrame) -> DataFrame:
    """Records as read, with each revisit joined to the response that it refers to.

    Per record: page_id, payload_bytes, payload_digest (of the full payload, from
    the stored response), record_type, refers_to (the response's page_id; null
    for responses). A revisit whose response is missing, or has another digest, keeps null
    payload_bytes.
    """
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    kept = staged(records.select("record_id", "refers_id", *cols), "records")
    full = kept.where("record_type = 'response'")
    one = full.select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"),
                      F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest"))
    revisits = spread_join(kept.where("record_type <> 'response'"), one, "refers_id", F.col("record_id"), "left")
    same = F.col("full_digest") == F.col("payload_digest")
    return full.select(*cols, F.lit(None).cast(records.schema["page_id"].dataType).alias("refers_to")).unionByName(
        revisits.select("page_id", F.when(same, F.col("full_bytes")).alias("payload_bytes"), "payload_digest",
                        "record_type", F.when(same, F.col("refers_to")).alias("refers_to")))
