"""WARC archives: writing segmented records with chunked payloads, and reassembling them."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questmart.llm.common import whole_text
from questmart.llm.shipping import ship_package
from questmart.session import new_stage_path, stage

CRLF = "\r\n"
# Smallest payload that is worth a revisit record.
REVISIT_BYTES = 1_000
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
# With SEGMENT_BYTES this bounds an archive file.
RECORDS_PER_FILE = 4_000
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Transfer-Encoding: chunked{CRLF}{CRLF}"
READ_SCHEMA = (
    "record_id string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, segment int, total_length long, block binary"
)


# -- writing --------------------------------------------------------------------------------------------------------


def pieces(data: bytes, size: int) -> Iterator[bytes]:
    """Cuts of at most ``size`` bytes that split no UTF-8 character."""
    begin = 0
    while begin < len(data):
        end = min(begin + size, len(data))
        while end < len(data) and end > begin + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[begin:end]
        begin = end


def chunked(payload: bytes) -> bytes:
    """The payload in chunked transfer framing."""
    framed = [b"%x\r\n%s\r\n" % (len(piece), piece) for piece in pieces(payload, CHUNK_BYTES)]
    return b"".join(framed) + b"0\r\n\r\n"


def _record(fields: list[tuple[str, object]], block: bytes) -> str:
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    return CRLF.join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", block.decode("utf-8")])


def records_of(name: str, page: dict) -> Iterator[str]:
    """The records of one page, without the blank lines that end a record: a revisit, or a response and continuations."""
    url = None if page["url"] is None else quote(page["url"], safe=":/?#[]@!$&'()*+,;=%~-._")
    fields = [
        ("WARC-Type", page["record_type"]),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{page['payload_digest']}"),
        ("X-Page-ID", page["page_id"]),
        ("X-Payload-Length", page["payload_bytes"]),
    ]
    if page["record_type"] == "revisit":
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record([*fields, ("WARC-Profile", profile), ("WARC-Refers-To", f"<urn:page:{page['refers_to']}>")], b"")
        return
    block = HTTP_HEAD.encode() + chunked(page["html"].encode("utf-8"))
    parts = list(pieces(block, SEGMENT_BYTES))
    if len(parts) == 1:
        yield _record(fields, block)
        return
    yield _record([*fields, ("WARC-Segment-Number", 1)], parts[0])
    for number, part in enumerate(parts[1:], 2):
        total = len(block) if number == len(parts) else None
        yield _record(
            [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", f"<{name}:{number}>"),
                ("WARC-Date", "1970-01-01T00:00:00Z"),
                ("WARC-Segment-Origin-ID", f"<{name}>"),
                ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", total),
            ],
            part,
        )


def plan_records(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with payload_bytes, payload_digest, record_type and refers_to."""
    body = whole_text("html")
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        body.alias("html"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha1(body).alias("payload_digest"),
    )
    # Stored before it meets the pages: a payload with very many copies then is split by the adaptive join.
    owners = keyed.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest").agg(
        F.max("page_id").alias("owner"), F.count("*").alias("copies")
    )
    owners = stage(owners.where("copies > 1").select(F.col("payload_digest").alias("_digest"), "owner"), "payload-owners")
    joined = keyed.join(owners.hint("merge"), F.col("payload_digest") == F.col("_digest"), "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).select(
        *keyed.columns, "record_type", F.when(revisit, F.col("owner")).alias("refers_to")
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes one record per page row into gzipped archive files under ``path``.

    Payload is the html in UTF-8 (null: empty). Of equal payloads of at least REVISIT_BYTES the page with the largest id
    is the response and the others revisit it; rows that repeat its id are responses too, as none is before the other. A
    null id is never the largest; equal payloads of pages without any id are all responses. Blocks longer than a segment
    go on in continuation records. Other columns are not read; an empty table writes no record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out: list[str] = []
            for page in _rows(batch):
                out.extend(records_of(f"urn:page:{page['page_id']}:{part}-{row}", page))
                row += 1
                if len(out) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                    out = []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    ship_package(pages.sparkSession)
    # Every record ends with two line ends, which the text writer adds.
    writer = plan_records(pages).mapInArrow(run, "value string").write.option("lineSep", CRLF * 2)
    writer.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for begin in range(0, batch.num_rows, 200):
        yield from batch.slice(begin, 200).to_pylist()


# -- reading --------------------------------------------------------------------------------------------------------


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record of an archive, led by the records' own lengths."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"record {fields.get('warc-record-id')} ends early")
        yield fields, block


def unchunked(body: bytes) -> bytes:
    """The payload of chunked transfer framing; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        if len(out[-1]) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("chunked body ends early")
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def reassembled(segments: list[tuple[int, bytes]], total: int | None) -> bytes:
    """The block of a segmented record; fails when a segment is missing or the total length differs."""
    ordered = sorted(segments, key=lambda s: s[0])
    if [number for number, _ in ordered] != list(range(1, len(ordered) + 1)):
        raise ValueError(f"segments {[number for number, _ in ordered]} are not complete")
    block = b"".join(part for _, part in ordered)
    if total != len(block):
        raise ValueError(f"segments have {len(block)} bytes, {total} expected")
    return block


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, payload: one row per response or revisit.

    Whole records are decoded where they are read. Segments are grouped by the identifier of their first record, ordered
    by segment number, checked against the total length and then decoded; a group holds one record only. Length and digest
    of responses are those of the decoded payload and must equal the stored digest. A revisit takes length, digest and, if
    kept, payload from the decoded response it refers to, by page id and digest; without such a response reading fails.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for fields, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    out.append(_read_row(fields, block, keep_payload))
                    if len(out) >= 500:
                        yield _read_batch(out)
                        out = []
                yield _read_batch(out)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 100):
                out = []
                for row in batch.slice(begin, 100).to_pylist():
                    segments = row.pop("segments")
                    if segments:
                        block = reassembled([(s["segment"], s["block"]) for s in segments], row["total_length"])
                        row |= _measured(payload_of(block), row["payload_digest"], keep_payload)
                    out.append({name: row[name] for name in names})
                yield pa.RecordBatch.from_pylist(out, schema=result)

    ship_package(spark)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    result = pa.schema(list(zip(names, kinds)))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = files.mapInArrow(run, READ_SCHEMA)
    grouped = records.groupBy("record_id").agg(
        *[F.max(c).alias(c) for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "total_length")],
        # Of the rows of one record only one has a payload, and only segments have blocks; lists pass nulls over.
        F.get(F.collect_list("payload"), F.lit(0)).alias("payload"),
        F.collect_list(F.when(F.col("segment").isNotNull(), F.struct("segment", "block"))).alias("segments"),
    )
    rows = grouped.mapInArrow(join, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
    # Stored, so that archives are read once and a response with very many revisits meets plain tables and can be split.
    return _with_referred(stage(rows, "records"), names)


def _with_referred(rows: DataFrame, names: list[str]) -> DataFrame:
    revisits = rows.where("record_type = 'revisit'")
    # Rows that repeat a page are several responses with one payload.
    responses = rows.where("record_type = 'response'").groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).agg(
        F.min("payload_bytes").alias("_bytes"), F.min("payload").alias("_payload")
    )
    found = revisits.join(responses.hint("merge"), (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    missing = F.concat(F.lit("no response with this payload for page "), F.col("page_id").cast("string"), F.lit(", which refers to "), F.col("refers_to").cast("string"))
    filled = found.select(
        "page_id",
        F.when(F.col("_id").isNull(), F.raise_error(missing).cast("long")).otherwise(F.col("_bytes")).alias("payload_bytes"),
        F.col("_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        F.col("_payload").alias("payload"),
    )
    return rows.where("record_type = 'response'").select(*names).unionByName(filled)


def _measured(payload: bytes, digest: str | None, keep_payload: bool) -> dict:
    found = hashlib.sha1(payload).hexdigest()
    if digest is not None and digest != found:
        raise ValueError(f"payload has digest {found}, {digest} expected")
    return {"payload_bytes": len(payload), "payload_digest": found, "payload": payload if keep_payload else None}


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _read_row(fields: dict[str, str], block: bytes, keep_payload: bool) -> dict:
    kind, segment = fields["warc-type"], _number(fields.get("warc-segment-number"))
    refers = fields.get("warc-refers-to")
    digest = fields.get("warc-payload-digest")
    row = {
        "record_id": fields.get("warc-segment-origin-id", fields["warc-record-id"]),
        "page_id": _number(fields.get("x-page-id")),
        "record_type": None if kind == "continuation" else kind,
        "refers_to": None if refers is None else int(refers.strip("<>").rsplit(":", 1)[1]),
        "payload_bytes": _number(fields.get("x-payload-length")),
        "payload_digest": None if digest is None else digest.removeprefix("sha1:"),
        "payload": None,
        "segment": segment,
        "total_length": _number(fields.get("warc-segment-total-length")),
        "block": block if segment is not None else None,
    }
    if kind == "response" and segment is None:
        row |= _measured(payload_of(block), row["payload_digest"], keep_payload)
    return row


_READ = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("segment", pa.int32()),
        ("total_length", pa.int64()),
        ("block", pa.binary()),
    ]
)


def _read_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_READ)


def round_trip(pages: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Writes the pages as archives into the shared folder and reads them back."""
    spark = pages.sparkSession
    path = new_stage_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, keep_payload)
