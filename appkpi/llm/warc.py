"""WARC archives as a chunked record table.

An archive is a table of rows (record, chunk, data): chunk 0 holds the record's WARC header and the
HTTP header its block begins with, the chunks after it hold the payload in pieces of at most
``CHUNK_BYTES``, so that no reader or writer needs a whole record in one buffer. The data of a
record's chunks in order, followed by two line ends, are the bytes of its WARC record. Each chunk
carries the SHA-256 of the payload up to its end, which a reader checks as it goes.

Record ids are name-based UUIDs. One that revisits refer to is made of its page_id and payload digest,
which the writer of a revisit knows without seeing the record; rows that repeat both are one record
stored twice. All others also contain the place of their row in the write.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from itertools import groupby
from operator import itemgetter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appkpi.llm.common import map_rows, settle

CHUNK_BYTES = 1 << 18
# Payloads below this are always stored.
LEAST_REVISIT_BYTES = 100
# Fixed value: the profile of a revisit record with the same payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = "record long, chunk long, last boolean, data binary, digest_so_far string"


def with_originals(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``pages`` as (page_id, url, html, original): the page_id whose record a revisit refers to.

    ``original`` is null where the row is stored itself: it has the smallest id of its payload, its
    payload is short, or no row with that payload has an id. Null html is an empty payload.
    """
    own = pages.select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    digest = F.sha2("html", 256)
    firsts = settle(
        own.where(F.octet_length("html") >= least_bytes)
        .select("page_id", digest.alias("digest"))
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "repeated-payloads",
    )
    # Only payloads found more than once are looked up; the rest goes through untouched.
    return (
        own.withColumn("digest", F.when(F.octet_length("html") >= least_bytes, digest))
        .join(firsts, "digest", "left")
        .select(
            "page_id", "url", "html",
            F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id")).alias("original"),
        )
    )


def record_id(*parts) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, parts))).urn}>"


def header(
    page_id: int | None, url: str, original: int | None, length: int, digest: str, record: int, date: str
) -> bytes:
    """The WARC header and the HTTP header; ``length`` and ``digest`` are those of the full payload."""
    own = (page_id, digest)
    if original is not None or page_id is None or length < LEAST_REVISIT_BYTES:
        own += (record,)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(*own)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {''.join(c if c >= ' ' else '%%%02X' % ord(c) for c in url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {length}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"Content-Length: {len(http) + (length if original is None else 0)}",
    ]
    if original is not None:
        fields += [
            f"WARC-Profile: {SAME_PAYLOAD}",
            f"WARC-Refers-To: {record_id(original, digest)}",
            f"X-Refers-To-Page-ID: {original}",
        ]
    return ("\r\n".join([*fields, "", ""]) + http).encode()


def chunks(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, at: datetime | None = None) -> DataFrame:
    """The chunk rows of one record per row of ``with_originals``; ``at`` is their date, now if not given."""
    date = (at or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import hashlib

        from pyspark import TaskContext

        # Records are numbered within the write, so rows with equal ids stay apart.
        record = TaskContext.get().partitionId() << 40
        for page_id, url, html, original in found:
            digest, length = hashlib.sha256(), 0
            for piece in utf8_pieces(html, chunk_bytes):
                digest.update(piece)
                length += len(piece)
            head = header(page_id, url, original, length, digest.hexdigest(), record, date)
            stored = original is None and length > 0
            yield record, 0, not stored, head, hashlib.sha256().hexdigest()
            if stored:
                so_far, done = hashlib.sha256(), 0
                for number, piece in enumerate(utf8_pieces(html, chunk_bytes), 1):
                    so_far.update(piece)
                    done += len(piece)
                    yield record, number, done == length, piece, so_far.hexdigest()
            record += 1

    return map_rows(pages, ["page_id", "url", "html", "original"], CHUNK, rows)


def utf8_pieces(text: str, size: int) -> Iterator[bytes]:
    """UTF-8 of a text, a bounded slice of it at a time."""
    step = max(1, size // 4)
    for at in range(0, len(text), step):
        yield text[at : at + step].encode()


def write(pages: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, at: datetime | None = None) -> None:
    """Writes ``pages`` (page_id, url, html) as a chunked archive table; other columns are not stored."""
    chunks(with_originals(pages), chunk_bytes, at).write.parquet(folder)


RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record.

    A record's chunks are streamed in order; a missing chunk or a payload that does not match its
    digests is an error. A revisit's length and digest are those of the payload it stands for.
    """
    placed = (
        spark.read.parquet(folder).repartition("record").sortWithinPartitions("record", "chunk")
    )
    names = ["record", "chunk", "last", "data", "digest_so_far"]

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        for record, parts in groupby(found, key=itemgetter(0)):
            yield read_record(record, parts)

    return map_rows(placed, names, RECORD, rows)


def read_record(record: int, parts: Iterator[tuple]) -> tuple:
    import hashlib

    digest, length, due, fields, ended, http = hashlib.sha256(), 0, 0, {}, False, 0
    for _, number, last, data, so_far in parts:
        if number != due or ended:
            raise ValueError(f"chunk {due} of record {record} is missing")
        if number == 0:
            head, block = data.split(b"\r\n\r\n", 1)
            fields, http = parse_header(head), len(block)
        else:
            digest.update(data)
            length += len(data)
        if digest.hexdigest() != so_far:
            raise ValueError(f"chunk {number} of record {record} is damaged")
        due, ended = due + 1, last
    said, full = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
    if not ended or http + length != int(fields["Content-Length"]):
        raise ValueError(f"record {record} is cut short")
    if fields["WARC-Type"] == "response" and digest.hexdigest() != said:
        raise ValueError(f"record {record} does not match its digest")
    return (
        number_in(fields["X-Page-ID"]), full, said, fields["WARC-Type"],
        number_in(fields.get("X-Refers-To-Page-ID", "")),
    )


def parse_header(data: bytes) -> dict[str, str]:
    lines = data.decode().split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def number_in(digits: str) -> int | None:
    return int(digits) if digits else None
