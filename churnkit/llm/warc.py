"""WARC archives: segmented, chunk-framed records written and read back.

Writing: one ``response`` record per distinct payload, a ``revisit`` record for
every other row with the same payload.  A response block is an HTTP message
whose body is framed with chunked transfer encoding.  Blocks longer than
``segment_bytes`` are segmented as ISO 28500 says: segment 1 in the response
record, the others in ``continuation`` records that name the response in
WARC-Segment-Origin-ID; the last carries WARC-Segment-Total-Length.

Reading: records are parsed file by file with Content-Length; the segments of a
response, from whatever files, are grouped by origin identifier, ordered by
segment number, checked for gaps and against the total length, joined, and the
chunked framing is decoded; the payload digest is verified.  Only segments are
shuffled: a record in one piece is decoded where it was read.

Defined cases: null html is an empty payload; a null url writes no
WARC-Target-URI; equal payloads: the smallest page_id is the response, null
page_ids count last, and rows that repeat the smallest page_id with the same
payload are all responses; an empty table writes an archive without records and
reads back no rows; a gap, a wrong total, a broken frame or a wrong digest
raises an error that names the record; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import stored
from churnkit.session import scratch_path

CRLF = b"\r\n"
VERSION = b"WARC/1.1"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
#: Fixed date of the records: an archive of a table has no capture times.
DATE = b"2000-01-01T00:00:00Z"


class WarcError(ValueError):
    pass


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i: i + size]
        parts += [b"%x" % len(piece), CRLF, piece, CRLF]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunk(body: bytes) -> bytes:
    """Decode chunked transfer framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise WarcError("chunk size line without an end")
        size = body[at:end].split(b";", 1)[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise WarcError(f"bad chunk size {size[:20]!r}")
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n: at + n + 2] != CRLF:
            raise WarcError("chunk shorter than its size or without its line end")
        out.append(body[at: at + n])
        at += n + 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without its closing CRLF CRLF (the writer's line separator)."""
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None), b"Content-Length: %d" % len(block), b"", b""]
    return CRLF.join(head) + block


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of every record of an archive."""
    at = 0
    while at < len(content):
        if content[at: at + 5] != b"WARC/":
            raise WarcError(f"no record at byte {at}")
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            raise WarcError(f"header without an end at byte {at}")
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if content[stop: stop + 4] != b"\r\n\r\n":
            raise WarcError(f"record at byte {at} does not end with its Content-Length")
        yield fields, content[start:stop]
        at = stop + 4


#: Profile of a revisit whose payload is that of another record, found by its digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write_archive(spark: SparkSession, pages: DataFrame, path: str, *, segment_bytes: int = 32768, chunk_bytes: int = 8192,
                  records_per_file: int = 2000) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path`` (files ``.txt.gz``, a gzip member each).

    A file holds at most ``records_per_file`` records, which bounds what a reader loads at once.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    digest = F.unhex(F.sha1(body))
    small = stored(spark, pages.select("page_id", digest.alias("digest")), "warc-digests")
    first = small.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    again = stored(spark, small.join(first.where("n > 1"), "digest").where("NOT page_id <=> first")
                   .select(F.col("page_id").alias("id"), F.col("digest").alias("same"), "first").distinct(), "warc-revisits")
    # Spark broadcasts the revisits only below its size threshold; else both sides are shuffled by page.
    rows = pages.select("page_id", "url", body.alias("body"), digest.alias("digest"))
    marked = (rows.join(again, rows["page_id"].eqNullSafe(again["id"]) & (rows["digest"] == again["same"]), "left")
              .select("page_id", "url", F.when(F.col("same").isNull(), F.col("body")).alias("body"), "digest",
                      F.octet_length("body").cast("long").alias("bytes"), "first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for page, url, payload, sha, size, earlier in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = base64.b32encode(sha).decode()
                own, row = f"<urn:page:{'' if page is None else page}:{part}.{row}>", row + 1  # repeated rows are records of their own
                common = [("WARC-Date", DATE.decode()), ("WARC-Target-URI", url and re.sub(r"[\r\n]", "", url)),
                          ("WARC-Payload-Digest", f"sha1:{name}"), ("X-Page-Id", page), ("X-Payload-Length", size)]
                if payload is None:
                    out.append(record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common,
                                       ("WARC-Profile", PROFILE), ("X-Refers-To-Page", earlier)], b""))
                    continue
                block = HTTP_HEAD + chunked(payload, chunk_bytes)
                pieces = [block[i: i + segment_bytes] for i in range(0, len(block), segment_bytes)]
                more = [("WARC-Segment-Number", 1)] if len(pieces) > 1 else []
                out.append(record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, *more], pieces[0]))
                for k, piece in enumerate(pieces[1:], 2):
                    total = len(block) if k == len(pieces) else None
                    out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{k}>"),
                                       ("WARC-Date", DATE.decode()), ("WARC-Segment-Origin-ID", own),
                                       ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)], piece))
            yield pa.record_batch([pa.array(out, pa.binary())], ["value"])

    # Spark's text writer puts the bytes of a string out as they are, so a binary column cast to string stays binary.
    (marked.mapInArrow(write, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


_READ = ("type string, page_id long, url string, digest string, bytes long, refers_to long, "
         "origin string, number int, total long, block binary")


def _decode(block: bytes, digest: str, name: str) -> bytes:
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise WarcError(f"{name}: no HTTP header")
    payload = unchunk(body) if re.search(rb"(?i)^transfer-encoding:\s*chunked\s*$", head, re.M) else body
    if f"sha1:{base32_sha1(payload)}" != digest:
        raise WarcError(f"{name}: the payload does not have the recorded digest")
    return payload


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole responses decoded (payload in ``block``), revisits, and segments as they are."""
    import gzip

    number = lambda x: int(x) if x else None
    for batch in batches:
        for content in batch.column(0):
            raw = content.as_py()
            raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
            rows = []
            for f, block in records(raw):
                kind, digest = f["warc-type"], f.get("warc-payload-digest")
                segment = number(f.get("warc-segment-number"))
                origin = (f["warc-segment-origin-id"] if kind == "continuation" else f["warc-record-id"]) if segment else None
                if kind == "response" and not segment:
                    block = _decode(block, digest, f["warc-record-id"])
                rows.append((kind, number(f.get("x-page-id")), f.get("warc-target-uri"), digest, number(f.get("x-payload-length")),
                             number(f.get("x-refers-to-page")), origin, segment, number(f.get("warc-segment-total-length")), block))
            names = [x.split()[0] for x in _READ.split(", ")]
            kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
            types = [kinds[x.split()[1]] for x in _READ.split(", ")]
            cols = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)


def reassemble(segments: DataFrame) -> DataFrame:
    """Segments (origin, number, total, block, ...) joined to whole blocks, a row per origin.

    One record's segments meet in one task: its payload must fit there, as it must in any reader.
    """
    ordered = F.array_sort(F.collect_list(F.struct("number", "total", "type", "page_id", "url", "digest", "bytes", "block")))
    whole = segments.groupBy("origin").agg(ordered.alias("s"), F.max("total").alias("total"))
    numbers = F.transform("s", lambda x: x["number"])
    whole = (whole.withColumn("joined", F.aggregate("s", F.lit(b""), lambda a, x: F.concat(a, x["block"])))
             .withColumn("fault", F.when(~numbers.eqNullSafe(F.sequence(F.lit(1), F.size("s"))), F.lit("a segment is missing or repeated"))
                         .when(F.col("total").isNull(), F.lit("the last segment is missing"))
                         .when(F.octet_length("joined") != F.col("total"), F.lit("the total length is wrong"))))
    first = F.col("s")[0]
    return whole.select(
        F.when(F.col("fault").isNotNull(), F.raise_error(F.concat(F.lit("WARC record "), "origin", F.lit(": "), "fault")).cast("string"))
        .otherwise(first["type"]).alias("type"),
        first["page_id"].alias("page_id"), first["url"].alias("url"), first["digest"].alias("digest"), first["bytes"].alias("bytes"),
        F.lit(None).cast("long").alias("refers_to"), F.col("joined").alias("block"))


def read_archive(spark: SparkSession, path: str, *, most_bytes: int = 512 << 20) -> DataFrame:
    """type, page_id, url, digest, bytes, refers_to and payload of every response and revisit under ``path``.

    A file over ``most_bytes`` is refused (binaryFile reads a file at once), never cut.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.when(F.col("length") > most_bytes, F.raise_error(F.concat(F.lit("archive too large: "), "path")).cast("binary"))
                     .otherwise(F.col("content")).alias("content")))
    parsed = files.mapInArrow(_parse, _READ)
    columns = ["type", "page_id", "url", "digest", "bytes", "refers_to", "block"]
    # One pass over the files: whole records keep a null origin and pass by the grouping.
    parsed = stored(spark, parsed, "warc-parsed")
    whole = parsed.where("number IS NULL").select(*columns)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index("block")
            blocks = [_decode(b, d, str(p)) for b, d, p in zip(batch.column(i).to_pylist(), batch.column("digest").to_pylist(),
                                                                batch.column("page_id").to_pylist(), strict=True)]
            yield batch.set_column(i, "block", pa.array(blocks, pa.binary()))

    joined = reassemble(parsed.where("number IS NOT NULL"))
    joined = joined.mapInArrow(decode, joined.schema)
    return whole.unionByName(joined).withColumnRenamed("block", "payload")


def archive_pages(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, and describe each record."""
    path = scratch_path(spark, "warc")
    write_archive(spark, pages, path, **options)
    back = read_archive(spark, path)
    length = F.when(F.col("type") == "response", F.octet_length("payload").cast("long")).otherwise(F.col("bytes"))
    return back.select("page_id", length.alias("payload_bytes"), F.regexp_replace("digest", "^sha1:", "").alias("payload_digest"),
                       F.col("type").alias("record_type"), "refers_to", "url")
