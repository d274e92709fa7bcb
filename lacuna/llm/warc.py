"""WARC archives: writing pages as records, and reading by segment reassembly (operator 11).

Writing: every page is a record of type ``response`` (an HTTP message whose body, the html in
UTF-8, is in chunked transfer framing) or, where another record holds the same payload,
``revisit`` (headers only, WARC-Refers-To).  A record whose block is longer than
``segment_bytes`` is cut: its first segment keeps the record's type, the others are
``continuation`` records with WARC-Segment-Origin-ID and a number, the last one with the total
length.  Spark's text writer puts one record after another into gzip files, byte for byte, on
whatever file system the folder lies.

Reading: a gzip file is read in order by one task, cut at ``WARC/``.  Payloads may hold that string
too, so a record is put together again from as many pieces as its Content-Length
asks for.  Uncut records are done then.  Segments, wherever they lie, are grouped by origin,
ordered by number and checked: numbers from 1 without a gap, total length as stated.  Then the
HTTP head goes, chunked framing is decoded, and the payload's SHA-1 is held against the header.
What fails a check is returned with its ``status`` and no payload; no record is dropped.

Of records with equal payloads (SHA-1) of at least ``min_bytes`` the one with the largest page_id
is the response.  Payloads never travel for this: digests are grouped, and the response's ids
come back through ``common.lookup``, so a payload that a third of all pages share is no hot key.

Cases: null html is an empty payload; a null page_id is the smallest, has no Page-ID header and
comes back null; rows alike in page_id and html are records of their own, any one of them the
response; bytes of a url up to 0x20, 0x7F and quotation brackets are percent-encoded in the
header (a null url is an empty one); an empty table gives no record and no row; extra columns
are not read.  A payload is one value of a row, 2 GB at most.  Files are named ``.txt.gz`` by
Spark's writer.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm.common import lookup, scratch, stash

CRLF = b"\r\n"
END = b"\r\n\r\n"
#: where files are cut; no part of it repeats inside it, so a reader's buffer end cannot hide one
CUT = "WARC/"
SEGMENT_BYTES = 1 << 30
CHUNK_BYTES = 4096
DATE = "1970-01-01T00:00:00Z"
#: bytes of records or payloads that a task holds before it hands a batch on
BATCH_BYTES = 4 << 20
_UNSAFE = re.compile(rb"[\x00-\x20\x7f<>]")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, uid, and of a revisit the uid of its response (``of``; else null)."""
    rows = stash(pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                              F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
                 .withColumn("sha", F.sha1("payload")).withColumn("uid", F.monotonically_increasing_id()))
    first = stash(rows.filter(F.length("payload") >= min_bytes).groupBy("sha")
                  .agg(F.max(F.struct("page_id", "uid")).alias("top"), F.count("*").alias("n")).filter("n > 1")
                  .select("sha", F.col("top.uid").alias("of"), "n"))
    met = lookup(rows, first, "sha", "n")
    return met.select("page_id", "url", "payload", "uid", F.when((F.col("of") != F.col("uid")) & (F.length("payload") >= min_bytes), F.col("of")).alias("of"))


def chunked(body: bytes, size: int) -> bytes:
    parts = []
    for at in range(0, len(body), size):
        piece = body[at:at + size]
        parts += [b"%x\r\n" % len(piece), piece, CRLF]
    return b"".join((*parts, b"0\r\n\r\n"))


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block


def write(pages: DataFrame, folder: str, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
          records_per_file: int = 200_000, date: str = DATE) -> None:
    """Write one record per page into gzip files under ``folder`` (a new folder)."""
    space = uuid.uuid4()

    def name(uid, segment=1):
        return f"<urn:uuid:{uuid.uuid5(space, f'{uid}/{segment}')}>"

    def records(r):
        uri = _UNSAFE.sub(lambda m: b"%%%02X" % m.group()[0], (r["url"] or "").encode()).decode()
        common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
        revisit = r["of"] is not None
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        block += CRLF if revisit else b"Transfer-Encoding: chunked\r\n\r\n" + chunked(r["payload"], chunk_bytes)
        cut = len(block) > segment_bytes
        yield record([("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(r["uid"])), *common,
                      ("Page-ID", r["page_id"]), ("WARC-Payload-Digest", f"sha1:{base32_sha1(r['payload'])}"),
                      ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
                      ("WARC-Refers-To", name(r["of"]) if revisit else None), ("Content-Type", "application/http;msgtype=response"),
                      ("WARC-Segment-Number", "1" if cut else None)], block[:segment_bytes])
        for at in range(segment_bytes, len(block), segment_bytes):
            n = at // segment_bytes + 1
            last = at + segment_bytes >= len(block)
            yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", name(r["uid"], n)), *common,
                          ("WARC-Segment-Origin-ID", name(r["uid"])), ("WARC-Segment-Number", n),
                          ("WARC-Segment-Total-Length", len(block) if last else None)], block[at:at + segment_bytes])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for n in range(b.num_rows):
                for got in records(b.slice(n, 1).to_pylist()[0]):
                    held.append(got)
                    size += len(got)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])

    (with_roles(pages, min_bytes).mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("compression", "gzip").option("lineSep", END.decode()).option("maxRecordsPerFile", records_per_file).text(folder))


FIELDS = ("type", "id", "uri", "page", "refers_to", "digest", "origin", "number", "total", "content_type")
_NAMES = ("warc-type", "warc-record-id", "warc-target-uri", "page-id", "warc-refers-to", "warc-payload-digest",
          "warc-segment-origin-id", "warc-segment-number", "warc-segment-total-length", "content-type")
RECORD = ", ".join(f"{f} string" for f in FIELDS) + ", block binary, status string"


def fields(head: bytes) -> dict[str, str]:
    """Header lines as lower-case names and values; the first of a repeated name counts."""
    out: dict[str, str] = {}
    for line in head.split(CRLF):
        k, colon, v = line.partition(b":")
        if colon:
            out.setdefault(k.strip().lower().decode("utf-8", "replace"), v.strip().decode("utf-8", "replace"))
    return out


class _Open:
    """A record being put together from pieces of one file."""

    def __init__(self):
        self.parts, self.size, self.need, self.head = [], 0, None, None

    def add(self, piece: bytes):
        if self.parts:
            self.parts.append(CUT.encode())
            self.size += len(CUT)
        self.parts.append(piece)
        self.size += len(piece)
        if self.need is None:
            data = b"".join(self.parts)
            at = data.find(END)
            if at >= 0:
                self.head = fields(data[:at])
                length = self.head.get("content-length", "")
                self.need = at + len(END) + int(length) if length.isascii() and length.isdigit() else -1
                self.at = at + len(END)

    def done(self) -> bool:
        return self.need is not None and self.size >= self.need

    def row(self) -> dict:
        data = b"".join(self.parts)
        head = self.head or fields(data)
        out = {f: head.get(n) for f, n in zip(FIELDS, _NAMES)}
        if self.need is None or self.need < 0:
            return out | {"block": None, "status": "malformed"}
        if len(data) < self.need:
            return out | {"block": None, "status": "truncated"}
        tail = data[self.need:]
        return out | {"block": data[self.at:self.need], "status": "ok" if tail in (b"", END) else "malformed"}


def records(spark: SparkSession, folder: str, plain: bool = False) -> DataFrame:
    """All records of the archives under ``folder``: headers, block and status.

    ``plain``: the files are not compressed, so Spark reads them in splits; their pieces are put
    back into file order first.
    """
    pieces = spark.read.option("lineSep", CUT).text(folder).select(
        F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    if plain:
        pieces = (pieces.withColumn("at", F.monotonically_increasing_id()).repartition("file")
                  .sortWithinPartitions("file", "start", "at").drop("at"))

    def run(batches):
        held, size, now, file = [], 0, None, None
        schema = pa.schema([(f, pa.string()) for f in FIELDS] + [("block", pa.binary()), ("status", pa.string())])
        for b in batches:
            for piece, name in zip(b.column("piece"), b.column("file").to_pylist()):
                piece = piece.as_py()
                if name != file:
                    if now:
                        held.append(now.row())
                    file, now = name, None
                    if not piece:  # before the first record
                        continue
                now = now or _Open()
                now.add(piece)
                if now.done():
                    held.append(now.row())
                    size += now.size
                    now = None
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if now:
            held.append(now.row())
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return pieces.select("piece", "file").mapInArrow(run, RECORD)


def unchunked(body: bytes) -> bytes | None:
    """The body without chunked framing; None where the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(CRLF, at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n = int(size, 16)
        at = end + 2
        if n == 0:  # trailers, if any, end with an empty line
            return b"".join(parts) if body.startswith(CRLF, at) or body.find(END, at) >= 0 else None
        if body[at + n:at + n + 2] != CRLF:
            return None
        parts.append(body[at:at + n])
        at += n + 2


def payload(block: bytes, content_type: str | None) -> bytes | None:
    """The HTTP body of a block of type application/http, unframed; other blocks as they are."""
    if not (content_type or "").lower().startswith("application/http"):
        return block
    head, found, body = block.partition(END)
    if not found:
        return None
    return unchunked(body) if fields(head).get("transfer-encoding", "").lower().endswith("chunked") else body


def reassembled(segments: list[dict]) -> tuple[bytes | None, str]:
    """Block of one record from its segments in order of number."""
    if any(s["status"] != "ok" or s["n"] is None for s in segments):
        return None, "bad segment"
    kept: dict[int, dict] = {}
    for s in segments:
        if kept.setdefault(s["n"], s)["block"] != s["block"]:
            return None, "two blocks of one number"
    blocks = [kept[n]["block"] for n in sorted(kept)]
    if sorted(kept) != list(range(1, len(kept) + 1)):
        return None, "missing segment"
    total = kept[len(kept)]["total"]
    if total is None or not total.isdigit():
        return None, "missing segment"
    return (b"".join(blocks), "ok") if int(total) == sum(map(len, blocks)) else (None, "wrong total length")


READ = "record_id string, record_type string, uri string, page_id long, refers_to string, payload binary, payload_digest string, status string"


def read(spark: SparkSession, folder: str, plain: bool = False) -> DataFrame:
    """One row per record other than continuations and warcinfo, segments joined, payload decoded and
    checked; ``payload`` is null for revisits and for records whose ``status`` is not ok."""
    got = records(spark, folder, plain).withColumn("n", F.col("number").try_cast("int"))
    entry = F.struct("n", *FIELDS, "block", "status")
    whole = got.filter(F.col("number").isNull()).select(F.array(entry).alias("segments"))
    cut = (got.filter(F.col("number").isNotNull())
           .groupBy(F.coalesce(F.when(F.col("type") == "continuation", F.col("origin")), F.col("id")).alias("key"))
           .agg(F.sort_array(F.collect_list(entry)).alias("segments")).select("segments"))

    def row(segments):
        head = next((s for s in segments if s["type"] != "continuation"), segments[0])
        block, status = (head["block"], head["status"]) if head["number"] is None else reassembled(segments)
        body = None
        if status == "ok" and head["type"] != "revisit":
            body = payload(block, head["content_type"])
            status = "ok" if body is not None else "broken framing"
        digest = (head["digest"] or "").removeprefix("sha1:") or None
        if body is not None and digest and base32_sha1(body) != digest:
            body, status = None, "wrong digest"
        page = head["page"]
        return {"record_id": head["id"], "record_type": head["type"], "uri": head["uri"],
                "page_id": int(page) if page and re.fullmatch(r"-?[0-9]{1,19}", page) else None, "refers_to": head["refers_to"],
                "payload": body, "payload_digest": digest, "status": status}

    def run(batches):
        schema = pa.schema([(c.split()[0], {"long": pa.int64(), "binary": pa.binary()}.get(c.split()[1], pa.string())) for c in READ.split(", ")])
        held, size = [], 0
        for b in batches:
            for segments in b.column("segments"):
                held.append(row(segments.as_py()))
                size += 500 + len(held[-1]["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return whole.unionByName(cut).mapInArrow(run, READ).filter(~F.col("record_type").eqNullSafe(F.lit("warcinfo")))


def digests(archive: DataFrame) -> DataFrame:
    """Per record page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id), status:
    a revisit has the bytes of the response that it refers to."""
    rows = stash(archive.select("record_id", "record_type", "page_id", "refers_to", F.length("payload").cast("long").alias("bytes"),
                                "payload_digest", "status"))
    used = rows.filter(F.col("refers_to").isNotNull()).groupBy("refers_to").agg(F.count("*").alias("n"))
    told = stash(rows.filter(F.col("record_type") == "response")
                 .select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("told_page"), F.col("bytes").alias("told_bytes"))
                 .dropDuplicates(["refers_to"]).join(used, "refers_to"))
    return lookup(rows, told, "refers_to", "n").select(
        "page_id", F.coalesce("bytes", "told_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("told_page").alias("refers_to"), "status")


def round_trip(pages: DataFrame, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``digests`` of the archives that ``write`` makes of the pages, read back."""
    spark = pages.sparkSession
    folder = scratch(spark)
    write(pages, folder, min_bytes, segment_bytes, chunk_bytes)
    return digests(read(spark, folder))
