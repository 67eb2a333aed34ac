"""WARC archives: records written in segments, read back, put together and decoded."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jurispark.llm.common import cut, lean, raw, shared_dir

#: Payloads of fewer bytes are stored in full even if another record holds the same.
REVISIT_BYTES = 1000
#: Bytes of a record's block before it goes on in a continuation record, bytes of a chunk, records of a file.
SEGMENT_BYTES, CHUNK_BYTES, FILE_RECORDS = 32_768, 8192, 2000
#: Packed bytes that are inflated at a time, and rows that a task gives back at a time.
INFLATE_BYTES, OUT_ROWS, OUT_BYTES = 1 << 16, 500, 1 << 24
END = b"\r\n\r\n"
#: What a chunk size consists of.
HEX_DIGITS = b"0123456789abcdefABCDEF"
HTTP = "application/http;msgtype=response"
#: Records whose payload is read; others (warcinfo, request, metadata, conversion) are passed over.
READ = ("response", "resource", "revisit")
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    parts = [b"%x\r\n%s\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunk(framed: bytes) -> bytes:
    """The body of a chunked message; a frame that is cut off or malformed raises ValueError."""
    out, at = [], 0
    while True:
        line = framed.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size missing")
        said = framed[at:line].split(b";")[0].strip(b" \t")
        if not said or said.strip(HEX_DIGITS):  # a sign or a prefix is no size
            raise ValueError("chunk size malformed")
        size = int(said, 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut off")
        out.append(framed[at : at + size])
        at += size + 2


def record_id(page: str | None, tag: int) -> str:
    """The name of the record that row ``tag`` gives; the same wherever it is worked out."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page}:{tag}')}>"


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


#: A member without content. Spark's text writer puts a separator behind each value, and this one adds nothing.
EMPTY = member(b"")


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + END


def records(name: str, page: str | None, url: str | None, body: bytes, sha1: str, date: str, refers_to: str | None, segment_bytes: int):
    """A page's records: a revisit without payload, or a response, continued in further records where it is long."""
    target = [("WARC-Target-URI", re.sub(r"\s", "%20", url or "about:blank")), ("WARC-Date", date)]
    common = [("WARC-Record-ID", name), *target, ("WARC-Payload-Digest", f"sha1:{sha1}"), *([] if page is None else [("X-Page-ID", re.sub(r"\s", "%20", page))]), ("Content-Type", HTTP)]
    if refers_to:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
        yield _record("revisit", [*common, ("WARC-Refers-To", refers_to), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], block)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(body)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record("response", [*common, *([("WARC-Segment-Number", "1")] if len(parts) > 1 else [])], parts[0])
    for n, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        yield _record("continuation", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, f'{name}:{n}')}>"), *target, ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(n)), *last], part)


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", segment_bytes: int = SEGMENT_BYTES, date: str | None = None) -> None:
    """Writes one WARC record for each row as files below ``path``, a folder of any file system that Spark writes.

    Each record is a gzip member of its own, with an empty member behind it; each task begins with a warcinfo
    record. Of rows with equal payloads of at least 1000 bytes, those with the largest id are responses, and the
    others revisit one of them by its record id (rows without id too); shorter ones are all responses. Ids may
    be of any type with an order. A null payload is empty, a null URL is about:blank, a row without id has no
    X-Page-ID header; repeated rows get records of their own. ``date`` is the WARC-Date of all, now if not given.

    A row's number (partition and place in it) names its record, so the table must give its rows in the same
    order whenever it is read, as files do. Payload digests are joined with each digest's largest id, which is
    combined before its shuffle; a digest of a third of the rows is a skewed join, split at run time.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    pages = pages.select(F.monotonically_increasing_id().alias("tag"), F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    pages = pages.select("*", F.sha1(F.col("body").cast("binary")).alias("sha1"), F.octet_length("body").alias("n"))
    leaders = pages.where(F.col("n") >= REVISIT_BYTES).groupBy("sha1", "n").agg(F.max(F.struct("page", "tag")).alias("leader"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    revisit = F.expr("leader IS NOT NULL AND NOT (page <=> leader.page)")
    rows = pages.join(leaders, ["sha1", "n"], "left").select("tag", F.col("page").cast("string"), "url", "body", "sha1", F.when(revisit, F.col("leader.page").cast("string")).alias("leader"), F.when(revisit, F.col("leader.tag")).alias("leader_tag"))

    def run(batches):
        info = f"software: jurispark\r\nformat: WARC File Format 1.1\r\npart: {TaskContext.get().partitionId()}\r\n".encode()
        out = [member(_record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], info))]
        for batch in batches:
            columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), raw(batch.column(3)), *(batch.column(i).to_pylist() for i in (4, 5, 6))]
            size = 0
            for tag, page, url, text, sha1, leader, leader_tag in zip(*columns, strict=True):
                made = records(record_id(page, tag), page, url, text, sha1, date, None if leader_tag is None else record_id(leader, leader_tag), segment_bytes)
                for r in map(member, made):
                    out.append(r)
                    size += len(r)
                if size > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                out = []

    packed = rows.mapInArrow(lean(run), "record binary").select(F.col("record").cast("string").alias("value"))
    packed.write.option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def inflate(packed: bytes):
    """The content of a file, bit by bit: all members of a gzip file one after the other, or the bytes as they are.
    A member that is cut off raises ValueError."""
    if packed[:2] != b"\x1f\x8b":
        for i in range(0, len(packed), INFLATE_BYTES):
            yield packed[i : i + INFLATE_BYTES]
        return
    at, unpack = 0, zlib.decompressobj(31)
    while at < len(packed):
        piece = packed[at : at + INFLATE_BYTES]
        out = unpack.decompress(piece)
        at += len(piece) - len(unpack.unused_data)
        if out:
            yield out
        if unpack.eof:
            while packed[at : at + 1] == b"\0":  # padding between members
                at += 1
            if at >= len(packed):
                return
            unpack = zlib.decompressobj(31)
    raise ValueError("a gzip member is cut off")


def parse(pieces):
    """(headers, block) of each record; names of headers are lower-case, lines that go on are joined. Only the record
    at hand is held."""
    held, base = bytearray(), 0

    def more() -> bool:
        piece = next(source, None)
        if piece is None:
            return False
        held.extend(piece)
        return True

    source = iter(pieces)
    while True:
        while held[:2] in (b"\r\n", b"\r") or held[:1] == b"\n":  # blank lines between records
            drop = 2 if held[:2] == b"\r\n" else 1
            if held[:2] == b"\r" and more():
                continue
            del held[:drop]
            base += drop
        if not held:
            if not more():
                return
            continue
        seen = 0
        while (head := held.find(END, max(0, seen - 3))) < 0:
            seen = len(held)
            if not more():
                raise ValueError(f"a record's headers end wrongly at byte {base + len(held)}")
        if not held.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {base}")
        headers: dict[str, str] = {}
        name = None
        for line in held[:head].decode("utf-8", "replace").split("\r\n")[1:]:
            if line[:1] in (" ", "\t") and name:
                headers[name] += " " + line.strip()
            else:
                name, _, value = line.partition(":")
                name = name.strip().lower()
                headers[name] = value.strip()
        start, end = head + 4, head + 4 + int(headers["content-length"])
        while len(held) < end + 4 and more():
            pass
        if len(held) < end:
            raise ValueError(f"a record ends wrongly at byte {base + len(held)}")
        if len(held) > end and held[end : end + 4] != END:
            raise ValueError(f"a record ends wrongly at byte {base + end}")
        yield headers, bytes(held[start:end])
        del held[: end + 4]
        base += end + 4


def _http(block: bytes) -> tuple[bytes, bytes]:
    """Head and body of an HTTP message."""
    ends = [(i, n) for i, n in ((block.find(END), 4), (block.find(b"\n\n"), 2)) if i >= 0]
    if not ends:
        return block, b""
    i, n = min(ends)
    return block[:i], block[i + n :]


def agrees(said: str | None, data: bytes) -> bool | None:
    """Whether bytes have a stated digest (``algorithm:value``, the value in hex or base 32); None where nothing known
    is stated."""
    kind, _, value = (said or "").partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("sha1", "md5", "sha256", "sha512") or not value:
        return None
    found = hashlib.new(kind, data).digest()
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def _hex_digest(said: str | None) -> str | None:
    """A stated SHA-1 in lower-case hex."""
    kind, _, value = (said or "").partition(":")
    if kind.lower().replace("-", "") != "sha1" or not value:
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


WHOLE = "record_id string, page string, uri string, date string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"
PART = f"{WHOLE}, origin string, number int, total long, said string, mime string, truncated string, block binary"


def decode(headers: dict, block: bytes, keep: bool) -> tuple:
    """A whole record as a row of WHOLE. The stated digest must be that of the payload, framed or not; a truncated
    record isn't held against it."""
    kind, said = headers["warc-type"].lower(), headers.get("warc-payload-digest")
    own = (headers["warc-record-id"], headers.get("x-page-id"), headers.get("warc-target-uri"), headers.get("warc-date"), kind)
    http = headers.get("content-type", "").lower().startswith("application/http")
    head, body = _http(block) if http else (b"", block)
    if kind == "revisit":
        length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        return *own, int(length[1]) if length else None, _hex_digest(said), headers.get("warc-refers-to"), None
    plain, broken = body, None
    if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head):
        try:
            plain = unchunk(body)
        except ValueError as e:
            broken = e
    ok = agrees(said, plain)
    # some archives state the framing but hold the body without it, or digests of framed bodies
    framed = agrees(said, body) if (ok is not True and plain is not body) or broken else None
    if broken and not framed and "warc-truncated" not in headers:
        raise ValueError(f"{headers['warc-record-id']}: {broken}")
    if ok is False and not framed and "warc-truncated" not in headers:
        raise ValueError(f"{headers['warc-record-id']}: payload digest differs")
    return *own, len(plain), hashlib.sha1(plain).hexdigest(), None, plain if keep else None


def _batch(rows: list, schema: str):
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def read_warc(spark: SparkSession, path: str, *, payloads: bool = True, pattern: str | None = None) -> DataFrame:
    """Reads archives, one's own or others', with or without gzip: record_id, page (X-Page-ID), uri, date, record_type,
    payload_bytes, payload_digest (SHA-1 in hex), refers_to (record id), payload. One row for each response,
    resource and revisit; warcinfo, request, metadata and conversion records are passed over.

    All files below ``path`` are read (``pattern``, a glob, selects some), each member by member; a task holds a
    file's packed bytes and one record. Names of headers count in any case, ids may be of any form. Records without continuation
    are decoded where they are read. Segments are grouped by the record they belong to and ordered by number. A group is one record, so no group grows with
    the input. Missing numbers, a length other than the stated total, broken chunk framing, members that are
    cut off and payloads that don't have the stated digest raise an error; what a writer has marked as truncated
    is taken as it is.

    Revisits have no payload. Their length and digest come from the record that they refer to; where they state
    another digest, an error is raised, and where no such record is in the archives, their own headers count
    (null if these say nothing). ``payloads`` False leaves payload null, which saves memory and disk.
    """

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                out, size = [], 0
                for headers, block in parse(inflate(raw(batch.column(0).slice(i, 1))[0])):
                    kind = headers["warc-type"].lower()
                    number = int(headers.get("warc-segment-number", 0))
                    if number:
                        total = headers.get("warc-segment-total-length")
                        own = (headers["warc-record-id"], headers.get("x-page-id"), headers.get("warc-target-uri"), headers.get("warc-date"), kind, None, None, headers.get("warc-refers-to"), None)
                        part = block if kind == "continuation" or kind in READ else b""
                        out.append((*own, headers.get("warc-segment-origin-id", own[0]), number, total and int(total), headers.get("warc-payload-digest"), headers.get("content-type"), headers.get("warc-truncated"), part))
                        size += len(part)
                    elif kind in READ:
                        out.append((*decode(headers, block, payloads), None, 0, *[None] * 5))
                        size += len(out[-1][8] or b"")
                    if len(out) >= OUT_ROWS or size >= OUT_BYTES:
                        yield _batch(out, PART)
                        out, size = [], 0
                if out:
                    yield _batch(out, PART)

    def join(key, group):
        parts = sorted(group.to_pylist(), key=lambda p: p["number"])
        origin, first = key[0].as_py(), parts[0]
        if [p["number"] for p in parts] != [*range(1, len(parts) + 1)]:
            raise ValueError(f"{origin}: segments {[p['number'] for p in parts]}")
        if first["record_type"] not in READ:
            return pa.Table.from_batches([_batch([], WHOLE)])
        block = b"".join(p["block"] for p in parts)
        if parts[-1]["total"] != len(block):
            raise ValueError(f"{origin}: {len(block)} bytes, {parts[-1]['total']} stated")
        named = {"warc-record-id": "record_id", "x-page-id": "page", "warc-target-uri": "uri", "warc-date": "date", "warc-type": "record_type", "warc-refers-to": "refers_to", "warc-payload-digest": "said", "content-type": "mime", "warc-truncated": "truncated"}
        headers = {h: first[c] for h, c in named.items() if first[c] is not None}
        return pa.Table.from_batches([_batch([decode(headers, block, payloads)], WHOLE)])

    files = spark.read.format("binaryFile")
    files = (files.option("pathGlobFilter", pattern) if pattern else files).load(path).select("content")
    parts = files.mapInArrow(lean(read), PART)
    names = [c.split()[0] for c in WHOLE.split(", ")]
    whole = cut(parts.where("number = 0").select(names).unionByName(parts.where("number > 0").groupBy("origin").applyInArrow(join, WHOLE)))
    origins = whole.where("record_type <> 'revisit'").select(F.col("record_id").alias("__id"), F.col("payload_bytes").alias("__bytes"), F.col("payload_digest").alias("__digest"))
    again = whole.where("record_type = 'revisit'").join(origins, F.col("refers_to") == F.col("__id"), "left")
    differs = F.col("payload_digest") != F.col("__digest")
    digest = F.when(differs, F.raise_error(F.concat("record_id", F.lit(": its payload is not that of "), "refers_to")).cast("string")).otherwise(F.coalesce("__digest", "payload_digest"))
    again = again.withColumn("payload_digest", digest).withColumn("payload_bytes", F.coalesce("__bytes", "payload_bytes"))
    return whole.where("record_type <> 'revisit'").unionByName(again.select(names))


def page_records(found: DataFrame) -> DataFrame:
    """What ``write_warc`` wrote, by page: page, payload_bytes, payload_digest, record_type, refers_to (a page)."""
    pages = found.where("record_type <> 'revisit'").select(F.col("record_id").alias("__id"), F.col("page").alias("__page"))
    named = found.join(pages, F.col("refers_to") == F.col("__id"), "left")
    return named.select("page", "payload_bytes", "payload_digest", "record_type", F.col("__page").alias("refers_to"))


def archive_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"


#: What the archives of all pages hold, in DuckDB.
WARC_SQL = """
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM leader THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM leader THEN leader END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS leader
  FROM (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages))
"""
