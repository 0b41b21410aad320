"""WARC archives: written by Spark's own writer, read back by a reader that salvages damaged ones.

A record is a gzip member of its own, as archives have it, or plain text. The text writer puts a separator after each
row; here it is the zero byte in which every member ends once an empty member follows it, so the file is nothing but
members. Files are committed as any of Spark's, so a lost executor leaves no half archive.

The reader takes an archive as a whole, goes record by record, and checks each: the member's own checksum, the
version line, the header block, the length, the payload digest. After a check fails it looks for the next member or
version line from which a whole record can be read, goes on there, and logs the bytes between as a gap. It does so with
the unpacked bytes of a member too, also with what could be unpacked of a damaged one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookfuse.session import scratch_folder

VERSION = b"WARC/1.1"
MIN_SHARED = 100
#: Rows in one archive; a task starts another beyond.
RECORDS_PER_FILE = 5_000
#: Bytes given to the unpacker at once, so that a member costs no more than its own length and this.
CHUNK = 1 << 14
MAGIC = b"\x1f\x8b\x08"
_EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
_VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r?\n")
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public name space for URLs

RECORD_SCHEMA = """archive string, offset bigint, length bigint, page_id bigint, url string, record_type string,
    refers_to bigint, payload_bytes bigint, payload_digest string, payload binary, gap string"""


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one record. A revisit has the headers of the response it stands for, and no payload."""
    def clean(value) -> str:
        return re.sub(r"[\r\n]+", " ", str(value))

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + (payload or b"")
    name = uuid.uuid5(_SPACE, f"{page_id}\n{url}\n{digest}")
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", "2000-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", clean(url)))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("X-Refers-To-Page-ID", str(refers_to)))
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"\r\n"
    return head + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member, with an empty one after it unless it ends in a zero byte by itself."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out.endswith(b"\0") else out + _EMPTY_MEMBER


def deduplicated(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, and refers_to for payloads that a smaller page_id has too.

    Digests are counted before anything is joined, and only those that several rows share are joined back.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"),
    )
    shared = (
        rows.where(F.col("payload_bytes") >= min_shared)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select(F.col("payload_digest").alias("__digest"), "first")
    )
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    return rows.join(shared, F.col("payload_digest") == F.col("__digest"), "left").withColumn("refers_to", refers).drop("__digest", "first")


def write_archives(pages: DataFrame, path: str, gzip: bool = True, min_shared: int = MIN_SHARED, records_per_file: int = RECORDS_PER_FILE) -> None:
    """A record for each row of ``pages`` (page_id, url, html), in archives below ``path``.

    The payload is the html in UTF-8, empty for a null. Of rows with equal payloads of ``min_shared`` bytes or more,
    those of the smallest page_id are responses and the others revisits that refer to it; rows without a page_id are
    never the first. Smaller payloads are all responses. Null urls and ids leave their headers out. Repeated rows are
    records of their own, alike. Other columns don't matter. An empty table makes a folder without records.
    """
    rows = deduplicated(pages, min_shared)
    revisit = F.col("refers_to").isNotNull()
    rows = rows.withColumn("payload", F.when(~revisit, F.col("payload")))
    names = ["page_id", "url", "payload", "payload_digest", "payload_bytes", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for page_id, url, payload, digest, length, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = record(page_id, url, payload, digest, length, refers_to, refers_to is not None)
                # The writer's separator stands in for the last byte.
                out.append(member(data)[:-1] if gzip else data[:-2])
                size += len(out[-1])
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    written = rows.select(*names).mapInArrow(run, "value binary").select(F.expr("cast(value as string)").alias("value"))
    written.write.option("lineSep", "\0" if gzip else "\r\n").option("maxRecordsPerFile", records_per_file).text(path)


def _parse(data: bytes, start: int) -> tuple[dict, bytes, int] | str:
    """(headers, block, end) of the record whose version line is at ``start``, or what is wrong with it."""
    line = _VERSION_LINE.match(data, start)
    if not line:
        return "no version line"
    head_end = data.find(b"\r\n\r\n", line.end() - 2)
    if head_end < 0:
        return "headers do not end"
    headers = {}
    for raw in data[line.end() : head_end].split(b"\r\n"):
        key, colon, value = raw.partition(b":")
        if raw and not colon:
            return "header without a colon"
        headers[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d+", headers.get("content-length", "")):
        return "no content length"
    begin = head_end + 4
    end = begin + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return "record does not end where its length says"
    return headers, data[begin:end], end + 4


def _fields(headers: dict, block: bytes) -> dict | str:
    """The columns of a record; what is wrong if its payload isn't the one that was written."""
    _, _, payload = block.partition(b"\r\n\r\n")
    kind = headers.get("warc-type")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", block[: len(block) - len(payload)])
    algorithm, _, want = headers.get("warc-payload-digest", "").partition(":")

    def number(name: str) -> int | None:
        return int(headers[name]) if re.fullmatch(r"-?\d+", headers.get(name, "")) else None

    out = {
        "page_id": number("x-page-id"), "url": headers.get("warc-target-uri"), "record_type": kind, "refers_to": number("x-refers-to-page-id"),
        "payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(), "payload": payload,
    }
    if kind == "revisit":
        return out | {"payload": None, "payload_bytes": int(stated[1]) if stated else None, "payload_digest": want or None}
    if stated and int(stated[1]) != len(payload):
        return "payload is not as long as stated"
    if algorithm.lower() == "sha256" and want.lower() != out["payload_digest"]:
        return "payload digest differs"
    if algorithm.lower() == "sha1" and want.upper() not in {x := base64.b32encode(hashlib.sha1(payload).digest()).decode(), hashlib.sha1(payload).hexdigest().upper(), x.rstrip("=")}:
        return "payload digest differs"
    return out


def _unpacked(data: bytes, at: int) -> tuple[bytes, int, str]:
    """(bytes, end, what is wrong) of the member at ``at``: of a damaged one, all that comes before the damage shows."""
    view, size = memoryview(data), len(data)
    for step in (CHUNK, 1):
        unpack, parts, fed = zlib.decompressobj(31), [], at
        try:
            # An error takes a chunk's bytes with it: up to the chunk it is in whole chunks, then single bytes.
            while not unpack.eof and fed < size:
                width = CHUNK if step == CHUNK or fed + CHUNK <= safe else 1
                parts.append(unpack.decompress(view[fed : fed + width]))
                fed = min(fed + width, size)
        except zlib.error as e:
            safe, problem = fed, f"member: {e}"
            continue
        return b"".join(parts), fed - len(unpack.unused_data), "" if unpack.eof else "member is cut off"
    return b"".join(parts), fed, problem


def _named(headers: dict) -> bool:
    """Whether the headers of a record of :func:`record` are those its name was made of; True for other records."""
    if "x-page-id" not in headers:
        return True
    digest = headers.get("warc-payload-digest", "").partition(":")[2]
    name = uuid.uuid5(_SPACE, f"{headers['x-page-id']}\n{headers.get('warc-target-uri')}\n{digest}")
    return headers.get("warc-record-id") == f"<urn:uuid:{name}>"


def _inside(plain: bytes, checked: bool) -> Iterator[tuple[int, int, dict | str]]:
    """(start, end, record or reason of a gap) over a member's bytes. Unless they are ``checked`` by its checksum, a
    record must have a digest of its payload, and headers that fit its name."""
    at, gap_start, reason = 0, None, ""
    while at < len(plain):
        one = _parse(plain, at)
        got = one if isinstance(one, str) else _fields(one[0], one[1])
        if isinstance(got, dict) and not checked and not (_named(one[0]) and re.match(r"sha(1|256):", one[0].get("warc-payload-digest", ""), re.I)):
            got = "record can't be checked"
        if isinstance(got, dict):
            if gap_start is not None:
                yield gap_start, at, reason
                gap_start = None
            yield at, one[2], got
            at = one[2]
            continue
        if gap_start is None:
            gap_start, reason = at, got
        line = _VERSION_LINE.search(plain, at + 1)
        at = line.start() if line else len(plain)
    if gap_start is not None:
        yield gap_start, len(plain), reason


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """(offset, length, record or reason of a gap) from start to end of an archive; what is whole is never skipped.

    Offsets and lengths are of the archive. The records of a member all have the member's; so has a gap inside one,
    whose reason then says which of the unpacked bytes it is. A damaged member reaches up to what is whole after it.
    """
    at, size, gap_start, reasons = 0, len(data), None, []
    # The next places to go on at, remembered until they are passed: a search to the end is made once.
    magic = line = 0
    # Of a damaged member: its records, their bytes, and how far it was read.
    parts, raw, reached = [], set(), 0
    while at < size:
        found, damaged = None, None
        if data.startswith(MAGIC, at):
            plain, end, problem = _unpacked(data, at)
            inside = list(_inside(plain, not problem or problem == "member is cut off"))
            whole = [x for x in inside if isinstance(x[2], dict)]
            reached = end if problem else reached
            gaps = [f"bytes {a} to {b} of the unpacked member: {x}" for a, b, x in inside if isinstance(x, str)]
            if not problem and (whole or not plain):
                found = (end, [*(x[2] for x in whole), *gaps])
            elif whole:
                damaged = ([x[2] for x in whole], {plain[a:b] for a, b, _ in whole}, [problem, *gaps])
            elif not problem:
                problem = inside[0][2]
        elif _VERSION_LINE.match(data, at):
            one = _parse(data, at)
            got = one if isinstance(one, str) else _fields(one[0], one[1])
            if isinstance(got, str):
                problem = got
            elif at < reached and data[at : one[2]] in raw:
                problem = "record of a damaged member that holds it unpacked"
            elif at < reached and not _named(one[0]):
                problem = "record can't be checked"
            else:
                found = (one[2], [got])
        else:
            problem = "neither a member nor a version line"
        if found or damaged:
            if gap_start is not None:
                for one in [*parts, *reasons]:
                    yield gap_start, at - gap_start, one
                gap_start, parts, raw = None, [], set()
        if found:
            for one in found[1]:
                yield at, found[0] - at, one
            at = found[0]
            continue
        if damaged:
            gap_start, (parts, raw, reasons) = at, damaged
        if gap_start is None:
            gap_start, reasons = at, [problem]
        if magic <= at:
            magic = data.find(MAGIC, at + 1)
            magic = size if magic < 0 else magic
        if line <= at:
            found = _VERSION_LINE.search(data, at + 1)
            line = found.start() if found else size
        at = min(magic, line)
    if gap_start is not None:
        for one in [*parts, *reasons]:
            yield gap_start, size - gap_start, one


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records and gaps of the archives below ``path``: :data:`RECORD_SCHEMA`.

    A gap has its archive, offset, length and reason, and no record; a record has no gap. A task holds one archive at
    a time (Spark reads files of up to 2 GB so). ``payloads=False`` leaves the payloads out.
    """
    names = [f.split()[0] for f in RECORD_SCHEMA.replace("\n", " ").split(",")]
    schema = pa.schema([(n, {"page_id": pa.int64(), "offset": pa.int64(), "length": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, size = [], 0
                for offset, length, got in salvage(content.as_py()):
                    one = dict.fromkeys(names) | {"archive": archive, "offset": offset, "length": length}
                    one |= {"gap": got} if isinstance(got, str) else got
                    if not payloads:
                        one["payload"] = None
                    size += len(one["payload"] or b"")
                    rows.append(one)
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, RECORD_SCHEMA)


def archived(pages: DataFrame, gzip: bool = True, min_shared: int = MIN_SHARED) -> DataFrame:
    """``pages`` written to archives in the shared scratch folder and read back, without payloads."""
    spark = pages.sparkSession
    path = scratch_folder(spark, "warc")
    write_archives(pages, path, gzip, min_shared)
    return read_archives(spark, path, payloads=False)
