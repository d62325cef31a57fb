"""WARC archives: a writer with revisit records, and a reader that salvages damaged archives.

The writer packs records into archives of bounded size and leaves them to
Spark's text writer, one archive per file, so that commits and retries are
Spark's. The reader takes whole archives, plain or with one gzip member per
record, and checks every record; after a failed check it searches for the next
member or version line whose record passes, and reports the bytes between as a
quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import batched
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.llm.common import written

#: Fixed values of the format.
VERSION, END, GZIP = b"WARC/1.1\r\n", b"\r\n\r\n", b"\x1f\x8b\x08"
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What the reader returns for each record and gap.
RECORDS = pa.schema([(n, pa.string()) for n in ("archive", "kind", "reason", "url", "record_type", "payload_digest")]
                    + [(n, pa.int64()) for n in ("offset", "length", "page_id", "refers_to", "payload_bytes")]
                    + [("payload", pa.binary())])


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def zip_member(data: bytes) -> bytes:
    """A gzip member, the same in every run."""
    made = zlib.compressobj(1, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def _page_of(value: bytes | None):
    found = re.fullmatch(rb"<urn:page:(-?\d+)>", (value or b"").strip())
    return int(found[1]) if found else None


def make_record(page_id, url, payload: bytes | None, digest: str, size: int, refers_to=None,
                date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record without its closing blank lines; a revisit carries the HTTP header only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block += payload if refers_to is None else b""
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block


def with_revisits(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """page_id, url, payload, refers_to: the response for revisits, whose payload is dropped before records are made."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    # equal payloads are those of one length and two digests: SHA-1 alone can be made to collide
    marks = {"sha": F.unhex(F.sha1("payload")), "md5": F.unhex(F.md5("payload")), "bytes": F.length("payload")}
    rows = rows.withColumns(marks)
    firsts = (rows.filter(F.col("bytes") >= min_bytes).groupBy(*marks)
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select(*marks, "first"))
    # as a table its size is known: few copies are broadcast, and payloads then stay where they are read
    joined = rows.join(written(firsts, "firsts"), list(marks), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.length("payload") >= min_bytes)
    return joined.select("page_id", "url", F.length("payload").cast("long").alias("size"), "sha",
                         F.when(again, F.col("first")).alias("refers_to"),
                         F.when(~again, F.col("payload")).alias("payload"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = 8 << 20, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html", member_records: int = 0, torn_every: int = 0) -> None:
    """Write one record per row of ``pages`` to WARC files under ``path``, plain or with a gzip member for ``member_records`` records.

    The text writer's line end closes the last record, or follows the last
    member. With ``torn_every``, the first half of every so many-th record stands once
    more before it, as an interrupted and resumed writer leaves it.

    Of rows with equal payloads of at least ``min_bytes``, those with the
    smallest id are responses and the others revisit it; rows without an id are
    responses unless an equal payload has one. A null payload is empty, a null
    url leaves its header out. Archives hold about ``archive_bytes``; a larger
    record has an archive of its own.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def archive(records):
            if member_records:
                members = [zip_member(b"".join(r + END for r in some)) for some in batched(records, member_records)]
                return pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["archive"])
            return pa.RecordBatch.from_arrays([pa.array([END.join(records)], pa.binary())], ["archive"])
        held, size = [], 0
        for n, r in enumerate(row for batch in batches for row in batch.to_pylist()):
            digest = base64.b32encode(r["sha"]).decode()
            record = make_record(r["page_id"], r["url"], r["payload"], digest, r["size"], r["refers_to"])
            if held and size + len(record) > archive_bytes:
                yield archive(held)
                held, size = [], 0
            if torn_every and n % torn_every == torn_every - 1:
                held.append(record[:len(record) // 2])
                size += len(held[-1])
            held.append(record)
            size += len(record)
        if held:
            yield archive(held)

    rows = with_revisits(pages, min_bytes, id_col, url_col, payload_col)
    (rows.mapInArrow(pack, "archive binary").select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", END.decode()).option("maxRecordsPerFile", 1).text(path))


def _headers(data: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in data.split(b"\r\n"))
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse_record(data: bytes, at: int):
    """(end, record) of the checked record at ``at`` in plain bytes; ValueError says which check failed."""
    if not START.match(data, at) or data.startswith(GZIP, at):
        raise ValueError("no version line")
    first = data.index(b"\r\n", at) + 2
    stop = data.find(END, at)
    if stop < 0:
        raise ValueError("header without an end")
    head = _headers(data[first:stop])
    length = head.get(b"content-length", b"")
    if not length.isdigit():
        raise ValueError("no content length")
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end:end + 4] != END:
        raise ValueError("length does not lead to a record end")
    block = data[begin:end]
    want = head.get(b"warc-block-digest", b"").decode("latin-1")
    if want.startswith("sha1:") and want[5:] != base32_sha1(block):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(END) if block.startswith(b"HTTP/") else (b"", b"", block)
    kind = head.get(b"warc-type", b"").decode("latin-1")
    digest = head.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:")
    size = len(payload)
    if kind == "revisit":
        declared = _headers(http).get(b"content-length", b"")
        size, payload = int(declared) if declared.isdigit() else None, None
    elif digest and digest != base32_sha1(payload):
        raise ValueError("payload digest differs")
    url = head.get(b"warc-target-uri")
    return end + 4, {"page_id": _page_of(head.get(b"warc-record-id")), "url": url and url.decode("latin-1"),
                     "record_type": kind, "refers_to": _page_of(head.get(b"warc-refers-to")),
                     "payload_digest": digest or base32_sha1(payload or b""), "payload_bytes": size, "payload": payload}


def _member(data: bytes, at: int, max_bytes: int, step: int = 1 << 16) -> tuple[int | None, bytes, str]:
    """(end, content, fault) of the gzip member at ``at``; the end is None, and the content what came before the fault, if a check fails."""
    unzip, content, size, fault = zlib.decompressobj(31), [], 0, ""
    while not unzip.eof and at < len(data) and size <= max_bytes and not fault:
        # small bites, so that a broken one takes little of the sound content with it
        for p in range(at, min(at + step, len(data)), 1 << 10):
            try:
                content.append(unzip.decompress(data[p:min(p + (1 << 10), at + step)]))
            except zlib.error as e:
                fault = f"gzip: {e}"
                break
            size += len(content[-1])
            if unzip.eof:
                break
        else:
            at = min(at + step, len(data))
            continue
        at = min(p + (1 << 10), at + step, len(data))
    if not unzip.eof and not fault:
        fault = "gzip: member without an end, or too long"
    return None if fault else at - len(unzip.unused_data), b"".join(content), fault


def _inside(content: bytes) -> Iterator[tuple[str, int, int, object]]:
    """Records and gaps of plain bytes: after a failed check, on from the next version line whose record passes."""
    at, gap, reason = 0, None, ""
    while at < len(content):
        try:
            end, record = parse_record(content, at)
        except ValueError as e:
            if gap is None:
                gap, reason = at, str(e)
            following = START.search(content, at + 1)
            at = following.start() if following else len(content)
            continue
        if gap is not None:
            yield "gap", gap, at - gap, reason
            gap = None
        yield "record", at, end - at, record
        at = end
    if gap is not None:
        yield "gap", gap, len(content) - gap, reason


def salvage(data: bytes, max_member: int = 1 << 30) -> Iterator[tuple[str, int, int, object]]:
    """(kind, offset, length, record or reason) for records and gaps.

    Offsets and lengths are bytes of the archive: records and gaps together
    cover every byte. Records that share a gzip member share its offset and
    length. Within a member the search goes on as outside: a sound member's
    faulty bytes are reported as 'inner gap' with the member's place, and of a
    member that breaks off or is damaged the records before its fault are
    kept, while its bytes are a gap.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        zipped = data.startswith(GZIP, at)
        try:
            if zipped:
                end, content, fault = _member(data, at, max_member)
                found = [x for x in _inside(content) if x[0] == "record" or not fault]
                if not any(kind == "record" for kind, *_ in found) or fault:
                    for _, _, _, record in found if fault else ():
                        yield "record", at, 0, record
                    raise ValueError(fault or (found[0][3] if found else "gzip: empty member"))
                end += len(data[end:end + 4]) - len(data[end:end + 4].lstrip(b"\r\n"))  # line ends behind a member are its own
            else:
                end, record = parse_record(data, at)
                found = [("record", 0, 0, record)]
        except ValueError as e:
            if gap is None:
                gap, reason = at, str(e)
            following = START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield "gap", gap, at - gap, reason
            gap = None
        for kind, begin, size, what in found:
            if kind == "record":
                yield "record", at, end - at, what
            else:
                yield "inner gap", at, end - at, f"{size} bytes from {begin} on within the member: {what}"
        at = end
    if gap is not None:
        yield "gap", gap, len(data) - gap, reason


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows of RECORDS: kind 'record' for each record that passes its checks, kinds 'gap' and 'inner gap' for quarantined bytes.

    A gap's offset, length and reason say what was skipped and which check
    failed first; records after it are recovered, within gzip members too (see
    ``salvage``). Empty files give no rows. Version lines are what the search
    goes by: a damaged plain record whose payload holds a whole sound record
    gives that one; members of one record each hide payloads from the search.
    One archive is read whole, so archives should be of bounded size, as
    ``write_archives`` makes them; a gzip member may unfold to 1 GB.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path"), batch.column("content")):
                for some in batched(salvage(content.as_py()), 256):
                    yield pa.RecordBatch.from_pylist(
                        [{"archive": archive.as_py(), "kind": kind, "offset": offset, "length": length}
                         | ({"reason": what} if kind != "record" else what) for kind, offset, length, what in some], RECORDS)
    files = spark.read.format("binaryFile").load(path)
    schema = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else f.type}" for f in RECORDS)
    return files.select("path", "content").mapInArrow(parse, schema)
