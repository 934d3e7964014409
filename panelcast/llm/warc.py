"""Web archives: pages written as records, long ones in segments, and put together again."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.staging import drop, small_batches, staged

VERSION = b"WARC/1.1\r\n"
#: Ends a record when written. When read, it is taken with the start of the next record.
END, NEXT = "\r\n\r\n", "\r\n\r\nWARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_ID = re.compile(r"<urn:page:(-?[0-9]*):([A-Z2-7]+)>")


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_name(page, digest: str) -> str:
    """A record's id; a revisit can name the record it refers to, since that has the same payload."""
    return f"<urn:page:{'' if page is None else page}:{digest}>"


def page_of(name: str) -> int | None:
    found = _ID.fullmatch(name)
    return int(found[1]) if found and found[1] else None


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in the framing of a chunked transfer."""
    parts = [payload[i: i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; ``ValueError`` if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size: at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its length says")
        out.append(body[at: at + size])
        at += size + 2


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without the two line breaks that end it."""
    lines = [*headers, ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block


def page_records(page, url: str | None, payload: bytes, refers_to, segment: int, chunk: int) -> list[bytes]:
    """A page's records: one revisit, or a response whose block is continued in further records beyond ``segment`` bytes."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = record_name(page, digest)
    common = [("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        common.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    if refers_to is not None:
        extra = [("WARC-Refers-To", record_name(refers_to, digest)), ("WARC-Profile", PROFILE), ("Content-Type", "application/http; msgtype=response")]
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common, *extra], HTTP)]
    block = HTTP + chunked(payload, chunk)
    parts = [block[i: i + segment] for i in range(0, len(block), segment)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common, ("Content-Type", "application/http; msgtype=response")]
    if len(parts) == 1:
        return [record(first, block)]
    out = [record([*first, ("WARC-Segment-Number", "1")], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        headers = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{number}>"), ("WARC-Date", "2024-01-01T00:00:00Z"),
            ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(number)),
        ]
        if number == len(parts):
            headers.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record(headers, part))
    return out


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0,
    segment: int = 8192, chunk: int = 4096, records_per_file: int = 20_000,
) -> None:
    """Write a record per page into ``.gz`` archives below ``path``, by Spark's own committed writes to any file system.

    Of pages whose payloads are equal and have ``least`` bytes or more, that with the smallest id becomes the response and the others
    revisit it. Digests are grouped in a narrow table; only page ids of revisits are joined to the pages, hashed and not sorted.
    Null html is an empty payload. Rows that repeat id and html have the same record id, and each is read back; a null id is kept as such
    and sorts last.
    """
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    version = F.xxhash64("payload").alias("version")  # tells the rows of one page apart, at less cost than a digest
    narrow, at_narrow = staged(
        rows.select("page_id", version, F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes")).filter(F.col("bytes") >= least), "digests"
    )
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    again = (
        narrow.join(first, "digest").filter("page_id IS NULL OR page_id <> first")
        .select(F.col("page_id").alias("again_id"), F.col("version").alias("again_version"), "first").distinct()
    )
    marked = rows.withColumn("version", version).join(
        again.hint("shuffle_hash"), F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("version") == F.col("again_version")), "left"
    )

    def run(batches):
        for batch in batches:
            out = [
                r for page, url, payload, first in zip(*(batch.column(i).to_pylist() for i in range(4)))
                for r in page_records(page, url, payload, first, segment, chunk)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    (
        marked.select("page_id", "url", "payload", "first").mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", END).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )
    drop(pages.sparkSession, at_narrow)


RECORD = "name string, type string, origin string, number int, total long, refers_to string, digest string, uri string, block binary, problem string"


def _parse(raw: bytes) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.strip().lower()] = value.strip()

    def whole(key):
        value = fields.get(key, "")
        return int(value) if value.isdigit() else None

    length, problem = whole("content-length"), None
    if length is None or len(rest) < length:
        problem = "the record ends before its length"
    name = fields.get("warc-record-id")
    digest = fields.get("warc-payload-digest")
    return (
        name, fields.get("warc-type"), fields.get("warc-segment-origin-id", name), whole("warc-segment-number"), whole("warc-segment-total-length"),
        fields.get("warc-refers-to"), digest.removeprefix("sha1:") if digest else None, fields.get("warc-target-uri"), rest[: length or 0], problem,
    )


def _complete(raw: bytes) -> bool:
    """Whether the record has as many bytes as its header says (or no length that could be waited for)."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        return False
    length = re.search(rb"\r\ncontent-length:[ \t]*([0-9]+)[ \t]*(?:\r\n|$)", head, re.I)
    return length is None or len(rest) >= int(length[1])


def _records(batches):
    """Records from the lines of archives in order. A payload may hold what separates records: lengths decide."""
    path = pending = None

    for batch in batches:
        out = []
        for at, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at != path:
                if pending is not None:
                    out.append(_parse(pending))
                path, pending = at, piece
            elif _complete(pending):
                out.append(_parse(pending))
                pending = b"WARC/1." + piece
            else:
                pending += NEXT.encode() + piece
        if out:
            yield _record_rows(out)
    if pending is not None:
        yield _record_rows([_parse(pending)])


def _record_rows(out):
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, kinds = zip(*(c.split() for c in RECORD.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*out), kinds)], names=list(names))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path`` as they are, segments apart: see :data:`RECORD`.

    An archive streams through one task record by record (a compressed file cannot be split); none is held whole.
    """
    small_batches(spark)
    lines = spark.read.option("lineSep", NEXT).text(path)
    return lines.select(F.col("_metadata.file_path"), F.col("value").cast("binary")).mapInArrow(_records, RECORD)


def _payload(block: bytes, digest: str | None, kind: str, problem: str | None) -> tuple:
    """Payload, its digest, and what is wrong."""
    if problem or kind != "response":
        return None, digest, problem
    head, _, body = block.partition(b"\r\n\r\n")
    try:
        payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError as error:
        return None, digest, f"chunked framing: {error}"
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (payload, own, None) if digest in (None, own) else (None, own, "the payload has another digest")


PAGE = "name string, type string, uri string, refers_to string, digest string, payload binary, problem string"


def _page_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PAGE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "payload" else pa.string()) for n, c in zip(names, zip(*rows))], names=names)


def _whole(batches):
    for batch in batches:
        if batch.num_rows:
            yield _page_rows([
                (name, kind, uri, refers, *_swap(_payload(block, digest, kind, problem)))
                for name, kind, refers, digest, uri, block, problem in zip(*(batch.column(i).to_pylist() for i in range(7)))
            ])


def _swap(found: tuple) -> tuple:
    payload, digest, problem = found
    return digest, payload, problem


def _reassembled(table: pa.Table) -> pa.Table:
    """A page from the segments of one origin: numbers without a gap, total length as announced, then the payload.

    Where rows of pages repeat, each segment comes as many times, and so does the page.
    """
    parts, problem, times = {}, None, Counter(table.column("number").to_pylist())
    for row in table.to_pylist():
        problem = problem or row["problem"]
        if parts.setdefault(row["number"], row)["block"] != row["block"]:
            problem = problem or "two segments have one number"
    order = sorted(parts, key=lambda n: (n is None, n))
    first, last = parts[order[0]], parts[order[-1]]
    block = b"".join(parts[n]["block"] for n in order)
    if order != list(range(1, len(order) + 1)):
        problem = problem or "a segment is missing"
    elif last["total"] != len(block):
        problem = problem or "the segments' total length is not what the last one says"
    done = _payload(block, first["digest"], first["type"], problem)
    if len(set(times.values())) > 1:
        done = (None, done[1], problem or "segments come a different number of times")
    page = (first["origin"], first["type"], first["uri"], first["refers_to"], *_swap(done))
    return pa.Table.from_batches([_page_rows([page] * min(times.values()))])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit of the archives: ``name, type, uri, refers_to, digest, payload, problem``.

    Segments are grouped by the record they continue, ordered by number, checked against the announced total, joined, and freed
    of chunked framing; a group is one page, as often as it was written. Records in one piece need no shuffle. A broken record is not
    dropped: its ``problem`` says what is wrong and its payload is null.
    """
    records = read_records(spark, path)
    single = records.filter("number IS NULL AND type IN ('response', 'revisit')").select("name", "type", "refers_to", "digest", "uri", "block", "problem")
    segmented = records.filter("number IS NOT NULL").groupBy("origin").applyInArrow(_reassembled, PAGE)
    return single.mapInArrow(_whole, PAGE).unionByName(segmented)
