"""WARC archives: written through Spark's text writer, read back by a reader that salvages damaged files.

A record that fails a check does not end the reading: the reader searches for the next version line or
compressed member that passes all checks, goes on there, and logs the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.memory import tidy

SMALLEST_REVISIT = 1000
RECORDS_PER_FILE = 2000
#: Fixed values of the format.
VERSION, END, MEMBER = b"WARC/1.", b"\r\n\r\n", b"\x1f\x8b\x08"
#: A member without content, and the eight bytes of its checksum and size that end it.
EMPTY, EMPTY_END = zlib.compress(b"", 9, 31)[:-8], bytes(8)
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
VERSION_LINE = re.compile(rb"WARC/1\.\d+\r\n")
#: The one field that may stand in a header more than once.
REPEATABLE = "warc-concurrent-to"


def _records(pages: DataFrame, id_col: str, url_col: str, html_col: str, date: str) -> DataFrame:
    """One column ``value``: the record of each page without the closing line ends."""
    page = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")) \
        .withColumns({"n": F.octet_length("html"), "same": F.sha2("html", 256)})
    groups = page.filter(F.col("n") >= SMALLEST_REVISIT).groupBy("same") \
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    page = page.join(groups, "same", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("html")))

    def field(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))

    def name_of(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    return page.withColumn("revisit", revisit).withColumn("block", block).select(F.concat(
        F.lit("WARC/1.0\r\n"),
        field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        field("WARC-Record-ID", name_of("page_id")),
        field("WARC-Date", date),
        field("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        F.when(F.col("revisit"), F.concat(field("WARC-Refers-To", name_of("first_id")), field("WARC-Profile", PROFILE)))
        .otherwise(""),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("html"))),
        field("WARC-Payload-Length", F.col("n").cast("string")),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1("block"))),
        field("Content-Type", "application/http; msgtype=response"),
        field("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", date: str = "1970-01-01T00:00:00Z",
                   records_per_file: int = RECORDS_PER_FILE, compress: bool = True) -> None:
    """Write a record per row of ``pages`` to archives in ``path``, which every executor must reach.

    Of rows with equal payloads of at least 1000 bytes the one with the largest id is a response and the others
    are revisits that refer to it; smaller payloads are all responses. Null payloads are empty. Rows with a
    null id rank last; if all ids of equal payloads are null, or rows repeat, each of them is a response. Line
    ends in an URL become a space. Other columns are ignored. An empty table gives no records. ``compress``
    makes each record a compressed member of its own, else records are plain. An empty member follows each record: its
    last bytes are the separator that the text writer puts after a value, so any reader of compressed files reads on.
    """
    def members(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first in range(0, part.num_rows, 1000):
                made = []
                for record in part["value"].slice(first, 1000).to_pylist():
                    engine = zlib.compressobj(6, zlib.DEFLATED, 31)
                    made.append(engine.compress(record.encode() + END) + engine.flush() + EMPTY)
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    records = _records(pages, id_col, url_col, html_col, date)
    if compress:  # the writer puts the bytes of the value as they are
        records = records.mapInArrow(tidy(members), "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", (EMPTY_END if compress else END).decode()) \
        .option("maxRecordsPerFile", records_per_file).text(path)


def _sha1(digest: str) -> bytes | None:
    """The SHA-1 that a header states in 40 hex digits or 32 base32 characters; None for any other form."""
    name, _, value = digest.partition(":")
    try:
        if name.lower() == "sha1" and len(value) in (32, 40):
            return bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value, casefold=True)
    except ValueError:
        pass
    return None


def _names(lines: bytes) -> set[str]:
    return {x.partition(":")[0].strip().lower() for x in lines.decode("utf-8", "replace").split("\r\n") if ":" in x}


def _runs_on(head: bytes) -> bool:
    """Whether a header was cut off and runs into that of another record.

    A version line may also end the value of a field, as that of an URL. It begins another record if what stands
    before it in its line is no field, or if a field stands on both sides of it.
    """
    for inner in VERSION_LINE.finditer(head, 1):
        before, after = head[:inner.start()], head[inner.end():]
        if b":" not in before[before.rfind(b"\r\n") + 2:] or _names(before) & _names(after) - {REPEATABLE}:
            return True
    return False


def _parse(data: bytes, at: int, last: bool) -> tuple[dict, bytes, int] | str:
    """Fields, block and end of the plain record at ``at``; or what is wrong with it."""
    if not VERSION_LINE.match(data, at):
        return "no version line"
    stop = data.find(END, at)
    if stop < 0:
        return "no end of the header"
    head = data[at:stop + 2]
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines[1:]) if colon}
    if not fields.get("content-length", "").isdigit():
        return "no content length"
    start = stop + len(END)
    end = start + int(fields["content-length"])
    if data[end:end + len(END)] != END and not (last and end == len(data)):
        return "block does not end where it should"
    block = data[start:end]
    digest = _sha1(fields.get("warc-block-digest", ""))
    if digest and digest != hashlib.sha1(block).digest():
        return "block digest differs"
    if _runs_on(head):
        return "another record begins in the header"
    return fields, block, min(end + len(END), len(data))


def _member(data: memoryview, at: int) -> tuple[bytes, int] | str:
    """Content and end of the compressed member at ``at``; or what is wrong with it."""
    engine, out, fed = zlib.decompressobj(31), [], at
    try:
        while not engine.eof:
            piece = data[fed:fed + (1 << 16)]
            if not len(piece):
                return "member is cut off"
            out.append(engine.decompress(piece))
            fed += len(piece)
    except zlib.error as error:
        return f"member is damaged: {error}"
    return b"".join(out), fed - len(engine.unused_data)


def _record(data: bytes, view: memoryview, at: int) -> tuple[dict | None, bytes, int] | str:
    """As ``_parse``, for plain and compressed records; an empty member has no fields."""
    if data.startswith(MEMBER, at):
        got = _member(view, at)
        if isinstance(got, str):
            return got
        content, end = got
        if not content:
            return None, b"", end
        inner = _parse(content, 0, last=True)
        if isinstance(inner, str):
            return inner
        return (inner[0], inner[1], end) if inner[2] == len(content) else "member holds more than a record"
    return _parse(data, at, last=False)


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes, str]]:
    """offset, length, fields (None for a gap), block and what was wrong, in order, for all bytes of an archive.

    Line ends and empty members between records belong to neither. Records may be plain or compressed one by one.
    """
    view, at, gap, why = memoryview(data), 0, -1, ""
    while at < len(data):
        if gap < 0 and data.startswith(b"\r\n", at):
            at += 2
            continue
        got = _record(data, view, at)
        if not isinstance(got, str):
            if gap >= 0:
                yield gap, at - gap, None, b"", why
            if got[0] is not None:
                yield at, got[2] - at, got[0], got[1], ""
            at, gap = got[2], -1
            continue
        if gap < 0:
            gap, why = at, got
        found = [x for x in (data.find(VERSION, at + 1), data.find(MEMBER, at + 1)) if x >= 0]
        at = min(found, default=len(data))
    if gap >= 0:
        yield gap, len(data) - gap, None, b"", why


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives in ``path`` and folders below, one row each.

    file, offset, length, status (record or gap), reason (of a gap), record_type, record_id, refers_to, url,
    payload_digest, payload_bytes, and payload if ``payloads``. A response whose payload does not have the
    digest its header states is a gap too. Digests are SHA-1 in hex or base32; others are not checked.
    ``payload_digest`` is SHA-1 in hex; a revisit's stated digest of another form stays as it is. Files and
    folders whose names start with _ or . are left out. Empty folders and files give no rows.
    """
    columns = ("file string, offset long, length long, status string, reason string, record_type string, "
               "record_id string, refers_to string, url string, payload_digest string, payload_bytes long")
    named = re.compile(r"<urn:page:(.*)>")

    def row(file: str, offset: int, length: int, fields: dict | None, block: bytes, why: str) -> tuple:
        if fields is not None:
            kind = fields.get("warc-type", "")
            body = block.partition(END)[2] if "application/http" in fields.get("content-type", "") else block
            digest = fields.get("warc-payload-digest", "")
            sha1 = _sha1(digest)
            digest = sha1.hex() if sha1 else digest
            size = int(fields["warc-payload-length"]) if fields.get("warc-payload-length", "").isdigit() else None
            if kind == "revisit":
                body = None
            elif sha1 and hashlib.sha1(body).digest() != sha1:
                fields, why = None, "payload digest differs"
            else:
                digest, size = hashlib.sha1(body).hexdigest(), len(body)
        if fields is None:
            return (file, offset, length, "gap", why, *[None] * 7)
        ids = [m[1] if (m := named.fullmatch(fields.get(k, ""))) else fields.get(k)
               for k in ("warc-record-id", "warc-refers-to")]
        return (file, offset, length, "record", None, kind, *ids, fields.get("warc-target-uri"), digest, size, body)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in
                            (x.split() for x in columns.split(", "))] + [("payload", pa.binary())] * payloads)
        for part in parts:
            for file, content in zip(part["path"], part["content"], strict=True):
                rows = []
                for found in salvage(content.as_py() or b""):
                    rows.append(row(file.as_py(), *found)[:len(schema)])
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(tidy(batches), columns + ", payload binary" * payloads)
