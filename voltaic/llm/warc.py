"""WARC archives: one gzip member per record, written and read in tasks.

Writing: pages with equal payloads become one ``response`` (smallest page id)
and ``revisit`` records that name it. Files of about ``file_bytes`` are written
to shared storage; the manifest lists them. Reading is sequential: a file is
decompressed incrementally, member by member, in pieces of fixed size; the
header block is read up to its blank line, the content by its declared length,
and the declared digests are verified against the bytes. A damaged record
raises.

The payload is the html in UTF-8; a null or empty html is a payload of 0 bytes
and takes part like any other when ``least_bytes`` is 0. A null page id sorts
after all others. Of repeated rows (equal page id and payload) one is the
response, the others revisit it. Further columns are ignored. Urls are written
percent-encoded where they hold spaces or line breaks; a null url is left out.
"""
from __future__ import annotations

import base64
import functools
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltaic.llm.common import Scratch, ship, slices
from voltaic.llm.files import new_name, reading, writing

VERSION = b"WARC/1.1"
#: Bytes read and decompressed at a time.
PIECE = 1 << 18
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    head += f"Content-Length: {len(block)}\r\n\r\n".encode()
    gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gzip.compress(head) + gzip.compress(block) + gzip.compress(b"\r\n\r\n") + gzip.flush()


class Members:
    """Byte stream over the members of a gzip file, a bounded piece at a time."""

    def __init__(self, source):
        self.source, self.raw, self.plain = source, b"", b""
        self.gzip, self.ended = None, False

    def next_member(self) -> bool:
        """Start the next member; False at the end of the file."""
        if self.plain or (self.gzip is not None and not self.gzip.eof):
            raise ValueError("bytes after the record's end")
        if not self.raw:
            self.raw = self.source.read(PIECE)
        if not self.raw:
            return False
        self.gzip = zlib.decompressobj(31)
        return True

    def _more(self) -> bool:
        if self.gzip.eof:
            return False
        data = self.gzip.unconsumed_tail or self.raw or self.source.read(PIECE)
        if not self.gzip.unconsumed_tail:
            self.raw = b""
        if not data:
            raise ValueError("a member ends too early")
        self.plain += self.gzip.decompress(data, PIECE)
        if self.gzip.eof:
            self.raw = self.gzip.unused_data + self.raw
        return True

    def line(self) -> bytes:
        while b"\r\n" not in self.plain:
            if not self._more():
                raise ValueError("a header line without an end")
        out, _, self.plain = self.plain.partition(b"\r\n")
        return out

    def take(self, length: int) -> bytes:
        pieces, have = [], 0
        while have < length:
            if not self.plain and not self._more():
                raise ValueError("content shorter than its length")
            piece = self.plain[: length - have]
            self.plain = self.plain[len(piece) :]
            pieces.append(piece)
            have += len(piece)
        return b"".join(pieces)

    def end(self) -> None:
        if self.take(4) != b"\r\n\r\n":
            raise ValueError("no record end after the content")
        while self._more():
            pass


def records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, in file order."""
    members = Members(source)
    while members.next_member():
        if not members.line().startswith(b"WARC/"):
            raise ValueError("no WARC record")
        headers = {}
        while line := members.line():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = members.take(int(headers["content-length"]))
        members.end()
        declared = headers.get("warc-block-digest")
        if declared and declared != f"sha1:{digest(block)}":
            raise ValueError(f"block digest of {headers.get('warc-record-id')} differs")
        yield headers, block


def _record_id(page: str) -> str:
    return f"<urn:page:{page}>"


def _write(folder: str, file_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write the rows of a partition; yields name, records and bytes of each file."""
    pending = (r for b in batches for part in slices(b, 2) for r in part.to_pylist())
    row = next(pending, None)
    while row is not None:
        name, count, size = new_name(folder, ".warc.gz"), 0, 0
        with writing(name) as out:
            while row is not None and size < file_bytes:
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                page = "null" if row["page_id"] is None else str(row["page_id"])
                block = b"" if row["revisit"] else payload
                headers = [("WARC-Type", "revisit" if row["revisit"] else "response")]
                headers += [("WARC-Record-ID", _record_id(page)), ("WARC-Date", "1970-01-01T00:00:00Z")]
                if row["url"] is not None:
                    url = "".join("%%%02X" % ord(c) if c <= " " else c for c in row["url"])
                    headers.append(("WARC-Target-URI", url))
                if row["revisit"]:
                    first = "null" if row["first"] is None else str(row["first"])
                    headers += [("WARC-Refers-To", _record_id(first)), ("WARC-Profile", REVISIT_PROFILE)]
                headers += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("X-Payload-Length", str(len(payload)))]
                headers += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "text/html; charset=utf-8")]
                size += out.write(made) if (made := record(headers, block)) else 0
                count += 1
                row = next(pending, None)
        yield pa.RecordBatch.from_pydict({"file": [name], "records": [count], "bytes": [size]})


def write(
    pages: DataFrame,
    scratch: Scratch,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    file_bytes: int = 64 << 20,
) -> DataFrame:
    """Write the archives; returns the stored manifest ``(file, records, bytes)``.

    The html moves in one shuffle by (id, payload), keys that are spread however
    often a payload repeats; only ids and digests meet in the grouping by payload.
    """
    ship(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("string").alias("page_id"),
        F.col(id_col).alias("order"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).alias("html"),
        F.sha2(F.coalesce(F.encode(html_col, "utf-8"), F.lit(b"")), 256).alias("payload"),
        F.coalesce(F.octet_length(html_col), F.lit(0)).alias("length"),
    )
    light = rows.where(F.col("length") >= least_bytes).select("order", "payload")
    firsts = light.groupBy("payload").agg(F.min("order").alias("first"), F.count("*").alias("n"))
    firsts = scratch.store(firsts.where("n > 1").select("payload", "first"), "firsts")
    repeated = scratch.store(light.distinct().join(firsts, "payload"), "repeated")
    copies = Window.partitionBy("order", "payload").orderBy("url")
    joined = rows.alias("r").join(
        repeated.alias("f"), (F.col("r.payload") == F.col("f.payload")) & F.col("r.order").eqNullSafe(F.col("f.order")), "left"
    )
    planned = joined.select("r.*", "f.first", F.col("f.payload").isNotNull().alias("again"))
    planned = planned.withColumn("copy", F.row_number().over(copies))
    revisit = F.col("again") & (~F.col("first").eqNullSafe(F.col("order")) | (F.col("copy") > 1))
    planned = planned.select("page_id", "url", "html", revisit.alias("revisit"), F.col("first").cast("string").alias("first"))
    run = functools.partial(_write, scratch.folder("warc"), file_bytes)
    return scratch.store(planned.mapInArrow(run, "file string, records long, bytes long"), "manifest")


def _page(urn: str | None) -> str | None:
    page = None if urn is None else urn.removeprefix("<urn:page:").removesuffix(">")
    return None if page == "null" else page


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name in batch.column(0).to_pylist():
            with reading(name) as source:
                rows, size = [], 0
                for headers, block in records(source):
                    kind = headers["warc-type"]
                    declared = headers["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and (digest(block) != declared or len(block) != int(headers["x-payload-length"])):
                        raise ValueError(f"payload digest of {headers['warc-record-id']} differs")
                    rows.append({
                        "page_id": _page(headers["warc-record-id"]),
                        "url": headers.get("warc-target-uri"),
                        "record_type": kind,
                        "refers_to": _page(headers.get("warc-refers-to")),
                        "payload_digest": declared,
                        "payload_bytes": int(headers["x-payload-length"]),
                        "payload": block if kind == "response" else None,
                    })
                    size += len(block)
                    if size > PIECE * 16 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)


_READ = pa.schema([
    ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])


def read(manifest: DataFrame) -> DataFrame:
    """Records of the files in ``manifest``, one task per some files; payloads of responses included."""
    ship(manifest.sparkSession)
    schema = (
        "page_id string, url string, record_type string, refers_to string, "
        "payload_digest string, payload_bytes long, payload binary"
    )
    files = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(_read, schema)
