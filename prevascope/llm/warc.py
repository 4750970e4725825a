"""Web archives: one gzip member per record, written by Spark's file committer and read back in sequence.

Spark's text sink writes the bytes of each member as they are and commits files only when their task
has succeeded. It ends each row with a separator of one byte, here zero: a member of under 16 MiB ends
in a zero byte anyway (the top byte of its length), which is taken off before; after a longer one the
zero is padding, which readers of gzip skip.

Files are cut by bytes as well as by records. The sink starts a new file after a fixed number of rows, so a file that is
full early gets empty rows, zeros at its end, up to that number. Every file starts with a ``warcinfo`` record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prevascope.llm.common import bounded_batches
from prevascope.session import materialise, scratch_path

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 4
READ_BYTES = 1 << 16
FILE_BYTES, FILE_RECORDS = 64 << 20, 5000
_BREAK = b"\r\n\r\n"
_ID = "urn:page:"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _http(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)


def _uri(key: object) -> str:
    return f"<{_ID}{quote(str(key), safe='') if key is not None else 'null'}>"


def write_record(key: object, url: str | None, payload: bytes, refers_to: object, revisit: bool, date: str) -> bytes:
    """One record as one gzip member."""
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _uri(key), "WARC-Date": date}
    if url:
        head["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(33, 127))))
    head["WARC-Payload-Digest"] = f"sha1:{digest_of(payload)}"
    block = _http(payload)
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _uri(refers_to)}
    else:
        block += payload
    head |= {"WARC-Block-Digest": f"sha1:{digest_of(block)}", "Content-Type": "application/http; msgtype=response"}
    return _member(head, block)


def write_info(date: str) -> bytes:
    """The record that says what a file is, as one gzip member."""
    block = b"format: WARC File Format 1.1\r\nsoftware: prevascope\r\n"
    head = {"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:info:pages>", "WARC-Date": date}
    return _member(head | {"WARC-Block-Digest": f"sha1:{digest_of(block)}", "Content-Type": "application/warc-fields"}, block)


def _member(head: dict[str, str], block: bytes) -> bytes:
    head = head | {"Content-Length": str(len(block))}
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items())
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + _BREAK) + press.flush()


class WarcError(ValueError):
    """An archive whose framing or digests do not hold."""


def members(source: BinaryIO) -> Iterator[Callable[[], bytes]]:
    """The gzip members of an archive in sequence, each as a function that gives its next bytes, none at its end.

    Neither what is read nor what comes out of it at once exceeds ``READ_BYTES``.
    """
    raw = b""
    while True:
        raw = raw.lstrip(b"\0")  # padding after a member
        if not raw:
            raw = source.read(READ_BYTES)
            if not raw:
                return
            continue
        unpack = zlib.decompressobj(31)

        def more() -> bytes:
            nonlocal raw
            while not unpack.eof:
                raw = raw or source.read(READ_BYTES)
                if not raw:
                    raise WarcError("the archive ends within a record")
                try:
                    out = unpack.decompress(raw, READ_BYTES)
                except zlib.error as error:
                    raise WarcError(str(error)) from None
                raw = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
                if out:
                    return out
            return b""

        yield more
        while more():
            pass


class _Bytes:
    """Bytes by marks and lengths from a function that gives the next ones."""

    def __init__(self, more: Callable[[], bytes]):
        self.more, self.held = more, bytearray()

    def _grow(self) -> None:
        piece = self.more()
        if not piece:
            raise WarcError("a record is shorter than it says")
        self.held += piece

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (cut := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            self._grow()
        head = bytes(self.held[:cut])
        del self.held[: cut + len(mark)]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        while n > 0:
            if not self.held:
                self._grow()
            piece = bytes(self.held[:n])
            del self.held[:n]
            n -= len(piece)
            yield piece

    def ends_with(self, mark: bytes) -> bool:
        rest = bytes(self.held)
        while len(rest) <= len(mark) and (piece := self.more()):
            rest += piece
        return rest == mark


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def read_record(more: Callable[[], bytes], keep: bool = True) -> dict:
    """Headers, payload (if to ``keep``) and its length of one record, read piece by piece.

    Raises ``WarcError`` if framing or a digest that is given is wrong. The payload is what stands after the HTTP headers, of
    other kinds of records the whole block; a revisit has none, and its length is what the HTTP headers state.
    """
    data = _Bytes(more)
    first, *lines = data.until(_BREAK).split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise WarcError("no record header")
    headers = _fields(lines)
    try:
        length = int(headers["content-length"])
    except (KeyError, ValueError):
        raise WarcError("no content length") from None
    block, body = hashlib.sha1(), hashlib.sha1()
    http, left = {}, length
    if headers.get("content-type", "").startswith("application/http"):
        head = data.until(_BREAK)
        left -= len(head) + len(_BREAK)
        if left < 0:
            raise WarcError(f"content length {length} does not fit the record")
        block.update(head + _BREAK)
        http = _fields(head.split(b"\r\n")[1:])
    parts, size = [], left
    for piece in data.take(left):
        block.update(piece)
        body.update(piece)
        if keep:
            parts.append(piece)
    if not data.ends_with(_BREAK):
        raise WarcError(f"content length {length} does not fit the record")
    revisit = headers.get("warc-type") == "revisit"
    for name, made in (("warc-block-digest", block), ("warc-payload-digest", None if revisit else body)):
        if made and name in headers and headers[name] != f"sha1:{base64.b32encode(made.digest()).decode()}":
            raise WarcError(f"{name} differs")
    stated = int(http.get("content-length", size)) if revisit else size
    return {"headers": headers, "payload": b"".join(parts) if keep and not revisit else None, "payload_bytes": stated}


def _key(uri: str | None) -> str | None:
    if uri is None:
        return None
    key = unquote(uri.strip("<>").removeprefix(_ID))
    return None if key == "null" else key


def _packed(date: str, file_bytes: int, file_records: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = used = 0  # of the current file
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                member = write_record(row[0], row[1], row[2], row[3], row[4], date)
                if rows > 1 and used + len(member) > file_bytes:
                    out += [b""] * (file_records - rows)
                    rows = 0
                rows %= file_records
                if not rows:
                    out.append(write_info(date)[:-1])
                    rows, used = 1, len(out[-1])
                out.append(member[:-1] if not member[-1] else member)
                rows, used = rows + 1, used + len(member)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    return run


def _unpacked(keep: bool):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for more in members(io.BufferedReader(pa.BufferReader(content.as_buffer()))):
                    record = read_record(more, keep)
                    h = record["headers"]
                    if h.get("warc-type") == "warcinfo":
                        continue
                    rows.append((
                        _key(h.get("warc-record-id")), record["payload_bytes"], h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                        h.get("warc-type"), _key(h.get("warc-refers-to")), h.get("warc-target-uri"), record["payload"],
                    ))
                    held += len(record["payload"] or b"")
                    if held > 4 << 20 or len(rows) >= 1000:
                        yield packed(rows)
                        rows, held = [], 0
                if rows:
                    yield packed(rows)

    return run


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha1, refers_to of the pages whose payload a page with a larger id has too."""
    raw = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    ids = pages.select("page_id", F.sha1(raw).alias("sha1"), F.octet_length(raw).cast("long").alias("n"))
    ids = materialise(ids.where(F.col("n") >= least_bytes), "digests")
    keep = F.max(F.struct("page_id")).alias("keep")
    groups = ids.groupBy("sha1", "n").agg(F.count(F.lit(1)).alias("size"), keep)
    groups = materialise(groups.where("size > 1"), "payload-groups")
    others = ids.join(groups, ["sha1", "n"]).where(~F.col("page_id").eqNullSafe(F.col("keep.page_id")))
    return materialise(others.select("page_id", "sha1", F.col("keep.page_id").alias("refers_to")).distinct(), "revisits")


def write_archives(
    pages: DataFrame, path: str | None = None, least_bytes: int = 0, file_bytes: int = FILE_BYTES,
    file_records: int = FILE_RECORDS, date: str = "1970-01-01T00:00:00Z",
) -> str:
    """Write a record for every row of ``pages`` (page_id, url, html) and return the folder.

    A file has at most ``file_records`` records (2 at least), and ``file_bytes`` unless a single record is larger.

    Of pages with equal payloads of ``least_bytes`` or more, that with the largest page_id is written as a
    response, the others as revisits of it; rows that repeat that page_id too are responses. A null
    html is an empty payload; a null page_id is an id of its own below all others; a null url leaves
    the target out. An empty table gives an archive without records.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    pages = pages.select("page_id", "url", "html")
    raw = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    known = pages.select("page_id", "url", raw.alias("payload"), F.sha1(raw).alias("sha1"))
    twins = revisits(pages, least_bytes)
    on = known["page_id"].eqNullSafe(twins["page_id"]) & (known["sha1"] == twins["sha1"])
    rows = known.join(twins, on, "left").select(
        known["page_id"], "url", "payload", "refers_to", twins["sha1"].isNotNull().alias("revisit")
    )
    path = path or scratch_path(spark, "warc")
    file_records = max(file_records, 2)  # the first tells what the file is
    packed = rows.mapInArrow(_packed(date, file_bytes, file_records), "member binary")
    packed = packed.select(F.col("member").cast("string").alias("value"))
    packed.write.option("lineSep", "\0").option("maxRecordsPerFile", file_records).text(path)
    return path


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload.

    Ids are text as written. Every record's framing and digests are verified; a wrong one raises
    ``WarcError``. payload is null for revisits, and for all records without ``payloads``: then a task holds a piece of a
    record at a time. A file is one value of the scan, which ``file_bytes`` bounds; ``warcinfo`` records are left out.
    """
    bounded_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(
        _unpacked(payloads),
        "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string, payload binary",
    )
