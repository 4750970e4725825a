import base64
import gzip
import hashlib
import io
import random
from collections import defaultdict
from pathlib import Path

import pytest

from prevascope.llm import warc
from prevascope.llm.common import table
from tests.conftest import SAMPLE
from tests.llm.rows import rows


def brute(data):
    groups = defaultdict(list)
    for page_id, _, html in data:
        groups[html or ""].append(page_id)
    out = []
    for page_id, _, html in data:
        raw = (html or "").encode()
        keep = max(groups[html or ""], key=lambda i: (i is not None, i))
        again = page_id != keep
        out.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", keep if again else None))
    return sorted(out, key=repr)


def read(spark, path):
    cast = ["cast(page_id as long)", "payload_bytes", "payload_digest", "record_type", "cast(refers_to as long)"]
    return rows(warc.read_archives(spark, path).selectExpr(*cast))


def test_sample_round_trip(spark):
    pages = table(spark, SAMPLE, "pages")
    path = warc.write_archives(pages)
    data = [tuple(r) for r in pages.collect()]
    assert read(spark, path) == brute(data)
    read_back = {(int(r.page_id), bytes(r.payload).decode()) for r in warc.read_archives(spark, path).where("payload is not null").collect()}
    assert read_back <= {(p, h or "") for p, _, h in data}


def test_awkward_rows(spark):
    big = "".join(chr(33 + i * 7919 % 90) for i in range(1000)) * 20_000
    data = [
        (1, "http://a.example/ä b\r\nX: y", "<p>ü</p>"), (2, None, "<p>ü</p>"), (2, None, "<p>ü</p>"), (3, "http://b.example", None),
        (4, "", ""), (None, "http://c.example", "no id"), (5, "http://d.example", big), (6, "http://d.example", "\r\n\r\n" * 9),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'x' as payload", "1 as sha1")
    path = warc.write_archives(pages)
    assert read(spark, path) == brute(data)
    assert read(spark, warc.write_archives(pages.limit(0))) == []


def test_files_are_plain_gzip_members(spark):
    data = [(i, f"http://x.example/{i}", f"<p>{i}</p>" * 50) for i in range(30)]
    path = warc.write_archives(spark.createDataFrame(data, "page_id long, url string, html string"))
    text = b"".join(gzip.decompress(f.read_bytes()) for f in Path(path.removeprefix("file:")).glob("part-*") if f.stat().st_size)
    assert text.count(b"WARC-Type: response\r\n") == 30
    assert all(f"<p>{i}</p>".encode() * 50 in text for i in range(30))


def test_files_are_cut_by_bytes(spark):
    rng = random.Random(3)
    data = [(i, f"http://x.example/{i}", rng.randbytes(60_000 if i != 17 else 900_000).hex()) for i in range(60)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").coalesce(2)
    path = warc.write_archives(pages, file_bytes=500_000, file_records=40)
    files = [f for f in Path(path.removeprefix("file:")).glob("part-*") if f.stat().st_size]
    assert len(files) > 10
    for f in files:
        text = gzip.decompress(f.read_bytes())
        n = text.count(b"WARC-Type: response\r\n")
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and 1 <= n < 40
        assert f.stat().st_size <= 500_000 + 40 or n == 1
    assert read(spark, path) == brute(data)
    assert read(spark, warc.write_archives(pages, file_records=7)) == brute(data)
    assert warc.read_archives(spark, path, payloads=False).where("payload is not null").count() == 0


class Slow(io.BytesIO):
    """Gives at most three bytes at a time."""

    def read(self, n=-1):
        return super().read(min(n, 3) if n >= 0 else 3)


def records(content, source=io.BytesIO, keep=True):
    return [warc.read_record(more, keep) for more in warc.members(source(content))]


def test_records_in_pieces():
    date = "2024-01-01T00:00:00Z"
    payloads = [b"", b"a", b"\r\n\r\n", b"x" * 70_000, random.Random(1).randbytes(200_000)]
    content = warc.write_info(date) + b"".join(
        warc.write_record(i, None, p, None, False, date) + b"\0" * i for i, p in enumerate(payloads)
    )
    for source in (io.BytesIO, Slow):
        assert [r["payload"] for r in records(content, source)][1:] == payloads
    assert [r["payload_bytes"] for r in records(content, keep=False)][1:] == list(map(len, payloads))
    assert not any(r["payload"] for r in records(content, keep=False))
    pieces = [len(x) for more in warc.members(io.BytesIO(content)) for x in iter(more, b"")]
    assert max(pieces) <= warc.READ_BYTES


def test_damage_is_found():
    whole = warc.write_record(1, "http://a.example", b"payload", None, False, "2024-01-01T00:00:00Z")
    assert [r["payload"] for r in records(whole)] == [b"payload"]
    plain = gzip.decompress(whole)
    for bad in (plain.replace(b"payload\r\n", b"pAyload\r\n"), plain[:-1], plain + b"x", plain[:20], b"HTTP" + plain[4:],
                plain.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9")):
        with pytest.raises(warc.WarcError):
            records(gzip.compress(bad))
    for bad in (whole[:-9], b"no archive" + whole, whole + whole[:30]):
        with pytest.raises(warc.WarcError):
            records(bad)
