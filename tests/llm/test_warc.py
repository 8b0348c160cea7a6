import gzip
import hashlib
import zlib

import pytest

from millrace.llm import warc

from .odd import clashing, real

PAGES = "page_id long, url string, html string"


def slow(rows):
    first = {}
    for r in rows:
        p = (r.html or "").encode()
        if len(p) >= 1000 and r.page_id is not None:
            first[p] = max(first.get(p, r.page_id), r.page_id)
    out = []
    for r in rows:
        p = (r.html or "").encode()
        to = first.get(p)
        revisit = to is not None and r.page_id != to
        out.append((str(r.page_id), len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", str(to) if revisit else "None"))
    return sorted(out)


def result(df):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in df.collect())


def odd_pages(spark):
    long = "<p>é</p>" * 400
    rows = [(1, "http://a", long), (2, None, long), (2, None, long), (3, "x\r\ny: %z é", "short"), (4, "u", "short"), (5, "u", None), (6, None, ""), (None, "u", long), (None, "u", "x" * 2000), (None, None, "x" * 2000), (7, "u", "WARC/1.1\r\n\r\n" * 300), (8, "u", "a" * 3_000_000)]
    return spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize("split", [50, 700, 8 << 20])
def test_round_trip_of_odd_pages(spark, split):
    pages = odd_pages(spark).repartition(2)
    found = warc.read(warc.write(clashing(pages)), split)
    assert result(found) == slow(pages.collect())
    urls = sorted((str(r.page_id), str(r.url)) for r in found.collect())
    assert urls == sorted((str(r.page_id), str(r.url)) for r in pages.collect())


@pytest.mark.parametrize("rows", [0, 100_000])
def test_real_pages(spark, rows):
    pages = real(spark, "pages", "0.01")
    pages = pages.union(pages.selectExpr("page_id + 1000", "url", "html"))
    assert result(warc.read(warc.write(pages, broadcast_rows=rows), 20_000)) == slow(pages.collect())


def test_empty_table(spark):
    assert warc.read(warc.write(odd_pages(spark).limit(0))).count() == 0


def test_false_magic_is_passed_over(tmp_path):
    """Gzip magic in the data, and gzip members that hold no record."""
    records = [warc.record(i, "u", bytes([31, 139, 8]) * 50 + bytes(range(i)), "00" * 20, None, False) for i in range(5)]
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    raw = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\n" + warc.MAGIC * 3 + b"\r\n\r\n"
    records.append(stored.compress(raw) + stored.flush())
    data = gzip.compress(b"no record") + b"\x1f\x8b\x08 junk" + b"".join(records)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    for step in (1, 3, 7, 64, len(data)):
        found = [raw for low in range(0, len(data), step) for _, raw in warc.records_in(str(path), low, low + step)]
        assert found == [zlib.decompress(r, 31) for r in records]


def test_archives_are_plain_gzip(spark):
    archives = warc.write(odd_pages(spark)).collect()
    text = b"".join(gzip.open(a.path.removeprefix("file://")).read() for a in archives)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 12
