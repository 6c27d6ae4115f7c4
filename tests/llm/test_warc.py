"""Archives: exact round trips, roles against their definition, damaged and foreign input."""

import glob
import gzip
import hashlib
import zlib

import pytest

from civicledger.llm import warc
from civicledger.llm.common import Scratch

PAGES = [(1, "http://a/1", "x" * 200), (2, "http://a/2", "x" * 200), (3, None, "short"), (4, "u\r\nInjected: 1", "short"),
         (5, "http://a/5", None), (6, "http://a/6", ""), (7, "http://a/7", "é\r\n\r\nWARC/1.1\r\n" * 30),
         (None, "http://a/8", "é\r\n\r\nWARC/1.1\r\n" * 30), (1, "http://a/1", "x" * 200), (9, "h", "long " * 60000)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string")


def expected():
    out = []
    for pid, _, html in PAGES:
        raw = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == raw and p is not None]
        first = min(same, default=None)
        revisit = len(raw) >= 100 and first is not None and pid != first and (pid is not None or same)
        out.append((pid, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(map(str, out))


def test_pages_survive_archives(spark, pages):
    assert sorted(str(tuple(r)) for r in warc.archive_pages(spark, pages).collect()) == expected()
    assert warc.archive_pages(spark, pages.where("false")).collect() == []


def test_every_record_is_a_member_and_indexed(spark, pages):
    s = Scratch(spark, "t")
    warc.write_archives(pages.coalesce(1), s.path("mono"), records_per_file=4)
    index = s.stage(warc.normalise(spark, s.path("mono"), s.path("out")), "index")
    folder = s.path("out").removeprefix("file:")
    names = sorted(glob.glob(f"{folder}/*.warc.gz"))
    assert len(names) == 3 and not glob.glob(f"{folder}/_*")
    assert sorted(map(str, index.collect())) == sorted(map(str, warc.read_index(spark, s.path("out")).collect()))
    whole = b""
    for n in names:
        with open(n, "rb") as f:
            raw = f.read()
        whole += gzip.decompress(raw)
        for r in index.where(index.archive == n.rsplit("/", 1)[1]).collect():
            rec = zlib.decompress(raw[r.offset:r.offset + r.length], 31)
            assert rec.startswith(b"WARC/1.1\r\n") and rec.endswith(b"\r\n\r\n")
    mono = b"".join(gzip.open(n).read() for n in sorted(glob.glob(s.path("mono").removeprefix("file:") + "/*.gz")))
    assert sorted(warc.records([whole], "")) == sorted(warc.records([mono], ""))
    back = {(r.page_id, r.url, r.payload.decode()) for r in warc.read_records(index, s.path("out")).collect()
            if r.record_type == "response"}
    assert (7, "http://a/7", PAGES[6][2]) in back and (4, "u Injected: 1", "short") in back and (3, None, "short") in back


def test_streams_of_any_blocks_and_members():
    rec = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    data = gzip.compress(rec * 3) + gzip.compress(rec)
    for step in (1, 7, 1 << 18):
        assert list(warc.records(warc.inflate(data, "x", step), "x")) == [rec] * 4
    assert list(warc.records(warc.inflate(b"", "x"), "x")) == []
    with pytest.raises(ValueError, match="arch"):
        list(warc.inflate(data[:-9], "arch"))
    with pytest.raises(ValueError, match="arch"):
        list(warc.records([rec[:-3]], "arch"))
