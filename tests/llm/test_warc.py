import gzip
import os
import zlib

import pytest

from paperloom.llm import warc


@pytest.fixture
def pages(spark):
    rows = [(1, "http://a/x", "<p>é</p>"), (2, None, None), (None, "http://b", ""), (3, "u", "WARC/1.0\r\n\r\nContent-Length: 5\r\n\r\n"), (3, "u", "twice"), (4, "big", "x\r\n\r\n" * 400_000)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, member_offset string")


def test_round_trip(spark, pages):
    got = sorted((r["page_id"] or 0, r["url"], r["body_bytes"], r["error"]) for r in warc.rewritten(pages.repartition(3)).collect())
    assert got == sorted((r["page_id"] or 0, r["url"] or "-", len((r["html"] or "").encode()), None) for r in pages.collect())
    assert warc.rewritten(pages.filter("page_id > 9")).collect() == []


def test_members(tmp_path):
    records = [warc.record(i, f"http://x/{i}", "body %d " % i * i) for i in range(50)]
    one = tmp_path / "a.warc.gz"
    one.write_bytes(gzip.compress(b"".join(records)))
    to, index, error = warc.normalise_file(str(one))
    assert error is None and len(index) == 50
    raw = open(to, "rb").read()
    assert gzip.decompress(raw) == b"".join(records)  # still one file
    for (a, n), r in zip(index, records):
        assert zlib.decompress(raw[a : a + n], 31) == r
    side = [tuple(map(int, x.split())) for x in open(to + ".idx")]
    assert side == index
    # members in, the same out
    two = tmp_path / "b.warc.gz"
    two.write_bytes(b"".join(gzip.compress(r) for r in records))
    assert warc.normalise_file(str(two))[1] == index
    assert not [f for f in os.listdir(tmp_path) if f.count(".") > 4]


@pytest.mark.parametrize("cut", [5, 300, -9, -1])
def test_damage(tmp_path, cut):
    path = tmp_path / "c.warc.gz"
    path.write_bytes(gzip.compress(b"".join(warc.record(i, "u", "text %d" % i) for i in range(30)))[:cut])
    _, index, error = warc.normalise_file(str(path))
    assert error and len(index) <= 30


def test_no_length(spark, tmp_path):
    path = tmp_path / "d.warc.gz"
    path.write_bytes(gzip.compress(warc.record(1, "u", "ok") + b"WARC/1.0\r\nX: 1\r\n\r\nbody"))
    rows = warc.read_back(warc.normalised(spark.createDataFrame([(str(path),), (None,)], "file string"))).collect()
    assert [(r["page_id"], r["error"] is None) for r in rows] == [(1, True), (None, False)]
