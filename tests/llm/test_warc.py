import base64
import hashlib

import pytest

from wickwork.llm import warc

PAGES = [(0, "http://a/é x", "<p>same</p>"), (1, None, "<p>same</p>"), (2, "http://b/\r\nX: y", "<p>other é</p>\r\n\r\nWARC/1.1\r\n"), (3, "c", None), (4, "d", ""), (5, "e", "z" * 100_000), (6, "f", "<p>same</p>")]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, sha string, first long").repartition(2)


def expected(rows, least=0):
    out = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "")]
        first = max(same)
        response = len(raw) < least or i == first
        out[i] = (i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if response else "revisit", None if response else first)
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = {r["page_id"]: tuple(r) for r in warc.round_trip(frame(spark), min_bytes=least).collect()}
    assert got == expected(PAGES, least)


def test_payloads_come_back(spark):
    folder = warc.new_folder(spark)
    index = warc.write(frame(spark), folder, archive_bytes=300)
    assert index.select("archive").distinct().count() > 1
    html = {i: h for i, _, h in PAGES}
    for r in warc.read(index, folder).collect():
        assert r["payload"] is None if r["record_type"] == "revisit" else r["payload"].decode() == (html[r["page_id"]] or "")
    some = warc.read(index.where("page_id in (2, 5)"), folder).collect()
    assert sorted(r["page_id"] for r in some) == [2, 5]


def test_ranges_are_merged():
    assert warc.ranges([(0, 10), (10, 5), (100, 5), (1000, 1)], gap=90, span=500) == [(0, 105, [(0, 10), (10, 5), (100, 5)]), (1000, 1, [(1000, 1)])]
    assert len(warc.ranges([(0, 10), (10, 10), (20, 10)], gap=0, span=20)) == 2


def test_damage_is_found(spark):
    raw = warc.record(1, "u", b"payload", None, True, "2000-01-01T00:00:00Z")
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw.replace(b"payload\r", b"payloud\r"))


def test_odd_rows(spark):
    rows = [(None, "a", "x"), (None, "a", "x"), (1, "b", "y"), (1, "b", "y"), (2, "c", "y")]
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"] or 0) for r in warc.round_trip(frame(spark, rows)).collect())
    assert got == [("1", "revisit", 2), ("1", "revisit", 2), ("2", "response", 0), ("None", "response", 0), ("None", "response", 0)]
    assert warc.round_trip(frame(spark).limit(0)).count() == 0
