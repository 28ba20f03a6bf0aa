"""Archives are written, found by their index, and read back whole."""

import hashlib

import pytest

from gradeflow.llm import warc


@pytest.fixture
def pages(spark):
    long, other = "<p>" + "x" * 2000, "é" * 600
    rows = [
        (1, "http://a/\r\nInjected: 1", long, "response"), (5, "http://b", long, "x"), (3, None, long, "x"), (None, "http://c", long, "x"),
        (7, "http://d", None, "x"), (8, "http://e", "", "x"), (9, "http://f", "short", "x"), (10, "http://g", "short", "x"),
        (11, "http://h", other, "x"), (12, "http://i", other, "x"), (12, "http://i", other, "x"), (20, "http://j", "WARC/1.1\r\n\r\n" * 300, "x"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")


def test_round_trip(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 3000)
    monkeypatch.setattr(warc, "BUNDLE", 400)
    index = warc.written(pages.repartition(3), f"{tmp_path}/bundles")
    found = warc.read_back(index).collect()
    told = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in found), key=repr)
    assert told == sorted(
        [(0, "response", None), (1, "revisit", 5), (3, "revisit", 5), (5, "response", None), (7, "response", None), (8, "response", None), (9, "response", None), (10, "response", None), (11, "revisit", 12), (12, "response", None), (12, "response", None), (20, "response", None)],
        key=repr,
    )
    bodies = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    for r in found:
        assert r.payload is None or bytes(r.payload) == bodies[r.page_id]
        assert r.payload_bytes == len(bodies[r.page_id]) and r.payload_digest == hashlib.sha1(bodies[r.page_id]).hexdigest()
    assert index.select("bundle").distinct().count() > 1 and index.agg({"frame": "max"}).first()[0] > 0
    for page_id in (1, 12, 20):
        assert {r["page_id"] for r in warc.lookup(index, page_id)} == {page_id}
    assert len(warc.lookup(index, 12)) == 2 and warc.lookup(index, 4) == []


def test_bundles_are_plain_zstandard(pages, tmp_path):
    import io

    import zstandard

    index = warc.written(pages.coalesce(1), f"{tmp_path}/bundles")
    with open(index.first().bundle.removeprefix("file://"), "rb") as file:
        data = file.read()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain.count(b"WARC-Record-ID") == 12


def test_empty(spark, pages, tmp_path):
    assert warc.archived(pages.where("false")).count() == 0


def test_frames_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 3000)
    monkeypatch.setattr(warc, "FRAMES", 4)
    pages = spark.range(60).selectExpr("id AS page_id", "concat('http://', id) AS url", "repeat(concat('<p>', id), 300) AS html")
    found = warc.read_back(warc.written(pages, f"{tmp_path}/bundles"))
    assert found.rdd.getNumPartitions() > 3 and found.count() == 60
