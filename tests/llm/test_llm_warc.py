import gzip
import hashlib

import pytest

from tickweave.llm import warc

SCHEMA = "page_id long, url string, html string, place string, digest string"


def archived(spark, rows, folder, **settings):
    frame = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    warc.write_archive(frame, folder, "2024-01-01T00:00:00Z", **settings)
    return warc.read_archive(spark, folder).collect()


BIG, OTHER = "<p>é</p>" * 40, "<b>x\r\n\r\nWARC/1.1\r\n</b>" * 30


def test_revisits_refer_to_the_smallest_page(spark, folder):
    rows = [(7, "http://a/7", BIG), (3, "http://a/3", BIG), (9, None, BIG), (4, "http://a/4", OTHER)]
    rows += [(1, "u", "short"), (2, "u", "short"), (5, "u", None), (6, "u", "")]
    got = {r["page_id"]: r for r in archived(spark, rows, folder())}
    assert {p: r["record_type"] for p, r in got.items()} == {
        7: "revisit", 3: "response", 9: "revisit", 4: "response", 1: "response", 2: "response",
        5: "response", 6: "response",
    }
    assert got[7]["refers_to"] == got[9]["refers_to"] == 3 and got[3]["refers_to"] is None
    for page, _, html in rows:
        payload = (html or "").encode()
        assert got[page]["payload_bytes"] == len(payload)
        assert got[page]["payload_digest"] == hashlib.sha256(payload).hexdigest()
    records = warc.read_records(spark, folder())
    revisit = records.filter("page_id = 7").first()
    assert revisit["payload_digest"] is None and revisit["payload_bytes"] == len(BIG.encode())
    assert records.select("record_id").distinct().count() == len(rows)


def test_odd_pages(spark, folder):
    rows = [
        (None, "http://n/ a\r\nX: y", BIG), (5, "http://n/5", BIG), (5, "http://n/5", BIG), (8, None, None),
        (6, "ü", "x" * 3_000_000), (None, None, None),
    ]
    got = archived(spark, rows, folder("a"))
    assert len(got) == len(rows)
    big = [r for r in got if r["payload_bytes"] == len(BIG.encode())]
    assert sorted(r["record_type"] for r in big) == ["response", "revisit", "revisit"]
    assert all(r["refers_to"] == 5 for r in big if r["record_type"] == "revisit")
    assert not any("\n" in (r["url"] or "") for r in got)
    assert archived(spark, [], folder("b")) == []


def test_files_are_plain_warc_and_bounded(spark, folder):
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>" * 50) for i in range(200)]
    archived(spark, rows, folder(), part_bytes=20_000)
    files = [r["content"] for r in spark.read.format("binaryFile").load(f"{folder()}/part-*").collect()]
    assert len(files) >= 10
    parsed = [x for f in files for x in warc.parse_records(gzip.decompress(f))]
    assert len(parsed) == 200 and all(x[0]["warc-type"] == "response" for x in parsed)


def test_broken_records_are_refused():
    with pytest.raises(ValueError):
        list(warc.parse_records(b"HTTP/1.1 200 OK\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabcd\r\n\r\n"))
