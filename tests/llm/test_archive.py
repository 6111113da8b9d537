"""ARC and WARC records: both versions, exact round trips, damage, revisits."""

import base64
import gzip
import hashlib
import zlib

import pytest

from tempolake.llm import archive


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_arc_files(version, packed):
    blocks = [b"", b"plain\n\nfiledesc://x 1 2 3 4", archive._HTTP + "é\r\n\r\n\n".encode(), b"x" * 600_000]
    fields = {
        "URL": "http://a/b", "IP-address": "1.2.3.4", "Archive-date": "19970102030405",
        "Content-type": "text/html", "Result-code": "200",
    }
    parts = [archive.arc_version_block(version, "f.arc", "19970101000000")]
    parts += [archive.arc_record(version, fields, b) for b in blocks]
    raw = b"".join(p + b"\n" for p in parts)
    if packed:  # several members, as archives have them
        raw = b"".join(gzip.compress(p + b"\n") for p in parts)
    got = list(archive.read_arc(raw))
    assert [b for _, b in got] == blocks
    assert all(f["URL"] == "http://a/b" and f["Archive-date"] == "19970102030405" for f, _ in got)


def test_damaged_archives_raise():
    block = archive.arc_version_block(1, "f.arc", "19970101000000") + b"\n"
    with pytest.raises(ValueError, match="version block"):
        list(archive.read_arc(b"http://a 1.1.1.1 1997 text/html 3\nabc\n"))
    with pytest.raises(ValueError, match="fields"):
        list(archive.read_arc(block + b"http://a b 1.1.1.1 1997 text/html 3\nabc\n"))
    with pytest.raises(ValueError, match="within a record"):
        list(archive.read_arc(block + b"http://a 1.1.1.1 1997 text/html 9\nabc\n"))
    with pytest.raises(ValueError, match="within a line"):
        list(archive.read_arc(block + b"http://a 1.1.1.1"))
    with pytest.raises(ValueError, match="version"):
        list(archive.read_warc(b"HTTP/1.1 200\r\n\r\n"))
    assert list(archive.read_arc(b"")) == list(archive.read_warc(b"")) == []


def test_dates_and_identifiers():
    assert archive.iso_date("19970102030405") == "1997-01-02T03:04:05Z"
    assert archive.iso_date("19970102") == "1997-01-02T00:00:00Z"
    assert archive.iso_date("1997") == "1997-01-01T00:00:00Z"
    one = archive.record_id("http://a", "1997", "X")
    assert one == archive.record_id("http://a", "1997", "X") != archive.record_id("http://b", "1997", "X")


def test_pages_round_trip(spark):
    pages = [
        (1, "http://a.example/x y", "<p>one</p>"), (2, "http://a.example/2", "<p>one</p>"),
        (3, None, "two\r\n\r\nWARC/1.0\r\n\r\n"), (4, "http://é.example/#f", None), (5, "", ""),
        (6, "http://c", "HTTP/1.1 200 OK\r\n\r\nbody"), (7, "http://d", "long " * 300_000),
        (8, "http://d", "\n" * 9), (None, "http://e", "<p>one</p>"), (None, "http://f", "alone"),
        (9, "http://g", "same row"), (9, "http://g", "same row"),
    ]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, date string")
    got = archive.convert_pages(frame).collect()
    assert len(got) == len(pages)
    by = {}
    for row in got:
        by.setdefault(row.page_id, []).append(row)
    for page_id, _, html in pages:
        for row in by[page_id]:
            if page_id is not None:
                assert row.payload_bytes == len((html or "").encode())
                assert row.payload_digest == digest(html or "")
                if row.record_type == "response":
                    assert bytes(row.payload) == (html or "").encode()
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got if r.page_id is not None}
    assert kinds == {
        1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("revisit", 5),
        5: ("response", None), 6: ("response", None), 7: ("response", None), 8: ("response", None),
        9: ("response", None),
    }
    unnamed = {r.payload_digest: r for r in by[None]}
    assert unnamed[digest("<p>one</p>")].refers_to == 2
    assert unnamed[digest("alone")].record_type == "response"
    assert archive.convert_pages(frame.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    from tempolake.llm.queries import op3_warc

    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    largest = {}
    for p in pages:
        key = digest(p.html or "")
        largest[key] = max(largest.get(key, p.page_id), p.page_id)
    got = {r.page_id: r for r in op3_warc(spark, folder).collect()}
    assert len(got) == len(pages)
    for p in pages:
        row, key = got[p.page_id], digest(p.html or "")
        kept = largest[key]
        assert (row.payload_bytes, row.payload_digest) == (len((p.html or "").encode()), key)
        assert row.refers_to == (None if kept == p.page_id else kept)
        assert row.record_type == ("response" if kept == p.page_id else "revisit")


def test_marks_in_urls_and_shared_ids(spark):
    pages = [
        (None, "http://a/#page_id=abc", "one"), (None, "http://a/#page_id=7", "two"),
        (7, "http://b/#page_id=9", "three"), (8, "http://c", "three"), (8, "http://c", "three"),
        (8, "http://d", "three"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = archive.convert_pages(frame).collect()
    found = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_digest) for r in got)
    three = digest("three")
    assert found == sorted(
        [(0, "response", 0, digest("one")), (0, "response", 0, digest("two"))]
        + [(7, "revisit", 8, three)] + [(8, "response", 0, three)] * 3
    )


def test_a_payload_that_most_pages_share(spark):
    frame = spark.range(3000).selectExpr(
        "id AS page_id", "concat('http://h/', id) AS url", "if(id % 10 < 7, '', string(id)) AS html"
    )
    got = archive.convert_pages(frame).collect()
    empty = [r for r in got if r.payload_bytes == 0]
    assert len(empty) == 2100 and len(got) == 3000
    assert {r.page_id for r in empty if r.record_type == "response"} == {2996}
    assert {r.refers_to for r in empty if r.record_type == "revisit"} == {2996}


def test_files_are_packed_at_the_set_level(spark, tmp_path):
    html = "".join(f"<p>{hashlib.sha1(str(n % 700).encode()).hexdigest()[: n % 40]} {n}" for n in range(9000))
    pages = spark.createDataFrame([(1, "http://a", html)], "page_id long, url string, html string")
    archive.write_arc(pages.coalesce(1), str(tmp_path / "arc"))
    archive.to_warc(archive.read_arc_records(spark, str(tmp_path / "arc")).coalesce(1), str(tmp_path / "warc"))
    for kind in ("arc", "warc"):
        file = max((tmp_path / kind).glob("part-*"), key=lambda f: f.stat().st_size)
        raw = gzip.decompress(file.read_bytes())
        assert html.encode() in raw
        level = {n: abs(len(zlib.compress(raw, n)) - file.stat().st_size) for n in (1, 4, 6)}
        assert level[4] == min(level.values()) < level[6]
