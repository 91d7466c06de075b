import hashlib
import zlib

import duckdb
import pytest

from sparkfeat.llm import warc


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    rows = [("http://a.example/x", "1.2.3.4", "20010203040506", "text/html", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\n\nURL IP"),
            ("dns:a.example", "0.0.0.0", "2001", "text/dns", b""), ("http://b/", "0.0.0.0", "20010203040507", "text/html", b"\n\n\n")]
    data = warc.arc_archive("t.arc", version, rows)
    got = list(warc.parse_arc(data))
    assert [(r.url, r.ip, r.date, r.content_type, r.body) for r in got] == rows
    if version == 2:
        offset = int(got[1].extra["Offset"])
        assert data[offset:].startswith(b"dns:a.example ")
    with pytest.raises(ValueError):
        list(warc.parse_arc(data[:-5]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(data.replace(b"%d 0 sparkfeat" % version, b"3 0 sparkfeat")))


def test_converted_records_are_well_formed():
    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\nContent-Length: 5\r\n\r\nhello"
    r = warc.ArcRecord("http://a/", "1.1.1.1", "20010203040506", "text/html", body, {})
    for refers in (None, ("http://a/", "20010203040505", 7)):
        data = warc.convert(r, refers) + b"\r\n\r\n"
        (field, block), = warc.parse_warc(data)
        assert field["WARC-Date"] == "2001-02-03T04:05:06Z" and field["WARC-Record-ID"].startswith("<urn:uuid:")
        assert field["WARC-Payload-Digest"] == warc._digest(b"hello")
        assert field["WARC-Type"] == ("revisit" if refers else "response")
        assert block == (body[:-5] if refers else body)
    # a record that is not HTTP keeps its type and whole body
    (field, block), = warc.parse_warc(warc.convert(warc.ArcRecord("dns:a", "0.0.0.0", "2001", "text/dns", b"x", {})) + b"\r\n\r\n")
    assert (field["Content-Type"], block, field["WARC-Date"]) == ("text/dns", b"x", "2001-00-00T00:00:00Z")


def test_edge_pages(spark, tmp_path):
    big, small = "é" * 600, "s" * 999
    rows = [(1, "http://a b/\n\t", big, "x", 1), (2, None, big, "x", 1), (3, "http://c/", small, "x", 1), (4, "", small, "x", 1),
            (5, "http://e/", None, "x", 1), (6, "http://f/", "", "x", 1), (None, "http://g/", big, "x", 1),
            (7, "http://h/", "a\r\n\r\nWARC/1.1\r\n\r\n" * 90, "x", 1), (7, "http://h/", "a\r\n\r\nWARC/1.1\r\n\r\n" * 90, "x", 1),
            (None, None, None, None, None), (8, "http://i/", "z" * 3_000_000, "x", 1), (9, "http://j/", "z" * 3_000_000, "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key string, refers int")
    got = warc.read_warc(spark, warc.archive_pages(pages, str(tmp_path / "w"))).collect()
    want = []
    for p, _, html, *_ in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if r[2] == html and r[0] is not None]
        first = max(same) if same else None
        again = len(data) >= 1000 and p != first
        want.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, want))
    assert {r["target_uri"] for r in got if r["page_id"] == 1} == {"http://a%20b/%0A%09"}
    ids = [r["record_id"] for r in got if r["page_id"] not in (7, None)]
    assert len(set(ids)) == len(ids)


def test_archives_are_plain_warc_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"page {i}") for i in range(5)], "page_id long, url string, html string")
    path = warc.archive_pages(pages, str(tmp_path / "w"))
    data = b"".join(zlib.decompress(f.read_bytes(), 31) for f in sorted((tmp_path / "w").glob("part-*.gz")))
    assert len(list(warc.parse_warc(data))) == 5
    assert warc.read_warc(spark, path).count() == 5


def test_archives_end_by_bytes(spark, tmp_path):
    size = lambda i: 50_000 if i % 40 == 0 else 2_000 + i
    pages = spark.createDataFrame([(i, f"http://a/{i}", chr(97 + i % 26) * size(i)) for i in range(400)],
                                  "page_id long, url string, html string").coalesce(1)
    limit = 100_000
    path = warc.archive_pages(pages, str(tmp_path / "w"), limit)
    files = [zlib.decompress(f.read_bytes(), 31) for f in (tmp_path / "w").glob("part-*.gz")]
    per_file = warc.records_a_file(warc.F.octet_length("html"), pages, limit)
    total = sum(map(size, range(400)))
    assert len(files) >= total // limit and per_file == limit // ((total + 400 * warc.HEAD_BYTES) / 400)
    assert max(len(list(warc.parse_warc(f))) for f in files) <= per_file
    assert warc.read_warc(spark, path).agg({"payload_bytes": "sum"}).first()[0] == total
    # the largest record bounds an archive as well
    huge = spark.createDataFrame([(1,)], "x int").select(warc.F.lit(10**9).alias("n"))
    assert warc.records_a_file(warc.F.col("n"), huge) == 1
    none = spark.createDataFrame([], "n int")
    assert warc.records_a_file(warc.F.col("n"), none) >= 1


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(spark, warc.archive_pages(none, str(tmp_path / "w"))).count() == 0


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = sorted(con.execute(warc.ORACLE).fetchall(), key=repr)
    assert sorted(map(tuple, warc.op2_arc_to_warc(spark, sf).collect()), key=repr) == want
