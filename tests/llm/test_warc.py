"""WARC: DuckDB, plain readers, index lookups against a scan, edge rows."""

import gzip

import duckdb

from riskspark.llm import warc
from riskspark.llm.common import scratch
from riskspark.llm.queries import QUERIES, SQL, table
from tests.conftest import SF001, SF01


def equal(spark, sf_dir, path):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{path}')")
    rel = con.execute(SQL["op1_warc"])
    names = [c[0] for c in rel.description]
    got = QUERIES["op1_warc"](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(rel.fetchall(), key=repr)


def test_query_equals_duckdb(spark):
    equal(spark, SF01, f"{SF01}/pages.parquet")


def test_edge_rows_equal_duckdb(spark, tmp_path):
    rows = [(5, "http://a.b/x", "same"), (3, "http://a.b/x", "same"), (3, "http://a.b/x", "same"), (4, None, None), (9, "", ""), (None, "http://a.b/x", "same"), (None, None, "alone"), (7, "no scheme\r\nWARC-Type: x y", "z\r\n\r\n" * 9), (8, "http://u:p@A.B:80/é #f", "ü" * 300000), (-1, "HTTP://[::1", "q")]
    spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, file string, offset int").write.parquet(str(tmp_path / "pages.parquet"))
    equal(spark, str(tmp_path), f"{tmp_path}/pages.parquet/*.parquet")
    none = table(spark, SF001, "pages").limit(0)
    assert warc.round_trip(none).collect() == []


def test_keys():
    assert warc.url_key("https://Blog.Example.com/en/7#top") == b"com,example,blog)/en/7"
    assert warc.url_key("http://example.com:80?q=1 2") == b"com,example)/?q=1%202"
    assert warc.url_key("http://example.com:8080/") == b"com,example:8080)/"
    assert warc.url_key(None) == warc.url_key("") == b""


def test_index_lookups_and_plain_gzip(spark, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 7)
    pages = table(spark, SF001, "pages")
    same = pages.selectExpr("page_id + 1000 as page_id", "'http://one.host/p' as url", "html")
    every = pages.unionByName(same)
    folder = scratch(spark, "test-warc")
    found = warc.write_archives(every, f"{folder}/a")
    index = warc.build_index(found, f"{folder}/i")
    want = sorted((bytes(r.key), r.page_id, r.file, r.offset, r.length) for r in found.collect())
    assert sorted(index.find(iter(sorted((k, p) for k, p, *_ in want)))) == want
    assert list(index.find(iter([(b"", 0), (b"com,example)/nothing", 1), (want[0][0], -5), (b"zzz", 1)]))) == []
    fs, path = warc.store(f"{folder}/a")
    texts = {r.html for r in pages.collect()}
    for name in {w[2] for w in want}:
        with fs.open_input_file(f"{path}/{name}") as f:
            whole = gzip.decompress(f.read())
        assert whole.count(b"WARC/1.1\r\n") == sum(w[2] == name for w in want)
    rows = warc.read_records(found, f"{folder}/a").collect()
    assert {bytes(r.payload).decode() for r in rows if r.record_type == "response"} == texts
