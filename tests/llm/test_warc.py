import hashlib

import duckdb
from pyspark.sql import functions as F

from leadlens.llm import queries as Q
from leadlens.llm import warc
from leadlens.llm.common import shared_folder, table
from tests.conftest import SF_SMALL

PAGES = "page_id bigint, url string, html string, DIGEST string, payload int"


def expected(rows):
    """page_id, payload_bytes, payload_digest, record_type, refers_to by plain grouping."""
    ids = {}
    for p, _, h in rows:
        ids.setdefault(h or "", []).append(p)
    out = []
    for p, u, h in rows:
        raw = (h or "").encode()
        head = max((x for x in ids[h or ""] if x is not None), default=None)
        other = len(raw) >= 1000 and head is not None and p != head
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if other else "response", head if other else None, u))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(p, u, h, "x", 1) for p, u, h in rows], PAGES)
    return sorted((tuple(r) for r in warc.round_trip(df, **options).collect()), key=repr)


def test_url_keys():
    assert warc.url_key("https://www.Blog.Example.com:8080/a/b?q=1#frag") == "com,example,blog:8080)/a/b?q=1"
    assert warc.url_key("http://example.com:80") == "com,example)/"
    assert [warc.url_key(x) for x in (None, "", "no url", "http://[bad")] == ["", "", "no url", "http://[bad"]


def test_edges_and_hot_groups(spark):
    big, hot = "é" * 900 + "\r\n\r\n<p>", "h" * 1500
    rows = [(1, "http://a.b/x", None), (2, "http://a.b/x", ""), (3, None, "p"), (4, "", "p" * 1000), (5, "http://a.b/\n:é", "p" * 1000),
            (6, "u", "p" * 999), (7, "u", "p" * 999), (None, "u", big), (8, "u", big), (8, "u", big), (None, "v", "q" * 1200),
            (None, "v", "q" * 1200), (9, "u", "z" * 3_000_000)]
    rows += [(100 + i, "http://hot.example/", hot) for i in range(300)] + [(1000 + i, f"http://hot.example/{i}", f"{i}") for i in range(200)]
    assert run(spark, rows, block_lines=7) == expected(rows)
    assert run(spark, []) == []


def test_lookup_reads_only_what_is_asked(spark):
    pages = table(spark, SF_SMALL, "pages")
    folder = shared_folder(spark, "warc-test")
    captures = warc.write_archives(pages, folder, max_archive_bytes=20_000)
    shards = warc.build_index(captures, folder, block_lines=5)
    some = pages.where("page_id % 7 = 3")
    asked = some.select("url").union(spark.createDataFrame([("http://nowhere.example/",)], "url string"))
    found = warc.read_records(warc.lookup(asked, shards, folder), folder)
    got = {r.page_id: bytes(r.payload).decode() for r in found.where(F.col("payload").isNotNull()).collect()}
    want = {r.page_id: r.html for r in pages.join(some.select("url").distinct(), "url").collect()}
    assert got == want and captures.select("archive").distinct().count() > 1


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    want = con.execute(Q.oracle_sql()["op1_warc_index"]).fetchall()
    assert sorted(tuple(r) for r in Q.op1_warc_index(spark, SF_SMALL).collect()) == sorted(want)


def test_target_uri_stands_bare_and_any_url_comes_back():
    for url in (None, "", "http://a.b/c?d=e: f", "http://a.b/é\n", "http://a.b/c?d=%20#x", "no url"):
        raw = warc.record(1, url, b"<p>", hashlib.sha1(b"<p>").hexdigest(), None)
        assert warc.parse(raw)["url"] == url
        assert url is None or " " in url or "\n" in url or not url or f"\r\nWARC-Target-URI: {url}\r\n".encode() in raw
    ids = {warc.record(1, "u", p, hashlib.sha1(p).hexdigest(), None).split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0] for p in (b"a", b"b")}
    assert len(ids) == 2


def test_payloads_pass_by_bounded_batches(spark, monkeypatch, tmp_path):
    """A batch of large pages is not held whole, packed or unpacked: no step of it exceeds BATCH_BYTES."""
    sizes = str(tmp_path / "sizes")
    batch = warc._batch

    def noted(rows, ddl):
        if ddl == warc.RECORD:
            with open(sizes, "a") as f:
                f.write(f"{len(rows)} {sum(len(r[-1] or b'') for r in rows)}\n")
        return batch(rows, ddl)

    monkeypatch.setattr(warc, "_batch", noted)
    rows = [(i, f"http://a.b/{i}", f"{i:06d}" + "x" * 200_000) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    folder = shared_folder(spark, "warc-test")
    captures = warc.write_archives(df, folder)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    got = warc.read_records(captures, folder).where("record_type = 'response' AND octet_length(payload) = payload_bytes")
    assert got.count() == 60
    made = [line.split() for line in open(sizes)]
    assert sum(int(n) for n, _ in made) == 60 and max(int(size) for _, size in made) <= warc.BATCH_BYTES + 200_006
