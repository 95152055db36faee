import gzip
import json
import zipfile

from pyspark.sql import functions as F

from archivolt.operators import hierarchy, reconcile, sets
from archivolt.sources import html_pages, inventory, text_files, web_archive, xml_files
from archivolt.streaming import incremental


def record(kind, uri, body=b"", extra=b""):
    head = b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Target-URI: %s\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: %d\r\n%s\r\n" % (kind, uri, len(body), extra)
    return head + body + b"\r\n\r\n"


def http(status, location=b""):
    return b"HTTP/1.1 %s X\r\n%s\r\nhello" % (status, b"Location: " + location + b"\r\n" if location else b"")


def test_web_archive(spark, tmp_path):
    one = record(b"warcinfo", b"") + record(b"response", b"http://a/", http(b"200")) + record(b"response", b"http://b/", http(b"301", b"http://c/"))
    two = record(b"response", b"http://a/", http(b"404")) + record(b"response", b"http://z/", http(b"200"))[:-6]
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(one[:200]) + gzip.compress(one[200:]))
    with zipfile.ZipFile(tmp_path / "two.wacz", "w") as z:
        z.writestr("archive/x.warc", two)
        z.writestr("pages/pages.jsonl", '{"format":"json-pages-1.0"}\n{"url":"http://a/","status":200}\nbroken\n{"url":"http://q/"}\n')
    (tmp_path / "note.txt").write_text("no archive")
    rows = web_archive.read_records(spark, str(tmp_path)).orderBy("file_ord", F.asc_nulls_last("pos")).collect()
    # the record that breaks off is followed by a row that says so
    assert b"ends after" in bytes(rows.pop().payload)
    assert [(r.rec_type, r.target_uri, r.http_status, r.location) for r in rows] == [
        ("warcinfo", None, None, None), ("response", "http://a/", "200", None), ("response", "http://b/", "301", "http://c/"), ("response", "http://a/", "404", None), ("response", "http://z/", "200", None),
    ]
    assert bytes(rows[1].payload) == b"hello"
    assert web_archive.read_records(spark, str(tmp_path), types="response", uriPrefix="http://a").count() == 2
    pages = {(r.url, r.status) for r in web_archive.wacz_pages(spark, str(tmp_path)).collect()}
    assert pages == {("http://a/", 200), ("http://q/", None)}
    merged = sets.merge_records(web_archive.read_records(spark, str(tmp_path)))
    assert merged.where("rec_type <> 'unreadable'").count() == 5
    (tmp_path / "bad.warc").write_bytes(b"WARC/1.0\r\nContent-Length: x\r\n\r\n")
    (tmp_path / "bad.wacz").write_bytes(b"no archive")
    assert sorted(r.file for r in web_archive.read_records(spark, str(tmp_path)).where("rec_type = 'unreadable'").collect()) == ["bad.wacz", "bad.warc", "two.wacz!archive/x.warc"]


def test_text_sources(spark, tmp_path):
    (tmp_path / "list.txt").write_text(" http://a/b \n\nnot a url\nhttp://a/b\n# note\n")
    path = str(tmp_path / "list.txt")
    assert {r.url for r in text_files.url_list(spark, path, only_valid=True).collect()} == {"http://a/b"}
    assert "" in {r.url for r in text_files.url_list(spark, path, keep_blank=True).collect()}
    assert "# note" not in {r.line for r in text_files.lines(spark, path, comments="#").collect()}
    (tmp_path / "t.csv").write_text('\ufeffid,dc:s,dc:s\n1,"a\nb",c\n')
    got = text_files.csv_table(spark, str(tmp_path / "t.csv"), ["id"])
    assert got.columns == ["id", "dc:s", "dc:s.1"] and got.collect()[0]["dc:s"] == "a\nb"
    raw = text_files.csv_lines(spark, str(tmp_path / "t.csv")).orderBy("line_no").collect()
    assert [r.raw_line for r in raw] == ["\ufeffid,dc:s,dc:s", '1,"a\nb",c']
    (tmp_path / "sums.csv").write_text("name,SHA1 checksum\na,ABC\nb, abc\n")
    assert [r.digest for r in text_files.checksum_report(spark, str(tmp_path / "sums.csv"), "sha1").collect()] == ["abc"]
    (tmp_path / "cdx.json").write_text(json.dumps([["k", "t", "o", "m", "s", "d"], ["k", "1", "u1", "", "", "D"], ["k", "2", "u2", "", "", "D"], ["k", "3", "u3", "", "", "E"]]))
    assert {(r.url, r.digest) for r in text_files.cdx_rows(spark, str(tmp_path / "cdx.json")).collect()} == {("u1", "D"), ("u3", "E")}
    (tmp_path / "tax.txt").write_text("# head\n- Audit \n- Tax\n")
    assert {r.term for r in text_files.taxonomy_lines(spark, str(tmp_path / "tax.txt")).collect()} == {"Audit", "Tax"}
    out = spark.range(1).select(text_files.classifier_output(F.lit("x\nBEGIN\nAudit\t0.9\nTax: 0.5\nEND"), "BEGIN", "END").alias("o")).collect()[0].o
    assert [(x.term, x.score) for x in out] == [("Audit", 0.9), ("Tax", 0.5)]


def test_log(spark, tmp_path):
    (tmp_path / "w.log").write_text(
        "--2024-01-01 00:00:00--  http://a/\nHTTP request sent, awaiting response... 301 Moved\nLocation: http://b/ [following]\n"
        "--2024-01-01 00:00:01--  http://b/\nHTTP request sent, awaiting response... 200 OK\nLength: unspecified [text/html]\n... 'x' saved [12]\n"
        "--2024-01-01 00:00:02--  http://b/\nHTTP request sent, awaiting response... 200 OK\nLength: 12 (1K)\n... 'x' saved [12/12]\n"
    )
    rows = text_files.wget_log(spark, str(tmp_path / "w.log")).orderBy("pos").collect()
    assert [(r.url, r.status, r.location, r.length, r.length_unspecified, r.saved) for r in rows] == [
        ("http://a/", "301", "http://b/", None, False, None), ("http://b/", "200", None, None, True, "12"), ("http://b/", "200", None, "12", False, None),
    ]
    log = text_files.wget_log(spark, str(tmp_path / "w.log"))
    want = spark.createDataFrame([("http://a/",), ("http://b/",), ("",)], "url string")
    assert {(r.url, r.category) for r in reconcile.reconcile(want, log).collect()} == {("http://a/", "redirect"), ("http://b/", "matching"), ("", "missing")}


def test_xml_and_html(spark, tmp_path):
    (tmp_path / "s.xml").write_text('<sitemapindex xmlns="n"><sitemap><loc>t.xml</loc></sitemap><sitemap><loc>s.xml</loc></sitemap></sitemapindex>')
    (tmp_path / "t.xml").write_text("<urlset><url><loc> http://a/?x=1&amp;y=2 </loc></url><url><loc>http://a/?x=1&amp;y=2</loc></url></urlset>")
    pages = hierarchy.sitemap_pages(xml_files.sitemap_entries(spark, str(tmp_path / "*.xml")), ["s.xml"])
    assert [r.url for r in pages.collect()] == ["http://a/?x=1&y=2"]
    df = spark.createDataFrame([('<r xmlns:x="u"><x:a> 1 </x:a><x:b><x:c>2</x:c><x:d>3</x:d></x:b></r>',), ("<broken",), (None,)], "x string")
    assert [r.m for r in df.select(xml_files.flatten_fragment(F.col("x")).alias("m")).collect()] == [{"a": "1", "b": "2 3", "c": "2", "d": "3"}, {}, None]
    page = '<table><tr><th>h</th><th>i</th></tr><tr><td>1</td><td> v </td></tr></table><a href=" /l ">x</a><a>y</a><div class="more-link extra">'
    html = spark.createDataFrame([("u", page), ("v", None)], "url string, html string")
    h = F.col("html")
    got = html.orderBy("url").select(html_pages.has_element(h, "div", "class", "extra").alias("e"), html_pages.links(h).alias("l")).collect()
    assert (got[0].e, got[0].l, got[1].e, got[1].l) == (True, ["/l"], None, None)
    assert [r.value for r in html_pages.table_column(html, 1, 2).collect()] == ["v"]
    (tmp_path / "items.xmlx").write_text("<x><item><a>1</a></item><item><b>2</b></item></x>")
    assert xml_files.xml_items(spark, str(tmp_path / "items.xmlx"), "item").columns == ["a", "b"]


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.TXT").write_bytes(b"x")
    got = inventory.files(spark, str(tmp_path), "md5").collect()
    assert (got[0].name, got[0].extension, got[0].size, got[0].digest) == ("a.TXT", "txt", 1, "9dd4e461268c8034f5c8564e155c67a6")
    import hashlib

    assert inventory.files(spark, str(tmp_path), "blake2b").collect()[0].digest == hashlib.blake2b(b"x").hexdigest()


def test_streaming(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()
    schema = "ref string"

    def run():
        stream = spark.readStream.schema(schema).json(str(source))
        incremental.process_new(stream, "ref", str(tmp_path / "done"), str(tmp_path / "cp"), lambda df, i: seen.extend(r.ref for r in df.collect())).awaitTermination()

    (source / "1.json").write_text('{"ref":"a"}\n{"ref":"b"}\n{"ref":"a"}\n')
    run()
    (source / "2.json").write_text('{"ref":"b"}\n{"ref":"c"}\n')
    run()
    assert sorted(seen) == ["a", "b", "c"]
    urls = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    where = str(tmp_path / "snap")
    assert incremental.monitor_snapshot(spark, urls("a", "b"), "url", where) is None
    diff = incremental.monitor_snapshot(spark, urls("b", "c"), "url", where)
    assert {(r.url, r.change) for r in diff.collect()} == {("a", "removed"), ("c", "added")}
    assert incremental.monitor_snapshot(spark, urls("b", "c"), "url", where).count() == 0
