"""Pages, sitemaps, sources, sinks, streams."""

from __future__ import annotations

import http.server
import json
import threading

from pyspark.sql import functions as F

from roundmill.operators import analytics, html, pages, upsert
from roundmill.sources import config, fetch, sinks
from roundmill.streaming.incremental import Snapshots, daily_totals, first_seen, upsert_stream

PAGE = """<html><head><title>Plain</title><meta property="og:title" content="Foo raises &#36;8 Mn"/><script type="application/ld+json">[{"@type":"x","datePublished":"2026-04-14T00:30:00+05:30"}]</script></head>
<body><nav><a href="/about">About</a><p>menu</p></nav><article><h1>Foo</h1><span class="author">Ann  Bee</span><p>One <b>two<p>Three</p><ul><li>Four</li></ul><script>var a="<p>no</p>";</script>
<a href="/2026/04/foo-raises-money?x=1#y">read</a><a href="https://b.example/z">z</a><a href="/2026/04/foo-raises-money">again</a><a>none</a></article><footer><p>foot</p></footer></body></html>"""


def test_detail_links_selectors(rows):
    df = rows("page_id long, url string, html string", (1, "https://a.example/list", PAGE), (2, "https://a.example/", None), (3, None, ""), (4, "x", "<p>broken <div"))
    got = {r["page_id"]: r["d"] for r in df.select("page_id", html.detail("html").alias("d")).collect()}
    assert (got[1]["title"], got[1]["author"], got[1]["published"][:10]) == ("Foo raises $8 Mn", "Ann Bee", "2026-04-14")
    assert got[1]["text"] == "One two\n\nThree\n\nFour" and got[2]["title"] is None and got[3]["text"] is None
    links = pages.candidate_links(df, ~F.col("href").contains("about")).orderBy("page_id", "place").collect()
    assert [(r["href"], r["place"]) for r in links] == [("https://a.example/2026/04/foo-raises-money", 1), ("https://b.example/z", 2)]
    hits = {r["page_id"]: r["h"] for r in df.select("page_id", html.selector_hits(["h1", "article p", "span.author, h1", 'meta[property="og:title"]'])("html").alias("h")).collect()}
    assert hits[1] == {"h1": 1, "article p": 2, "span.author, h1": 2, 'meta[property="og:title"]': 1} and hits[2] == {} and hits[4]["h1"] == 0
    assert [r["href"] for r in pages.crawl(df, F.lit(True), 2).collect()] == ["https://a.example/about", "https://a.example/2026/04/foo-raises-money"]
    assert {r["section"]: r["n_links"] for r in pages.link_census(df).collect()} == {"about": 1, "2026": 2, "z": 1}


def test_sitemap_and_predicates(rows, spark):
    xml = "<urlset><url><loc> https://a/foo-raises-5mn </loc><lastmod>2026-01-01</lastmod></url><url><loc>https://a/weather</loc></url><url><loc>https://a/seed-round</loc><lastmod>2026-02-01</lastmod></url></urlset>"
    got = pages.sitemap_entries(rows("xml string", (xml,), (None,), ("",)), pages.about_funding(F.col("loc")), 10).collect()
    assert [r["loc"] for r in got] == ["https://a/seed-round", "https://a/foo-raises-5mn"]
    u = rows("u string", ("https://a/2026/04/a-long-slug-here",), ("https://a/tag/x",)).select(pages.dated_slug(F.col("u")).alias("d"), pages.path_depth(F.col("u")).alias("n"), pages.outside_sections(F.col("u"), ("tag",)).alias("o")).collect()
    assert [tuple(r) for r in u] == [(True, 3, True), (False, 2, False)]
    urls = lambda *a: [r["url"] for r in pages.page_addresses(spark, *a).orderBy("number").collect()]
    assert urls("https://a/l", 3) == ["https://a/l", "https://a/l/page-2", "https://a/l/page-3"] and urls("https://a/l?x=1", 3, "query") == ["https://a/l?x=1&page=1", "https://a/l?x=1&page=2"] and urls("https://a/l", 5, "same") == ["https://a/l"]


def test_sources(spark, tmp_path):
    path = tmp_path / "s.yaml"
    path.write_text("sources:\n  one:\n    base_url: https://a.example  # front\n    rate: 0.8\n    kind: dynamic\n  two:\n    base_url: 'https://b.example'\n    enabled: false\n    odd: 1\n")
    got = config.load_sources(spark, str(path))
    assert [(r["name"], r["kind"], r["rate"], r["enabled"]) for r in got.collect()] == [("one", "dynamic", 0.8, True), ("two", "static", 1.0, False)]
    assert config.enabled_sources(got).count() == 1
    config.register("one", lambda df: df)
    assert config.reader_of("one")(got) is got
    try:
        config.reader_of("none")
        raise AssertionError
    except KeyError:
        pass
    assert config.fetch_order(got.select(F.col("base_url").alias("url")), 2).count() == 2


class _Handler(http.server.BaseHTTPRequestHandler):
    def do_GET(self):  # noqa: N802
        self.send_response(404 if "no" in self.path else 200)
        self.end_headers()
        self.wfile.write(b"<p>hi</p>")

    def log_message(self, *a):
        pass


def test_fetch(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    fetch.register(spark)
    got = {r["url"]: r for r in spark.read.format("roundmill_pages").option("urls", f"{base}/yes\n{base}/no").option("rate", "50").load().collect()}
    server.shutdown()
    assert (got[f"{base}/yes"]["status"], got[f"{base}/yes"]["html"]) == (200, "<p>hi</p>") and got[f"{base}/no"]["status"] == 404 and got[f"{base}/no"]["html"] is None
    assert fetch.fetch("http://127.0.0.1:9/x", 0.2, attempts=2, first_wait=0.01)[1] is None
    assert spark.read.format("roundmill_pages").load().count() == 0


def _public(rows):
    f = rows("record_id long, round_id string, company_name string, company_json string, stage string, amount double, currency string, amount_usd double, announced_on string, summary string, confidence double", (1, "a", 'Foo "X", Ltd', None, "seed", 11e6, "USD", 11e6, "2026-01-01", "a,b\nc", 0.9), (2, "b", None, None, None, None, None, None, None, None, None))
    return analytics.public_rows(analytics.joined_rounds(f, rows("round_id string, name string, lead int", ("a", "Y", 0), ("a", "X", 1)), rows("round_id string, article_url string"), None))


def test_sinks(spark, rows, tmp_path):
    public = _public(rows)
    for _ in range(2):  # the same files again
        sinks.write_csv(public, str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("*.csv")).read_text()
    assert text.splitlines()[0] == ",".join(analytics.PUBLIC_COLUMNS) and "11000000.0" in text and "X | Y" in text and '"Foo ""X"", Ltd"' in text
    sinks.write_json(public, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    document = json.loads(sinks.json_document(public).first()["document"])
    assert [d["company_name"] for d in document] == ['Foo "X", Ltd', ""]
    meta = analytics.kpis(rows("amount_usd double, stage string", (1.0, "seed")))
    sinks.write_dashboard(public, meta, str(tmp_path / "d.html"))
    assert "Foo" in (tmp_path / "d.html").read_text()
    cells = {(r["row"], r["column"]): r["value"] for r in sinks.sheet_cells(public).collect()}
    assert cells[1, "A"] == "company_name" and cells[2, "E"] == "11000000.0" and cells[3, "E"] == ""
    assert sinks.sheet_widths(public).first()["company_name"] == 14
    try:
        sinks.json_document(public, 1)
        raise AssertionError
    except ValueError:
        pass


def test_streams(spark, rows, tmp_path):
    schema = "url string, title string, enrichment_status string, enrichment_json string, fetched_at timestamp"
    source = str(tmp_path / "in")
    shots = Snapshots(spark, str(tmp_path / "table"), schema)
    assert shots.read().count() == 0
    for i, title in enumerate(("one", "two")):
        spark.sql(f"select 'u' as url, '{title}' as title, 'pending' as enrichment_status, cast(null as string) as enrichment_json, timestamp'2026-01-0{i + 1} 00:00:00' as fetched_at").write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        upsert_stream(stream, shots, upsert.upsert_articles, str(tmp_path / "cp")).start().awaitTermination()
    assert [(r["title"],) for r in shots.read().collect()] == [("two",)] and shots.versions() == [1, 2]
    stream = spark.readStream.schema(schema).parquet(source)
    first_seen(stream, "url", "fetched_at").writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("seen").count() == 1
    daily_totals(stream.withColumn("v", F.lit(1)), "fetched_at", "url", "v").writeStream.outputMode("complete").format("memory").queryName("days").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("days").count() == 2
