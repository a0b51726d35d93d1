import time

from orgextract.sources import documents, feeds, orgs, sinks
from orgextract.streaming import monitor


def test_org_csv(spark, tmp_path):
    f = tmp_path / "o.csv"
    f.write_text('﻿Name,Web Site,Note\n"Acme, CU",acme.or,x\n,www.beta-cu.org,\nDup,http://www.acme.org/,\nNone,,gamma.coop\n', encoding="utf-8")
    got = {(r.name, r.url) for r in orgs.seeds(orgs.read_csv(spark, str(f))).collect()}
    assert got == {("Acme, CU", "https://acme.org"), ("BETA CU", "https://www.beta-cu.org"), ("None", "https://gamma.coop")}


def test_latin1_fallback(spark, tmp_path):
    f = tmp_path / "l.csv"
    f.write_bytes("name,url\nCr\xe9dit,https://c.org\n".encode("latin-1"))
    assert orgs.read_csv_any(spark, str(f)).first()["name"] == "Cr\xe9dit"


def test_feed_and_snapshot(spark, tmp_path):
    f = tmp_path / "f.xml"
    f.write_text("<rss><channel><item><title>Ann named CEO</title><link>https://a</link></item><item><title>x</title></item></channel></rss>")
    assert sorted((r.title, r.description, r.link) for r in feeds.read_feed(spark, str(f)).collect()) == [("Ann named CEO", "", "https://a"), ("x", "", "")]
    path = str(tmp_path / "snap")
    assert feeds.read_snapshot(spark, path).count() == 0
    df = spark.createDataFrame([("t", "l", "N/A", "N/A")], feeds.SNAPSHOT)
    feeds.replace_snapshot(df, path)
    feeds.replace_snapshot(feeds.read_snapshot(spark, path).unionByName(df), path)
    assert feeds.read_snapshot(spark, path).count() == 2


def test_pdf_gate_and_ocr_trigger(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF tiny")
    (tmp_path / "b.txt").write_bytes(b"no")
    df = documents.read_pdfs(spark, str(tmp_path))
    assert df.count() == 1 and documents.read_pdfs(spark, str(tmp_path), 3).count() == 0
    got = documents.pdf_texts(df, 3, lambda c, n: ["short"], lambda c: ["from the picture"]).first()
    assert got.texts == ["short"] and got.ocr_texts == ["from the picture"]
    got = documents.pdf_texts(df, 3, lambda c, n: [], lambda c: ["from the picture"]).first()
    assert got.texts == got.ocr_texts == ["from the picture"]
    assert documents.pdf_texts(df, 3, lambda c, n: ["long " * 99], lambda c: ["x"]).first().ocr_texts == []
    assert documents.pdf_texts(df, 3, documents.native_texts).first().texts == []


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "x string, y double")
    path = str(tmp_path / "e")
    for _ in range(2):
        sinks.append_events(df, path, "r1")
    sinks.append_events(df, path, "r2")
    assert spark.read.parquet(path).count() == 2
    assert sinks.load_state(spark, str(tmp_path / "none"), "visited", "node string").count() == 0


def test_stream_monitor(spark, tmp_path):
    rows = [("Ann named CEO", "l1", 1), ("Ann named CEO", "l1", 2), ("weather", "l2", 3), ("Bo appointed", "l3", 4)]
    df = spark.createDataFrame(rows, "Title string, Link string, s int").selectExpr("Title", "Link", "timestamp_seconds(s) AS fetched_at")
    df.write.parquet(str(tmp_path / "in"))
    stream = monitor.new_announcements(monitor.announcements(spark, str(tmp_path / "in"), df.schema))
    q = monitor.write_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    time.sleep(0.2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_atom_and_missing_feeds(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<feed><entry><title>Bo appointed</title><link rel="self" href="https://s"/><link href="https://b"/><summary>x</summary></entry><entry><title>y</title></entry></feed>')
    (tmp_path / "r.xml").write_text("<rss><channel><item><title>t</title><link>https://r</link></item></channel></rss>")
    (tmp_path / "bad.xml").write_text("<rss><item><title>t</ti")
    paths = [f"{tmp_path}/{n}.xml" for n in ("a", "r", "bad", "none")]
    got = sorted(tuple(r) for r in feeds.read_feed(spark, paths).collect())
    assert got == [("Bo appointed", "x", "https://b"), ("t", "", "https://r"), ("y", "", "")]
    assert feeds.read_feed(spark, [f"{tmp_path}/none.xml"]).count() == 0


def test_pdf_responses_and_retry(spark):
    row = lambda u, status=200, kind="text/html", length=1, sec=1.0, content=b"x": (u, status, kind, length, sec, content)
    rows = [row("a.pdf"), row("b", kind="application/pdf; x"), row("c"), row("d.pdf", 404), row("e.PDF", length=9_000_000), row("f.pdf", content=b"y" * 4_194_305), row("g.pdf", sec=26.0), row("h.pdf", content=None), row("i.pdf", kind=None, length=None, sec=None)]
    df = spark.createDataFrame(rows, "url string, status int, content_type string, content_length long, seconds double, content binary")
    assert sorted(r.path for r in documents.pdf_responses(df).collect()) == ["a.pdf", "b", "i.pdf"]
    assert sorted(r.path for r in documents.pdf_responses(df, None, None).collect()) == ["a.pdf", "b", "e.PDF", "f.pdf", "g.pdf", "i.pdf"]
    wanted = spark.createDataFrame([("https://a",), ("http://b",), ("https://c",), (None,)], "url string")
    pages = spark.createDataFrame([("https://a", "ok", "A"), ("https://b", "ok", None), ("http://b", "failed", "x"), ("https://c", "failed", "x")], "url string, status string, html string")
    got = {r.url: (r.source_url, r.html) for r in documents.fetched_pages(wanted, pages).collect()}
    assert got == {"https://a": ("https://a", "A"), "http://b": ("https://b", None), "https://c": (None, None), None: (None, None)}


def test_text_responses(spark):
    rows = [("https://a.org/", "https://a.org/x", "text/html; charset=x"), ("https://a.org/", "https://b.org/", "text/html"), ("https://a.org/", "https://a.org/p.png", "text/plain"), ("https://a.org/", "https://a.org/y", "image/png"), ("https://a.org/", "https://a.org/z", None)]
    df = spark.createDataFrame(rows, "base string, url string, content_type string")
    assert [r.url for r in documents.text_responses(df, "base").collect()] == ["https://a.org/x"]


def test_prepared_image():
    import numpy as np

    x = np.linspace(60, 120, 400).reshape(20, 20)
    y = documents.prepared_image(np.stack([x] * 3, axis=-1))
    assert y.shape == (20, 20) and y.min() == 0 and y.max() == 255
    assert documents.prepared_image(x, 100).size <= 100 and documents.prepared_image(np.zeros((0, 3))).size == 0
    assert documents.prepared_image(np.full((4, 4), 7)).tolist() == [[7] * 4] * 4


def test_crawl_state(spark, tmp_path):
    import pytest

    path = f"file://{tmp_path}/state"
    nodes = spark.createDataFrame([("a", 0), ("b", 1)], "node string, depth int")
    sites = spark.createDataFrame([("h", 2, True)], "site string, pages long, done boolean")
    sinks.save_state(path, visited=nodes, frontier=nodes.filter("false"), sites=sites)
    before = sinks.load_state(spark, path, "visited")
    sinks.save_state(path, visited=before.unionByName(spark.createDataFrame([("c", 2)], "node string, depth int")))
    assert before.count() == 2 and sinks.load_state(spark, path, "visited").count() == 3
    assert sinks.load_state(spark, path, "frontier").count() == 0 and sinks.load_state(spark, path, "sites").count() == 0
    (tmp_path / "state" / "3" / "visited").mkdir(parents=True)  # an unfinished generation
    assert sinks.load_state(spark, path, "visited").count() == 3
    (tmp_path / "state" / "3" / "_DONE").write_text("")
    with pytest.raises(Exception):
        (tmp_path / "state" / "3" / "visited" / "x.parquet").write_text("no parquet")
        sinks.load_state(spark, path, "visited").count()
    sinks.reset_state(spark, path)
    sinks.reset_state(spark, path)
    assert sinks.load_state(spark, path, "visited").count() == 0
    state = sinks.encode_state(nodes).unionByName(spark.createDataFrame([("{bad",)], "state string"))
    assert sorted(tuple(r) for r in sinks.decode_state(state, "node string, depth int").filter("node IS NOT NULL").collect()) == [("a", 0), ("b", 1)]


def test_exports_and_reports(spark, tmp_path):
    rows = [("CEO", "Ann", "b@x.org", "u", "html", 0.9), (None, "Bo", "a@x.org", "u", "html", None), ("", "Cy", "", "u", "html", 0.5), ("VP", "Di", "a@x.org", "v", "html", 0.5)]
    df = spark.createDataFrame(rows, "role string, name string, email string, source string, found_via string, confidence double")
    paths = sinks.export_results(df, str(tmp_path), "20250101_000000")
    assert paths["people_csv"].endswith("people_20250101_000000.csv")
    assert [r.email for r in spark.read.json(paths["emails_json"]).collect()] == ["a@x.org", "b@x.org"]
    assert spark.read.option("header", True).csv(paths["people_csv"]).count() == 4
    assert sinks.report(df.orderBy("name"), ["role", "name"], 2) == ["CEO · Ann", " · Bo"]
    for _ in range(2):
        sinks.append_csv(df, f"{tmp_path}/all", "r1")
    assert spark.read.option("header", True).csv(f"{tmp_path}/all").count() == 4


def test_rotating_log(tmp_path):
    from orgextract.streaming.progress import setup_logging

    log = setup_logging(str(tmp_path), "orgextract-test")
    log.info("seen")
    assert setup_logging(str(tmp_path), "orgextract-test") is log and len(log.handlers) == 2
    assert (tmp_path / "orgextract-test.log").read_text().strip() == "seen"


def test_budget_per_host_as_a_stream(spark, tmp_path):
    put = lambda n, rows: spark.createDataFrame(rows, "host string, url string, s int").selectExpr("host", "url", "timestamp_seconds(s) AS ts").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    schema = "host string, url string, ts timestamp"
    put(1, [("h", "1", 1000), ("h", "2", 1200), ("g", "1", 1250), (None, "x", 1)])
    out = []
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = monitor.watched(stream, 300).writeStream.foreachBatch(lambda df, i: out.extend(map(tuple, df.select("host", "url", "event").collect()))).option("checkpointLocation", f"{tmp_path}/cp").start()
    try:
        q.processAllAvailable()
        put(2, [("h", "3", 1290), ("h", "4", 1301), ("k", "1", 2000)])
        q.processAllAvailable()
        put(3, [("k", "2", 2001)])
        q.processAllAvailable()
    finally:
        q.stop()
    visits = {x for x in out if x[2] != "budget exceeded"}
    assert visits == {("h", "1", "visit"), ("h", "2", "visit"), ("g", "1", "visit"), ("h", "3", "visit"), ("h", "4", "skipped"), ("k", "1", "visit"), ("k", "2", "visit")}
    assert sorted(x[0] for x in out if x[2] == "budget exceeded") == ["g", "h"]
