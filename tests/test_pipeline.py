from orgextract import cli
from orgextract.sources import sinks

HOME = '<a href="/team">t</a><a href="/blog/1">b</a><a href="https://other.org/">o</a><a href="/minutes.pdf">p</a> write to info@acme.org'
TEAM = (
    '<script type="application/ld+json">{"@type":"Person","jobTitle":"CEO","name":"Ann Bo","email":"Ann@acme.org"}</script>'
    '<p>Treasurer, Max Moe <a href="mailto:max@acme.org">write</a></p><a href="/team/board">more</a>'
)
BOARD = '<p>Board Chair Bea Lomax bea [at] acme [dot] org</p><a href="/team/board/old">older</a>'


def tables(spark, folder):
    pages = [("https://acme.org", HOME, "ok"), ("https://acme.org/team/", TEAM, "ok"), ("https://acme.org/team/board", BOARD, "ok"), ("https://acme.org/team/board/old", "x@acme.org", "ok"),
             ("https://unlinked.acme.org/", "no@acme.org", "ok"), ("https://beta.coop/", "<p>kim@beta.coop", "failed"), (None, "nul@acme.org", "ok"), ("https://acme.org/blog/1", "blog@acme.org", "ok")]
    spark.createDataFrame(pages, "url string, html string, status string").write.parquet(f"{folder}/pages")
    pdfs = [("https://acme.org/minutes.pdf", 200, "application/pdf", 9, 1.0, b"Secretary, Zoe Quill, zoe@acme.org"), ("https://acme.org/big.pdf", 200, "application/pdf", 9, 1.0, b"big@acme.org")]
    spark.createDataFrame(pdfs, "url string, status int, content_type string, content_length long, seconds double, content binary").write.parquet(f"{folder}/pdfs")
    spark.createDataFrame([("https://acme.org/team", "https://acme.org/api", "application/json", '{"m":"api@acme.org"}')], "page_url string, url string, content_type string, body string").write.parquet(f"{folder}/responses")
    with open(f"{folder}/orgs.csv", "w") as f:
        f.write("name,website\nAcme CU,https://acme.org/\nAcme again,acme.org\nBeta,beta.coop\n")


def test_command_line_from_list_to_events(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    tables(spark, folder)
    monkeypatch.setattr("orgextract.sources.documents.native_texts", None)
    import orgextract.plans.pipeline as pl

    monkeypatch.setattr(pl, "pdf_texts", lambda df, pages, ocr=None: df.selectExpr("path", "array(decode(content, 'UTF-8')) AS texts", "cast(array() AS array<string>) AS ocr_texts"))
    args = [f"{folder}/orgs.csv", "--pages", f"{folder}/pages", "--responses", f"{folder}/responses", "--pdf", "--pdfs", f"{folder}/pdfs", "--out", f"{folder}/out",
            "--checkpoint-dir", f"{folder}/state", "--log-dir", f"{folder}/log", "--as-of", "2025-01-01", "--depth-limit", "1"]
    assert cli.main([*args, "--run-id", "one"]) == 0
    got = {(r.type, r.role, r.name, r.address, r.found_via) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert ("LEADERSHIP", "CEO", "Ann Bo", "mailto:ann@acme.org", "json-ld") in got
    assert ("EMAIL", "", "", "ann@acme.org", "json-ld-email") in got  # the first place it is found at
    assert any(g[:2] == ("LEADERSHIP", "Treasurer") and g[3:] == ("mailto:max@acme.org", "html-context") for g in got)
    assert ("EMAIL", "", "", "max@acme.org", "html") in got and ("EMAIL", "", "", "kim@beta.coop", "html-after-fail") in got
    assert ("EMAIL", "", "", "api@acme.org", "network") in got
    assert ("LEADERSHIP", "Secretary", "Secretary", "mailto:zoe@acme.org", "pdf-window") in got
    addresses = {g[3].removeprefix("mailto:") for g in got}
    # a shared mailbox stays out of plain addresses but its leadership record brings it in
    assert ("EMAIL", "", "", "info@acme.org", "html-context-email") in got and ("EMAIL", "", "", "info@acme.org", "html") not in got
    assert addresses.isdisjoint({"no@acme.org", "nul@acme.org", "blog@acme.org", "big@acme.org", "bea@acme.org", "x@acme.org"})
    assert {(r.node, r.depth) for r in sinks.load_state(spark, f"{folder}/state", "frontier").collect()} == {("https://acme.org/team/board", 2)}
    # a second run goes on from the saved state
    assert cli.main([*args[:-1], "2", "--run-id", "two"]) == 0
    more = {r.address for r in spark.read.parquet(f"{folder}/out").filter("run_id = 'two'").collect()}
    assert more == {"mailto:bea@acme.org", "bea@acme.org"}
    assert cli.main([*args, "--limit-domains", "none.org"]) == 1


def test_csv_output_and_reset(spark, tmp_path):
    folder = str(tmp_path)
    tables(spark, folder)
    args = [f"{folder}/orgs.csv", "--pages", f"{folder}/pages", "--out", f"{folder}/out", "--out-format", "csv", "--checkpoint-dir", f"{folder}/state", "--reset", "--limit-seeds", "1",
            "--extractors-of", "acme.org=leadership-mailto,click-here"]
    for _ in range(2):
        assert cli.main(args) == 0
    got = spark.read.option("header", True).csv(f"{folder}/out")
    assert got.filter("found_via = 'leadership-mailto'").count() == 0  # the first record per key stays: html-context
    assert {r.address for r in got.collect()} >= {"mailto:ann@acme.org", "mailto:max@acme.org"} and "kim@beta.coop" not in {r.address for r in got.collect()}
    assert got.select("run_id").distinct().count() == 1
