from orgextract.operators import extract

HTML = (
    '<div>CEO Ann Leeds ann@x.org</div><p>Treasurer, Max Moe <a href="mailto:max@x.org?s=1">mail</a></p>'
    '<a data-cfemail="5a3b34341a392f7435283d">Click here</a><a href="a/b">1</a><a href="/c#t">2</a><a href="c">3</a><a href="/blog/">4</a><a href="http://y.org">5</a>'
)


def pages(spark):
    return spark.createDataFrame([(1, "https://x.org/d/", HTML), (2, "https://x.org/e", None), (3, None, "")], "page_id int, source_url string, html string")


def test_extractors(spark):
    got = {(r.found_via, r.role, r.name, r.email) for r in extract.extract(pages(spark)).collect()}
    assert ("leadership-structured", "CEO", "Ann Leeds", "ann@x.org") in got
    assert ("cfemail", "", "", "ann@cu.org") in got and ("click-here", "", "", "ann@cu.org") in got
    assert any(g[0] == "leadership-mailto" and g[1] == "Treasurer" and g[3] == "max@x.org" for g in got)
    assert {g[3] for g in got if g[0] == "html"} == {"ann@x.org", "max@x.org"}
    assert extract.extract(pages(spark).filter("false")).count() == 0


def test_links(spark):
    got = sorted((r.pos, r.url) for r in extract.links(pages(spark)).collect())
    assert [u for _, u in got] == ["https://x.org/d/a/b", "https://x.org/c", "https://x.org/d/c"]
    assert extract.links(pages(spark), cap=1).count() == 1


def test_site_config(spark):
    cfg = spark.createDataFrame([("x.or", 2, "second"), ("x.org", 1, "first")], "key string, ord int, name string")
    got = {r.page_id: r.name for r in extract.site_config(pages(spark), cfg).collect()}
    assert got == {1: "first", 2: "first", 3: None}
    cfg = spark.createDataFrame([("y.org", 1, "Y", "https://y.org/", ["/a"])], "key string, ord int, name string, base string, allowed_paths array<string>")
    got = {r.page_id: (r.name, r.base, r.allowed_paths) for r in extract.site_config(pages(spark), cfg).filter("page_id < 3").collect()}
    assert got == {1: ("X", "https://x.org/", ["/"]), 2: ("X", "https://x.org/", ["/"])}


def test_look_behind(spark):
    df = spark.createDataFrame([(1, "", "President & CEO Ann Leeds: ann@x.org")], "page_id int, source_url string, html string")
    r = extract.look_behind_people(df).first()
    assert (r.role, r.email) == ("President & CEO", "ann@x.org")


def test_text_people(spark):
    text = "<p>CEO Ann Leeds, ann@x.org</p>" + "y " * 400 + "<p>Treasurer</p>" + "z " * 400 + "Loan Officer and Branch Manager Bo Li"
    df = spark.createDataFrame([(1, "u", text), (2, "u", None)], "page_id int, source_url string, html string")
    got = {(r.role, r.name, r.email) for r in extract.text_people(df).collect()}
    assert any(g[0] == "CEO" and "Ann Leeds" in g[1] and g[2] == "ann@x.org" for g in got)
    assert ("Treasurer", "", "") in got  # a lone capitalised word is no person's name on profile A
    assert extract.structured_or_text_people(df).filter("role = 'CEO'").count() >= 1


def test_other_sources(spark):
    pdf = spark.createDataFrame([(1, "u", ["Treasurer Max Moe max@x.org", None]), (2, "u", []), (3, "u", ["Secretary Zoe Bo zoe (at) x.org, mailto:amy@x.org?x", "b"])], "page_id int, source_url string, texts array<string>")
    assert {(r.email, r.role, r.found_via) for r in extract.pdf_people(pdf).collect()} == {("max@x.org", "Treasurer", "pdf-window"), ("amy@x.org", "Secretary", "pdf-window")}
    passes = {(r.kind, r.email, r.found_via) for r in extract.pdf_passes(pdf.filter("page_id = 3")).collect()}
    assert passes == {("LEADERSHIP", "amy@x.org", "pdf-text-context"), ("LEADERSHIP", "zoe@x.org", "pdf-text-context"), ("LEADERSHIP", "amy@x.org", "pdf-text-mailto"),
                      ("EMAIL", "amy@x.org", "pdf-text"), ("EMAIL", "zoe@x.org", "pdf-text"), ("EMAIL", "amy@x.org", "pdf-mailto")}
    assert {r.found_via for r in extract.pdf_passes(pdf, tag="pdf-ocr").collect()} == {"pdf-ocr", "pdf-ocr-context", "pdf-ocr-mailto", "pdf-mailto"}
    assert {(r.email, r.role, r.name) for r in extract.pdf_people(pdf, profile="B").filter("page_id = 1").collect()} == {("max@x.org", "Treasurer", "Treasurer Max Moe")}
    resp = spark.createDataFrame([(1, "u", 'a@x.org <i data-cfemail="5a3b34341a392f7435283d">')], "page_id int, source_url string, body string")
    assert {(r.email, r.found_via) for r in extract.network_emails(resp).collect()} == {("a@x.org", "network"), ("ann@cu.org", "network-cfemail")}
    failed = spark.createDataFrame([(1, "u", "a@x.org", "failed"), (2, "u", "b@x.org", "ok")], "page_id int, source_url string, html string, status string")
    assert [r.email for r in extract.salvage_emails(failed).collect()] == ["a@x.org"]
    assert extract.dispatch(pages(spark), {"x.org": ["html"], "y.org": ["html"]}).count() == 2


def test_progress_lines(tmp_path):
    import json

    from orgextract.streaming.progress import log_event

    log_event(str(tmp_path / "p"), "seen", n=1)
    assert json.loads((tmp_path / "p").read_text())["n"] == 1


def test_click_here_forms(spark):
    code = "5a3b34341a392f7435283d"
    html = (
        f'<p>CEO Ann Leeds <a href="/cdn-cgi/l/email-protection#9"><span class="__cf_email__" data-cfemail="{code}">x</span> Click HERE</a></p>'
        '<a href="mailto:m@x.org?subject=a" onclick="go(\'mailto:o@x.org\')">click here</a><a href="mailto:z@x.org">write</a><a href="#">click here</a>'
    )
    df = spark.createDataFrame([(1, "u", html), (2, "u", None)], "page_id int, source_url string, html string")
    assert {(r.found_via, r.email) for r in extract.click_here(df).collect()} == {("cfemail", "ann@cu.org"), ("click-here", "m@x.org"), ("onclick", "o@x.org")}
    b = {(r.found_via, r.role, r.name) for r in extract.click_here(df, "B").filter("found_via = 'cfemail'").collect()}
    assert b == {("cfemail", "CEO", "Ann Leeds")}


def test_mailto_rules(spark):
    html = (
        '<section>Director Ann Leeds of Sales<p>by <a href="mailto:a@x.org">mail</a></p></section>'
        '<ul><li>Bo Li Moss</li><li>Treasurer</li><li><a href="mailto:info@x.org">w</a> bo.li [at] x.org</li></ul>'
    )
    df = spark.createDataFrame([(1, "u", html), (2, "u", "")], "page_id int, source_url string, html string")
    c = {(r.email, r.role, r.name) for r in extract.mailto_people(df).collect()}
    assert c == {("a@x.org", "Director", "Director Ann Leeds"), ("info@x.org", "", "")}
    plain = {(r.email, r.role) for r in extract.mailto_people(df, tag="leadership-mailto-fallback").collect()}
    assert plain == {("a@x.org", ""), ("info@x.org", "")}
    a = {(r.email, r.role, r.name) for r in extract.mailto_context(df.withColumn("html", __import__("pyspark").sql.functions.expr("regexp_extract(html, '<ul>.*', 0)"))).collect()}
    assert a == {("bo.li@x.org", "Treasurer", "Bo Li Moss")}


def test_context_reads_the_parent_of_the_link_first(spark):
    html = "Manager Bo Li a@x.org" + " z" * 10 + '<p>Treasurer, Ann Leeds <a href="mailto:a@x.org">w</a></p> and Secretary Cy Moss b@x.org'
    df = spark.createDataFrame([(1, "u", html)], "page_id int, source_url string, html string")
    got = {r.email: (r.role, r.name) for r in extract.context_people(df).collect()}
    assert got["a@x.org"][0] == "Treasurer" and got["b@x.org"][0] == "Manager"


def test_containers(spark):
    html = "<html><body><div><h3>Leadership</h3><p>x</p></div><section><h2>Meet Our  Staff</h2>CEO Ann Leeds ann@acme.org</section></body></html>"
    df = spark.createDataFrame([(1, "u", html), (2, "u", "<p>no</p>"), (3, "u", None)], "page_id int, source_url string, html string")
    c = {r.page_id: (r.container or "").strip() for r in extract.container_text(df).collect()}
    assert c == {1: "Meet Our Staff", 2: "no", 3: ""}
    b = {r.page_id: r.container for r in extract.container_text(df, "B").collect()}
    assert b == {1: "Meet Our Staff CEO Ann Leeds ann@acme.org", 2: "", 3: ""}
    assert [(r.role, r.name, r.email, r.found_via) for r in extract.structured_people_b(df, "acme.org").collect()] == [("CEO", "Ann Leeds", "ann@acme.org", "leadership-text")]


def test_reaches_of_the_fallback(spark):
    text = "Treasurer " + "x" * 450 + " far@x.org and " + "Secretary" + "y" * 700 + " none@x.org"
    df = spark.createDataFrame([(1, "u", text), (2, "u", "CEO Ann Leeds ann @ x . org")], "page_id int, source_url string, html string")
    got = {(r.page_id, r.role, r.email, r.found_via) for r in extract.structured_or_text_people(df).collect()}
    assert (1, "Treasurer", "far@x.org", "msfcu-spacy") in got and (2, "CEO", "ann@x.org", "msfcu-strict") in got


def test_priority_links_and_site_links(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(["/x", "/team", "/y", "/board", "/z"],), ([],)], "l array<string>")
    first = lambda q: [r.p for r in df.select(extract.priority_links(F.col("l"), lambda x: x.rlike("team|board"), q).alias("p")).collect()]
    assert first(3) == [["/team", "/board", "/x"], []] and first(1) == [["/team", "/board"], []]
    html = '<a href="/zzz-auto-x">n</a><a href="/zzz">1</a><a href="/team">2</a>'
    pages_ = spark.createDataFrame([(1, "https://x.org/", html)], "page_id int, source_url string, html string")
    seen = spark.createDataFrame([("https://x.org/team",)], "url string")
    assert [r.url for r in extract.links(pages_, visited=seen).collect()] == ["https://x.org/zzz"]
    pdfs = spark.createDataFrame([(1, "https://x.org/", '<a href="/a.pdf"></a><a href="/b.PDF"></a><a href="/c.pdf"></a><a href="/a.pdf"></a><a href="/loans/d.pdf"></a>')], "page_id int, source_url string, html string")
    assert sorted(r.url for r in extract.pdf_links(pdfs).collect()) == ["https://x.org/a.pdf", "https://x.org/b.PDF"] and extract.pdf_links(pdfs, None).count() == 3


def test_hooks(spark):
    from pyspark.sql import functions as F

    from orgextract.functions import urls as u

    urls = ["https://www.s.org/contact/", "https://s.org/a?x=/support", "https://sub.s.org/staff", "https://t.org/contact", None]
    df = spark.createDataFrame([(x,) for x in urls], "u string")
    of = lambda profile: [r.h for r in df.select(u.hook_applies(F.col("u"), "s.org", profile).alias("h")).collect()]
    assert of("A") == [True, False, True, False, None] and of("B") == [True, True, False, False, None] and of("C") == [True, True, False, False, None]
