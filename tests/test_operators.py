from pyspark.sql import functions as F

from orgextract.functions.html import ancestor_text, html_elements
from orgextract.functions.jsonld import people
from orgextract.operators import announcements, nearest, resolve
from orgextract.operators.frontier import expand
from orgextract.operators.skew import join_counted, join_split


def test_nearest_span(spark):
    hits = spark.createDataFrame([(1, 10), (1, 500), (1, 2000), (2, 5)], "doc int, pos int")
    spans = spark.createDataFrame([(1, 5, 9, "Ann"), (1, 300, 310, "Bob"), (1, 515, 520, "Cy")], "doc int, start int, end int, text string")
    got = {(r.doc, r.pos): r.nearest for r in nearest.nearest_span(hits, spans, "doc", 300).collect()}
    assert got == {(1, 10): "Ann", (1, 500): "Cy", (1, 2000): "", (2, 5): ""}
    plan = nearest.nearest_span(hits, spans, "doc", 300)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_frontier_cycle_and_depth(spark):
    links = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (None, 9), (5, 5)], "src int, dst int")
    seeds = spark.createDataFrame([(0,), (0,), (None,)], "node int")
    assert sorted(tuple(r) for r in expand(links, seeds, 3).collect()) == [(0, 0), (1, 1), (2, 2), (3, 3)]
    assert expand(links, seeds.filter("false"), 3).count() == 0
    stop = spark.createDataFrame([(2,)], "node int")
    assert sorted(r.node for r in expand(links, seeds, 3, stop).collect()) == [0, 1, 2]


def test_dedup_and_caps(spark):
    df = spark.createDataFrame([(1, "CEO", "Ann", "A@x.org", "u"), (2, "ceo", "ann", "a@x.org", "u"), (3, None, None, None, None), (4, "CEO", "Ann", "a@x.org", "v")], "id int, role string, name string, email string, source_url string")
    assert sorted(r.id for r in resolve.dedup_records(resolve.clean_records(df), ["id"]).collect()) == [1, 4]
    pages = spark.range(3000).select(F.when(F.col("id") < 2900, "hot").otherwise(F.col("id").cast("string")).alias("h"), "id")
    capped = nearest.cap_per_key(pages, "h", ["id"], 3)
    assert sorted(r.id for r in capped.filter("h = 'hot'").collect()) == [0, 1, 2] and capped.count() == 103


def test_confidence(spark):
    df = spark.createDataFrame([("json-ld", "CEO"), ("html-context", ""), ("network-cfemail", ""), ("onclick", ""), (None, None)], "tag string, role string")
    assert [r.c for r in df.select(resolve.confidence(F.col("tag"), F.col("role")).alias("c")).collect()] == [0.75, 0.6, 0.7, 0.6, 0.6]


def test_role_rank(spark):
    names = ["President & CEO", "Vice President", "Chief Financial Officer", "SVP", "Coordinator", None]
    df = spark.createDataFrame([(n,) for n in names], "role string")
    assert [r.x for r in df.select(resolve.role_rank(F.col("role")).alias("x")).collect()] == [0, 1, 9, 4, 3, 9]


def test_personal_emails_fall_back(spark):
    df = spark.createDataFrame([("info@a.org",), ("info@a.org",)], "email string")
    assert [r.email for r in resolve.personal_emails(df).collect()] == ["info@a.org"]
    more = df.unionByName(spark.createDataFrame([("ann@a.org",)], "email string"))
    assert [r.email for r in resolve.personal_emails(more).collect()] == ["ann@a.org"]


def test_jsonld(spark):
    bodies = ['{"@type":"Person","jobTitle":"CEO"}', "{bad", None, '[{"name":"A"}]', '{"staff":{"name":"B","email":"b@x.org"}}', "3", '{"name":"no person"}']
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    assert sorted(tuple(r) for r in people(df, ["i"], "body").collect()) == [(0, "CEO", "", ""), (3, "", "A", ""), (4, "", "B", "b@x.org")]
    assert [r.i for r in people(df, ["i"], "body", needs_email=True).collect()] == [4]


def test_html_elements(spark):
    df = spark.createDataFrame([(1, "<div>CEO<br><p>Ann <a href='mailto:a@x.org'>mail</a></p></div>"), (2, None), (3, "")], "id int, html string")
    a = ancestor_text(html_elements(df, "id", "html"), "id").filter("tag = 'a'").first()
    assert a.attrs["href"] == "mailto:a@x.org" and a.text_up1 == "Ann mail"


def test_new_announcements(spark):
    cur = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "3")], "Title string, Link string")
    prev = spark.createDataFrame([("a", "1"), (None, "3")], "Title string, Link string")
    assert sorted((tuple(r) for r in announcements.new_rows(cur, prev).collect()), key=str) == [("b", "2"), (None, "3")]


def test_join_counted_matches_plain_join(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 50).cast("string")).alias("k"), "id")
    keyed = rows.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("m")).filter("k <> '5'")
    want = rows.join(keyed.drop("n"), "k", "left").select("id", "m")
    got = join_counted(rows, keyed, "k", "n", "left").select("id", "m")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert join_counted(rows, keyed, "k", "n").count() == rows.join(keyed, "k").count()


def test_join_split_matches_plain_join(spark):
    left = spark.range(400).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None).otherwise((F.col("id") % 20).cast("string")).alias("k"), F.col("id").alias("a"))
    right = left.select("k", F.col("a").alias("b"))
    want = sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    plan = join_split(left, right, ["k"], least=10, sample=1)
    assert sorted(map(tuple, plan.select("k", "a", "b").collect())) == want
    assert join_split(left, right, ["k"]).count() == len(want)
    assert join_split(left, right, ["k"], least=40, sample=4).count() == len(want)
    assert join_split(left, right.filter("false"), ["k"], least=10).count() == 0


def test_neighbour_line_rules(spark):
    rows = [
        (1, 0, "CEO", ""), (1, 1, "", "Ann"), (1, 2, "", ""), (1, 8, "CFO", ""), (1, 9, "", "Bo"), (1, 7, "", "Cy"),
        (2, 0, "CEO", "Ann"), (2, 1, "Online Banking Manager", ""), (2, 2, "CFO", "Bo"), (3, 0, "VP", ""), (4, 0, "", "Di"),
    ]
    df = spark.createDataFrame(rows, "k int, line_no int, role string, name string")
    got = {r.k: (r.role, r.name) for r in nearest.neighbour_line(df, "k", 5, lambda c: F.lower(c).contains("online banking")).collect()}
    assert got == {1: ("CFO", "Bo"), 2: ("", "Ann"), 3: ("VP", ""), 4: ("", "Di")}
    assert nearest.neighbour_line(df.filter("false"), "k").count() == 0


def test_expansion_goes_on_from_a_saved_state(spark):
    links = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (0, 4), (4, 5), (5, 0)], "src int, dst int")
    seeds = spark.createDataFrame([(0,)], "node int")
    whole = sorted(tuple(r) for r in expand(links, seeds, 3).collect())
    early = expand(links, seeds, 1)
    frontier = spark.createDataFrame([(2, 2), (5, 2), (1, 5)], "node int, depth int")
    assert sorted(tuple(r) for r in expand(links, frontier, 3, visited=early).collect()) == whole
    assert sorted(tuple(r) for r in expand(links, frontier.filter("false"), 3, visited=early).collect()) == sorted(tuple(r) for r in early.collect())


def test_a_finished_site_is_left(spark):
    links = spark.createDataFrame([("a/0", "a/1"), ("a/1", "a/2"), ("a/0", "b/0"), ("b/0", "b/1"), ("b/1", "a/3")], "src string, dst string")
    seeds = spark.createDataFrame([("a/0",)], "node string")
    site = lambda c: F.substring_index(c, "/", 1)
    senior = lambda level: level.filter("node = 'a/1'").select(site(F.col("node")).alias("site"))
    got = sorted(r.node for r in expand(links, seeds, 5, site=site, finished=senior).collect())
    assert got == ["a/0", "a/1", "b/0", "b/1"]


def test_budget_and_counters(spark):
    df = spark.createDataFrame([("h", 0), ("h", 299), ("h", 301), ("g", 500), (None, 1)], "host string, s int").selectExpr("host", "timestamp_seconds(s) AS ts")
    got = {(r.host, r.elapsed, r.ok) for r in resolve.within_budget(df, "host", "ts", 300).collect()}
    assert got == {("h", 0.0, True), ("h", 299.0, True), ("h", 301.0, False), ("g", 0.0, True), (None, None, True)}
    texts = spark.createDataFrame([(1, ["ab", None, "c"]), (2, None)], "id int, texts array<string>")
    assert {r.id: r.chars for r in resolve.text_lengths(texts, "id").collect()} == {1: 3, 2: 0}


def test_entities_of_an_entry(spark):
    df = spark.createDataFrame([(1, "Ann Bo named CEO", "of Red Oak Credit Union, says Cy Moss", "l"), (2, None, "", None)], "id int, title string, description string, link string")
    got = {r.id: (r.persons, r.organizations) for r in announcements.with_entities(df, "id").collect()}
    assert got[2] == ([], []) and got[1][1] == ["Red Oak Credit Union"] and got[1][0][0] == "Ann Bo"


def test_leaders_addresses_become_events(spark):
    schema = "credit_union string, email string, source_url string, found_via string, role string, id int"
    x = spark.createDataFrame([("A", "info@a.org", "https://a.org/", "html-context", "CEO", 2), ("A", "ann@a.org", "https://a.org/", "json-ld", "", 3), ("A", "", "https://a.org/", "json-ld", "", 4)], schema)
    plain = resolve.email_records(spark.createDataFrame([("A", "info@a.org", "https://a.org/", "html", "", 1), ("A", "Ann@a.org", "https://a.org/", "html", "", 3)], schema), F.array().cast("array<string>"))
    got = {(r.email, r.found_via) for r in resolve.with_leaders_emails(plain, x, F.array().cast("array<string>"), ["id"]).collect()}
    assert got == {("info@a.org", "html-context-email"), ("ann@a.org", "html")}
