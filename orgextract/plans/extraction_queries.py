"""Queries of the extractors, gates and crawl rules over pages, requests and records derived from the tables.

The pages are templates with a row's key in them; the SQL beside a query states, in closed form,
what the documented rules make of the template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgextract import profiles as p
from orgextract.functions import emails as e
from orgextract.functions import text as t
from orgextract.functions import urls as u
from orgextract.operators import announcements as ann
from orgextract.operators import extract as ext
from orgextract.operators import resolve
from orgextract.operators.frontier import expand
from orgextract.plans.reference_queries import _ORG_C, _RE2_EMAIL, _STRIP, _sql_list
from orgextract.session import table
from orgextract.sources import documents

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _filled(template: str, key: Column) -> Column:
    return F.replace(F.lit(template), F.lit("{k}"), key.cast("string"))


def _pages(spark: SparkSession, d: str, template: str, url: str = "https://www.s{k}cu.org/team") -> DataFrame:
    """A page per supplier: page_id, source_url, html."""
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("page_id"), _filled(url, k).alias("source_url"), _filled(template, k).alias("html"))


_FOUND = ["page_id", "found_via", "role", "name", "email"]


def _expected(*rows: tuple[str, str, str, str]) -> str:
    """SQL of the same records for every page; {k} is the key."""
    filled = lambda v: "'" + v.replace("'", "''").replace("{k}", "' || s_suppkey || '") + "'"
    parts = [f"SELECT s_suppkey AS page_id, {filled(via)} AS found_via, {filled(role)} AS role, {filled(name)} AS name, {filled(mail)} AS email FROM supplier" for via, role, name, mail in rows]
    return " UNION ALL ".join(parts)


# ---------------------------------------------------------------- e-mail and URL rules


@query(r"""SELECT doc_id, unnest(list_distinct(regexp_extract_all(replace(replace(replace(replace(replace(replace(text, '[at]', '@'), '(at)', '@'), ' at ', '@'), '[dot]', '.'), '(dot)', '.'), ' dot ', '.'), '{EMAIL}'))) AS email FROM documents""".replace("{EMAIL}", _RE2_EMAIL))
def emails_extract_all(spark: SparkSession, d: str) -> DataFrame:
    """Plain and encoded addresses of a text made readable, each once."""
    return table(spark, d, "documents").select("doc_id", F.explode(e.extract_all(F.col("text"))).alias("email"))


@query("SELECT c_custkey, 'ann' || c_custkey || '@cu.org' AS email FROM customer")
def deobfuscate_entities(spark: SparkSession, d: str) -> DataFrame:
    """E3 (C): character entities are resolved before brackets are read."""
    raw = _filled("ann{k}&#91;at]cu &lsqb;dot&#x5d; org", F.col("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", e.deobfuscate(raw, "C").alias("email"))


@query(rf"""SELECT rec_id, list_contains({_sql_list(p.GENERIC_C)}, lower(split_part(email, '@', 1)))
 AND NOT (contains(found_via, 'leadership') OR contains(found_via, 'json-ld') OR contains(found_via, 'pdf-window')) AS suppressed FROM people WHERE email IS NOT NULL""")
def generic_suppressed(spark: SparkSession, d: str) -> DataFrame:
    """P7."""
    x = table(spark, d, "people").filter("email IS NOT NULL")
    return x.select("rec_id", e.suppress_generic(F.col("email"), F.col("found_via"), F.lit(False)).alias("suppressed"))


#: URL, blocked on A, blocked on C.
_REQUESTS = [("https://x.org/a.PNG", True, True), ("https://x.org/a.png?v=2", True, True), ("https://x.org/a.pngx", False, False), ("https://x.org/f.woff2", True, True), ("https://x.org/gtm.com/x", True, True),
             ("https://www.google-analytics.com/c", False, False), ("https://google-analytics.com/c", True, True), ("https://ad.doubleclick.net/x", True, True), ("https://facebook.com/tr/1", True, True),
             ("https://snapchat.com/x", False, True), ("https://hotjar.com/x", True, True), ("https://x.org/doc.pdf", False, False), ("https://x.org/v.mp4", False, False)]


@query("SELECT n_nationkey, url, a, c FROM nation, (VALUES " + ", ".join(f"('{x}', {a}, {c})" for x, a, c in _REQUESTS) + ") AS r(url, a, c)")
def blocked_requests(spark: SparkSession, d: str) -> DataFrame:
    """S17, P12 on profiles A and C."""
    x = table(spark, d, "nation").select("n_nationkey", F.explode(F.array(*[F.lit(r[0]) for r in _REQUESTS])).alias("url"))
    return x.select("n_nationkey", "url", u.is_blocked(F.col("url"), "A").alias("a"), u.is_blocked(F.col("url"), "C").alias("c"))


@query(rf"""SELECT entry_id, len(list_filter({_sql_list(p.PEOPLE_ALLOW)}, lambda w: contains(lower(source_url), w))) > 0 OR len(list_filter({_sql_list(p.PEOPLE_DENY)}, lambda w: contains(lower(source_url), w))) = 0 AS relevant
FROM leadership_entries WHERE source_url IS NOT NULL""")
def url_relevance(spark: SparkSession, d: str) -> DataFrame:
    """P9b."""
    x = table(spark, d, "leadership_entries").filter("source_url IS NOT NULL")
    return x.select("entry_id", u.is_people_relevant(F.col("source_url")).alias("relevant"))


_TYPES = [("text/html; charset=utf-8", True), ("TEXT/PLAIN", True), ("application/json", True), ("application/xhtml+xml", True), ("application/xml", True), ("text/css", False), ("image/png", False), ("", False)]


@query("SELECT n_nationkey, kind, ok FROM nation, (VALUES " + ", ".join(f"('{x}', {ok})" for x, ok in _TYPES) + ") AS r(kind, ok)")
def content_types(spark: SparkSession, d: str) -> DataFrame:
    """P10, S10."""
    x = table(spark, d, "nation").select("n_nationkey", F.explode(F.array(*[F.lit(k) for k, _ in _TYPES])).alias("kind"))
    return x.select("n_nationkey", "kind", u.is_text_type(F.col("kind")).alias("ok"))


@query("""SELECT s_suppkey, s_suppkey % 3 <> 2 AND s_suppkey % 2 = 0 AS a, CASE s_suppkey % 3 WHEN 0 THEN s_suppkey % 2 = 0 WHEN 1 THEN true ELSE false END AS b, s_suppkey % 3 = 0 AS c FROM supplier""")
def hook_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages a site's own extractor reads, on each profile."""
    k = F.col("s_suppkey")
    host = F.when(k % 3 == 0, "https://www.acme.org").when(k % 3 == 1, "https://sub.acme.org").otherwise("https://acne.org")
    path = F.when(k % 2 == 0, "/contact/us").otherwise(F.when(k % 3 == 1, "/x?y=/support").otherwise("/about"))
    url = F.concat(host, path)
    return table(spark, d, "supplier").select(k, *[u.hook_applies(url, "acme.org", x).alias(x.lower()) for x in "ABC"])


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'https://s' || s_suppkey || '.org' WHEN 1 THEN 'http://s' || s_suppkey || '.org' END AS source_url, CASE WHEN s_suppkey % 3 < 2 THEN 'page' END AS html FROM supplier""")
def fetch_retry(spark: SparkSession, d: str) -> DataFrame:
    """A third answers, a third answers under the other scheme only, a third under neither."""
    k = table(spark, d, "supplier").select("s_suppkey", _filled("https://s{k}.org", F.col("s_suppkey")).alias("url"))
    at = F.col("s_suppkey") % 3
    first = k.select("url", F.when(at == 0, "ok").otherwise("failed").alias("status"), F.lit("page").alias("html"))
    other = k.filter(at == 1).select(u.flip_scheme(F.col("url")).alias("url"), F.lit("ok").alias("status"), F.lit("page").alias("html"))
    return documents.fetched_pages(k.select("url"), first.unionByName(other)).join(k, "url").select("s_suppkey", "source_url", "html")


@query("SELECT 's' || s_suppkey || CASE WHEN s_suppkey % 6 = 0 THEN '.pdf' ELSE '' END AS path FROM supplier WHERE s_suppkey % 6 IN (0, 1)")
def pdf_gate(spark: SparkSession, d: str) -> DataFrame:
    """By suffix, by content type; not: other type, failed, too long by header, too slow."""
    k = F.col("s_suppkey")
    at = k % 6
    x = table(spark, d, "supplier").select(
        F.concat(_filled("s{k}", k), F.when(at == 1, "").when(at == 2, ".html").otherwise(".pdf")).alias("url"), F.when(at == 3, 404).otherwise(200).alias("status"),
        F.when(at == 1, "application/pdf").otherwise("text/html").alias("content_type"), F.when(at == 4, 5_000_000).otherwise(1).cast("bigint").alias("content_length"),
        F.when(at == 5, 26.0).otherwise(1.0).alias("seconds"), F.lit("x").cast("binary").alias("content"),
    )
    return documents.pdf_responses(x).select("path")


# ---------------------------------------------------------------- organisation list


@query(r"""WITH a AS (SELECT org_id, trim(coalesce(CASE WHEN org_id % 2 = 0 THEN replace(url, '.example', '.org') ELSE url END, ''), E' \t\n\r"''') AS x FROM credit_unions),
b AS (SELECT org_id, x, CASE WHEN regexp_matches(x, '(?i)^[a-z][a-z0-9+.-]*://') THEN x ELSE 'https://' || ltrim(x, '/') END AS f FROM a),
c AS (SELECT org_id, x, f, lower(trim(regexp_extract(f, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1))) AS h FROM b)
SELECT org_id, x <> '' AND NOT (h LIKE '%facebook.com%' OR h LIKE '%wixsite.com%' OR h LIKE '%linktr.ee%') AND regexp_matches(f, '(?i)^https?://[^/?#]+')
 AND (h LIKE '%.coop' OR h LIKE '%.or' OR h LIKE '%.og' OR h LIKE '%.coo' OR h LIKE '%.org' OR h LIKE '%.cu' OR h LIKE '%creditunion%') AS ok FROM c""")
def seed_valid(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the list that are kept."""
    raw = F.when(F.col("org_id") % 2 == 0, F.replace("url", F.lit(".example"), F.lit(".org"))).otherwise(F.col("url"))
    return table(spark, d, "credit_unions").select("org_id", u.is_valid_seed(raw).alias("ok"))


@query("SELECT org_id, credit_union FROM credit_unions ORDER BY org_id LIMIT 10")
def seed_limit(spark: SparkSession, d: str) -> DataFrame:
    """L1: the first ten; the limit is the feature."""
    return resolve.first_rows(table(spark, d, "credit_unions").select("org_id", "credit_union"), ["org_id"], 10)


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'First' ELSE 'S' || s_suppkey END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'https://first.org/' ELSE 'https://s' || s_suppkey || '.org/' END AS base FROM supplier""")
def site_defaults(spark: SparkSession, d: str) -> DataFrame:
    """JN6: half of the hosts have a configuration, the others get the default."""
    k = F.col("s_suppkey")
    url = F.when(k % 2 == 0, "https://www.first.org/x").otherwise(_filled("https://s{k}.org/x", k))
    pages = table(spark, d, "supplier").select(k.alias("page_id"), url.alias("source_url"))
    config = spark.createDataFrame([("first.o", 2, "Second", "https://second.org/"), ("first.org", 1, "First", "https://first.org/")], "key string, ord int, name string, base string")
    return ext.site_config(pages, config).select(F.col("page_id").alias("s_suppkey"), "name", "base")


# ---------------------------------------------------------------- extractors


@query(_expected(("mailto-context", "Treasurer", "Max Moe", "max{k}@cu.org"), ("mailto-context", "", "Ann Leeds", "info{k}@cu.org"), ("mailto-context", "Secretary", "Zoe Quill", "zoe.q{k}@cu.org")))
def mailto_context_lines(spark: SparkSession, d: str) -> DataFrame:
    """X5 (A), JN4, JN5: the last role line decides, a service role blanks and ends, the address that fits the name is taken."""
    html = (
        '<div><div><p>President</p><p>Max Moe</p><p>Treasurer <a href="mailto:max{k}@cu.org?subject=x">write</a></p></div></div>'
        '<section><section><p>Ann Leeds</p><p>CEO</p><p>Director of online banking</p><p>Treasurer <a href="mailto:info{k}@cu.org">write</a></p></section></section>'
        '<table><tr><td>Zoe Quill<br>Secretary<br>zoe.q{k} [at] cu [dot] org <a href="mailto:hello{k}@cu.org">write</a></td></tr></table>'
    )
    return ext.mailto_context(_pages(spark, d, html)).select(*_FOUND)


@query(_expected(("leadership-mailto", "Director", "Director Ann Leeds", "a{k}@cu.org"), ("leadership-mailto", "Manager", "Bo Li", "b{k}@cu.org")))
def mailto_grandparent(spark: SparkSession, d: str) -> DataFrame:
    """X5 (C), JN5: a short parent gives way to the grandparent."""
    html = '<section>Director Ann Leeds of Sales<p>by <a href="mailto:a{k}@cu.org">mail</a></p></section><section>Nobody here<p>Bo Li, Manager <a href="mailto:b{k}@cu.org">mail</a></p></section>'
    return ext.mailto_people(_pages(spark, d, html)).select(*_FOUND)


@query(_expected(("support-mailto", "branch manager", "Bo Li", "b{k}@cu.org")))
def mailto_support(spark: SparkSession, d: str) -> DataFrame:
    """X5 (B): the longest role and the first name of the parent."""
    return ext.mailto_people(_pages(spark, d, '<p>Bo Li is branch manager, not CEO <a href="mailto:b{k}@cu.org?x">mail</a></p>'), "B", "support-mailto").select(*_FOUND)


@query(_expected(("click-here", "", "", "m{k}@cu.org"), ("onclick", "", "", "o{k}@cu.org"), ("cfemail", "", "", "ann@cu.org")))
def click_here_forms(spark: SparkSession, d: str) -> DataFrame:
    """A mailto link, an onclick script and a protected link."""
    html = (
        '<a href="mailto:m{k}@cu.org?subject=a" onclick="go(&quot;mailto:o{k}@cu.org&quot;)">Click HERE</a><a href="mailto:n{k}@cu.org">write</a>'
        '<a href="/cdn-cgi/l/email-protection#1"><span class="__cf_email__" data-cfemail="5a3b34341a392f7435283d">x</span> click here</a>'
    )
    return ext.click_here(_pages(spark, d, html)).select(*_FOUND)


@query("""SELECT s_suppkey AS page_id, CASE WHEN s_suppkey % 3 = 0 THEN 'Meet our staff' WHEN s_suppkey % 3 = 1 THEN 'Our Leadership team' ELSE 'plain page' END AS c,
 CASE WHEN s_suppkey % 3 = 0 THEN 'Meet our staff CEO Ann Leeds' ELSE '' END AS b FROM supplier""")
def container_headings(spark: SparkSession, d: str) -> DataFrame:
    """X7b on profiles C and B."""
    k = F.col("page_id")
    html = F.when(k % 3 == 0, "<p>Leadership</p><div><h2>Meet our  staff</h2>CEO Ann Leeds</div>").when(k % 3 == 1, "<h4>Our Leadership team</h4><p>x</p>").otherwise("plain page")
    pages = _pages(spark, d, "").withColumn("html", html)
    c = ext.container_text(pages, "C").select("page_id", F.col("container").alias("c"))
    return c.join(ext.container_text(pages, "B").select("page_id", F.col("container").alias("b")), "page_id")


@query(_expected(("leadership-text", "Loan Officer", "Bo Li", "bo{k}@acme.org")))
def structured_block_b(spark: SparkSession, d: str) -> DataFrame:
    """X7 (B): only around the heading, only the site's own domain."""
    html = "<p>CEO Out Side out{k}@acme.org</p><div><h2>Meet our staff</h2><p>Loan Officer: Bo Li - bo{k}@acme.org</p><p>CEO Ann Leeds ann{k}@other.org</p></div>"
    return ext.structured_people_b(_pages(spark, d, html), "acme.org").select(*_FOUND)


@query("""SELECT s_suppkey AS page_id, 'msfcu-strict' AS found_via, 'CEO' AS role, 'Ann Leeds' AS name, 'ann' || s_suppkey || '@cu.org' AS email FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey, 'msfcu-spacy', 'Treasurer', 'Max Moe', 'far' || s_suppkey || '@cu.org' FROM supplier WHERE s_suppkey % 2 = 1""")
def structured_or_text(spark: SparkSession, d: str) -> DataFrame:
    """The fallback sees persons within 400 characters and addresses within 600."""
    k = F.col("page_id")
    strict = _filled("<p>CEO Ann Leeds ann{k} @ cu . org</p>", k)
    loose = F.concat(F.lit("<p>Max Moe</p> "), F.repeat(F.lit("x "), 100), F.lit(" Treasurer "), F.repeat(F.lit("y "), 270), _filled("far{k}@cu.org", k), F.repeat(F.lit(" z"), 40), F.lit(" none@cu.org"))
    return ext.structured_or_text_people(_pages(spark, d, "").withColumn("html", F.when(k % 2 == 0, strict).otherwise(loose))).select(*_FOUND)


@query(_expected(("text-spacy", "CEO", "Ann Leeds", "ann{k}@cu.org"), ("text-spacy", "Treasurer", "", "")))
def text_people(spark: SparkSession, d: str) -> DataFrame:
    """The nearest person and the address that fits; a service role is left out."""
    html = "<p>CEO: <b>Ann Leeds</b> info{k}@cu.org or ann{k}@cu.org</p>" + "x " * 350 + "<p>Treasurer</p>" + "y " * 350 + "<p>Director of Online Banking</p>"
    return ext.text_people(_pages(spark, d, html)).select(*_FOUND)


@query(_expected(("html-context", "Treasurer", "Ann Leeds", "a{k}@cu.org"), ("html-context", "Manager", "Bo Li", "b{k}@cu.org"), ("html-context", "", "", "info@cu.org")))
def context_parent(spark: SparkSession, d: str) -> DataFrame:
    """The text around the link comes before the window; a shared mailbox without a role names nobody."""
    html = (
        "<p>Bo Li - Manager - b{k} (at) cu (dot) org</p>" + "x " * 250 + '<p>ann writes: Ann Leeds, Treasurer <a href="mailto:a{k}@cu.org">mail</a></p>'.replace("ann writes: ", "")
        + "y " * 250 + "Some One info@cu.org"
    )
    return ext.context_people(_pages(spark, d, html)).select(*_FOUND)


@query(_expected(("HTML", "Vice President", "Ann Leeds", "ann{k}@cu.org")))
def look_behind(spark: SparkSession, d: str) -> DataFrame:
    """X3B: the longest role and the first name before the address."""
    return ext.look_behind_people(_pages(spark, d, "CEO " + "x " * 100 + "Ann Leeds, Vice President and VP: ann{k}@cu.org, Treasurer")).select(*_FOUND)


@query(_expected(("network", "", "", "api{k}@cu.org"), ("network", "", "", "b{k}@cu.org"), ("network-cfemail", "", "", "ann@cu.org")))
def network_emails(spark: SparkSession, d: str) -> DataFrame:
    """Addresses in responses, made readable, and encoded ones."""
    body = '{"m": "api{k}@cu.org", "n": "b{k}[at]cu[dot]org", "c": \'<i data-cfemail="5a3b34341a392f7435283d">\'}'
    return ext.network_emails(_pages(spark, d, body).withColumnRenamed("html", "body")).select(*_FOUND)


@query("SELECT s_suppkey AS page_id, 'html-after-fail' AS found_via, '' AS role, '' AS name, 'a' || s_suppkey || '@cu.org' AS email FROM supplier WHERE s_suppkey % 2 = 0")
def salvage(spark: SparkSession, d: str) -> DataFrame:
    """X12."""
    pages = _pages(spark, d, "a{k}@cu.org").withColumn("status", F.when(F.col("page_id") % 2 == 0, "failed").otherwise("ok"))
    return ext.salvage_emails(pages).select(*_FOUND)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    one, two = "Secretary, Zoe Quill, zoe{k} (at) cu.org", "mailto:max{k}@cu.org, Max Moe, Treasurer"
    x = _pages(spark, d, one, "https://cu.org/{k}.pdf").withColumn("two", _filled(two, F.col("page_id")))
    return x.select("page_id", "source_url", F.array("html", "two", F.lit(None), F.lit("late@cu.org")).alias("texts"))


@query(_expected(("pdf-window", "Secretary", "Secretary", "max{k}@cu.org")))
def pdf_people(spark: SparkSession, d: str) -> DataFrame:
    """X10 (C), S13, L4: the text as it is, three pages."""
    return ext.pdf_people(_texts(spark, d)).select(*_FOUND)


@query(_expected(("pdf", "Secretary", "Secretary", "max{k}@cu.org"), ("pdf", "Treasurer", "Secretary", "late@cu.org")))
def pdf_people_b(spark: SparkSession, d: str) -> DataFrame:
    """X10 (B): 180 characters before the address, every page."""
    return ext.pdf_people(_texts(spark, d), profile="B").select(*_FOUND)


@query(
    " UNION ALL ".join(
        f"SELECT s_suppkey AS page_id, '{kind}' AS kind, '{via}' AS found_via, '{mail}' || s_suppkey || '@cu.org' AS email FROM supplier"
        for kind, via, mail in [("LEADERSHIP", "pdf-text-context", "max"), ("LEADERSHIP", "pdf-text-context", "zoe"), ("LEADERSHIP", "pdf-text-mailto", "max"),
                                ("EMAIL", "pdf-text", "max"), ("EMAIL", "pdf-text", "zoe"), ("EMAIL", "pdf-mailto", "max")]
    )
)
def pdf_passes(spark: SparkSession, d: str) -> DataFrame:
    """X11: what the three passes find, each once."""
    return ext.pdf_passes(_texts(spark, d)).select("page_id", "kind", "found_via", "email").distinct()


@query(_expected(("html", "", "", "a{k}@cu.org"), ("leadership-mailto", "CEO", "Ann Leeds", "a{k}@cu.org")).replace("FROM supplier UNION", "FROM supplier WHERE s_suppkey % 3 = 0 UNION") + " WHERE s_suppkey % 3 <= 1")
def dispatch_hosts(spark: SparkSession, d: str) -> DataFrame:
    """JN7: two of three hosts have extractors of their own."""
    pages = _pages(spark, d, '<p>Ann Leeds, CEO <a href="mailto:a{k}@cu.org">w</a></p>').withColumn("source_url", F.concat(F.lit("https://www.h"), (F.col("page_id") % 3).cast("string"), F.lit(".org/")))
    return ext.dispatch(pages, {"h0.org": ["html", "leadership-mailto"], "h1.org": ["leadership-mailto"]}).select(*_FOUND)


# ---------------------------------------------------------------- links and crawl rules


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN ['/team', '/board', '/x'] ELSE ['/team', '/staff', '/about', '/board'] END AS links FROM supplier""")
def priority_links(spark: SparkSession, d: str) -> DataFrame:
    """people's pages first, all of them, others up to the quota of three."""
    arr = lambda *xs: F.array(*[F.lit(x) for x in xs])
    found = F.when(F.col("s_suppkey") % 2 == 0, arr("/x", "/team", "/y", "/board", "/z")).otherwise(arr("/team", "/x", "/staff", "/about", "/y", "/board"))
    return table(spark, d, "supplier").select("s_suppkey", ext.priority_links(found, lambda x: x.rlike(u.any_of(p.ALLOWED_PATHS_A)), 3).alias("links"))


@query("""SELECT s_suppkey AS page_id, pos, 'https://www.s' || s_suppkey || 'cu.org' || url AS url FROM supplier, (VALUES (2, '/team'), (4, '/zzz')) AS l(pos, url)""")
def ordered_links(spark: SparkSession, d: str) -> DataFrame:
    """Denied, foreign, PDF and visited links are out."""
    html = '<a href="/loans/x">1</a><a href="/seen">2</a><a href="/team/#a">3</a><a href="/b.pdf">4</a><a href="/zzz">5</a><a href="https://x.org/">6</a><a href="/team/">7</a>'
    pages = _pages(spark, d, html)
    seen = pages.select(F.concat(u.base_url(F.col("source_url")), F.lit("seen")).alias("url"))
    return ext.links(pages, visited=seen).select("page_id", "pos", "url")


@query("""SELECT 's' || s_suppkey || '.org' AS host, 'https://s' || s_suppkey || '.org/' || l AS url FROM supplier, (VALUES ('a.pdf'), ('b.PDF')) AS x(l)""")
def pdf_links(spark: SparkSession, d: str) -> DataFrame:
    """Two PDFs of a host."""
    html = '<a href="/a.pdf">1</a><a href="/b.PDF">2</a><a href="/c.pdf">3</a><a href="/a.pdf">4</a><a href="/rates/d.pdf">5</a>'
    return ext.pdf_links(_pages(spark, d, html, "https://s{k}.org/")).select("host", "url")


def _graph(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("src"))
    return n.withColumn("dst", ((F.col("src") * 7 + 3) % 25).cast("int")).unionByName(n.withColumn("dst", ((F.col("src") * 5 + 1) % 25).cast("int")))


_EDGES = "e AS (SELECT n_nationkey AS a, (7 * n_nationkey + 3) % 25 AS b FROM nation UNION SELECT n_nationkey, (5 * n_nationkey + 1) % 25 FROM nation)"


@query(rf"""WITH {_EDGES}, l0 AS (SELECT 0 AS b), d0 AS (SELECT b % 5 AS s FROM l0 WHERE b % 3 = 1),
l1 AS (SELECT DISTINCT b FROM e WHERE a IN (FROM l0) AND b NOT IN (FROM l0) AND b % 5 NOT IN (FROM d0)), d1 AS (FROM d0 UNION SELECT b % 5 FROM l1 WHERE b % 3 = 1),
l2 AS (SELECT DISTINCT b FROM e WHERE a IN (FROM l1) AND b NOT IN (FROM l0 UNION FROM l1) AND b % 5 NOT IN (FROM d1)), d2 AS (FROM d1 UNION SELECT b % 5 FROM l2 WHERE b % 3 = 1),
l3 AS (SELECT DISTINCT b FROM e WHERE a IN (FROM l2) AND b NOT IN (FROM l0 UNION FROM l1 UNION FROM l2) AND b % 5 NOT IN (FROM d2))
SELECT b AS node, 0 AS depth FROM l0 UNION ALL SELECT b, 1 FROM l1 UNION ALL SELECT b, 2 FROM l2 UNION ALL SELECT b, 3 FROM l3""")
def crawl_stop(spark: SparkSession, d: str) -> DataFrame:
    """P17 in the expansion: a site (node modulo 5) is left once one of its nodes has what is looked for."""
    links = _graph(spark, d)
    site = lambda c: c % 5
    found = lambda level: level.filter("node % 3 = 1").select(site(F.col("node")).alias("site"))
    return expand(links, links.filter("src = 0").select(F.col("src").alias("node")), 3, site=site, finished=found)


@query(rf"""WITH {_EDGES}, l0 AS (SELECT 0 AS b), l1 AS (SELECT DISTINCT b FROM e WHERE a IN (FROM l0) AND b NOT IN (FROM l0)),
l2 AS (SELECT DISTINCT b FROM e WHERE a IN (FROM l1) AND b NOT IN (FROM l0 UNION FROM l1)),
l3 AS (SELECT DISTINCT b FROM e WHERE a IN (FROM l2) AND b NOT IN (FROM l0 UNION FROM l1 UNION FROM l2))
SELECT b AS node, 0 AS depth FROM l0 UNION ALL SELECT b, 1 FROM l1 UNION ALL SELECT b, 2 FROM l2 UNION ALL SELECT b, 3 FROM l3""")
def crawl_resume(spark: SparkSession, d: str) -> DataFrame:
    """An expansion ended at depth 1 goes on from its visited nodes and open frontier."""
    links = _graph(spark, d)
    early = expand(links, links.filter("src = 0").select(F.col("src").alias("node")), 1)
    open_ = early.filter("depth = 1").join(links, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), F.lit(2).alias("depth"))
    return expand(links, open_, 3, visited=early)


@query("""SELECT event_id, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id) <= 86400000000 AS ok FROM events""")
def host_budget(spark: SparkSession, d: str) -> DataFrame:
    """P20, I4: visits within a day of their host's first."""
    return resolve.within_budget(table(spark, d, "events").select("event_id", "user_id", "ts"), "user_id", "ts", 86_400).select("event_id", "ok")


# ---------------------------------------------------------------- records


@query("SELECT doc_id, coalesce(length(subject), 0) + coalesce(length(text), 0) AS chars FROM documents")
def text_lengths(spark: SparkSession, d: str) -> DataFrame:
    """A3."""
    return resolve.text_lengths(table(spark, d, "documents").select("doc_id", F.array("subject", "text").alias("texts")), "doc_id")


@query(f"""SELECT min(entry_id) AS entry_id FROM (SELECT entry_id, lower({_STRIP.format('role')}) AS r, lower({_STRIP.format('name')}) AS n, lower({_STRIP.format('email')}) AS m, lower(coalesce(source_url, '')) AS s, lower(coalesce(credit_union, '')) AS c FROM leadership_entries)
GROUP BY r, n, m, s, c""")
def leadership_dedup_a(spark: SparkSession, d: str) -> DataFrame:
    """A8 (A): the source ignores case too, the organisation counts, blank records stay."""
    x = table(spark, d, "leadership_entries").select("entry_id", "role", "name", "email", "source_url", "credit_union")
    return resolve.dedup_records(resolve.clean_records(x, "A"), ["entry_id"], "A").select("entry_id")


@query(f"""SELECT min(rec_id) AS rec_id FROM (SELECT rec_id, {_STRIP.format('role')} AS r, {_STRIP.format('name')} AS n, {_STRIP.format('email')} AS m, coalesce(source, '') AS s FROM people)
WHERE m <> '' AND m <> 'user@example.com' AND lower(regexp_extract(m, '(?s)^[^@]*@(.*)$', 1)) IN (SELECT lower(trim(domain, ' ')) FROM credit_unions WHERE trim(domain, ' ') <> '') GROUP BY lower(r), lower(n), lower(m), s""")
def people_gate_b(spark: SparkSession, d: str) -> DataFrame:
    """B3, A8 (B): an address of a listed domain, then the first record per key."""
    x = table(spark, d, "people").select("rec_id", "role", "name", "email", "found_via", F.coalesce("source", F.lit("")).alias("source_url"))
    domains = table(spark, d, "credit_unions").select(F.lower(F.trim("domain")).alias("domain"), F.lit(True).alias("_known")).filter("domain <> ''").distinct()
    x = x.withColumn("domain", e.email_domain(u.strip(F.col("email")))).join(domains, "domain", "left")
    x = resolve.gate_records(x, F.array(F.when(F.col("_known"), F.col("domain")).otherwise("none.invalid")))
    return resolve.dedup_records(x, ["rec_id"], "B").select("rec_id")


@query(rf"""WITH a AS (SELECT 0 AS b, rec_id AS id, email, coalesce(source, '') AS s, coalesce(found_via, '') AS v FROM people WHERE regexp_full_match(coalesce(email, ''), '{_RE2_EMAIL}')
  AND NOT (list_contains({_sql_list(p.GENERIC_C)}, lower(split_part(email, '@', 1))) AND NOT (contains(found_via, 'leadership') OR contains(found_via, 'json-ld') OR contains(found_via, 'pdf-window')))
UNION ALL SELECT 1, entry_id, m, coalesce(source_url, ''), coalesce(found_via, '') || '-email' FROM (SELECT *, lower({_STRIP.format('email')}) AS m FROM leadership_entries) WHERE regexp_full_match(m, '{_RE2_EMAIL}')),
g AS (SELECT *, lower(regexp_extract(email, '(?s)^[^@]*@(.*)$', 1)) AS d, ltrim(lower(regexp_extract(s, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), 'w.') AS h FROM a)
SELECT lower(email) AS email, v AS found_via, id FROM g WHERE email <> 'user@example.com' AND (ltrim(d, 'w.') = ltrim(h, 'w.') OR {_ORG_C}) QUALIFY row_number() OVER (PARTITION BY lower(email) ORDER BY id, b) = 1""")
def leader_email_events(spark: SparkSession, d: str) -> DataFrame:
    """Plain addresses and those of leadership records, the first per address."""
    none = F.array().cast("array<string>")
    org = F.lit("").alias("credit_union")
    via = F.coalesce("found_via", F.lit("")).alias("found_via")
    plain = table(spark, d, "people").select(F.col("rec_id").alias("id"), org, "email", F.coalesce("source", F.lit("")).alias("source_url"), via)
    leaders = table(spark, d, "leadership_entries").select(F.col("entry_id").alias("id"), org, F.lower(u.strip(F.coalesce("email", F.lit("")))).alias("email"), F.coalesce("source_url", F.lit("")).alias("source_url"), via)
    return resolve.with_leaders_emails(resolve.email_records(plain, none), leaders, none, ["id"]).select("email", "found_via", "id")


@query(rf"""SELECT rec_id, regexp_matches(coalesce(role, ''), '(?i)\b(?:{"|".join(p.ROLES_B)})\b') AS leadership FROM people""")
def leadership_first(spark: SparkSession, d: str) -> DataFrame:
    """R4, K10."""
    return resolve.leadership_first(table(spark, d, "people").select("rec_id", "role"), ["rec_id"]).select("rec_id", "leadership")


@query(rf"""SELECT change_id AS id, coalesce(Title, '') AS "Title", coalesce(Link, '') AS "Link", CASE WHEN contains(coalesce(Title, ''), 'Credit Union') THEN 'Credit Union' ELSE 'N/A' END AS "Organizations"
FROM leadership_changes_rss WHERE regexp_matches(concat_ws(' ', Title, Link), '{p.ANNOUNCEMENT}')""")
def announcement_rows(spark: SparkSession, d: str) -> DataFrame:
    """Classified entries with what a tagger finds in them; here one that knows a single name."""

    def tagger(df: DataFrame, key: str, text: str) -> DataFrame:
        found = t.spans(df, [key], text, "Credit Union")
        first = found.filter("ord = 0")
        return first.select(key, F.lit("ORG").alias("label"), "start", "end", F.col("match").alias("text"))

    x = table(spark, d, "leadership_changes_rss").select("change_id", F.coalesce("Title", F.lit("")).alias("title"), F.lit("").alias("description"), F.coalesce("Link", F.lit("")).alias("link"))
    x = ann.with_entities(ann.classify(x), "change_id", tagger)
    return ann.rows(x, "change_id").select(F.col("change_id").alias("id"), "Title", "Link", "Organizations")
