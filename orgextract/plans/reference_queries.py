"""Queries of the extraction engine over the test tables, each with its SQL.

Inputs the tables don't hold (obfuscated addresses, encoded addresses, JSON-LD, site pages)
are derived from columns by the same expression in the query and in its SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgextract import profiles as p
from orgextract.functions import emails as e
from orgextract.functions import text as t
from orgextract.functions import urls as u
from orgextract.functions.entities import entity_spans
from orgextract.functions.html import ancestor_text, html_elements
from orgextract.functions.jsonld import people as jsonld_people
from orgextract.functions.jsonld import scripts
from orgextract.operators import announcements as ann
from orgextract.operators import extract as ext
from orgextract.operators import nearest, resolve
from orgextract.operators import frontier
from orgextract.operators.frontier import expand
from orgextract.operators.skew import join_counted
from orgextract.session import table
from orgextract.sources import orgs

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.replace("{EMAIL}", _RE2_EMAIL).replace("{DENY}", _sql_list(p.PEOPLE_DENY)).replace("{GENERIC_C}", _sql_list(p.GENERIC_C)).replace("{GENERIC_A}", _sql_list(p.GENERIC_A)).replace("{ROLES_C}", p.ROLES_C).replace("{ROLES_B}", "|".join(p.ROLES_B)).replace("{DENYRX}", "|".join(p.PEOPLE_DENY_PATHS))
        return f

    return add


_RE2_EMAIL = p.EMAIL.replace("\\-", "-")
_sql_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"

# ---------------------------------------------------------------- e-mails in text


@query(r"""SELECT doc_id, ord - 1 AS ord, email, lower(split_part(email, '@', 2)) AS domain FROM (
  SELECT doc_id, unnest(m) AS email, generate_subscripts(m, 1) AS ord FROM (
    SELECT doc_id, regexp_extract_all(text, '{EMAIL}') AS m FROM documents WHERE text LIKE '%@%'))""")
def email_scan_documents(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", F.posexplode(e.find_emails(F.col("text"))).alias("ord", "email"))
    return x.withColumn("domain", e.email_domain(F.col("email")))


@query(r"""SELECT email, min(doc_id) AS doc_id, count(*) AS hits FROM (
  SELECT doc_id, lower(unnest(regexp_extract_all(text, '{EMAIL}'))) AS email FROM documents) GROUP BY email""")
def email_distinct_documents(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", F.explode(e.find_emails(F.col("text"))).alias("email"))
    return resolve.distinct_emails(x, "doc_id")


@query(r"""SELECT email, min(doc_id) AS doc_id, count(*) AS hits FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL}')) AS email FROM documents) GROUP BY email""")
def email_distinct_cased(spark: SparkSession, d: str) -> DataFrame:
    """A6 on profiles A and B: letter case tells addresses apart."""
    x = table(spark, d, "documents").select("doc_id", F.explode(e.find_emails(F.col("text"))).alias("email"))
    return resolve.distinct_emails(x, "doc_id", fold_case=False)


@query(rf"""WITH h AS (
  SELECT doc_id, generate_subscripts(m, 1) - 1 AS ord, unnest(m) AS raw FROM (
    SELECT doc_id, regexp_extract_all(text, '{_RE2_EMAIL}') AS m FROM documents)),
k AS (SELECT doc_id, ord, lower(raw) AS email, lower(split_part(raw, '@', 2)) AS domain FROM h),
v AS (SELECT domain FROM k GROUP BY domain HAVING count(DISTINCT doc_id) >= 5),
g AS (SELECT * FROM k WHERE email <> 'user@example.com' AND (domain IN (FROM v)
      OR domain LIKE '%.coop' OR domain LIKE '%.org' OR domain LIKE '%.cu' OR domain LIKE '%creditunion%' OR domain LIKE '%fcu%' OR domain LIKE '%cu.com' OR domain LIKE '%cu.%'))
SELECT email, domain, doc_id, 0.6 AS confidence FROM g QUALIFY row_number() OVER (PARTITION BY email ORDER BY doc_id, ord) = 1""")
def email_kept_deduped(spark: SparkSession, d: str) -> DataFrame:
    """The minimum slice: scan, gate by domain (P5; valid are domains of five documents or more), score (B5), first record per address."""
    x = table(spark, d, "documents").select("doc_id", F.posexplode(e.find_emails(F.col("text"))).alias("ord", "email"))
    x = x.withColumn("email", F.lower("email")).withColumn("domain", e.email_domain(F.col("email")))
    seen = x.select("domain", "doc_id").distinct().groupBy("domain").agg(F.count("*").alias("n"))
    x = join_counted(x, seen.filter("n >= 5").withColumn("_known", F.lit(True)), "domain", "n", "left")
    x = x.filter(e.keep_email(F.col("email"), F.lit("none.invalid"), F.array_compact(F.array(F.when(F.col("_known"), F.col("domain")))), "C"))
    x = resolve.dedup_emails(x, ["doc_id", "ord"])
    return x.select("email", e.email_domain(F.col("email")).alias("domain"), "doc_id", resolve.confidence(F.lit("html"), F.lit("")).alias("confidence"))


# ---------------------------------------------------------------- URLs


@query(r"""WITH a AS (SELECT org_id, trim(coalesce(url, ''), E' \t\n\r"''') AS x, url FROM credit_unions),
b AS (SELECT org_id, CASE WHEN regexp_matches(x, '(?i)^[a-z][a-z0-9+.-]*://') THEN x ELSE 'https://' || ltrim(x, '/') END AS f, x FROM a),
c AS (SELECT org_id, x, f, lower(trim(regexp_extract(f, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1))) AS h FROM b),
e AS (SELECT *, CASE WHEN h LIKE '%.or' THEN h || 'g' WHEN h LIKE '%.coo' THEN h || 'p' WHEN h LIKE '%.coom' THEN left(h, len(h) - 5) || '.com'
  WHEN h LIKE '%.con' THEN left(h, len(h) - 4) || '.com' WHEN h LIKE '%.og' THEN left(h, len(h) - 3) || '.org' WHEN h LIKE '%.cm' THEN left(h, len(h) - 3) || '.com' ELSE h END AS g FROM c)
SELECT org_id, CASE WHEN x = '' OR g LIKE '%facebook.com%' OR g LIKE '%wixsite.com%' OR g LIKE '%linktr.ee%' THEN ''
  ELSE regexp_extract(f, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) || '://' || g || regexp_replace(f, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*', '') END AS url FROM e""")
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "credit_unions").select("org_id", u.normalize_url(F.col("url")).alias("url"))


@query(r"""SELECT entry_id, regexp_replace(regexp_replace(source_url, '(?s)#.*$', ''), '/$', '') AS url FROM leadership_entries WHERE source_url IS NOT NULL""")
def url_canonical(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "leadership_entries").filter("source_url IS NOT NULL")
    return x.select("entry_id", u.canonical_url(F.col("source_url")).alias("url"))


@query(r"""SELECT host, count(*) AS entries FROM (
  SELECT ltrim(lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), 'w.') AS host FROM leadership_entries WHERE source_url IS NOT NULL) GROUP BY host""")
def host_root(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "leadership_entries").filter("source_url IS NOT NULL").select(u.host_root(F.col("source_url")).alias("host"))
    return x.groupBy("host").agg(F.count("*").alias("entries"))


_TLDS = "['.or', '.coo', '.coom', '.con', '.og', '.cm', '.org', '.or:80']"


@query(rf"""WITH h AS (SELECT s_suppkey, lower('S' || s_suppkey || ({_TLDS})[1 + s_suppkey % 8]) AS h FROM supplier)
SELECT s_suppkey, CASE WHEN h LIKE '%.or' THEN h || 'g' WHEN h LIKE '%.coo' THEN h || 'p' WHEN h LIKE '%.coom' THEN left(h, len(h) - 5) || '.com'
 WHEN h LIKE '%.con' THEN left(h, len(h) - 4) || '.com' WHEN h LIKE '%.og' THEN left(h, len(h) - 3) || '.org' WHEN h LIKE '%.cm' THEN left(h, len(h) - 3) || '.com' ELSE h END AS host FROM h""")
def tld_fix(spark: SparkSession, d: str) -> DataFrame:
    ends = F.array(*[F.lit(x) for x in (".or", ".coo", ".coom", ".con", ".og", ".cm", ".org", ".or:80")])
    host = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"), F.get(ends, (F.col("s_suppkey") % 8).cast("int")))
    return table(spark, d, "supplier").select("s_suppkey", u.fix_tld(host).alias("host"))


@query(r"""WITH a AS (SELECT entry_id, source_url AS s, regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) AS n FROM leadership_entries WHERE source_url IS NOT NULL)
SELECT entry_id, n AS netloc, regexp_extract(s, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || '/' AS base, upper(split_part(n, '.', 1)) AS label,
 CASE WHEN regexp_extract(s, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(s, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) || CASE WHEN s LIKE '%/' AND regexp_extract(s, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) NOT LIKE '%/' THEN '/' ELSE '' END END AS path,
 CASE WHEN s LIKE 'https://%' THEN 'http://' || s[9:] WHEN s LIKE 'http://%' THEN 'https://' || s[8:] ELSE s END AS flipped,
 regexp_matches(s, '(?i)^https?://[^/?#]+') AS valid, lower(s) LIKE '%.pdf' AS pdf FROM a""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("source_url")
    return table(spark, d, "leadership_entries").filter("source_url IS NOT NULL").select(
        "entry_id", u.netloc(s).alias("netloc"), u.base_url(s).alias("base"), u.host_label(u.netloc(s)).alias("label"), u.url_path(s).alias("path"),
        u.flip_scheme(s).alias("flipped"), u.is_valid_http(s).alias("valid"), u.is_pdf(s).alias("pdf"),
    )


_HREFS = ["a/b.html", "/staff", "../up", "./same", "#top", "?q=1", "//other.org/x", "http://abs.org/y", "a/../b/./c", "../../far?x=/../y"]


@query("""SELECT n_nationkey, h AS href, CASE h WHEN 'a/b.html' THEN r || '/d1/a/b.html' WHEN '/staff' THEN r || '/staff' WHEN '../up' THEN r || '/up' WHEN './same' THEN r || '/d1/same'
 WHEN '#top' THEN r || '/d1/page#top' WHEN '?q=1' THEN r || '/d1/page?q=1' WHEN '//other.org/x' THEN 'https://other.org/x' WHEN 'http://abs.org/y' THEN h
 WHEN 'a/../b/./c' THEN r || '/d1/b/c' ELSE r || '/far?x=/../y' END AS url
FROM (SELECT n_nationkey, 'https://n' || n_nationkey || '.org' AS r, unnest(['a/b.html', '/staff', '../up', './same', '#top', '?q=1', '//other.org/x', 'http://abs.org/y', 'a/../b/./c', '../../far?x=/../y']) AS h FROM nation)""")
def url_join(spark: SparkSession, d: str) -> DataFrame:
    base = F.concat(F.lit("https://n"), F.col("n_nationkey").cast("string"), F.lit(".org/d1/page"))
    x = table(spark, d, "nation").select("n_nationkey", base.alias("base"), F.explode(F.array(*[F.lit(h) for h in _HREFS])).alias("href"))
    return x.select("n_nationkey", "href", u.join_url(F.col("base"), F.col("href")).alias("url"))


@query(r"""SELECT entry_id, CASE WHEN len(list_filter({DENY}, lambda w: contains(lower(source_url), w))) > 0 OR regexp_matches(lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1)), '{DENYRX}') THEN true ELSE false END AS denied,
 regexp_matches(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '^/(contact|about|leadership|management|executive|board|team|staff|who-we-are|our-team|meet|people|directory|governance)') AS allowed
FROM leadership_entries WHERE source_url IS NOT NULL""")
def url_gates(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("source_url")
    allowed = F.array(*[F.lit(a) for a in p.ALLOWED_PATHS_A])
    return table(spark, d, "leadership_entries").filter("source_url IS NOT NULL").select("entry_id", u.is_denied(s).alias("denied"), u.allowed_path(s, allowed).alias("allowed"))


@query(r"""SELECT org_id, upper(trim(coalesce(credit_union, ''), E' \t\n\r')) AS label FROM credit_unions""")
def org_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "credit_unions").select("org_id", u.org_label(F.col("credit_union")).alias("label"))


@query(r"""SELECT domain, (lower(domain) LIKE '%.coop' OR lower(domain) LIKE '%.org' OR lower(domain) LIKE '%.cu' OR lower(domain) LIKE '%creditunion%') AS a,
 (lower(domain) LIKE '%.coop' OR lower(domain) LIKE '%.org' OR lower(domain) LIKE '%.cu' OR lower(domain) LIKE '%creditunion%' OR lower(domain) LIKE '%fcu%' OR lower(domain) LIKE '%cu.com' OR lower(domain) LIKE '%cu.%') AS c
FROM (SELECT DISTINCT domain FROM credit_unions WHERE domain IS NOT NULL)""")
def org_domain_test(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "credit_unions").select("domain").filter("domain IS NOT NULL").distinct()
    return x.select("domain", u.is_org_domain(F.col("domain"), "A").alias("a"), u.is_org_domain(F.col("domain"), "C").alias("c"))


# ---------------------------------------------------------------- e-mail functions

_MASKED_SQL = "'user' || c_custkey || CASE c_custkey % 3 WHEN 0 THEN ' [AT] cu' WHEN 1 THEN '(at)cu' ELSE ' at cu' END || c_nationkey || CASE WHEN c_custkey % 2 = 0 THEN ' (dot) org' ELSE '[dot]org' END"


def _masked(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    at = F.when(k % 3 == 0, " [AT] cu").when(k % 3 == 1, "(at)cu").otherwise(" at cu")
    dot = F.when(k % 2 == 0, " (dot) org").otherwise("[dot]org")
    return table(spark, d, "customer").select("c_custkey", F.concat(F.lit("user"), k.cast("string"), at, F.col("c_nationkey").cast("string"), dot).alias("raw"))


@query(rf"""SELECT c_custkey, replace(replace(regexp_replace(regexp_replace({_MASKED_SQL}, '\s*\[at\]\s*|\s+at\s+', '@', 'gi'), '\s*\[dot\]\s*|\s+dot\s+', '.', 'gi'), ' (at) ', '@'), ' (dot) ', '.') AS email FROM customer""")
def deobfuscate_a(spark: SparkSession, d: str) -> DataFrame:
    return _masked(spark, d).select("c_custkey", e.deobfuscate(F.col("raw"), "A").alias("email"))


@query(rf"""SELECT c_custkey, replace(replace(replace(replace(replace(replace({_MASKED_SQL}, '[at]', '@'), '(at)', '@'), ' at ', '@'), '[dot]', '.'), '(dot)', '.'), ' dot ', '.') AS email FROM customer""")
def deobfuscate_b(spark: SparkSession, d: str) -> DataFrame:
    return _masked(spark, d).select("c_custkey", e.deobfuscate(F.col("raw"), "B").alias("email"))


@query(rf"""SELECT c_custkey, regexp_replace(regexp_replace({_MASKED_SQL}, '\s*\[at\]\s*|\s*\(at\)\s*', '@', 'gi'), '\s*\[dot\]\s*|\s*\(dot\)\s*', '.', 'gi') AS email FROM customer""")
def deobfuscate_c(spark: SparkSession, d: str) -> DataFrame:
    return _masked(spark, d).select("c_custkey", e.deobfuscate(F.col("raw"), "C").alias("email"))


@query("SELECT c_custkey, 'ann' || c_custkey || '@cu.org' AS email FROM customer")
def cfemail_decode(spark: SparkSession, d: str) -> DataFrame:
    """The address is encoded with a key from the row, found in an attribute and decoded again."""
    k = (F.col("c_custkey") % 200 + 16).cast("int")
    plain = F.concat(F.lit("ann"), F.col("c_custkey").cast("string"), F.lit("@cu.org"))
    two = lambda n: F.lpad(F.lower(F.hex(n)), 2, "0")
    code = F.concat(two(k), F.array_join(F.transform(F.split(plain, ""), lambda c: two(F.ascii(c).bitwiseXOR(k))), ""))
    html = F.concat(F.lit('<a data-cfemail="'), code, F.lit('">x</a>'))
    x = table(spark, d, "customer").select("c_custkey", html.alias("html"))
    return x.select("c_custkey", e.decode_cf(F.get(e.find_cf(F.col("html")), F.lit(0))).alias("email"))


@query(r"""SELECT rec_id, email, lower(regexp_extract(coalesce(email, ''), '(?s)^[^@]*@(.*)$', 1)) AS domain, list_contains({GENERIC_C}, lower(split_part(coalesce(email, ''), '@', 1))) AS generic,
 regexp_full_match(coalesce(email, ''), '{EMAIL}') AS valid FROM people""")
def email_parts(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("email")
    return table(spark, d, "people").select("rec_id", "email", e.email_domain(m).alias("domain"), e.is_generic(m).alias("generic"), e.is_email(m).alias("valid"))


@query(r"""WITH c AS (SELECT c_custkey AS k, 'Ann' || chr(97 + (c_custkey % 26)::INT) || ' Lee' || (c_custkey % 5) AS name,
  CASE c_custkey % 4 WHEN 0 THEN ['info@cu.org', 'ann' || chr(97 + (c_custkey % 26)::INT) || '@cu.org'] WHEN 1 THEN ['info@cu.org', 'bob@cu.org'] WHEN 2 THEN ['contact@cu.org'] ELSE ['bad', 'hello@cu.org', 'x lee@cu.org'] END AS cs FROM customer)
SELECT k AS c_custkey, CASE k % 4 WHEN 0 THEN cs[2] WHEN 1 THEN 'bob@cu.org' WHEN 2 THEN 'contact@cu.org' ELSE 'xlee@cu.org' END AS email FROM c""")
def best_email(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    tag = F.char(k % 26 + 97)
    name = F.concat(F.lit("Ann"), tag, F.lit(" Lee"), (k % 5).cast("string"))
    own = F.concat(F.lit("ann"), tag, F.lit("@cu.org"))
    arr = lambda *xs: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    cs = F.when(k % 4 == 0, arr("info@cu.org", own)).when(k % 4 == 1, arr("info@cu.org", "bob@cu.org")).when(k % 4 == 2, arr("contact@cu.org")).otherwise(arr("bad", "hello@cu.org", "x lee@cu.org"))
    return table(spark, d, "customer").select("c_custkey", e.best_email(cs, name).alias("email"))


_ORG_C = "d LIKE '%.coop' OR d LIKE '%.org' OR d LIKE '%.cu' OR d LIKE '%creditunion%' OR d LIKE '%fcu%' OR d LIKE '%cu.com' OR d LIKE '%cu.%'"


def _org_domains(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "credit_unions").select(F.lower(F.trim("domain")).alias("domain"), F.lit(True).alias("_known")).filter("domain <> ''").distinct()


@query(rf"""SELECT p.rec_id, (email <> '' AND email <> 'user@example.com' AND (ltrim(d, 'w.') = ltrim(lower(ltrim(h, 'w.')), 'w.') OR {_ORG_C})) AS keep_c,
 (email <> '' AND email <> 'user@example.com' AND k) AS keep_b, (email <> '' AND email <> 'user@example.com' AND (d = n OR k OR d LIKE '%.coop' OR d LIKE '%.org' OR d LIKE '%.cu' OR d LIKE '%creditunion%')) AS keep_a
FROM (SELECT *, d IN (SELECT lower(trim(domain, ' ')) FROM credit_unions WHERE trim(domain, ' ') <> '') AS k, ltrim(n, 'w.') AS h FROM (
 SELECT rec_id, email, lower(regexp_extract(email, '(?s)^[^@]*@(.*)$', 1)) AS d, lower(regexp_extract(coalesce(source, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)) AS n FROM people WHERE email IS NOT NULL)) p""")
def email_gate(spark: SparkSession, d: str) -> DataFrame:
    """P5 on all profiles: C without a list, A and B with the organisations' domains."""
    x = table(spark, d, "people").filter("email IS NOT NULL").withColumn("domain", e.email_domain(F.col("email"))).join(_org_domains(spark, d), "domain", "left")
    m, src = F.col("email"), F.coalesce("source", F.lit(""))
    none, listed = F.array().cast("array<string>"), F.array(F.when(F.col("_known"), F.col("domain")).otherwise("none.invalid"))
    return x.select(
        "rec_id", e.keep_email(m, u.host_root(src), none, "C").alias("keep_c"), e.keep_email(m, F.lit(""), listed, "B").alias("keep_b"), e.keep_email(m, u.netloc(src), listed, "A").alias("keep_a")
    )


@query(r"""SELECT doc_id, replace(replace(replace(replace(text, '&gt;', '>'), '&quot;', '"'), '&nbsp;', chr(160)), '&amp;', '&') AS text FROM documents WHERE text LIKE '%&%'""")
def html_unescape(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter(F.contains("text", F.lit("&"))).select("doc_id", e.html_unescape(F.col("text")).alias("text"))


# ---------------------------------------------------------------- roles, names, spans


@query(r"""SELECT entry_id, regexp_extract(coalesce(role, ''), '{ROLES_C}', 1) AS role_c, regexp_matches(coalesce(role, ''), '(?i)\b(?:{ROLES_B})\b') AS leadership FROM leadership_entries""")
def role_first_c(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("role")
    return table(spark, d, "leadership_entries").select("entry_id", t.role_first_c(r).alias("role_c"), t.is_leadership(r).alias("leadership"))


_B_SQL = ", ".join(f"struct_pack(l := 0, r := {len(p.ROLES_B) - i}, ms := regexp_extract_all(role, '(?i)\\b{r}\\b'))" for i, r in enumerate(p.ROLES_B))


@query(rf"""WITH h AS (SELECT entry_id, unnest([{_B_SQL}]) AS x FROM leadership_entries WHERE role IS NOT NULL),
m AS (SELECT entry_id, x.r AS r, unnest(x.ms) AS m, generate_subscripts(x.ms, 1) AS o FROM h)
SELECT e.entry_id, coalesce(b.m, '') AS role_b FROM leadership_entries e LEFT JOIN (SELECT entry_id, m FROM m QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY len(m) DESC, r DESC, o) = 1) b USING (entry_id)""")
def role_infer_b(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "leadership_entries").select("entry_id", t.infer_role_b(F.col("role")).alias("role_b"))


_FOLD = "regexp_replace(text, '[ªµºÀ-ÖØ-öø-ɏ]', '_', 'g')"


@query(rf"""SELECT doc_id, ord - 1 AS ord, name FROM (SELECT doc_id, unnest(m) AS name, generate_subscripts(m, 1) AS ord FROM (
  SELECT doc_id, regexp_extract_all({_FOLD}, '{p.NAME_C}', 1) AS m FROM documents))""")
def name_spans(spark: SparkSession, d: str) -> DataFrame:
    return t.spans(table(spark, d, "documents"), ["doc_id"], "text", p.NAME_C, 1).select("doc_id", "ord", F.col("match").alias("name"))


@query(r"""SELECT doc_id, count(*) AS n, sum(len(m))::BIGINT AS chars FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS m FROM documents) GROUP BY doc_id""")
def span_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Every span's text equals the substring at its offsets; what differs would be missing here."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    s = t.spans(docs, ["doc_id", "text"], "text", "[0-9]+")
    s = s.filter(F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")) == F.col("match"))
    return s.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("match")).alias("chars"))


@query(r"""WITH m AS (SELECT doc_id, text, unnest(list_distinct(regexp_extract_all(text, '{EMAIL}'))) AS e FROM documents WHERE text LIKE '%@%'),
w AS (SELECT doc_id, e, substr(text, greatest(instr(text, e) - 400, 1), instr(text, e) + len(e) + 200 - greatest(instr(text, e) - 400, 1)) AS w FROM m WHERE e <> '')
SELECT doc_id, e AS email, len(list_filter(string_split_regex(w, '[\n\r,;•·|\-]'), lambda x: trim(x, E' \t\n\r ') <> '')) AS chunks, len(w) AS chars FROM w""")
def email_windows(spark: SparkSession, d: str) -> DataFrame:
    """T10, T12 (C): the window around the first place of every address of a text."""
    x = table(spark, d, "documents").select("doc_id", "text", F.explode(F.array_distinct(e.find_emails(F.col("text")))).alias("email"))
    x = x.withColumn("w", t.window_around(F.col("text"), F.col("email"), 400, 200))
    return x.select("doc_id", "email", F.size(t.chunks(F.col("w"))).alias("chunks"), F.length("w").alias("chars"))


@query(rf"""WITH s AS (SELECT doc_id, split(text, ' ') AS w FROM documents),
r AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, w FROM s),
n AS (SELECT doc_id, pos, w[pos] AS x FROM r)
SELECT a.doc_id, a.pos, coalesce((SELECT arg_min(b.x, struct_pack(d := abs(b.pos - a.pos), s := b.pos)) FROM n b WHERE b.doc_id = a.doc_id AND regexp_matches(b.x, '^[A-Z][a-z]+$') AND abs(b.pos - a.pos) <= 5), '') AS nearest
FROM n a WHERE a.x = 'the'""")
def nearest_span(spark: SparkSession, d: str) -> DataFrame:
    """JN2 on words: the nearest capitalised word within five of each "the"."""
    w = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("p", "x")).withColumn("pos", F.col("p") + 1)
    hits = w.filter("x = 'the'").select("doc_id", "pos")
    caps = w.filter(F.col("x").rlike("^[A-Z][a-z]+$")).select("doc_id", F.col("pos").alias("start"), F.col("pos").alias("end"), F.col("x").alias("text"))
    return nearest.nearest_span(hits, caps, "doc_id", 5)


@query(rf"""WITH s AS (SELECT doc_id, split(text, ' ') AS w FROM documents), n AS (SELECT doc_id, pos, w[pos] AS x FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, w FROM s))
SELECT a.doc_id, a.pos, count(*) AS near FROM n a JOIN n b ON a.doc_id = b.doc_id AND abs(a.pos - b.pos) <= 3 AND regexp_matches(b.x, '^[A-Z][a-z]+$') WHERE a.x = 'the' GROUP BY ALL""")
def window_join(spark: SparkSession, d: str) -> DataFrame:
    """JN3: how many capitalised words stand within three words of each "the"."""
    w = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("p", "x")).withColumn("pos", F.col("p") + 1)
    caps = w.filter(F.col("x").rlike("^[A-Z][a-z]+$")).select("doc_id", F.col("pos").alias("start"), F.col("x").alias("text"))
    return nearest.in_window(w.filter("x = 'the'").select("doc_id", "pos"), caps, "doc_id", 3).groupBy("doc_id", "pos").agg(F.count("*").alias("near"))


@query(r"""SELECT doc_id, len(list_filter(string_split_regex(text, '\r?\n'), lambda x: trim(x) <> '')) AS lines, left(text, 40) AS head FROM documents""")
def text_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.size(t.lines(F.col("text"))).alias("lines"), t.truncated(F.col("text"), 40).alias("head"))


@query(r"""SELECT doc_id, regexp_replace(text, '<[^>]+>', ' ', 'g') AS text FROM documents WHERE text LIKE '%<%'""")
def strip_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter(F.contains("text", F.lit("<"))).select("doc_id", t.strip_tags(F.col("text")).alias("text"))


@query()
def entity_spans_documents(spark: SparkSession, d: str) -> DataFrame:
    return entity_spans(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


@query(r"""SELECT rec_id, role, len(list_filter(['bill payer', 'online banking', 'mobile deposit', 'digital banking', 'branch manager', 'loan officer'], lambda s: contains(lower(coalesce(role, '')), s))) > 0 AS service,
 CASE WHEN name IN ('Email','E-mail','Mail','St','Street','Hours','Support','Customer','Service','Info','Contact','Us','Department') THEN '' ELSE name END AS name FROM people""")
def role_name_filters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "people").select("rec_id", "role", t.is_service_role(F.col("role")).alias("service"), t.blank_bad_name(F.col("name")).alias("name"))


# ---------------------------------------------------------------- structured data


@query(r"""SELECT s_suppkey, 'CEO' AS role, 'Ann ' || s_name AS name, 'ann' || s_suppkey || '@cu.org' AS email FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT s_suppkey, 'CFO', 'Bob', 'b' || s_suppkey || '@cu.org' FROM supplier WHERE s_suppkey % 4 = 1
UNION ALL SELECT s_suppkey, '', 'Cy', '' FROM supplier WHERE s_suppkey % 4 = 1
UNION ALL SELECT s_suppkey, 'Teller', s_name, '' FROM supplier WHERE s_suppkey % 4 = 2""")
def jsonld(spark: SparkSession, d: str) -> DataFrame:
    """JSON-LD bodies found in a page's scripts; bad JSON (every fourth) gives nothing."""
    k, n = F.col("s_suppkey").cast("string"), F.col("s_name")
    person = F.concat(F.lit('{"@type":"Person","jobTitle":"CEO","name":"Ann '), n, F.lit('","email":"ann'), k, F.lit('@cu.org"}'))
    group = F.concat(F.lit('{"@type":"Organization","employees":[{"role":"CFO","name":"Bob","emailAddress":"b'), k, F.lit('@cu.org"},{"name":"Cy"},3]}'))
    array = F.concat(F.lit('[{"jobTitle":"Teller","name":"'), n, F.lit('"}]'))
    body = F.when(F.col("s_suppkey") % 4 == 0, person).when(F.col("s_suppkey") % 4 == 1, group).when(F.col("s_suppkey") % 4 == 2, array).otherwise("{bad")
    html = F.concat(F.lit('<html><script type="application/ld+json">'), body, F.lit("</script></html>"))
    x = table(spark, d, "supplier").select("s_suppkey", F.explode(scripts(html)).alias("body"))
    return jsonld_people(x, ["s_suppkey"], "body")


@query(r"""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'CEO' ELSE 'loan officer' END AS role, 'Ann Leeds' AS name, 'ann' || c_custkey || '@x.org' AS email FROM customer""")
def structured_block(spark: SparkSession, d: str) -> DataFrame:
    """X7, corrected: only the role ignores case, so a name never takes in the address."""
    k = F.col("c_custkey")
    line = F.concat(F.when(k % 2 == 0, "<p>CEO Ann Leeds ann").otherwise("<p>loan officer · Ann Leeds: ann"), k.cast("string"), F.lit("@x.org</p>"))
    pages = table(spark, d, "customer").select(k.alias("page_id"), F.lit("https://x.org/").alias("source_url"), line.alias("html"))
    return ext.structured_people(pages).select(F.col("page_id").alias("c_custkey"), "role", "name", "email")


@query(r"""SELECT n_nationkey, 'CEO' AS role, 'Ann ' || substr(n_name, 1, 1) || lower(substr(n_name, 2)) AS context_name, 'ann' || n_nationkey || '@cu.org' AS email FROM nation WHERE NOT regexp_matches(n_name, ' ')""")
def mailto_context(spark: SparkSession, d: str) -> DataFrame:
    """X5, JN5: an address link, role and name from the text of its parent element."""
    name = F.concat(F.substring("n_name", 1, 1), F.lower(F.substring("n_name", 2, 99)))
    html = F.concat(F.lit("<div><p>CEO<br>Ann "), name, F.lit(' <a href="mailto:ann'), F.col("n_nationkey").cast("string"), F.lit('@cu.org?subject=x">write</a></p></div>'))
    pages = table(spark, d, "nation").filter(~F.contains("n_name", F.lit(" "))).select("n_nationkey", html.alias("html"))
    x = ancestor_text(html_elements(pages, "n_nationkey", "html"), "n_nationkey").filter("tag = 'a'")
    parent = F.regexp_replace(F.col("text_up1"), "^(CEO)", "$1 ")
    return x.select("n_nationkey", t.role_first_c(parent).alias("role"), F.regexp_extract(parent, r"(Ann [A-Z]\w+)", 1).alias("context_name"), e.strip_mailto(F.col("attrs")["href"]).alias("email"))


@query(r"""SELECT n_nationkey, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'manager' ELSE 'director' END AS role FROM nation""")
def neighbour_lines(spark: SparkSession, d: str) -> DataFrame:
    """JN4: the name one line after the last role line."""
    x = table(spark, d, "nation")
    role = F.when(F.col("n_nationkey") % 2 == 0, "manager").otherwise("director")
    rows = F.array(
        F.struct(F.lit(0).alias("line_no"), F.lit("officer").alias("role"), F.lit("").alias("name")),
        F.struct(F.lit(1).alias("line_no"), F.lit("").alias("role"), F.lit("Else").alias("name")),
        F.struct(F.lit(7).alias("line_no"), role.alias("role"), F.lit("").alias("name")),
        F.struct(F.lit(8).alias("line_no"), F.lit("").alias("role"), F.col("n_name").alias("name")),
        F.struct(F.lit(6).alias("line_no"), F.lit("").alias("role"), F.lit("Before").alias("name")),
    )
    lines = x.select("n_nationkey", F.inline(rows))
    return nearest.neighbour_line(lines, "n_nationkey").select("n_nationkey", "name", "role")


# ---------------------------------------------------------------- scoring, dedup, unify, rank


@query(r"""SELECT rec_id, round(CASE WHEN t LIKE '%leadership-text%' THEN 0.9 WHEN t LIKE '%leadership-mailto%' OR t LIKE '%leadership-structured%' THEN 0.85 WHEN t LIKE '%pdf-window%' THEN 0.8
 WHEN t LIKE '%json-ld%' THEN 0.7 WHEN t LIKE '%support-mailto%' OR t LIKE '%click-here%' OR t LIKE '%cfemail%' THEN 0.7 ELSE 0.6 END + CASE WHEN regexp_matches(coalesce(role, ''), '{ROLES_C}') THEN 0.05 ELSE 0 END, 2) AS confidence
FROM (SELECT rec_id, role, lower(coalesce(found_via, '')) AS t FROM people)""")
def confidence_c(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "people").select("rec_id", resolve.confidence(F.col("found_via"), F.col("role")).alias("confidence"))


@query(r"""SELECT rec_id, CASE found_via WHEN 'leadership-text' THEN 0.9 WHEN 'json-ld' THEN 0.7 WHEN 'click-here' THEN 0.7 WHEN 'cfemail' THEN 0.7 WHEN 'onclick' THEN 0.7
 WHEN 'network' THEN CASE WHEN l THEN 0.7 ELSE 0.5 END WHEN 'support-mailto' THEN CASE WHEN l THEN 0.7 ELSE 0.5 END WHEN 'leadership-mailto' THEN CASE WHEN l THEN 0.85 ELSE 0.6 END ELSE 0.6 END AS confidence
FROM (SELECT rec_id, found_via, regexp_matches(coalesce(role, ''), '(?i)\b(?:{ROLES_B})\b') AS l FROM people)""")
def confidence_b(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "people").select("rec_id", resolve.confidence(F.col("found_via"), F.col("role"), "B").alias("confidence"))


_STRIP = "regexp_replace(coalesce({0}, ''), '^[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]+|[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]+$', '', 'g')"
_LEADERS_SQL = "SELECT entry_id, " + ", ".join(f"{'lower(' if c == 'email' else ''}{_STRIP.format(c)}{')' if c == 'email' else ''} AS {c}" for c in ("role", "name", "email")) + ", source_url FROM leadership_entries"


@query(rf"""WITH l AS ({_LEADERS_SQL})
SELECT min(entry_id) AS entry_id FROM l WHERE role <> '' OR name <> '' OR email <> '' GROUP BY lower(role), lower(name), lower(email), coalesce(source_url, '')""")
def leadership_dedup(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "leadership_entries").select("entry_id", "role", "name", "email", "source_url")
    return resolve.dedup_records(resolve.clean_records(x), ["entry_id"]).select("entry_id")


@query(r"""SELECT 'EMAIL' AS type, '2025-01-01T00:00:00.000000Z' AS timestamp, upper(org) AS credit_union, '' AS role, '' AS name, email AS address, via AS found_via, src AS source_url, NULL::DOUBLE AS confidence,
  '[EMAIL] 2025-01-01T00:00:00.000000Z  ' || upper(org) || '  ' || email || '  via=' || via AS formatted FROM (SELECT 'cu ' || s_nationkey AS org, 's' || s_suppkey || '@cu.org' AS email, 'html' AS via, 'https://cu' || s_nationkey || '.org/' AS src FROM supplier)
UNION ALL SELECT 'LEADERSHIP', '2025-01-01T00:00:00.000000Z', upper(org), role, name, CASE WHEN email = '' THEN '' ELSE 'mailto:' || email END, via, src, confidence,
  '[LEADERSHIP] 2025-01-01T00:00:00.000000Z  ' || upper(org) || '  · ' || CASE WHEN role = '' THEN name ELSE role END || '  ' || CASE WHEN email = '' THEN '' ELSE 'mailto:' || email END || '  via=' || via || '  conf=' || CASE WHEN role = '' THEN '0.7' ELSE '0.75' END
  FROM (SELECT 'cu ' || c_nationkey AS org, CASE WHEN c_custkey % 2 = 0 THEN 'CEO' ELSE '' END AS role, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'c' || c_custkey || '@cu.org' END AS email, 'json-ld' AS via,
   'https://cu' || c_nationkey || '.org/' AS src, CASE WHEN c_custkey % 2 = 0 THEN 0.75 ELSE 0.7 END::DOUBLE AS confidence FROM customer)""")
def unified_events(spark: SparkSession, d: str) -> DataFrame:
    key = lambda c: F.col(c).cast("string")
    cat = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    emails = table(spark, d, "supplier").select(
        cat("cu ", key("s_nationkey")).alias("credit_union"), cat("s", key("s_suppkey"), "@cu.org").alias("email"), F.lit("html").alias("found_via"), cat("https://cu", key("s_nationkey"), ".org/").alias("source_url")
    )
    role = F.when(F.col("c_custkey") % 2 == 0, "CEO").otherwise("")
    leaders = table(spark, d, "customer").select(
        cat("cu ", key("c_nationkey")).alias("credit_union"), role.alias("role"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, "").otherwise(cat("c", key("c_custkey"), "@cu.org")).alias("email"), F.lit("json-ld").alias("found_via"),
        cat("https://cu", key("c_nationkey"), ".org/").alias("source_url"), resolve.confidence(F.lit("json-ld"), role).alias("confidence"),
    )
    as_of = t.utc_string(F.lit("2025-01-01 00:00:00").cast("timestamp"))
    return resolve.unified_events(emails, leaders, as_of)


@query(r"""SELECT coalesce(credit_union, '') AS credit_union, coalesce(role, '') AS role, coalesce(name, '') AS name, coalesce(email, '') AS email, arg_min(domain, struct_pack(kind := kind, id := id)) AS domain, coalesce(source_url, '') AS source_url, coalesce(found_via, '') AS found_via
FROM (SELECT 0 AS kind, entry_id AS id, credit_union, role, name, email, '' AS domain, source_url, found_via FROM leadership_entries
UNION ALL SELECT 1, rec_id, '', '', '', email, lower(regexp_extract(email, '(?s)^[^@]*@(.*)$', 1)), source, found_via FROM people WHERE email IS NOT NULL) GROUP BY 1, 2, 3, 4, 6, 7""")
def combined_export(spark: SparkSession, d: str) -> DataFrame:
    leaders = table(spark, d, "leadership_entries").select(F.col("entry_id").alias("id"), "credit_union", "role", "name", "email", "source_url", "found_via")
    emails = table(spark, d, "people").filter("email IS NOT NULL").select(F.col("rec_id").alias("id"), "email", e.email_domain(F.col("email")).alias("domain"), F.col("source").alias("source_url"), "found_via")
    return resolve.combined_export(emails, leaders, ["id"])


@query(r"""SELECT entry_id, role, CASE WHEN r LIKE '%chief executive officer%' OR r LIKE '%ceo%' THEN 0 WHEN r LIKE '%president%' THEN 1 WHEN r LIKE '%cfo%' THEN 2 WHEN r LIKE '%coo%' THEN 3 WHEN r LIKE '%vp%' THEN 4 ELSE 9 END AS rank
FROM (SELECT entry_id, role, lower(coalesce(role, '')) AS r FROM leadership_entries) ORDER BY rank, entry_id LIMIT 100""")
def role_priority_topk(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report; the limit is the feature."""
    return resolve.top_roles(table(spark, d, "leadership_entries").select("entry_id", "role"), ["entry_id"])


@query(r"""WITH a AS (SELECT DISTINCT email FROM people WHERE email IS NOT NULL), g AS (SELECT email, list_contains({GENERIC_A}, lower(split_part(email, '@', 1))) AS g FROM a)
SELECT email FROM g WHERE NOT g OR (SELECT count(*) FROM g WHERE NOT g) = 0""")
def personal_emails(spark: SparkSession, d: str) -> DataFrame:
    return resolve.personal_emails(table(spark, d, "people").filter("email IS NOT NULL"))


@query(r"""SELECT found_via, count(*) AS n, count(DISTINCT lower(email)) AS emails, count(*) FILTER (role IS NOT NULL AND trim(role) <> '') AS with_role, count(DISTINCT source) AS pages FROM people GROUP BY found_via""")
def extractor_counters(spark: SparkSession, d: str) -> DataFrame:
    """A2, A5: counters per extractor."""
    return resolve.counters(table(spark, d, "people"), "source")


# ---------------------------------------------------------------- links, frontier, caps


@query(r"""WITH e AS (SELECT n_nationkey AS a, (7 * n_nationkey + 3) % 25 AS b FROM nation UNION SELECT n_nationkey, (5 * n_nationkey + 1) % 25 FROM nation),
l0 AS (SELECT 0 AS node), l1 AS (SELECT DISTINCT b FROM e WHERE a IN (SELECT node FROM l0) AND b NOT IN (SELECT node FROM l0)),
l2 AS (SELECT DISTINCT b FROM e WHERE a IN (FROM l1) AND b NOT IN (SELECT node FROM l0 UNION FROM l1)),
l3 AS (SELECT DISTINCT b FROM e WHERE a IN (FROM l2) AND b NOT IN (SELECT node FROM l0 UNION FROM l1 UNION FROM l2))
SELECT node, 0 AS depth FROM l0 UNION ALL SELECT b, 1 FROM l1 UNION ALL SELECT b, 2 FROM l2 UNION ALL SELECT b, 3 FROM l3""")
def crawl_bfs(spark: SparkSession, d: str) -> DataFrame:
    """A cyclic link graph over nations, three levels from node 0."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("src"))
    links = n.withColumn("dst", ((F.col("src") * 7 + 3) % 25).cast("int")).unionByName(n.withColumn("dst", ((F.col("src") * 5 + 1) % 25).cast("int")))
    return expand(links, n.filter("src = 0").select(F.col("src").alias("node")), 3)


@query(r"""SELECT host, url FROM (SELECT DISTINCT regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) AS host, regexp_replace(regexp_replace(source_url, '(?s)#.*$', ''), '/$', '') AS url FROM leadership_entries WHERE source_url LIKE 'http%')
QUALIFY row_number() OVER (PARTITION BY host ORDER BY url) <= 50""")
def host_page_cap(spark: SparkSession, d: str) -> DataFrame:
    """At most fifty pages per host, in URL order."""
    s = F.col("source_url")
    x = table(spark, d, "leadership_entries").filter(F.startswith(s, F.lit("http"))).select(u.netloc(s).alias("host"), u.canonical_url(s).alias("url")).distinct()
    return nearest.cap_per_key(x, "host", ["url"], p.PROFILES["A"].page_cap)


@query(r"""SELECT host, count(DISTINCT url) AS pages, count(*) AS hits FROM (SELECT regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) AS host, source_url AS url FROM leadership_entries WHERE source_url LIKE 'http%') GROUP BY host""")
def host_page_counts(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("source_url")
    x = table(spark, d, "leadership_entries").filter(F.startswith(s, F.lit("http"))).select(u.netloc(s).alias("host"), s.alias("url"))
    return resolve.host_counts(x, "host", "url")


_LINK = r"https?://[^\s<>\[\]\"]+"


@query(rf"""SELECT doc_id, url FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '{_LINK}'))) AS url FROM documents) WHERE NOT lower(url) LIKE '%.pdf'
 AND len(list_filter({{DENY}}, lambda w: contains(lower(url), w))) = 0 AND NOT regexp_matches(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1)), '{{DENYRX}}')""".replace("{{", "{").replace("}}", "}"))
def link_discovery(spark: SparkSession, d: str) -> DataFrame:
    """Absolute links of a text, once each, without denied ones and PDFs."""
    x = table(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_LINK), 0))).alias("url"))
    return x.filter(~u.is_pdf(F.col("url")) & ~u.is_denied(F.col("url")))


@query(rf"""SELECT doc_id, pos, url FROM (SELECT doc_id, unnest(l) AS url, generate_subscripts(l, 1) AS pos FROM (
  SELECT doc_id, list_transform(list_sort(list_transform(list_distinct(m), lambda x: struct_pack(p := list_position(m, x), u := x))), lambda x: x.u)[1:40] AS l FROM (SELECT doc_id, regexp_extract_all(text, '{_LINK}') AS m FROM documents)))""")
def link_fanout_cap(spark: SparkSession, d: str) -> DataFrame:
    """L3, A10: the first forty different links of each text, in order."""
    x = table(spark, d, "documents").select("doc_id", F.posexplode(F.slice(F.array_distinct(F.regexp_extract_all("text", F.lit(_LINK), 0)), 1, p.PROFILES["C"].fanout)).alias("p", "url"))
    return x.select("doc_id", (F.col("p") + 1).alias("pos"), "url")


# ---------------------------------------------------------------- announcements


_ANN_SQL = p.ANNOUNCEMENT


@query(rf"""SELECT change_id, regexp_matches(concat_ws(' ', Title, Link), '{_ANN_SQL}') AS hit FROM leadership_changes_rss""")
def announcement_flag(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "leadership_changes_rss").select("change_id", t.is_announcement(F.concat_ws(" ", "Title", "Link")).alias("hit"))


@query(r"""WITH r AS (SELECT DISTINCT feed_id, run_no FROM leadership_changes_rss), n AS (SELECT feed_id, run_no, lag(run_no) OVER (PARTITION BY feed_id ORDER BY run_no) AS prev FROM r)
SELECT c.change_id FROM leadership_changes_rss c JOIN n USING (feed_id, run_no)
WHERE NOT EXISTS (SELECT 1 FROM leadership_changes_rss p WHERE p.feed_id = c.feed_id AND p.run_no = n.prev AND p.Title = c.Title AND p.Link = c.Link)""")
def announcement_new(spark: SparkSession, d: str) -> DataFrame:
    """JN1, I5 over every run of every feed: rows the run before in the feed didn't hold."""
    x = table(spark, d, "leadership_changes_rss").select("change_id", "feed_id", "run_no", "Title", "Link")
    return ann.new_per_run(x, ["feed_id"], "run_no").select("change_id")


@query(r"""SELECT change_id, CASE WHEN Persons IS NULL OR Persons = '' THEN 'N/A' ELSE Persons END AS Persons FROM leadership_changes_rss""")
def joined_or_na(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "leadership_changes_rss")
    return x.select("change_id", t.joined_or_na(F.array_compact(F.array("Persons"))).alias("Persons"))


# ---------------------------------------------------------------- organisation seeds


@query(r"""SELECT 'credit_union' AS column_name, count(*) FILTER (regexp_matches(credit_union, '{RX}')) AS hits FROM credit_unions UNION ALL SELECT 'domain', count(*) FILTER (regexp_matches(domain, '{RX}')) FROM credit_unions
UNION ALL SELECT 'url', count(*) FILTER (regexp_matches(url, '{RX}')) FROM credit_unions UNION ALL SELECT 'allowed_paths', count(*) FILTER (regexp_matches(allowed_paths, '{RX}')) FROM credit_unions""".replace("{RX}", orgs.URL_LIKE.replace("'", "''")))
def seed_column_scores(spark: SparkSession, d: str) -> DataFrame:
    """S3, A1: URL-like cells per column, one aggregate over the table."""
    x = table(spark, d, "credit_unions").select("credit_union", "domain", "url", "allowed_paths")
    return orgs.column_scores(x)


@query(r"""WITH a AS (SELECT org_id, credit_union, coalesce(CASE WHEN regexp_matches(url, '{RX}') THEN url END, CASE WHEN regexp_matches(domain, '{RX}') THEN domain END) AS raw FROM credit_unions),
b AS (SELECT org_id, credit_union, CASE WHEN regexp_matches(trim(raw, E' \t\n\r"'''), '(?i)^[a-z][a-z0-9+.-]*://') THEN trim(raw, E' \t\n\r"''') ELSE 'https://' || ltrim(trim(raw, E' \t\n\r"'''), '/') END AS url FROM a WHERE raw IS NOT NULL),
c AS (SELECT org_id, ltrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), 'w.') AS host FROM b)
SELECT min(org_id) AS org_id, host FROM c GROUP BY host""".replace("{RX}", orgs.URL_LIKE.replace("'", "''")))
def seed_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The first URL-like cell of a row, first row per host."""
    x = table(spark, d, "credit_unions").withColumn("raw", orgs.first_url(["url", "domain"])).filter("raw IS NOT NULL")
    x = x.withColumn("host", u.host_root(u.normalize_url(F.col("raw")))).select("org_id", "host")
    return nearest.keep_first(x, ["host"], ["org_id"])


# ---------------------------------------------------------------- composite extractors over pages derived from columns


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """A page per supplier: a JSON-LD block, a mailto link, an encoded address and a staff line."""
    k, n = F.col("s_suppkey").cast("string"), F.col("s_suppkey")
    cat = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    url = cat("https://www.s", (n % 7).cast("string"), "cu.org/team/", k)
    html = cat(
        '<html><script type="application/ld+json">{"@type":"Person","jobTitle":"CFO","name":"Joan Lee","email":"j', k, '@cu.org"}</script>',
        '<p>Treasurer, Max Moe, <a href="mailto:max', k, '@cu.org?subject=a">write</a></p><a href="#" data-cfemail="5a3b34341a392f7435283d">click here</a>',
        '<div>CEO Ann Leeds ann', k, '@cu.org</div><a href="../about">a</a><a href="/staff/', k, '">b</a><a href="/blog/x">c</a><a href="/doc.pdf">d</a><a href="https://other.org/">e</a></html>',
    )
    return table(spark, d, "supplier").select(n.alias("page_id"), url.alias("source_url"), html.alias("html"))


@query(r"""WITH s AS (SELECT s_suppkey AS k FROM supplier)
SELECT k AS page_id, 'json-ld' AS found_via, 'CFO' AS role, 'Joan Lee' AS name, 'j' || k || '@cu.org' AS email FROM s
UNION ALL SELECT k, 'cfemail', '', '', 'ann@cu.org' FROM s UNION ALL SELECT k, 'click-here', '', '', 'ann@cu.org' FROM s
UNION ALL SELECT k, 'leadership-mailto', 'Treasurer', 'Treasurer', 'max' || k || '@cu.org' FROM s
UNION ALL SELECT k, 'leadership-structured', 'CEO', 'Ann Leeds', 'ann' || k || '@cu.org' FROM s
UNION ALL SELECT k, 'html', '', '', unnest(['j' || k || '@cu.org', 'max' || k || '@cu.org', 'ann' || k || '@cu.org']) FROM s""")
def extractors(spark: SparkSession, d: str) -> DataFrame:
    """X1, X5, X6, X7, X9 in one union."""
    x = ext.extract(_pages(spark, d), ["json-ld", "html", "cfemail", "leadership-mailto", "click-here", "leadership-structured"])
    return x.select("page_id", "found_via", "role", "name", "email")


@query(r"""SELECT s_suppkey AS page_id, pos, 'https://www.s' || (s_suppkey % 7) || 'cu.org/' || CASE pos WHEN 3 THEN 'staff/' || s_suppkey ELSE 'about' END AS url FROM supplier, (SELECT unnest([2, 3]) AS pos)""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Same-host links, made absolute, without denied ones and PDFs."""
    return ext.links(_pages(spark, d)).filter("NOT url LIKE '%/team/%'").select("page_id", "pos", "url")


@query(r"""WITH t AS (SELECT doc_id, replace(replace(replace(replace(text, '&gt;', '>'), '&quot;', '"'), '&nbsp;', chr(160)), '&amp;', '&') AS text FROM documents WHERE text LIKE '%@%'),
d AS (SELECT doc_id, text, unnest(list_distinct(regexp_extract_all(text, '{EMAIL}'))) AS email FROM t),
w AS (SELECT doc_id, email, [trim(x, E' \t\n\r') FOR x IN string_split_regex(substr(text, greatest(instr(text, email) - 400, 1), instr(text, email) + len(email) + 200 - greatest(instr(text, email) - 400, 1)), '[\n\r,;•·|\-]')] AS c FROM d),
r AS (SELECT doc_id, email, coalesce([regexp_extract(x, '{ROLES_C}', 1) FOR x IN c IF regexp_extract(x, '{ROLES_C}', 1) <> ''][1], '') AS role,
  coalesce([regexp_extract(x, '{NAME_C}', 1) FOR x IN [regexp_replace(y, '[ªµºÀ-ÖØ-öø-ɏ]', '_', 'g') FOR y IN c] IF regexp_extract(x, '{NAME_C}', 1) <> ''][1], '') AS name FROM w)
SELECT doc_id, email, role, CASE WHEN name IN ('Email','E-mail','Mail','St','Street','Hours','Support','Customer','Service','Info','Contact','Us','Department') OR (role = '' AND list_contains({GENERIC_C}, lower(split_part(email, '@', 1)))) THEN '' ELSE name END AS name FROM r""".replace("{NAME_C}", p.NAME_C))
def context_people(spark: SparkSession, d: str) -> DataFrame:
    """Role and name near each address of a text."""
    x = table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.lit("").alias("source_url"), F.col("text").alias("html"))
    return ext.context_people(x).select(F.col("page_id").alias("doc_id"), "email", "role", "name")


@query(r"""SELECT e.entry_id, c.org_id FROM (SELECT entry_id, lower(trim(credit_union, E' \t\n\r')) AS k FROM leadership_entries WHERE credit_union IS NOT NULL) e
JOIN (SELECT lower(trim(credit_union, E' \t\n\r')) AS k, min(org_id) AS org_id FROM credit_unions WHERE trim(coalesce(credit_union, '')) <> '' GROUP BY 1) c USING (k)""")
def attach_org(spark: SparkSession, d: str) -> DataFrame:
    """JN10: records meet their organisation by folded name, balanced for organisations with many records."""
    key = F.lower(u.strip(F.col("credit_union")))
    rows = table(spark, d, "leadership_entries").filter("credit_union IS NOT NULL").select("entry_id", key.alias("k"))
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    org = table(spark, d, "credit_unions").select("org_id", key.alias("k")).filter("k <> ''").groupBy("k").agg(F.min("org_id").alias("org_id"))
    return join_counted(rows, org.join(counts, "k"), "k", "n").select("entry_id", "org_id")


@query(rf"""SELECT rec_id, email, d AS domain FROM (SELECT rec_id, found_via, lower(email) AS email, lower(regexp_extract(email, '(?s)^[^@]*@(.*)$', 1)) AS d,
  ltrim(lower(regexp_extract(coalesce(source, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), 'w.') AS host FROM people WHERE regexp_full_match(coalesce(email, ''), '{{EMAIL}}'))
WHERE email <> 'user@example.com' AND (ltrim(d, 'w.') = ltrim(host, 'w.') OR d IN (SELECT lower(trim(domain, ' ')) FROM credit_unions WHERE trim(domain, ' ') <> '') OR {_ORG_C})
 AND NOT (list_contains({{GENERIC_C}}, split_part(email, '@', 1)) AND NOT (contains(found_via, 'leadership') OR contains(found_via, 'json-ld') OR contains(found_via, 'pdf-window')))
QUALIFY row_number() OVER (PARTITION BY email ORDER BY rec_id) = 1""".replace("{{", "{").replace("}}", "}"))
def email_records(spark: SparkSession, d: str) -> DataFrame:
    """B1, P5, P7, A7 over person records: validated, gated against the source's host and the organisations' domains,
    shared mailboxes only from extractors that hint at a person, first per address."""
    x = table(spark, d, "people").select("rec_id", F.lower("email").alias("email"), F.coalesce("source", F.lit("")).alias("source_url"), F.coalesce("found_via", F.lit("")).alias("found_via"))
    x = x.withColumn("domain", e.email_domain(F.col("email"))).join(_org_domains(spark, d), "domain", "left")
    x = resolve.email_records(x, F.array(F.when(F.col("_known"), F.col("domain")).otherwise("none.invalid")))
    return resolve.dedup_emails(x, ["rec_id"]).select("rec_id", "email", "domain")


@query(r"""SELECT org_id, upper(trim(regexp_replace(split_part(h, '.', 1), '[-_]', ' ', 'g'))) AS name FROM (
  SELECT org_id, ltrim(lower(regexp_extract(CASE WHEN regexp_matches(trim(url, E' \t\n\r'), '(?i)^https?://') THEN trim(url, E' \t\n\r') ELSE 'https://' || trim(url, E' \t\n\r') END, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), 'w.') AS h
  FROM credit_unions WHERE trim(coalesce(url, ''), E' \t\n\r') <> '')""")
def name_from_url(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "credit_unions").filter(u.strip(F.coalesce("url", F.lit(""))) != "")
    return x.select("org_id", u.name_from_url(F.col("url")).alias("name"))


@query(rf"""SELECT rec_id, name FROM people WHERE email <> '' AND len(list_filter({_sql_list(sorted({x.lower() for x in p.SENIOR_TITLES}))}, lambda t: contains(lower(role), t))) > 0""")
def senior_found(spark: SparkSession, d: str) -> DataFrame:
    """Records with a senior title anywhere in the role and an address, which end a site's expansion."""
    return frontier.senior_records(table(spark, d, "people")).select("rec_id", "name")


@query(r"""SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL""")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """The windowed aggregate of the streaming variant, over the events table as a batch."""
    x = table(spark, d, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return x.select("event_type", F.col("w.start").alias("hour"), "n", "value")
