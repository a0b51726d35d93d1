from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orgextract import profiles as p
from orgextract.functions import emails as e
from orgextract.functions import text as t
from orgextract.functions import urls as u


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first().x


def test_urls(spark):
    cases = [
        (u.fix_tld, "acu.or", "acu.org"), (u.fix_tld, "acu.coom", "acu.com"), (u.fix_tld, "acu.or:80", "acu.or:80"), (u.fix_tld, "acu.coo", "acu.coop"),
        (u.canonical_url, "https://a.org/", "https://a.org"), (u.canonical_url, "https://a.org/x//", "https://a.org/x/"),
        (u.canonical_url, "https://a.org/x/#top", "https://a.org/x"), (u.host_root, "https://www.webster.org/", "ebster.org"),
        (u.host_root, "https://WWW.W3.org", "3.org"), (u.normalize_url, "  \"acu.or/x\" ", "https://acu.org/x"), (u.normalize_url, None, ""),
        (u.normalize_url, "https://www.facebook.com/p", ""), (u.url_path, "https://a.org?x=1", "/"), (u.name_from_url, "www.first-coast.org", "FIRST COAST"),
        (u.flip_scheme, "http://a.org", "https://a.org"), (u.netloc, "https://u@h:8/x", "u@h:8"),
    ]
    for f, value, want in cases:
        assert one(spark, value, f) == want, (f.__name__, value)


def test_emails(spark):
    for profile, value, want in [
        ("A", "ann [AT] cu [dot] org", "ann@cu.org"), ("A", "ann(at)cu.org", "ann(at)cu.org"), ("A", "Meet us at example.com", "Meet us@example.com"),
        ("B", "ann [at] cu.org", "ann @ cu.org"), ("B", "ann [AT] cu [dot] org", "ann [AT] cu . org"), ("C", "ann(at)cu.org", "ann@cu.org"),
        ("C", "Meet us at example.com", "Meet us at example.com"),
    ]:
        assert one(spark, value, lambda c: e.deobfuscate(c, profile)) == want
    for value, want in [("5a3b34341a392f7435283d", "ann@cu.org"), ("5a3b4", "a^"), ("5a", ""), ("zzzz", ""), (None, "")]:
        assert one(spark, value, e.decode_cf) == want
    assert one(spark, "a..b@c.org u003ejane@cu.org logo@2x.png", e.find_emails) == ["a..b@c.org", "u003ejane@cu.org", "logo@2x.png"]
    assert one(spark, None, e.find_emails) == []
    assert one(spark, "mailto:ann@cu.org?subject=x", e.strip_mailto) == "ann@cu.org"
    pick = lambda cs, name: spark.range(1).select(e.best_email(F.array(*[F.lit(c) for c in cs]).cast("array<string>"), F.lit(name)).alias("x")).first().x
    assert pick(["info@cu.org", "alee@cu.org"], "Ann Lee") == "alee@cu.org"
    assert pick(["info@cu.org", "bob@cu.org"], "Ann Lee") == "bob@cu.org"
    assert pick(["info@cu.org"], "") == "info@cu.org" and pick([], "x") == ""
    assert one(spark, "a &amp; b &#64; c", e.html_unescape) == "a & b @ c"


def test_roles(spark):
    for f, value, want in [
        (t.role_first_c, "Chief Financial Officer", "Officer"), (t.role_first_c, "President", ""), (t.role_first_c, "President & CEO", "CEO"),
        (t.role_first_c, "Assistant Vice President", "Assistant Vice President"), (t.infer_role_b, "President & CEO", "President & CEO"),
        (t.infer_role_b, "Vice President and CEO", "Vice President"), (t.infer_role_b, None, ""), (t.first_name, "Jane McDonald", "Jane"),
        (t.first_name, "Jane Q. Smith-Jones", "Jane Q. Smith-Jones"), (t.is_announcement, "renamed", False), (t.is_announcement, "Named CEO", True),
        (t.is_announcement, "nominee", False),
    ]:
        assert one(spark, value, f) == want, value
    assert one(spark, "VP of Lending Jane Smith", t.roles_a) == ["VP of Lending Jane Smith"]


def test_structured_block(spark):
    line = "CEO Ann Leeds ann@x.org"
    got = lambda rx: spark.range(1).select(*[F.regexp_extract(F.lit(line), rx, i).alias(f"g{i}") for i in (1, 2, 3)]).first()
    assert tuple(got(p.STRUCTURED)) == ("CEO", "Ann Leeds", "ann@x.org")
    assert tuple(got(p.STRUCTURED_LITERAL)) == ("CEO", "Ann Leeds an", "n@x.org")


@settings(max_examples=20, deadline=None)
@given(st.text(max_size=60), st.text(alphabet="ab1 é😀", max_size=20))
def test_span_offsets(spark, a, b):
    text = a + "7x77" + b
    df = spark.createDataFrame([(1, text)], "id int, t string")
    for r in t.spans(df, ["id"], "t", "[0-9]+").collect():
        assert text[r.start : r.end] == r.match


def test_spans_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, t string")
    assert t.spans(df, ["id"], "t", "[0-9]+").count() == 0
