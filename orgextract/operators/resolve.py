"""Gate, score, deduplicate, unify and rank extracted records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgextract import profiles as p
from orgextract.functions import emails as e
from orgextract.functions import urls as u
from orgextract.functions.text import is_leadership
from orgextract.operators.nearest import keep_first
from orgextract.operators.skew import join_counted


def confidence(tag: Column, role: Column, profile: str = "C") -> Column:
    """B5, B6."""
    if profile == "B":
        out = None
        for name, (low, high) in p.CONFIDENCE_B.items():
            v = F.when(is_leadership(role), high).otherwise(low)
            out = F.when(tag == name, v) if out is None else out.when(tag == name, v)
        return out.otherwise(0.6)
    t, out = F.lower(F.coalesce(tag, F.lit(""))), None
    for parts, base in p.CONFIDENCE_C:
        hit = None
        for part in parts:
            hit = F.contains(t, F.lit(part)) if hit is None else hit | F.contains(t, F.lit(part))
        out = F.when(hit, base) if out is None else out.when(hit, base)
    bonus = F.when(F.coalesce(role, F.lit("")).rlike(p.ROLES_C), 0.05).otherwise(0.0)
    return F.round(out.otherwise(0.60) + bonus, 2)


def clean_records(df: DataFrame, profile: str = "C") -> DataFrame:
    """Trimmed fields, '' for null, blank records dropped (A keeps them, B needs an address)."""
    prof = p.PROFILES[profile]
    for c in ("role", "name", "email"):
        df = df.withColumn(c, u.strip(F.coalesce(F.col(c), F.lit(""))))
    if prof.lower_email:
        df = df.withColumn("email", F.lower("email"))
    if prof.needs_email:
        return df.filter("email <> ''")
    return df if profile == "A" else df.filter("role <> '' OR name <> '' OR email <> ''")


def dedup_records(df: DataFrame, order: list[str], profile: str = "C") -> DataFrame:
    """The first record per key of the profile; role, name, e-mail (and organisation) ignore case."""
    keys = []
    for c in p.PROFILES[profile].dedup:
        v = F.coalesce(F.col(c), F.lit(""))
        keys.append(v if c == "source_url" and profile != "A" else F.lower(v))
    return keep_first(df, keys, order)


def gate_records(df: DataFrame, valid: Column) -> DataFrame:
    """Records of profile B: cleaned, an address that passes the gate, its confidence by extractor and role."""
    x = clean_records(df, "B").filter(e.keep_email(F.col("email"), F.lit(""), valid, "B"))
    return x.withColumn("confidence", confidence(F.col("found_via"), F.col("role"), "B"))


def dedup_emails(df: DataFrame, order: list[str]) -> DataFrame:
    """The first record per lower-cased address, over all organisations."""
    return keep_first(df.withColumn("email", F.lower("email")), ["email"], order)


def email_records(df: DataFrame, valid: Column, profile: str = "C") -> DataFrame:
    """B1: strips mailto:, resolves obfuscation, validates and gates `email` against the source's host."""
    x = df.withColumn("email", e.deobfuscate(e.strip_mailto(F.col("email")), profile)).filter(e.is_email(F.col("email")))
    host = u.host_root(F.col("source_url")) if profile == "C" else u.netloc(F.col("source_url"))
    x = x.filter(e.keep_email(F.col("email"), host, valid, profile))
    if profile == "C":
        x = x.filter(~e.suppress_generic(F.col("email"), F.col("found_via"), F.coalesce(F.col("keep_generic"), F.lit(False)) if "keep_generic" in x.columns else F.lit(False)))
    return x.withColumn("domain", e.email_domain(F.col("email")))


def with_leaders_emails(emails: DataFrame, leaders: DataFrame, valid: Column, order: list[str], profile: str = "C") -> DataFrame:
    """B2, second branch: e-mail records with one for each leadership record that has an address, tagged
    `<tag>-email` and kept even if the mailbox is shared; the first record per address over both, in `order`,
    e-mail records before those of leadership records that come at the same place. Both need credit_union,
    email, source_url, found_via and the columns of `order`; `emails` are checked records (email_records)."""
    cols = list(dict.fromkeys(["credit_union", "email", "domain", "source_url", "found_via", *order]))
    own = leaders.filter("email <> ''").withColumn("found_via", F.concat("found_via", F.lit("-email")))
    own = email_records(own.withColumn("keep_generic", F.lit(True)), valid, profile)
    both = emails.select(*cols, F.lit(0).alias("_branch")).unionByName(own.select(*cols, F.lit(1).alias("_branch")))
    return dedup_emails(both, [*order, "_branch"]).drop("_branch")


def unified_events(emails: DataFrame, leaders: DataFrame, as_of: Column) -> DataFrame:
    """EMAIL and LEADERSHIP rows in one schema; confidence is null on EMAIL rows, '' only in a CSV."""
    org = u.org_label(F.col("credit_union"))
    blank = F.lit("")
    em = emails.select(
        F.lit("EMAIL").alias("type"), as_of.alias("timestamp"), org.alias("credit_union"), blank.alias("role"), blank.alias("name"),
        F.col("email").alias("address"), "found_via", "source_url", F.lit(None).cast("double").alias("confidence"),
        F.concat(F.lit("[EMAIL] "), as_of, F.lit("  "), org, F.lit("  "), F.col("email"), F.lit("  via="), F.col("found_via")).alias("formatted"),
    )
    shown = F.when((F.col("email") != "") & ~F.startswith(F.col("email"), F.lit("mailto:")), F.concat(F.lit("mailto:"), F.col("email"))).otherwise(F.col("email"))
    who = F.when(F.col("role") != "", F.col("role")).otherwise(F.col("name"))
    le = leaders.select(
        F.lit("LEADERSHIP").alias("type"), as_of.alias("timestamp"), org.alias("credit_union"), "role", "name", shown.alias("address"), "found_via",
        "source_url", "confidence",
        F.concat(F.lit("[LEADERSHIP] "), as_of, F.lit("  "), org, F.lit("  · "), who, F.lit("  "), shown, F.lit("  via="), F.col("found_via"), F.lit("  conf="), F.col("confidence").cast("string")).alias("formatted"),
    )
    return em.unionByName(le)


EXPORT = ["credit_union", "role", "name", "email", "domain", "source_url", "found_via"]


def combined_export(emails: DataFrame, leaders: DataFrame, order: list[str]) -> DataFrame:
    """Both kinds aligned by column, blanks for what one lacks, the first row of those alike in all but the domain.

    Leadership rows come first, then e-mail rows, each in `order` (columns of both).
    """
    side = lambda d, kind: d.select(
        *[(F.coalesce(F.col(c), F.lit("")) if c in d.columns else F.lit("")).alias(c) for c in EXPORT],
        F.struct(F.lit(kind).alias("kind"), *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)]).alias("_order"),
    )
    both = side(leaders, 0).unionByName(side(emails, 1))
    return both.groupBy(*[c for c in EXPORT if c != "domain"]).agg(F.min_by("domain", "_order").alias("domain")).select(*EXPORT)


def role_rank(role: Column) -> Column:
    """R1."""
    r = F.lower(F.coalesce(role, F.lit("")))
    has = lambda s: F.contains(r, F.lit(s))
    return F.when(has("chief executive officer") | has("ceo"), 0).when(has("president"), 1).when(has("cfo"), 2).when(has("coo"), 3).when(has("vp"), 4).otherwise(9)


def top_roles(df: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    """Planned as one TakeOrderedAndProject."""
    return df.withColumn("rank", role_rank(F.col("role"))).orderBy("rank", *order).limit(n)


def personal_emails(emails: DataFrame) -> DataFrame:
    """Distinct non-generic addresses, sorted; all of them if every one is generic."""
    d = emails.select("email").distinct().withColumn("_g", e.is_generic(F.col("email"), "A"))
    personal = d.agg(F.count_if(~F.col("_g"))).scalar()
    return d.filter(~F.col("_g") | (personal == 0)).select("email").orderBy("email")


def leadership_first(people: DataFrame, order: list[str]) -> DataFrame:
    """People with `leadership`, leaders before others, each in the given order."""
    return people.withColumn("leadership", is_leadership(F.col("role"))).orderBy(F.desc("leadership"), *order)


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """L1, L4: the first n rows in a given order, a seed limit or a preview; planned as one TakeOrderedAndProject."""
    return df.orderBy(*order).limit(n)


def host_counts(df: DataFrame, host: str, url: str) -> DataFrame:
    """A2: host, pages (different URLs), hits (rows). Counted by URL first, so a hot host is reduced before its sum."""
    return df.groupBy(host, url).agg(F.count("*").alias("n")).groupBy(host).agg(F.count(F.col(url)).alias("pages"), F.sum("n").alias("hits"))


def counters(df: DataFrame, source: str) -> DataFrame:
    """A5: per extractor: records, different addresses, records with a role, different sources."""
    return df.groupBy("found_via").agg(
        F.count("*").alias("n"), F.countDistinct(F.lower("email")).alias("emails"), F.count_if(F.trim(F.col("role")) != "").alias("with_role"), F.countDistinct(source).alias("pages")
    )


def distinct_emails(hits: DataFrame, row: str, fold_case: bool = True) -> DataFrame:
    """Email, the least row it stands in, hits; on profile C addresses ignore case."""
    key = F.lower("email") if fold_case else F.col("email")
    return hits.groupBy(key.alias("email")).agg(F.min(row).alias(row), F.count("*").alias("hits"))


def text_lengths(texts: DataFrame, key: str) -> DataFrame:
    """A3: key, chars: the characters over all page texts of a document (null texts count nothing)."""
    chars = F.aggregate(F.coalesce("texts", F.array().cast("array<string>")), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(F.length(x), F.lit(0)))
    return texts.select(key, chars.alias("chars"))


def within_budget(visits: DataFrame, host: str, ts: str, seconds: int) -> DataFrame:
    """P20, I4: visits (host, ts) with `elapsed` since the host's first one and whether it is within the budget.

    Other hosts go on when one is over its budget. The first visits come by a minimum per host that
    is joined back balanced, so one host may hold a third of the visits. A null host has no budget.
    """
    first = visits.filter(F.col(host).isNotNull()).groupBy(host).agg(F.min(ts).alias("_first"), F.count("*").alias("_n"))
    x = join_counted(visits, first, host, "_n", "left")
    elapsed = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_first").cast("timestamp"))) / 1e6
    return x.withColumn("elapsed", F.round(elapsed, 3)).withColumn("ok", F.coalesce(F.col("elapsed") <= seconds, F.lit(True))).drop("_first")
