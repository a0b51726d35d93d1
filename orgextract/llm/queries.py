"""Queries p2, p3, p4 and p6 to p10 over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgextract.llm import history, leaks, ledger, names, packing, reference_match, sentences, survivors
from orgextract.operators.packed import ORGANIZATION, PERSON, with_items
from orgextract.operators.skew import short_list
from orgextract.session import scratch_folder, stored, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows loaded before the last 30 days stand as history; the rest arrives as one batch."""
    entries = table(spark, sf_dir, "leadership_entries").select("entry_id", "email", "role", "name", "loaded_at")
    rows = stored(ledger.keyed(entries, "entry_id", ["email", "role", "name"], ["loaded_at"]), "keyed")
    last = rows.agg(F.max("loaded_at")).first()[0]
    late = F.coalesce(F.col("loaded_at") > F.lit(last).cast("timestamp") - F.expr("INTERVAL 30 DAYS"), F.lit(False))
    book = ledger.open_ledger(spark, scratch_folder(spark, "ledger"))
    book = ledger.merge(book, rows.filter(~late))
    book = ledger.merge(book, rows.filter(late))
    return ledger.copies(rows, book).select(F.col("first_id").alias("first_entry_id"), F.col("_id").alias("entry_id"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = table(spark, sf_dir, "role_reference").select(
        "role_ref_id", F.col("canonical_role").alias("canonical"), F.col("short_form").alias("short")
    )
    entries = table(spark, sf_dir, "leadership_entries").select("entry_id", "role")
    return reference_match.match_reference(entries, "entry_id", "role", ref).select(
        "entry_id", F.col("ref_id").alias("role_ref_id")
    )


def reference_matcher(spark: SparkSession, sf_dir: str) -> reference_match.Matcher:
    """role_reference as one matcher for the headlines' text check; the list travels to the workers, so its size is checked."""
    ref = table(spark, sf_dir, "role_reference").select("role_ref_id", "canonical_role", "short_form")
    rows = ref.limit(reference_match.BROADCAST_ENTRIES + 1).collect()
    if len(rows) > reference_match.BROADCAST_ENTRIES:
        raise ValueError("the list of positions is too long to travel with the headline parser")
    return reference_match.Matcher([(r[0], r[1], r[2]) for r in rows])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs but the last of each feed's numbering are history, the last run arrives as a batch."""
    runs = table(spark, sf_dir, "feed_runs").filter("feed_kind = 'incremental'").select("feed_id").distinct()
    rss = table(spark, sf_dir, "leadership_changes_rss").join(short_list(runs), "feed_id")
    rows = rss.select(F.col("change_id").alias("id"), history.page_key(F.col("Link")).alias("page"), F.col("Title").alias("title"))
    matcher = reference_matcher(spark, sf_dir)
    read = stored(history.read_headlines(rows, matcher), "headlines")
    last = rss.agg(F.max("run_no")).first()[0]
    early = rss.filter(F.col("run_no") < F.lit(last)).agg(F.max("change_id")).first()[0] or 0
    store = history.open_store(spark, scratch_folder(spark, "history"))
    for batch in (read.filter(F.col("id") <= early), read.filter(F.col("id") > early)):
        store = history.accept(store, batch, matcher)
    return history.repeats(read, store).select(F.col("first_id").alias("first_change_id"), F.col("id").alias("change_id"))


# Extractors whose hits are read off loose context, and words that are no name.
LOOSE_EXTRACTORS = ["onclick", "html-context", "network", "pdf-ocr-context"]
NO_NAMES = ["email", "e-mail", "mail", "st", "street", "hours", "support", "customer", "service", "info", "contact", "us",
            "contact us", "department", "n/a", "staff", "team", "our team"]


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"(?U)^[\s\u200B\uFEFF]+|[\s\u200B\uFEFF]+$", "")
    people = (
        table(spark, sf_dir, "people")
        .select(
            "rec_id", F.lower(clean("email")).alias("email_key"), clean("name").alias("name"), clean("role").alias("role"),
            "found_via", "confidence", "seen_at",
        )
        .filter("email_key <> ''")
    )
    trust = F.when(F.lower(F.coalesce("found_via", F.lit(""))).isin(LOOSE_EXTRACTORS), 1).when(F.col("confidence") < 0.65, 1).otherwise(2)
    seen = F.coalesce("seen_at", F.lit("1900-01-01").cast("timestamp"))

    # Names: full words in natural order are worth more than initials, inverted or single words.
    full_words = F.size(F.regexp_extract_all("name", F.lit(r"(?U)\p{L}[\p{L}\p{M}'’-]+"), 0))
    initials = F.col("name").rlike(r"^\p{L}\.?\s|\s\p{L}\.?$")
    marked = F.col("name").rlike(r"[^\p{L}\p{M}\p{N}\s.'’-]|^(?U)\p{L}{2,4}\. |^\p{Lu}{3,} |\d")
    complete_name = (
        F.when((F.col("name") == "") | F.lower("name").isin(NO_NAMES), 0)
        .when(full_words < 2, 1)
        .when(initials, 2)
        .when(marked, 3)
        .otherwise(4)
    )
    # agreement with the address tells a misspelt or reordered name from the person's own
    squashed = lambda c: F.regexp_replace(F.translate(F.lower(c), "áàâäãåéèêëíìîïóòôöõúùûüñçý", "aaaaaaeeeeiiiiooooouuuuncy"), r"[^a-z]", "")
    local = squashed(F.substring_index("email_key", "@", 1))
    first, final = squashed(F.regexp_extract("name", r"^(\S+)", 1)), squashed(F.regexp_extract("name", r"(\S+)$", 1))
    agrees = (local.contains(first) | (F.substring(local, 1, 1) == F.substring(first, 1, 1))).cast("int") + local.contains(final).cast("int") * 2
    named = survivors.cells(people, "email_key", complete_name, trust, agrees, seen, "rec_id", F.col("name"))
    # The fullest name in the best source is dominated by none, so its first layer always fills this field.
    named = survivors.layers(named, "cells", 1)
    best_name = survivors.from_layers(
        named, 1, lambda x: x["complete"] > 0, lambda x: [(x["complete"] >= 3).cast("int"), x["trust"], x["complete"], x["n"], x["seen"], x["rid"]]
    )
    names = named.select("email_key", best_name.alias("best_name"))

    # Roles: wordings of the reference list are full; a cell per wording and trust.
    ref = table(spark, sf_dir, "role_reference").select(F.lower(F.trim("canonical_role")).alias("_role"), "role_ref_id")
    titled = people.withColumn("_role", F.lower("role")).join(short_list(ref), "_role", "left")
    complete_role = F.when((F.col("role") == "") | F.lower("role").isin(NO_NAMES), 0).when(F.col("role_ref_id").isNull(), 1).otherwise(2)
    held = survivors.cells(titled, "email_key", complete_role, trust, F.coalesce("role_ref_id", F.lit(-1)), seen, "rec_id", F.col("role"))
    held = held.select("email_key", survivors.ranked(F.col("cells")).alias("ranked"))
    roles = held.select("email_key", _position("ranked").alias("best_role"))

    groups = people.groupBy("email_key").count().filter("count > 1").select("email_key")
    return groups.join(names, "email_key", "left").join(roles, "email_key", "left")


def _position(ranked: str):
    """The full wording of the position held last, from cells with their dominance layers.

    Cells of equal completeness and trust lie in layers by recency, so the policy takes the uppermost
    layer with a usable cell. The first layer gives the latest trusted full wording and a trusted
    fragment later than it. A wording that is only the tail (or the part before "of") of a longer one
    is filled from the layers below, as is a fragment: by a trusted, else a less trusted full wording.
    """
    c = F.col(ranked)
    full = lambda t: F.filter(c, lambda x: (x["complete"] == 2) & (x["trust"] == t))
    part_of = lambda part, whole: whole.endswith(F.concat(F.lit(" "), part)) | whole.startswith(F.concat(part, F.lit(" of ")))
    upper = lambda arr: survivors.pick(arr, lambda x: [-x["layer"], x["rid"]])
    top = lambda complete: upper(F.filter(c, lambda x: (x["layer"] == 1) & (x["complete"] == complete) & (x["trust"] == 2)))
    trusted, loose = full(2), full(1)
    latest, fragment = top(2), top(1)
    longer = upper(F.filter(trusted, lambda x: part_of(latest, x["value"])))
    whole = lambda arr: upper(F.filter(arr, lambda x: part_of(fragment, x["value"])))
    by_fragment = F.when(~part_of(fragment, F.coalesce(longer, latest)), F.coalesce(whole(trusted), whole(loose)))
    return F.coalesce(by_fragment, longer, latest, whole(loose), upper(loose), fragment, upper(c))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.sentence_units(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "leadership_entries").filter("name IS NOT NULL")
    email = names.address(F.col("email"))
    host = F.regexp_replace(F.lower(F.regexp_extract("source_url", r"(?i)//(?:www\.)?([^/:?#]+)", 1)), r"^www\.", "")
    site = F.coalesce(
        names.organisation(F.col("credit_union")),
        names.domain_organisation(F.substring_index(email, "@", -1)),
        names.domain_organisation(F.nullif(host, F.lit(""))),
    )
    on_sites = entries.select(names.spelling(F.col("name")).alias("spelling"), site.alias("org"), email.alias("email"), F.lit(None).cast("string").alias("told"))

    # The organisation a headline writes out is taken where the packed field confirms it; only the
    # other rows need the packed field taken apart.
    rss = table(spark, sf_dir, "leadership_changes_rss").select("Title", "Persons", "Organizations")
    phrase = F.regexp_extract(F.coalesce("Title", F.lit("")), names.ORGANISATION_PHRASE, 1)
    rss = rss.filter(F.length("Persons") > 3).withColumn("_phrase", phrase)
    confirmed = F.coalesce((F.col("_phrase") != "") & F.contains("Organizations", F.col("_phrase")), F.lit(False))
    rss = rss.withColumn("_unsure", F.when(~confirmed, F.col("Organizations")))
    listed = with_items(with_items(rss, "Persons", PERSON, "items"), "_unsure", ORGANIZATION, "orgs")
    headline = F.regexp_replace(names.plain(F.col("Title")), "[^a-z0-9]+", "")
    unions = F.filter("orgs", lambda o: o.rlike(names.UNION_WORDS))
    listed = listed.withColumn("_o", F.transform(unions, names.organisation))
    listed = listed.withColumn("_h", F.when(F.size("_o") > 1, headline).otherwise(""))
    named = F.filter("_o", lambda o: F.col("_h").contains(o))
    org = F.coalesce(F.get(named, F.lit(0)), F.get("_o", F.lit(0)), names.organisation(F.col("_phrase")))
    listed = listed.select("items", org.alias("org"), "Title")
    # outer, so that no filter on the array is inferred and pushed down to where it is computed again
    in_feeds = listed.select(F.explode_outer("items").alias("item"), "org", "Title").filter("item IS NOT NULL").select(
        names.spelling(F.col("item")).alias("spelling"), "org", F.lit(None).cast("string").alias("email"), "Title"
    )
    # only a spelling with an initial looks into its headline
    one_letter = F.col("spelling").rlike(r"^\p{L} | \p{L}$")
    told = F.when(one_letter, names.told_in_full(F.col("spelling"), names.spelling(F.when(one_letter, F.col("Title")))))
    in_feeds = in_feeds.withColumn("told", told).drop("Title")
    return names.spelling_pairs(names.persons(on_sites.unionByName(in_feeds)))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = packing.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return packing.pack(sizes, "doc_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")
    return leaks.find_leaks(docs, "doc_id", items, "item_id").select("doc_id", "item_id")


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p6_found": p6_found, "p7_found": p7_found, "p8_containers": p8_containers, "p9_found": p9_found, "p10_found": p10_found}

_BLANKS = r"[\s\x{00A0}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"
_SQL_STRIP = "regexp_replace({0}, '^" + _BLANKS.replace("{", "{{").replace("}", "}}") + "|" + _BLANKS.replace("{", "{{").replace("}", "}}") + "$', '', 'g')"
_SQL_SQUASH = "regexp_replace(translate(lower({0}), 'áàâäãåéèêëíìîïóòôöõúùûüñçý', 'aaaaaaeeeeiiiiooooouuuuncy'), '[^a-z]', '', 'g')"

ORACLES = {
    "p2_found": r"""
WITH k AS (
  SELECT entry_id, list_sort([regexp_replace(lower(nfc_normalize(coalesce(v, ''))), '[^\p{L}\p{N}]+', '', 'g') for v in [email, role, name]]) AS k
  FROM leadership_entries)
SELECT f AS first_entry_id, entry_id FROM (SELECT entry_id, min(entry_id) OVER (PARTITION BY k) AS f FROM k) WHERE entry_id > f""",
    "p6_found": r"""
WITH p AS (
  SELECT rec_id, lower(w(coalesce(email, ''))) AS k, w(coalesce(name, '')) AS name, w(coalesce(role, '')) AS role,
         CASE WHEN lower(coalesce(found_via, '')) IN ('onclick', 'html-context', 'network', 'pdf-ocr-context') OR confidence < 0.65 THEN 1 ELSE 2 END AS trust,
         coalesce(seen_at, TIMESTAMPTZ '1900-01-01 00:00:00+00') AS seen
  FROM people WHERE w(coalesce(email, '')) <> ''),
bad AS (SELECT ['email', 'e-mail', 'mail', 'st', 'street', 'hours', 'support', 'customer', 'service', 'info', 'contact', 'us', 'contact us', 'department', 'n/a', 'staff', 'team', 'our team'] AS b),
f AS (SELECT *, sq(split_part(k, '@', 1)) AS l, sq(regexp_extract(name, '^(\S+)', 1)) AS a, sq(regexp_extract(name, '(\S+)$', 1)) AS z FROM p),
n AS (
  SELECT k, rec_id, seen, trust, name AS v,
    CASE WHEN name = '' OR list_contains(b, lower(name)) THEN 0
         WHEN len(regexp_extract_all(name, '\p{L}[\p{L}\p{M}''’-]+')) < 2 THEN 1
         WHEN regexp_matches(name, '^\p{L}\.?\s|\s\p{L}\.?$') THEN 2
         WHEN regexp_matches(name, '[^\p{L}\p{M}\p{N}\s.''’-]|^\p{L}{2,4}\. |^\p{Lu}{3,} |\d') THEN 3 ELSE 4 END AS c,
    (contains(l, a) OR l[1] = a[1])::INT + 2 * contains(l, z)::INT AS e
  FROM f, bad),
nc AS (SELECT k, c, trust, e, count(*) AS cnt, max(struct_pack(seen := seen, rec_id := rec_id, v := v)) AS top FROM n WHERE c > 0 GROUP BY ALL),
sky AS (SELECT * FROM nc x WHERE NOT EXISTS (SELECT 1 FROM nc y WHERE y.k = x.k AND y.c >= x.c AND y.trust >= x.trust AND y.top.seen >= x.top.seen
        AND (y.c > x.c OR y.trust > x.trust OR y.top.seen > x.top.seen))),
names AS (SELECT k, arg_max(top.v, struct_pack(a := (c >= 3)::INT, b := trust, c := c, d := cnt, e := top.seen, f := top.rec_id)) AS best_name FROM sky GROUP BY k),
r AS (SELECT k, role AS v, trust, seen, rec_id, (t.c IS NOT NULL) AS full_ FROM p LEFT JOIN (SELECT DISTINCT lower(trim(canonical_role)) AS c FROM role_reference) t ON lower(role) = t.c, bad
      WHERE role <> '' AND NOT list_contains(b, lower(role))),
tf AS (SELECT * FROM r WHERE full_ AND trust = 2), lf AS (SELECT * FROM r WHERE full_ AND trust = 1),
latest AS (SELECT k, arg_max(v, struct_pack(s := seen, i := rec_id)) AS v, max(seen) AS at FROM tf GROUP BY k),
longer AS (SELECT tf.k, arg_max(tf.v, struct_pack(s := seen, i := rec_id)) AS v FROM tf JOIN latest l USING (k) WHERE tf.v LIKE '% ' || l.v OR tf.v LIKE l.v || ' of %' GROUP BY tf.k),
frag AS (SELECT r.k, arg_max(r.v, struct_pack(s := r.seen, i := r.rec_id)) AS v FROM r LEFT JOIN latest l USING (k) WHERE NOT full_ AND trust = 2 AND (l.at IS NULL OR r.seen > l.at) GROUP BY r.k),
ft AS (SELECT tf.k, arg_max(tf.v, struct_pack(s := seen, i := rec_id)) AS v FROM tf JOIN frag g USING (k) WHERE tf.v LIKE '% ' || g.v OR tf.v LIKE g.v || ' of %' GROUP BY tf.k),
fl AS (SELECT lf.k, arg_max(lf.v, struct_pack(s := seen, i := rec_id)) AS v FROM lf JOIN frag g USING (k) WHERE lf.v LIKE '% ' || g.v OR lf.v LIKE g.v || ' of %' GROUP BY lf.k),
ll AS (SELECT k, arg_max(v, struct_pack(s := seen, i := rec_id)) AS v FROM lf GROUP BY k),
la AS (SELECT k, arg_max(v, struct_pack(s := seen, i := rec_id)) AS v FROM r GROUP BY k),
g AS (SELECT k FROM p GROUP BY k HAVING count(*) > 1)
SELECT g.k AS email_key, names.best_name,
  coalesce(CASE WHEN frag.v IS NOT NULL AND NOT coalesce(coalesce(longer.v, latest.v) LIKE '% ' || frag.v OR coalesce(longer.v, latest.v) LIKE frag.v || ' of %', true) THEN coalesce(ft.v, fl.v) END,
           longer.v, latest.v, fl.v, ll.v, frag.v, la.v) AS best_role
FROM g LEFT JOIN names USING (k) LEFT JOIN latest USING (k) LEFT JOIN longer USING (k) LEFT JOIN frag USING (k) LEFT JOIN ft USING (k) LEFT JOIN fl USING (k)
LEFT JOIN ll USING (k) LEFT JOIN la USING (k)"""
    .replace("w(coalesce(email, ''))", _SQL_STRIP.format("coalesce(email, '')")).replace("w(coalesce(name, ''))", _SQL_STRIP.format("coalesce(name, '')"))
    .replace("w(coalesce(role, ''))", _SQL_STRIP.format("coalesce(role, '')"))
    .replace("sq(split_part(k, '@', 1))", _SQL_SQUASH.format("split_part(k, '@', 1)")).replace("sq(regexp_extract(name, '^(\\S+)', 1))", _SQL_SQUASH.format("regexp_extract(name, '^(\\S+)', 1)"))
    .replace("sq(regexp_extract(name, '(\\S+)$', 1))", _SQL_SQUASH.format("regexp_extract(name, '(\\S+)$', 1)")),
    "p9_found": r"""
WITH words AS (
  SELECT kind, id, [w FOR w IN string_split(regexp_replace(regexp_replace(lower(
      regexp_replace(regexp_replace(coalesce(text, ''),
        '(?i)</?(?:p|br|blockquote|div|ul|ol|li|h[1-6]|hr|table|tr|td|th|pre)\b[^<>]*>|\[/?(?:quote|list|code)\b[^\[\]]*\]|&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,30});', ' ', 'g'),
        '(?i)</?[a-z][^<>]*>|\[/?(?:b|i|u|s|url|img|color|size|font|center)\b[^\[\]]*\]', '', 'g')),
      '([\p{L}\p{M}\p{N}])[''’‐‑-]([\p{L}\p{N}])', '\1\2', 'g'), '[^\p{L}\p{M}\p{N}]+', ' ', 'g'), ' ') IF w <> ''] AS w
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM eval_items)),
spans AS (SELECT kind, id, w[p : p + 11] AS s FROM (SELECT kind, id, w, unnest(range(1, len(w) - 10)) AS p FROM words WHERE len(w) >= 12)),
keys AS (SELECT DISTINCT kind, id, j, array_to_string(list_concat(s[1 : j - 1], ['*'], s[j + 1 : 12]), ' ') AS k
         FROM spans, (SELECT unnest(range(1, 13)) AS j))
SELECT DISTINCT d.id AS doc_id, i.id AS item_id
FROM (SELECT * FROM keys WHERE kind = 'd') d JOIN (SELECT * FROM keys WHERE kind = 'i') i USING (j, k)""",
}
