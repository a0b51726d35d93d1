"""Composite extractors (X1-X13, X15): pages in, candidate records out. Each is DataFrame -> DataFrame.

Pages have (page_id, source_url, html); candidates have page_id, source_url, role, name, email,
found_via, ord. Discovery order is (page, extractor, place), so keep-first steps are defined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgextract import profiles as p
from orgextract.functions import emails as e
from orgextract.functions import jsonld
from orgextract.functions import text as t
from orgextract.functions import urls as u
from orgextract.functions.entities import Tagger, entity_spans, pattern_tagger
from orgextract.functions.html import ANCESTORS, html_anchors, html_elements
from orgextract.operators.nearest import cap_per_key, nearest_span, neighbour_line
from orgextract.session import stored

KEYS = ["page_id", "source_url"]
RANK = {"network": 0, "json-ld": 1, "html": 2, "cfemail": 3, "html-context": 4, "leadership-mailto": 5, "click-here": 5, "onclick": 5,
        "leadership-structured": 5, "pdf-ocr": 6, "pdf-window": 7, "pdf-text": 8}


def _out(df: DataFrame, tag: str, **values: Column) -> DataFrame:
    cols = {"role": F.lit(""), "name": F.lit(""), "email": F.lit(""), "ord": F.lit(0), "found_via": F.lit(tag)} | values
    return df.select(*KEYS, *[cols[c].alias(c) for c in ("role", "name", "email", "ord")], cols["found_via"].alias("found_via"), F.lit(RANK.get(tag, 9)).alias("extractor_rank"))


def html_emails(pages: DataFrame) -> DataFrame:
    """Addresses of the page's source."""
    x = pages.select(*KEYS, F.posexplode(e.find_emails(F.col("html"))).alias("_o", "_e"))
    return _out(x, "html", email=F.col("_e"), ord=F.col("_o"))


def cf_emails(pages: DataFrame) -> DataFrame:
    """Encoded addresses."""
    x = pages.select(*KEYS, F.posexplode(F.transform(e.find_cf(F.col("html")), e.decode_cf)).alias("_o", "_e")).filter("_e <> ''")
    return _out(x, "cfemail", email=F.col("_e"), ord=F.col("_o"))


def role_name_in_window(text: Column, email: Column) -> tuple[Column, Column]:
    """X3, the window part: the first phrase with a role and the first with a name around an address."""
    parts = t.chunks(t.window_around(text, email, 400, 200))
    role = F.get(F.filter(F.transform(parts, t.role_first_c), lambda r: r != ""), F.lit(0))
    name = F.get(F.filter(F.transform(parts, lambda c: t.first_name(c, "C")), lambda n: n != ""), F.lit(0))
    return F.coalesce(role, F.lit("")), F.coalesce(name, F.lit(""))


def _credible(role: Column, name: Column, email: Column) -> Column:
    """A name that is a label, or stands beside a shared mailbox without a role, is nobody's."""
    return F.when((role == "") & e.is_generic(email, "C"), "").otherwise(t.blank_bad_name(name))


def near_addresses(texts: DataFrame, tag: str, anchors: DataFrame | None = None, rank: str | None = None) -> DataFrame:
    """Each distinct address of a text (page_id, source_url, html) with the role and name near it.

    The text of the element around the first link to the address decides, if it holds either; else
    the window around the address's first place. `anchors` are the page's links (html_anchors).
    """
    x = texts.select(*KEYS, F.col("html").alias("_txt"), F.posexplode(F.array_distinct(e.find_emails(F.col("html")))).alias("_o", "_e"))
    role, name = role_name_in_window(F.col("_txt"), F.col("_e"))
    x = x.select(*KEYS, "_o", "_e", role.alias("_wr"), name.alias("_wn"))
    role, name = F.col("_wr"), F.col("_wn")
    if anchors is not None:
        href = F.col("attrs")["href"]
        linked = anchors.filter(F.contains(href, F.lit("@"))).select(F.col("page_id").alias("_p"), "ord", href.alias("_href"), F.get("up", F.lit(0)).alias("_up"))
        first = x.select("page_id", "_e").distinct().join(linked, F.col("page_id") == F.col("_p")).filter(F.contains("_href", F.col("_e")))
        first = first.groupBy("page_id", "_e").agg(F.min_by("_up", "ord").alias("_up"))
        first = first.select("page_id", "_e", t.role_first_c(F.col("_up")).alias("_ar"), t.first_name(F.col("_up"), "C").alias("_an"))
        x = x.join(first.filter("_ar <> '' OR _an <> ''"), ["page_id", "_e"], "left")
        role, name = F.coalesce("_ar", "_wr"), F.coalesce("_an", "_wn")
    return _out(x, tag, role=role, name=_credible(role, name, F.col("_e")), email=F.col("_e"), ord=F.col("_o")).withColumn("extractor_rank", F.lit(RANK.get(rank or tag, 9)))


def context_people(pages: DataFrame, anchors: DataFrame | None = None) -> DataFrame:
    """X3 over a page's source with addresses made readable."""
    readable = pages.select(*KEYS, e.deobfuscate(F.col("html"), "C").alias("html"))
    return near_addresses(readable, "html-context", _links_of(pages, anchors))


def look_behind_people(pages: DataFrame, behind: int = 160) -> DataFrame:
    """X3B: role and name from the text just before an address (longest role, first name)."""
    x = pages.select(*KEYS, "html", F.posexplode(F.array_distinct(e.find_emails(F.col("html")))).alias("_o", "_e"))
    x = x.withColumn("_w", t.window_around(F.col("html"), F.col("_e"), behind, 0)).withColumn("_w", F.regexp_replace("_w", r"\S+$", ""))
    return _out(x, "HTML", role=t.infer_role_b(F.col("_w")), name=t.first_name(F.col("_w"), "B"), email=F.col("_e"), ord=F.col("_o"))


def jsonld_records(pages: DataFrame) -> DataFrame:
    """X9."""
    bodies = pages.select(*KEYS, F.posexplode(jsonld.scripts(F.col("html"))).alias("_o", "_b"))
    x = jsonld.people(bodies, [*KEYS, "_o"], "_b")
    return _out(x, "json-ld", role=F.col("role"), name=F.col("name"), email=F.col("email"), ord=F.col("_o"))


def _links_of(pages: DataFrame, anchors: DataFrame | None) -> DataFrame:
    """The pages' links; `anchors` are those already at hand, so that a page is parsed once for several extractors."""
    return html_anchors(pages, KEYS, "html") if anchors is None else anchors


def _mailtos(pages: DataFrame, anchors: DataFrame | None = None) -> DataFrame:
    """Links to an address, with the address and the texts of the elements around."""
    href = F.col("attrs")["href"]
    links = _links_of(pages, anchors).filter(href.rlike("^mailto:"))
    return links.select(*KEYS, "ord", "up", F.get("up", F.lit(0)).alias("parent"), e.strip_mailto(href).alias("email"))


def mailto_people(pages: DataFrame, profile: str = "C", tag: str = "leadership-mailto", anchors: DataFrame | None = None) -> DataFrame:
    """X5, B and C: mailto links with role and name of the parent element's text. On profile C a text of
    fewer than ten characters gives way to the grandparent's longer one, except under the fallback tag."""
    x = _mailtos(pages, anchors)
    ctx = F.coalesce("parent", F.lit(""))
    if profile == "C" and not tag.endswith("fallback"):
        grand = F.coalesce(F.get("up", F.lit(1)), F.lit(""))
        ctx = F.when((F.length(ctx) < 10) & (F.length(grand) > F.length(ctx)), grand).otherwise(ctx)
    x = x.withColumn("_ctx", ctx)
    role = t.infer_role_b(F.col("_ctx")) if profile == "B" else t.role_first_c(F.col("_ctx"))
    return _out(x, tag, role=role, name=t.first_name(F.col("_ctx"), profile), email=F.col("email"), ord=F.col("ord"))


def mailto_context(pages: DataFrame, anchors: DataFrame | None = None) -> DataFrame:
    """X5, A: the lines of three ancestors' texts decide role and name (JN4) and offer addresses beside the link's own."""
    x = _mailtos(pages, anchors).withColumn("_link", F.concat_ws(":", "page_id", "ord"))
    x = x.withColumn("_lines", t.lines(F.array_join(F.slice("up", 1, ANCESTORS), "\n")))
    lines = x.select("_link", F.posexplode("_lines").alias("line_no", "_l"))
    lines = lines.select("_link", "line_no", F.regexp_extract("_l", p.ROLES_A, 1).alias("role"), t.first_name(F.col("_l"), "A").alias("name"))
    found = neighbour_line(lines, "_link", 5, t.is_service_role)
    x = x.join(found, "_link", "left").withColumn("name", F.coalesce("name", F.lit("")))
    offered = F.flatten(F.transform("_lines", lambda line: e.find_emails(e.deobfuscate(line, "A"))))
    best = e.best_email(F.concat(offered, F.array("email")), F.col("name"))
    return _out(x, "mailto-context", role=F.coalesce("role", F.lit("")), name=F.col("name"), email=best, ord=F.col("ord"))


def click_here(pages: DataFrame, profile: str = "C", anchors: DataFrame | None = None) -> DataFrame:
    """Links that read "click here": a mailto link, else a protected one with its code inside, else one that
    carries the code itself; and, beside any, an address in the onclick script. Profile B adds role and name
    of the parent's text."""
    x = _links_of(pages, anchors).filter(F.contains(F.lower("text"), F.lit(p.CLICK_HERE)))
    href, onclick = F.coalesce(F.col("attrs")["href"], F.lit("")), F.coalesce(F.col("attrs")["onclick"], F.lit(""))
    mailto = F.contains(href, F.lit("mailto:"))
    protected = F.contains(href, F.lit(p.PROTECTED_LINK))
    found = {
        "click-here": F.when(mailto, e.strip_mailto(href)).when(~protected, e.decode_cf(F.col("attrs")["data-cfemail"])),
        "cfemail": F.when(~mailto & protected, e.decode_cf(F.col("cf"))),
        "onclick": e.strip_mailto(F.regexp_extract(onclick, "mailto:([^)\"']+)", 1)),
    }
    forms = F.array(*[F.struct(F.lit(tag).alias("tag"), c.alias("found")) for tag, c in found.items()])
    x = x.withColumn("_parent", F.get("up", F.lit(0))).select(*KEYS, "ord", "_parent", F.inline(forms)).filter("found <> ''")
    role, name = (t.infer_role_b(F.col("_parent")), t.first_name(F.col("_parent"), "B")) if profile == "B" else (F.lit(""), F.lit(""))
    return _out(x, "click-here", role=role, name=name, email=F.col("found"), ord=F.col("ord"), found_via=F.col("tag"))


def structured_people(pages: DataFrame, strict_reference: bool = False, text: str | None = None) -> DataFrame:
    """Role, name and address in a row; the corrected pattern unless strict_reference. `text` is a column
    that holds the text to read instead of the whole page (see container_text)."""
    rx = p.STRUCTURED_LITERAL if strict_reference else p.STRUCTURED
    x = t.spans(pages.withColumn("_txt", t.strip_tags(F.col("html")) if text is None else F.col(text)), KEYS, "_txt", rx)
    part = lambda i: F.regexp_extract("match", rx, i)
    return _out(x, "leadership-structured", role=part(1), name=part(2), email=part(3), ord=F.col("ord"))


def structured_people_b(pages: DataFrame, domain: str) -> DataFrame:
    """X7, B: the block around the staff heading, addresses of one domain only."""
    rx = p.TEXT_B.format(domain=domain.replace(".", r"\."))
    x = t.spans(container_text(pages, "B"), KEYS, "container", rx)
    part = lambda i: F.regexp_extract("match", rx, i)
    return _out(x, "leadership-text", role=part(1), name=F.trim(part(2)), email=part(3), ord=F.col("ord"))


def container_text(pages: DataFrame, profile: str = "C") -> DataFrame:
    """Pages with `container`: the text a staff heading leads to.

    A second-level heading with the words comes first, then the first element that holds them; on
    profile C then one with another heading's words, and the whole page where there is none. C
    reads the element itself, B its parent ('' without one).
    """
    el = html_elements(pages, "page_id", "html")
    low = F.lower("text")
    has = lambda words: low.rlike(u.any_of(words))
    staff = F.contains(low, F.lit(p.STAFF_HEADING))
    level = F.when(staff & (F.col("tag") == "h2"), 1).when(staff, 2)
    if profile == "C":
        level = level.when(has(p.OTHER_HEADINGS), 3)
    found = el.withColumn("_level", level).filter("_level IS NOT NULL")
    best = found.groupBy("page_id").agg(F.min_by(F.struct("ord", "parent_ord", "text"), F.struct("_level", "ord")).alias("_h"))
    if profile == "B":
        up = el.select(F.col("page_id").alias("_p"), F.col("ord").alias("_o"), F.col("text").alias("container"))
        best = best.join(up, (F.col("page_id") == F.col("_p")) & (F.col("_h.parent_ord") == F.col("_o")), "left").select("page_id", "container")
        return pages.join(best, "page_id", "left").withColumn("container", F.coalesce("container", F.lit("")))
    best = best.select("page_id", F.col("_h.text").alias("container"))
    return pages.join(best, "page_id", "left").withColumn("container", F.coalesce("container", t.strip_tags(F.col("html"))))


def priority_links(found: Column, relevant: Callable[[Column], Column], quota: int) -> Column:
    """The relevant links of an array in order, all of them, then others up to the quota."""
    first = F.filter(found, relevant)
    others = F.array_except(found, first)
    return F.concat(first, F.slice(others, F.lit(1), F.greatest(F.lit(quota) - F.size(first), F.lit(0))))


def _hrefs(pages: DataFrame, absolute: Callable[[Column, Column], Column]) -> DataFrame:
    """page_id, source_url, _o, url: link targets in order, made absolute inside the generator, so that no filter
    on the URL is pushed down to where it would be computed once per test."""
    href = F.regexp_extract_all("html", F.lit(r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"']"), 1)
    return pages.select(*KEYS, F.posexplode(F.transform(href, lambda h: absolute(F.col("source_url"), F.trim(h)))).alias("_o", "url"))


def links(pages: DataFrame, allowed: Column | None = None, cap: int | None = 40, visited: DataFrame | None = None) -> DataFrame:
    """page_id, source_url, pos, url: links made absolute, on the same host, neither denied nor PDF nor
    visited (url), once each: people's pages first, then others, in their order; the first `cap` per page,
    or all of them where cap is None."""
    x = _hrefs(pages, lambda base, h: u.canonical_url(u.join_url(base, h)))
    ok = u.same_domain(F.col("source_url"), F.col("url")) & ~u.is_pdf(F.col("url")) & ~u.is_denied(F.col("url"))
    if allowed is not None:
        ok = ok & u.allowed_path(F.col("url"), allowed)
    x = x.filter(ok).groupBy(*KEYS, "url").agg(F.min("_o").alias("pos"))
    if visited is not None:
        x = x.join(visited.select("url").distinct(), "url", "left_anti")
    entry = F.struct((~u.is_people_relevant(F.col("url"))).alias("_later"), "pos", "url")
    kept = F.array_sort(F.collect_list(entry))  # one page's links
    kept = x.groupBy(*KEYS).agg((kept if cap is None else F.slice(kept, 1, cap)).alias("_l"))
    return kept.select(*KEYS, F.inline("_l")).drop("_later")


def pdf_links(pages: DataFrame, per_host: int | None = 2) -> DataFrame:
    """Url, host, page_id, source_url of the PDFs pages link to, once each, the first `per_host` of a host."""
    x = _hrefs(pages, u.join_url)
    x = x.filter(u.is_pdf(F.col("url")) & ~u.is_denied(F.col("url")))
    x = x.groupBy("url").agg(F.min(F.struct("page_id", "_o", "source_url")).alias("_f"))
    x = x.select("url", u.host_root(F.col("url")).alias("host"), "_f.page_id", "_f.source_url")
    return x if per_host is None else cap_per_key(x, "host", ["page_id", "url"], per_host)


EXTRACTORS = {
    "json-ld": jsonld_records, "html": html_emails, "cfemail": cf_emails, "html-context": context_people, "leadership-mailto": mailto_people,
    "mailto-context": mailto_context, "click-here": click_here, "leadership-structured": structured_people,
}


#: Extractors that read the pages' links.
ANCHORED = {"html-context", "leadership-mailto", "mailto-context", "click-here"}


def extract(pages: DataFrame, names: list[str] | None = None) -> DataFrame:
    """All registered extractors over the pages, in one union. Where several read the links, these are parsed once and stored."""
    names, out = names or list(EXTRACTORS), None
    shared = {"anchors": stored(html_anchors(pages, KEYS, "html"), "anchors")} if len(ANCHORED & set(names)) > 1 else {}
    for n in names:
        x = EXTRACTORS[n](pages, **(shared if n in ANCHORED else {}))
        out = x if out is None else out.unionByName(x)
    return out


def site_config(pages: DataFrame, config: DataFrame) -> DataFrame:
    """JN6: the first configuration (key, ord, name, base, allowed_paths, ...) whose key is part of the page's host;
    other pages get the default one: the host's label, its root and every path.

    The configuration is a short, hand-written list; it is broadcast behind a check of its size.
    """
    if config.limit(1001).count() > 1000:
        raise ValueError("a site configuration holds at most 1,000 rows")
    cols = [c for c in config.columns if c not in ("key", "ord")]
    host = u.netloc(F.col("source_url"))
    hosts = pages.select(host.alias("_host")).filter("_host IS NOT NULL").distinct()
    best = hosts.join(F.broadcast(config), F.contains(F.col("_host"), F.col("key"))).groupBy("_host").agg(F.min_by(F.struct(*cols), "ord").alias("_c"))
    out = pages.withColumn("_host", host).join(best.select("_host", F.lit(True).alias("_own"), "_c.*"), "_host", "left")
    default = {"name": u.host_label(F.col("_host")), "base": u.base_url(F.col("source_url")), "allowed_paths": F.array(F.lit("/"))}
    for c, value in default.items():
        if c in cols:
            out = out.withColumn(c, F.when(F.col("_own"), F.col(c)).otherwise(value))
    return out.drop("_host", "_own")


def network_emails(responses: DataFrame) -> DataFrame:
    """Addresses in text responses (page_id, source_url, body) of the page's own host, made readable, and encoded ones."""
    plain = html_emails(responses.withColumn("html", e.deobfuscate(F.col("body"), "C"))).withColumn("found_via", F.lit("network"))
    coded = cf_emails(responses.withColumnRenamed("body", "html")).withColumn("found_via", F.lit("network-cfemail"))
    return plain.unionByName(coded).withColumn("extractor_rank", F.lit(RANK["network"]))


def text_people(pages: DataFrame, tagger: Tagger = pattern_tagger, reach: int = 300, email_reach: int | None = None, tag: str = "text-spacy") -> DataFrame:
    """Each role in the text with the nearest person within reach and the best address of the text
    `email_reach` characters to either side (as far as persons, if not given).

    Roles and persons are span tables of the same document. Service roles are left out; a role
    without a person or address near it stays, with ''. Null and blank texts give nothing.
    """
    email_reach = email_reach or reach
    txt = pages.withColumn("_txt", t.strip_tags(F.coalesce("html", F.lit("")))).filter(F.trim("_txt") != "").select(*KEYS, "_txt")
    roles = t.spans(txt, [*KEYS, "_txt"], "_txt", p.ROLES_A, 1).filter(~t.is_service_role(F.col("match")))
    around = F.substring("_txt", F.greatest(F.col("start") - email_reach, F.lit(0)) + 1, F.least(F.col("start"), F.lit(email_reach)) + email_reach)
    roles = roles.select(*KEYS, F.col("start").alias("pos"), "ord", F.col("match").alias("role"), e.find_emails(around).alias("_mails"))
    people = entity_spans(txt, "page_id", "_txt", tagger).filter("label = 'PERSON'").drop("label")
    x = nearest_span(roles, people, "page_id", reach)
    return _out(x, tag, role=F.col("role"), name=F.col("nearest"), email=e.best_email(F.col("_mails"), F.col("nearest")), ord=F.col("ord"))


def structured_or_text_people(pages: DataFrame, tagger: Tagger = pattern_tagger) -> DataFrame:
    """Role, name and address in a row, the address mended; pages without one are read with X4, persons
    within 400 characters and addresses within 600."""
    readable = pages.select(*KEYS, e.deobfuscate(t.strip_tags(F.coalesce("html", F.lit(""))), "A").alias("html"))
    x = t.spans(readable, KEYS, "html", p.STRICT_A)
    part = lambda i: F.regexp_extract("match", p.STRICT_A, i)
    strict = _out(x, "msfcu-strict", role=part(1), name=part(2), email=e.best_email(F.array(part(3)), part(2)), ord=F.col("ord"))
    rest = readable.join(strict.select("page_id").distinct(), "page_id", "left_anti")
    return strict.unionByName(text_people(rest, tagger, 400, 600, "msfcu-spacy"))


def _joined(texts: DataFrame, column: str, keep_pages: int | None) -> DataFrame:
    """page_id, source_url, html: a document's page texts in one, the first `keep_pages` (None: all)."""
    kept = F.coalesce(F.col(column), F.array().cast("array<string>"))
    if keep_pages is not None:
        kept = F.slice(kept, 1, keep_pages)
    return texts.select(*KEYS, F.array_join(F.transform(kept, lambda x: t.truncated(x)), "\n").alias("html"))


def pdf_people(texts: DataFrame, keep_pages: int | None = 3, profile: str = "C") -> DataFrame:
    """Texts (page_id, source_url, texts array): each address with role and name around it (C) or in
    the 180 characters before it (B)."""
    if profile == "B":
        return look_behind_people(_joined(texts, "texts", None), 180).withColumn("found_via", F.lit("pdf"))
    return near_addresses(_joined(texts, "texts", keep_pages), "pdf-window")


def pdf_passes(texts: DataFrame, column: str = "texts", tag: str = "pdf-text", keep_pages: int | None = 3) -> DataFrame:
    """X11: three passes over a document: its text as it is, made readable, and addresses behind "mailto:".

    Each pass gives person records (`<tag>-context`, `<tag>-mailto`) and plain addresses (`<tag>`,
    `pdf-mailto`); `kind` tells them apart. Use column "ocr_texts" and tag "pdf-ocr" for recognised texts.
    """
    raw = _joined(texts, column, keep_pages)
    readable = raw.withColumn("html", e.deobfuscate(F.col("html"), "C"))
    behind = F.regexp_extract_all("html", F.lit(r"(?i)mailto:([A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,})"), 1)
    linked = raw.select(*KEYS, F.col("html").alias("_txt"), F.posexplode(F.array_distinct(behind)).alias("_o", "_e"))
    role, name = role_name_in_window(F.col("_txt"), F.col("_e"))
    mailto = _out(linked, f"{tag}-mailto", role=role, name=_credible(role, name, F.col("_e")), email=F.col("_e"), ord=F.col("_o"))
    people = near_addresses(raw, f"{tag}-context").unionByName(near_addresses(readable, f"{tag}-context"))
    plain = html_emails(raw).unionByName(html_emails(readable)).withColumn("found_via", F.lit(tag))
    plain = plain.unionByName(_out(linked, "pdf-mailto", email=F.col("_e"), ord=F.col("_o")))
    people = people.unionByName(mailto).withColumn("kind", F.lit("LEADERSHIP"))
    return people.unionByName(plain.withColumn("kind", F.lit("EMAIL"))).withColumn("extractor_rank", F.lit(RANK.get(tag, 9)))


def salvage_emails(pages: DataFrame) -> DataFrame:
    """Addresses of pages whose load failed (status = 'failed')."""
    return html_emails(pages.filter("status = 'failed'")).withColumn("found_via", F.lit("html-after-fail"))


def dispatch(pages: DataFrame, by_host: dict[str, list[str]]) -> DataFrame:
    """JN7: extractors registered for a host root run on that host's pages only.

    The register becomes one lookup per page, so the plan has a branch per extractor, not per host.
    """
    if not by_host:
        raise ValueError("no host is registered")
    register = F.create_map(*[x for host, names in by_host.items() for x in (F.lit(host), F.array(*[F.lit(n) for n in names]))])
    marked = pages.withColumn("_names", F.try_element_at(register, u.host_root(F.col("source_url"))))
    out = None
    for n in sorted({n for names in by_host.values() for n in names}):
        x = EXTRACTORS[n](marked.filter(F.array_contains("_names", n)).drop("_names"))
        out = x if out is None else out.unionByName(x)
    return out
