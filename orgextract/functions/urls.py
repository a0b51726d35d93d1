"""URL functions (U1-U12) and predicates (P1-P4, P8-P12) as column expressions.

Null in, null out, except that the normalisers return '' for blank input. Parsing is lenient:
it works on patterns and never raises, whatever the text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgextract import profiles as p

any_of = lambda words: "|".join(re.escape(w) for w in words)
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def strip(c: Column) -> Column:
    """Trims all Unicode white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def netloc(url: Column) -> Column:
    """Authority with port and user info; '' without a scheme."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def fix_tld(host: Column) -> Column:
    """The first matching mistyped ending is mended; a port hides the ending."""
    h = F.lower(strip(host))
    out = None
    for wrong, right in p.TLD_FIXES:
        hit = h.endswith(wrong)
        value = F.concat(F.left(h, F.length(h) - len(wrong)), F.lit(right))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(h)


def is_bad_host(host: Column) -> Column:
    """Any listed host is part of this one."""
    return host.rlike(any_of(p.BAD_HOSTS))


def normalize_url(raw: Column) -> Column:
    """Trimmed, unquoted, with a scheme, mended ending; '' for blank input and bad hosts."""
    t = strip(F.coalesce(raw, F.lit("")))
    t = F.regexp_replace(F.regexp_replace(t, '^"+|"+$', ""), "^'+|'+$", "")
    full = F.when(t.rlike("(?i)^[a-z][a-z0-9+.-]*://"), t).otherwise(F.concat(F.lit("https://"), F.regexp_replace(t, "^/+", "")))
    host = netloc(full)
    fixed = fix_tld(host)
    rebuilt = F.concat(F.regexp_extract(full, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1), F.lit("://"), fixed, F.regexp_replace(full, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", ""))
    return F.when((t == "") | is_bad_host(fixed), "").otherwise(rebuilt)


def canonical_url(url: Column) -> Column:
    """Without fragment, then without one trailing slash."""
    return F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), "/$", "")


def host_root(url: Column) -> Column:
    """U4: lower-case authority without leading characters of the set {w, .}."""
    return F.ltrim(F.lower(netloc(url)), F.lit("w."))


def base_url(url: Column) -> Column:
    """Scheme://authority/."""
    return F.regexp_replace(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1), "$", "/")


def join_url(base: Column, href: Column) -> Column:
    """Resolves a reference; dot segments are folded with a stack."""
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", ""), r"[?#].*$", "")
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    no_fragment = F.regexp_replace(base, "#.*$", "")
    relative = F.concat(F.when(F.startswith(href, F.lit("/")), F.lit("")).otherwise(folder), href)
    rel_path = F.regexp_replace(relative, r"[?#].*$", "")
    rel_tail = F.regexp_extract(relative, r"([?#].*)$", 1)
    stack = F.aggregate(
        F.split(rel_path, "/"),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when((s == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when(s == "..", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    folded = F.array_join(stack, "/")
    folded = F.when(rel_path.rlike(r"/\.{1,2}$"), F.concat(folded, F.lit("/"))).otherwise(folded)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(href == "", no_fragment)
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .when(F.startswith(href, F.lit("?")), F.concat(root, F.when(path == "", "/").otherwise(path), href))
        .otherwise(F.concat(root, folded, rel_tail))
    )


def host_label(host: Column) -> Column:
    """U8: first DNS label, upper case."""
    return F.upper(F.substring_index(host, ".", 1))


def name_from_url(url: Column) -> Column:
    """A readable name from the host's first label."""
    u = strip(url)
    full = F.when(u.rlike("(?i)^https?://"), u).otherwise(F.concat(F.lit("https://"), u))
    host = host_root(full)
    label = F.upper(strip(F.regexp_replace(F.substring_index(host, ".", 1), "[-_]", " ")))
    return F.when(label == "", F.upper(host)).otherwise(label)


def org_label(name: Column) -> Column:
    """U10."""
    return F.upper(strip(F.coalesce(name, F.lit(""))))


def flip_scheme(url: Column) -> Column:
    """Http <-> https."""
    return (
        F.when(F.startswith(url, F.lit("https://")), F.concat(F.lit("http://"), F.substring(url, 9, 1 << 30)))
        .when(F.startswith(url, F.lit("http://")), F.concat(F.lit("https://"), F.substring(url, 8, 1 << 30)))
        .otherwise(url)
    )


def bare_path(url: Column) -> Column:
    """The path, '/' if none."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def url_path(url: Column) -> Column:
    """The path, with a trailing '/' where the URL itself ends with one."""
    path = bare_path(url)
    return F.when(url.endswith("/") & ~path.endswith("/"), F.concat(path, F.lit("/"))).otherwise(path)


def is_valid_http(url: Column) -> Column:
    """P2."""
    return F.coalesce(url.rlike(r"(?i)^https?://[^/?#]+"), F.lit(False))


def same_domain(base: Column, url: Column) -> Column:
    """Equal authorities; www and bare hosts differ."""
    return netloc(base) == netloc(url)


def is_org_domain(domain: Column, profile: str = "C") -> Column:
    """P4."""
    d = F.lower(F.coalesce(domain, F.lit("")))
    a = d.endswith(".coop") | d.endswith(".org") | d.endswith(".cu") | F.contains(d, F.lit("creditunion"))
    return a if profile != "C" else a | F.contains(d, F.lit("fcu")) | d.endswith("cu.com") | F.contains(d, F.lit("cu."))


def allowed_path(url: Column, allowed: Column) -> Column:
    """The path begins with an allowed prefix; an empty list allows all."""
    path = url_path(url)
    return (F.size(allowed) == 0) | F.exists(allowed, lambda a: F.startswith(path, a))


def is_denied(url: Column) -> Column:
    """A denied pattern in the path, or a denied word anywhere in the URL, host included."""
    u = F.lower(url)
    return bare_path(u).rlike(any_of(p.PEOPLE_DENY_PATHS)) | u.rlike(any_of(p.PEOPLE_DENY))


def is_people_relevant(url: Column) -> Column:
    """An allowed word anywhere in the URL, else no denied one."""
    u = F.lower(url)
    return u.rlike(any_of(p.PEOPLE_ALLOW)) | ~u.rlike(any_of(p.PEOPLE_DENY))


def is_text_type(content_type: Column) -> Column:
    """P10: listed prefix of a content type."""
    return F.coalesce(F.lower(content_type).rlike(f"^(?:{any_of(p.TEXT_CONTENT_TYPES)})"), F.lit(False))


def is_pdf(url: Column) -> Column:
    """P11."""
    return F.lower(url).endswith(".pdf")


def is_blocked(url: Column, profile: str = "C") -> Column:
    """A request a crawl doesn't make: pictures, fonts and trackers."""
    return url.rlike("(?i)" + "|".join(p.BLOCKED if profile == "A" else p.BLOCKED_BC))


def hook_applies(url: Column, site: str, profile: str = "C") -> Column:
    """Whether a site's own extractor reads this page. A: host and path, B: host and URL, C: the host root alone."""
    host = F.lower(netloc(url))
    if profile == "A":
        return F.contains(host, F.lit(site)) & F.lower(bare_path(url)).rlike(any_of(p.HOOK_MARKS_A))
    if profile == "B":
        return F.contains(host, F.lit(site)) & F.lower(url).rlike(any_of(p.HOOK_MARKS_B))
    return host_root(url) == site


def is_valid_seed(raw: Column) -> Column:
    """A row of an organisation list whose URL normalises to a web address of an organisation's domain (A)."""
    url = normalize_url(raw)
    return (url != "") & is_valid_http(url) & is_org_domain(netloc(url), "A")
