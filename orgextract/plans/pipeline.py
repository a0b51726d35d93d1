"""The whole run over supplied tables: organisations and fetched pages in, unified events out.

Seeds start a bounded expansion over the links of the pages at hand; the pages reached go through
the extractors, as do the PDFs they link to and the responses beside them; records are gated,
scored and deduplicated in discovery order and unified. One plan handles all organisations.

Defined results
* a page is looked at once however many seeds or links lead to it, for the organisation whose host it has;
* pages of hosts without a seed, pages beyond the depth and failed ones give nothing, except that the
  addresses of a failed page's source are kept;
* empty tables give an empty result; null URLs and sources are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgextract.functions import text as t
from orgextract.functions import urls as u
from orgextract.operators import extract as ext
from orgextract.operators import nearest, resolve
from orgextract.operators.frontier import expand
from orgextract.session import stored
from orgextract.sources.documents import pdf_responses, pdf_texts

#: What gives plain addresses; everything else gives person records.
ADDRESS_TAGS = ["html", "cfemail", "network", "network-cfemail", "html-after-fail", "pdf-text", "pdf-ocr", "pdf-mailto"]
ORDER = ["depth", "page_id", "extractor_rank", "ord", "found_via"]


@dataclass(frozen=True)
class Options:
    depth: int = 3
    fanout: int | None = 40
    pdf: bool = False
    pdf_pages: int | None = 3
    pdf_per_host: int | None = 2
    valid_domains: tuple[str, ...] = ()
    extractors: tuple[str, ...] = ("json-ld", "html", "cfemail", "html-context")
    by_host: dict[str, list[str]] = field(default_factory=dict)


def _page_rows(pages: DataFrame) -> DataFrame:
    status = F.col("status") if "status" in pages.columns else F.lit("ok")
    url = F.col("url")
    x = pages.filter(url.isNotNull()).select(u.canonical_url(url).alias("page_id"), url.alias("source_url"), "html", F.coalesce(status, F.lit("ok")).alias("status"))
    return nearest.keep_first(x, ["page_id"], ["status", "source_url"])


def reached(pages: DataFrame, seeds: DataFrame, o: Options, visited: DataFrame | None = None, frontier: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(node, depth) of the pages reached from the seeds (name, url), or from a saved state on, and what was found but lies too deep."""
    found = ext.links(pages.filter("status = 'ok'"), cap=o.fanout).select(u.canonical_url(F.col("source_url")).alias("src"), F.col("url").alias("dst"))
    found = stored(found, "found")
    start = seeds.select(u.canonical_url(F.col("url")).alias("node"), F.lit(0).alias("depth"))
    if frontier is not None:
        start = start.unionByName(frontier.select("node", "depth"))
    nodes = stored(expand(found, start, o.depth, visited=visited), "reached")
    open_ = nodes.filter(F.col("depth") == o.depth).select(F.col("node").alias("src")).join(found, "src").select(F.col("dst").alias("node"))
    open_ = open_.distinct().join(nodes.select("node"), "node", "left_anti").withColumn("depth", F.lit(o.depth + 1))
    return nodes, open_


def candidates(pages: DataFrame, o: Options, responses: DataFrame | None = None, pdfs: DataFrame | None = None, pdf_parser=None, ocr=None) -> DataFrame:
    """Candidates of every extractor over pages (page_id, source_url, html, status)."""
    good = pages.filter("status = 'ok'")
    out = ext.extract(good, list(o.extractors)).unionByName(ext.salvage_emails(pages))
    if o.by_host:
        out = out.unionByName(ext.dispatch(good, o.by_host))
    if responses is not None:
        near = responses.select(u.canonical_url(F.col("page_url")).alias("page_id"), "url", "content_type", "body")
        base = good.select("page_id", F.col("source_url").alias("base"))
        own = near.join(base, "page_id").filter(u.same_domain(F.col("base"), F.col("url")) & u.is_text_type(F.col("content_type")) & ~u.is_blocked(F.col("url")))
        out = out.unionByName(ext.network_emails(own.select("page_id", F.col("url").alias("source_url"), "body")))
    if o.pdf and pdfs is not None:
        linked = ext.pdf_links(good, o.pdf_per_host).select(F.col("url").alias("path"), "page_id")
        read = {} if pdf_parser is None else {"parser": pdf_parser}
        texts = pdf_texts(pdf_responses(pdfs).join(linked.select("path"), "path", "left_semi"), o.pdf_pages, ocr=ocr, **read)
        texts = stored(texts.join(linked, "path").withColumnRenamed("path", "source_url"), "pdfs")
        passes = ext.pdf_passes(texts, "ocr_texts", "pdf-ocr", o.pdf_pages).unionByName(ext.pdf_passes(texts, "texts", "pdf-text", o.pdf_pages))
        out = out.unionByName(ext.pdf_people(texts, o.pdf_pages)).unionByName(passes.drop("kind"))
    return out


def records(found: DataFrame, visits: DataFrame, orgs: DataFrame, o: Options) -> tuple[DataFrame, DataFrame]:
    """(e-mail records, leadership records) of candidates on visited pages, first one per key in discovery order."""
    host = orgs.select(u.host_root(F.col("url")).alias("_host"), F.col("name").alias("credit_union"))
    where = visits.select(F.col("node").alias("page_id"), "depth").join(host, u.host_root(F.col("page_id")) == F.col("_host"))
    x = stored(found.join(where, "page_id"), "candidates")
    plain = F.col("found_via").isin(ADDRESS_TAGS)
    valid = F.array(*[F.lit(d) for d in o.valid_domains]).cast("array<string>")
    leaders = resolve.clean_records(x.filter(~plain))
    leaders = stored(resolve.dedup_records(leaders, ORDER).withColumn("confidence", resolve.confidence(F.col("found_via"), F.col("role"))), "leaders")
    emails = resolve.email_records(x.filter(plain & (F.col("email") != "")), valid)
    return resolve.with_leaders_emails(emails, leaders, valid, ORDER), leaders


def events(pages: DataFrame, orgs: DataFrame, as_of: str, o: Options = Options(), visited: DataFrame | None = None, frontier: DataFrame | None = None, **sources) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unified events, visited nodes, open frontier). pages: (url, html[, status]); orgs: (name, url)."""
    rows = stored(_page_rows(pages), "pages")
    nodes, open_ = reached(rows, orgs, o, visited, frontier)
    fresh = nodes if visited is None else nodes.join(visited.select("node"), "node", "left_anti")
    seen = rows.join(fresh.select(F.col("node").alias("page_id")), "page_id", "left_semi")
    emails, leaders = records(candidates(seen, o, **sources), fresh, orgs, o)
    return resolve.unified_events(emails, leaders, t.utc_string(F.lit(as_of).cast("timestamp"))), nodes, open_
