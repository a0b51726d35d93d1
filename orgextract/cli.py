"""Command line: organisation list and tables of fetched pages in, unified events out."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orgextract.functions import urls as u
from orgextract.plans import pipeline
from orgextract.sources import orgs, sinks
from orgextract.streaming.progress import log_event, setup_logging


def parser() -> argparse.ArgumentParser:
    a = argparse.ArgumentParser(prog="orgextract")
    a.add_argument("csv_file", help="organisation list; any columns")
    a.add_argument("--pages", required=True, help="Parquet table: url, html and, if known, status ('ok' or 'failed')")
    a.add_argument("--responses", help="Parquet table: page_url, url, content_type, body")
    a.add_argument("--pdf", action="store_true", help="read the PDFs the pages link to")
    a.add_argument("--pdfs", help="Parquet table: url, status, content_type, content_length, seconds, content")
    a.add_argument("--out", required=True)
    a.add_argument("--out-format", choices=["parquet", "csv"], default="parquet")
    a.add_argument("--run-id", default="run")
    a.add_argument("--csv-sep", default=",")
    a.add_argument("--csv-encoding", default="UTF-8")
    a.add_argument("--limit-domains", nargs="*", default=[], help="host roots")
    a.add_argument("--limit-seeds", type=int, help="the first organisations only, by name")
    a.add_argument("--valid-domains", nargs="*", default=[])
    a.add_argument("--depth-limit", type=int, default=3)
    a.add_argument("--fanout-per-page", type=int, default=40)
    a.add_argument("--extractors-of", nargs="*", default=[], metavar="HOST=NAME,NAME", help="extractors of one host root")
    a.add_argument("--checkpoint-dir", help="crawl state; a later run goes on from it")
    a.add_argument("--reset", action="store_true", help="forget the crawl state first")
    a.add_argument("--log-dir")
    a.add_argument("--as-of", default="1970-01-01 00:00:00")
    return a


def main(argv: list[str] | None = None) -> int:
    """0, or 1 where the list holds no organisation."""
    o = parser().parse_args(argv)
    spark = SparkSession.builder.appName("orgextract").getOrCreate()
    note = lambda event, **kw: None
    if o.log_dir:
        setup_logging(o.log_dir)
        note = lambda event, **kw: log_event(os.path.join(o.log_dir, "progress.jsonl"), event, **kw)
    seeds = orgs.seeds(orgs.read_csv(spark, o.csv_file, o.csv_sep, o.csv_encoding))
    if o.limit_domains:
        seeds = seeds.filter(u.host_root(F.col("url")).isin(o.limit_domains))
    if o.limit_seeds:
        seeds = seeds.orderBy("name", "url").limit(o.limit_seeds)
    if seeds.isEmpty():
        note("no_organisations", file=o.csv_file)
        return 1
    visited = frontier = None
    if o.checkpoint_dir:
        if o.reset:
            sinks.reset_state(spark, o.checkpoint_dir)
        visited, frontier = (sinks.load_state(spark, o.checkpoint_dir, part) for part in ("visited", "frontier"))
    by_host = {host: names.split(",") for host, names in (x.split("=", 1) for x in o.extractors_of)}
    options = pipeline.Options(depth=o.depth_limit, fanout=o.fanout_per_page, pdf=o.pdf, valid_domains=tuple(o.valid_domains), by_host=by_host)
    sources = {"responses": spark.read.parquet(o.responses) if o.responses else None, "pdfs": spark.read.parquet(o.pdfs) if o.pdfs else None}
    note("run_start", run=o.run_id)
    found, nodes, open_ = pipeline.events(spark.read.parquet(o.pages), seeds, o.as_of, options, visited, frontier, **sources)
    (sinks.append_csv if o.out_format == "csv" else sinks.append_events)(found, o.out, o.run_id)
    if o.checkpoint_dir:
        sinks.save_state(o.checkpoint_dir, visited=nodes, frontier=open_)
    note("run_done", run=o.run_id, pages=nodes.count())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
