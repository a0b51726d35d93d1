"""Queries of the general data operations: p1 (packed lists) and p5 (snapshot changes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgextract.operators.packed import ORGANIZATION, PERSON, explode_packed
from orgextract.operators.snapshots import snapshot_diff
from orgextract.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rss = table(spark, sf_dir, "leadership_changes_rss").select("change_id", "Persons", "Organizations")
    return explode_packed(rss, ["change_id"], {"Persons": PERSON, "Organizations": ORGANIZATION})


LINK_KEY = r"/$"


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rss = table(spark, sf_dir, "leadership_changes_rss").select("feed_id", "run_no", "Title", "Link")
    runs = table(spark, sf_dir, "feed_runs").filter((F.col("feed_kind") == "full") & (F.col("status") == "ok"))
    link = F.regexp_replace(F.regexp_replace(F.trim("Link"), r"(?s)#.*$", ""), LINK_KEY, "")
    rows = rss.withColumn("link_key", link).filter(F.trim(F.col("Link")) != "")
    title = F.trim(F.regexp_replace(F.coalesce("Title", F.lit("")), r"(?U)\s+", " "))
    return snapshot_diff(rows, runs, "feed_id", "run_no", "link_key", title)


QUERIES = {"p1_found": p1_found, "p5_found": p5_found}

ORACLES = {
    "p5_found": r"""
WITH runs AS (
  SELECT feed_id, run_no, lag(run_no) OVER (PARTITION BY feed_id ORDER BY run_no) AS prev
  FROM feed_runs WHERE feed_kind = 'full' AND status = 'ok'),
r AS (
  SELECT DISTINCT feed_id, run_no, regexp_replace(regexp_replace(trim(Link), '(?s)#.*$', ''), '/$', '') AS link_key,
         trim(regexp_replace(coalesce(Title, ''), '[\s\x{00A0}]+', ' ', 'g')) AS t
  FROM leadership_changes_rss WHERE trim(Link) <> ''),
g AS (SELECT feed_id, run_no, link_key, list_sort(list(t)) AS ts FROM r GROUP BY ALL),
now AS (SELECT g.feed_id, runs.run_no, link_key, ts FROM g JOIN runs USING (feed_id, run_no) WHERE prev IS NOT NULL),
bef AS (SELECT g.feed_id, runs.run_no, link_key, ts FROM g JOIN runs ON g.feed_id = runs.feed_id AND g.run_no = runs.prev)
SELECT feed_id, run_no, link_key,
       CASE WHEN bef.ts IS NULL THEN 'added' WHEN now.ts IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM now FULL JOIN bef USING (feed_id, run_no, link_key)
WHERE bef.ts IS NULL OR now.ts IS NULL OR now.ts <> bef.ts""",
}
