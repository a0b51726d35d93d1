import pytest

from orgextract.llm.queries import QUERIES

TABLES = {
    "leadership_entries": "entry_id long, credit_union string, role string, name string, email string, source_url string, found_via string, captured_at timestamp, loaded_at timestamp",
    "leadership_changes_rss": "change_id long, feed_id int, run_no int, fetched_at timestamp, published_at timestamp, Title string, Link string, Persons string, Organizations string",
    "feed_runs": "feed_id int, feed_name string, feed_url string, feed_kind string, run_no int, fetched_at timestamp, status string",
    "people": "rec_id long, role string, name string, email string, source string, found_via string, confidence double, seen_at timestamp",
    "role_reference": "role_ref_id int, canonical_role string, short_form string, role_family string",
    "documents": "doc_id long, text string",
    "eval_items": "item_id long, subject string, text string",
}
KEYS = {"role_reference": [(1, "Chief Executive Officer", "CEO", "x")], "feed_runs": [(1, None, None, "incremental", 1, None, "ok")]}


@pytest.mark.parametrize("nulls", [False, True])
def test_empty_tables_and_rows_of_nulls(spark, tmp_path, nulls):
    for name, schema in TABLES.items():
        n = len(schema.split(","))
        rows = KEYS.get(name, [(i, *[None] * (n - 1)) for i in (1, 2)]) if nulls else []
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, query in QUERIES.items():
        got = query(spark, str(tmp_path)).collect()
        # two entries without any value are copies of one another; nothing else has a result
        assert [tuple(r) for r in got] == ([(1, 2)] if nulls and name == "p2_found" else []), name
