from orgextract.llm.reference_match import SYNONYMS, map_to_sharded_reference, match_reference


def test_an_earlier_stage_wins_over_a_nearer_later_one(spark):
    ref = spark.createDataFrame([(i, c, None) for i, c in [(3, "President"), (25, "Loan Officer"), (43, "Treasurer"), (44, "Auditor")]], "role_ref_id int, canonical string, short string")
    values = ["Tresurer, President", "Presidnet; Treasurer", "Auditr, Loan Officer", "Loan Oficer | President", "Presidnet, Auditor"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, role string")
    want = {(0, 43), (1, 3), (2, 44), (3, 25), (4, 3)}
    assert {tuple(r) for r in match_reference(df, "id", "role", ref).collect()} == want
    assert {tuple(r) for r in map_to_sharded_reference(df, "id", "role", ref, SYNONYMS, 4).collect()} == want


def test_every_role_of_a_table_in_shards(spark):
    """One tree against 2, 4 and 8 shards, all positions and all distinct roles."""
    import os

    import pytest
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.01"
    if not os.path.exists(folder):
        pytest.skip("no test tables here")
    ref = spark.read.parquet(f"{folder}/role_reference.parquet").select("role_ref_id", F.col("canonical_role").alias("canonical"), F.col("short_form").alias("short"))
    roles = spark.read.parquet(f"{folder}/leadership_entries.parquet").select("role").distinct().withColumn("id", F.col("role"))
    want = {tuple(r) for r in match_reference(roles, "id", "role", ref).collect()}
    assert len(want) > 1000 and sum(x == -1 for _, x in want) < len(want) / 2
    for shards in (2, 4, 8):
        assert {tuple(r) for r in map_to_sharded_reference(roles, "id", "role", ref, SYNONYMS, shards).collect()} == want, shards


def test_another_domain_s_lexicon(spark):
    from orgextract.llm.reference_match import Lexicon

    rows = [("abbreviation", "st", "saint"), ("filler", "city", None), ("synonym", "Big Apple", "New York"), ("remark", "downtown", None), ("place", "north", None)]
    lexicon = Lexicon.load(spark.createDataFrame(rows, "kind string, written string, meant string"))
    ref = spark.createDataFrame([(1, "Saint Paul", None), (2, "New York", "NYC")], "role_ref_id int, canonical string, short string")
    values = ["St. Paul", "city of new york", "Big Aple", "nyc", "Downtown Saint Pual", "North New York", "Chief Executive Officer"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, role string")
    want = {(0, 1), (1, -1), (2, 2), (3, 2), (4, 1), (5, 2), (6, -1)}
    assert {tuple(r) for r in match_reference(df, "id", "role", ref, lexicon=lexicon).collect()} == want
    assert {tuple(r) for r in map_to_sharded_reference(df, "id", "role", ref, None, 2, lexicon).collect()} == want
