from pyspark.sql import functions as F

from orgextract.operators.packed import ORGANIZATION, PERSON, explode_packed, with_items

PERSONS = [
    (None, []),
    ("", []),
    ("  \t", []),
    ("N/A", []),
    (" ; ,", []),
    ("Uma Reognova", ["Uma Reognova"]),
    ("A. Bo, C D", ["A. Bo", "C D"]),
    ("A Bo;C D;", ["A Bo", "C D"]),
    ("A Bo || C D", ["A Bo", "C D"]),
    ("A Bo\r\nC D", ["A Bo", "C D"]),
    ("['A Bo', \"C O'D\"]", ["A Bo", "C O'D"]),
    ('["K \\"Ka\\" G", "E M"]', ['K "Ka" G', "E M"]),
    ("“A Bo” “C D”", ["A Bo", "C D"]),
    ('"Bo, A",C D', ["Bo, A", "C D"]),
    ('"D ""Da"" S", E F', ['D "Da" S', "E F"]),
    ('C "Ch" L', ['C "Ch" L']),
    ("Bo\\, A, C D", ["Bo, A", "C D"]),
    ("Nolen, Keisha", ["Nolen, Keisha"]),
    ("de la Bo, Kay", ["de la Bo, Kay"]),
    ("Gideon Nap, CPA", ["Gideon Nap, CPA"]),
    ("A B, C D, and E F", ["A B", "C D", "E F"]),
    ("A B & C D, ,", ["A B", "C D"]),
    ("A B / C D", ["A B", "C D"]),
    ("0, A B", ["0", "A B"]),
]
ORGS = [
    ("Rub Fal Savings and Credit Co-op, Ltd.", ["Rub Fal Savings and Credit Co-op, Ltd."]),
    ("A Teachers & Nurses Credit Union", ["A Teachers & Nurses Credit Union"]),
    ("A FCU / Finch, Marlow & Partners", ["A FCU", "Finch, Marlow & Partners"]),
    ("A FCU, Vantage Core / Nimbus Data", ["A FCU", "Vantage Core / Nimbus Data"]),
    ("A Credit Union and Open Ledger Foundation", ["A Credit Union", "Open Ledger Foundation"]),
    ("A Credit Union, B FCU, & C CU", ["A Credit Union", "B FCU", "C CU"]),
    ("A Members Credit Union\\, Inc., B FCU", ["A Members Credit Union, Inc.", "B FCU"]),
]


def check(spark, cases, notation):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, v string")
    got = {r.i: r["items"] for r in with_items(df, "v", notation, "items").collect()}
    for i, (text, want) in enumerate(cases):
        assert got[i] == want, text


def test_person_notations(spark):
    check(spark, PERSONS, PERSON)


def test_organisation_notations(spark):
    check(spark, ORGS, ORGANIZATION)


def test_positions_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "A B;;C D", "x", None), (1, "A B;;C D", "x", None)], "id int, Persons string, item string, Organizations string")
    got = explode_packed(df, ["id"], {"Persons": PERSON, "Organizations": ORGANIZATION}).collect()
    assert sorted((r.item_pos, r.item) for r in got) == [(1, "A B"), (1, "A B"), (2, "C D"), (2, "C D")]


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "id int, Persons string, Organizations string")
    assert explode_packed(df, ["id"], {"Persons": PERSON}).count() == 0
    long = spark.range(1).select(F.col("id"), F.repeat(F.lit("Ann Bo; "), 20000).alias("Persons"))
    assert explode_packed(long, ["id"], {"Persons": PERSON}).count() == 20000


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([(1, "A")], "id int, Persons string")
    plan = explode_packed(df, ["id"], {"Persons": PERSON})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
