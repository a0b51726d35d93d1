import itertools
import random

from pyspark.sql import functions as F

from orgextract.llm import history, headlines, names
from orgextract.llm.components import components
from orgextract.llm.editmetric import levenshtein
from orgextract.llm.reference_match import SYNONYMS, Matcher

M = Matcher([(2, "President & CEO", None), (5, "Chief Financial Officer", "CFO"), (25, "Loan Officer", None)], SYNONYMS)


def test_parse():
    key = lambda t: (lambda h: h and h[:4])(headlines.parse(t, M))
    want = ("annbo", "", 5, "redoak")
    for t in ["Red Oak Credit Union appoints Ann Bo as CFO", "UPDATE: Ann Bo named Chief Financial Officer of Red Oak CU!", "ANN BO ELECTED CFO AT RED OAK CREDIT UNION",
              "Board of Red Oak FCU selects Ann Bo for Chf Fin Ofcr post", "Red  Oak CU names new CFO: Ann Bo - Daily News"]:
        assert key(t) == want, t
    assert key("Ann K. Bo joins Red Oak CU as CFO") == ("annbo", "k", 5, "redoak")
    assert key("People on the move") is None and key("") is None and key("x" * 30_000) is None


COMMON = headlines.CommonWords(M)


def halves(a, b):
    x = headlines.fingerprint(a) ^ headlines.fingerprint(b)
    return (x & ((1 << headlines.HALF) - 1)).bit_count(), (x >> headlines.HALF).bit_count()


def test_fingerprint_bits():
    a = ["ann", "bowen", "oak", "red"]
    assert halves(a, a) == (0, 0) and halves(a, ["ann", "bowne", "oak", "red"]) == (0, 0) and halves(a, ["ann", "bowe", "oak", "red"]) == (1, 0)
    assert halves(a, ["ann", "bowem", "oak", "red"]) == (2, 0) and halves(a, ["ann", "nowen", "oak", "red"]) == (2, 2) and halves(a, ["ann", "obwen", "oak", "red"]) == (0, 2)


def test_own_words():
    own = lambda t: headlines.normal(t, COMMON)[1]
    for t in ["Red Oak Credit Union appoints Ann Bowen as CFO", "UPDATE: Ann Bowen named Cheif Financial Officer of Red Oak CU, Imc.!", "ANN K. BOWEN ELECTED CFO AT RED OAK FEDERAL CREDIT UNION",
              "Board of Red Oak Ciy & County FCU selects Ann Bowen for Chf Fin Ofcr pot", "Ann Bowen joins Red Oak Cred…"]:
        assert own(t) == ["ann", "bowen", "oak", "red"] or (t.startswith("Ann") and set(own(t)) <= {"ann", "bowen", "oak", "red"}), t
    assert own("") == [] and own("Credit union names new CFO") == []


def test_every_pair_within_the_documented_bits_meets(spark):
    """Against brute force: exact within MAX_BITS per half, and of all pairs with one slip at least 0.9."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("aeioulnrstdmkvbg") for _ in range(r.randint(4, 8)))
    texts = [sorted(word() for _ in range(4)) for _ in range(300)]
    slipped = []
    for t in texts:
        i = r.randrange(4)
        w, at = t[i], r.randrange(len(t[i]))
        w = r.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at + 1 :], w[:at] + "x" + w[at:]])
        slipped.append(sorted([*t[:i], *t[i + 1 :], w]))
    fps = [headlines.fingerprint(t) for t in texts + slipped]
    df = spark.createDataFrame(list(enumerate(fps)), "rep long, fp long")
    cut = history.block_rows(df).withColumn("old", F.lit(False)).cache()
    got = {(x.b, x.a) for x in history.near(cut, cut).collect()}
    low = (1 << headlines.HALF) - 1
    close = lambda x: (x & low).bit_count() <= history.MAX_BITS and (x >> headlines.HALF).bit_count() <= history.MAX_BITS
    assert got == {(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if close(fps[i] ^ fps[j])}
    assert sum((i, i + 300) in got for i in range(300)) >= 0.99 * 300


def test_page_key(spark):
    links = ["https://WWW.a.org/x/?utm_source=m&id=3#top", "http://a.org/x?id=3", "https://a.org/x/?id=3&fbclid=9", " ", None, "https://a.org/", "https://a.org/y"]
    df = spark.createDataFrame([(x,) for x in links], "l string")
    assert [r.k for r in df.select(history.page_key(F.col("l")).alias("k")).collect()] == ["a.org/x?id=3"] * 3 + [None] * 3 + ["a.org/y"]


TITLES = [
    (1, "a.org/1", "Ann Bowen named CFO of Red Oak CU"), (2, None, "Red Oak CU appoints Ann Bowne as CFO"), (3, "a.org/3", "Ann Bowen joins Red Oak CU as Loan Officer"),
    (4, "a.org/3", "People on the move"), (5, "a.org/5", "People on the move"), (6, "a.org/5", "Red Oak CU appoints Ann L. Bowen as CFO"), (7, None, None),
    (8, None, "Red Oak CU appoints Bea Bowen as CFO"), (9, "a.org/9", "Red Oak CU appoints Ann L. Bowen as CFO"), (10, None, "New faces"),
]


WANT = [(1, 2), (1, 5), (1, 6), (1, 9), (3, 4)]


def test_batches_agree_with_one_pass(spark, tmp_path):
    df = spark.createDataFrame(TITLES, "id long, page string, title string")
    rows = history.read_headlines(df, M).cache()
    for cuts in ((3, 20), (2, 6)):
        store = history.open_store(spark, f"file://{tmp_path}/{cuts}", 4)
        for a, b in zip((0, *cuts), (*cuts, 99)):
            store = history.accept(store, rows.filter((F.col("id") > a) & (F.col("id") <= b)), M)
        assert sorted(tuple(r) for r in history.repeats(rows, store).collect()) == WANT, cuts


def test_history_lasts_and_grows_by_appending(spark, tmp_path):
    import os

    path = f"file://{tmp_path}/h"
    more = [(100 + i, f"b.org/{i}", f"{''.join(random.Random(i).sample('aeilnorstu', 6)).title()} Quo{chr(97 + i % 26)}{chr(97 + i // 26)}r joins Blue{chr(97 + i % 7)} Hill CU as CFO") for i in range(600)]
    rows = history.read_headlines(spark.createDataFrame(TITLES + more, "id long, page string, title string"), M).cache()
    late = F.col("id").isin(6, 9)
    history.accept(history.open_store(spark, path, 32), rows.filter(~late), M)
    files = lambda v: {os.path.join(d, f) for d, _, fs in os.walk(f"{tmp_path}/h") for f in fs if f.endswith(".parquet") and f"version={v}-" in d}
    before = {f: os.path.getmtime(f) for f in files(1)}
    # another session goes on with what the first one left
    store = history.open_store(spark.newSession(), path)
    assert store.version == 1
    store = history.accept(store, rows.filter(late), M)
    size = lambda v: sum(map(os.path.getsize, files(v)))
    assert {f: os.path.getmtime(f) for f in files(1)} == before and size(2) < size(1) / 10
    got = {tuple(r) for r in history.repeats(rows, history.open_store(spark, path)).collect()}
    assert set(WANT) <= got and all(a >= 100 for a, _ in got - set(WANT))


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20] + [(r.randint(100, 140), r.randint(100, 140)) for _ in range(25)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {x.node: x.label for x in components(df, "a", "b").collect()}
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    assert components(df.filter("false"), "a", "b").count() == 0


def test_segment_join_is_complete(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abcde") for _ in range(r.randint(9, 13))) for _ in range(60)]
    keys = set(base)
    for b in base:
        x = list(b)
        for _ in range(r.randint(1, 2)):
            i = r.randrange(len(x))
            x[i : i + r.randint(0, 1)] = r.choice(["", "z", "zz"[:1]])
        keys.add("".join(x))
    df = spark.createDataFrame([("o", k) for k in keys], "org string, key string")
    got = {(x.key, x.other) for x in names.alike(df, df).collect()}
    want = {(a, b) for a, b in itertools.permutations(keys, 2) if levenshtein(a, b) <= (2 if len(a) >= 8 else 1)}
    assert got == want


def test_persons(spark):
    rows = [
        ("ann bowen", "redoak", "ann@x.org"), ("a bowen", "redoak", None), ("bowen ann", "redoak", None), ("ann bwoen", "redoak", None), ("hon ann k bowen", "redoak", None),
        ("ann bowen", "other", None), ("bea lomax", "redoak", "bea@x.org"), ("b lomax", "redoak", None), ("bob lomax", "redoak", "bob@x.org"), ("chief officer", "redoak", None),
        ("", "redoak", None), (None, None, None), ("ann", "redoak", None), ("zed quorn", None, None), ("yul briner", "redoak", None), ("yul brinner", "redoak", None),
    ]
    df = spark.createDataFrame(rows, "spelling string, org string, email string")
    got = {tuple(x) for x in names.spelling_pairs(names.persons(df)).collect()}
    ann = sorted(["ann bowen", "a bowen", "bowen ann", "ann bwoen", "hon ann k bowen"])
    assert got == set(itertools.combinations(ann, 2)) | {("yul briner", "yul brinner")}
    assert names.spelling_pairs(names.persons(df.filter("false"))).count() == 0


def test_spelling(spark):
    df = spark.createDataFrame([("éva O’Neil​ ",), ("A\tB",), (None,)], "n string")
    assert [r.s for r in df.select(names.spelling(F.col("n")).alias("s")).collect()] == ["éva o neil", "a b", None]


def test_initials_of_persons_without_address(spark):
    rows = [
        ("v fufeski", "gosegate", None, None), ("valerie fufeski", "gosegate", None, None), ("b lomax", "redoak", None, "bea lomax"), ("b lomax", "other", None, None),
        ("bea lomax", "redoak", "bea@x.org", None), ("bob lomax", "redoak", "bob@x.org", None), ("c odu", "redoak", None, None), ("cora odu", "redoak", None, None), ("carl odu", "redoak", None, None),
        ("d odu", "redoak", None, "delia odu"), ("delia odu", "redoak", None, None), ("dirk odu", "redoak", None, None), ("lomax b", "redoak", None, None),
    ]
    df = spark.createDataFrame(rows, "spelling string, org string, email string, told string")
    got = {tuple(x) for x in names.spelling_pairs(names.persons(df)).collect()}
    assert got == {("v fufeski", "valerie fufeski"), ("b lomax", "bea lomax"), ("d odu", "delia odu")}


def test_told_in_full(spark):
    cases = [
        ("v fufeski", "gosegate cu names valerie fufeski teller", "valerie fufeski"), ("v fufeski", "valerie d fufeski named teller", "valerie d fufeski"), ("fufeski v", "valerie fufeski joins", "valerie fufeski"),
        ("ann b", "cu hires ann bowen as cfo", "ann bowen"), ("v fufeski", "olga fufeski joins", None), ("v fufeski", None, None), ("ann bo", "ann bo joins", None),
    ]
    df = spark.createDataFrame(cases, "s string, h string, want string")
    assert [r.t for r in df.select(names.told_in_full(F.col("s"), F.col("h")).alias("t")).collect()] == [w for _, _, w in cases]


def test_links_carry_on(spark):
    chain, slips = ["abel quornam", "abel quozzam", "abel zuozzam"], ["dora kalinski", "dora kalinzzi", "dora kalxnzzi"]
    rows = [(x, "redoak", None) for x in chain + slips[1:]] + [(slips[0], "redoak", "dora@x.org")]
    df = spark.createDataFrame(rows, "spelling string, org string, email string")
    got = {tuple(x) for x in names.spelling_pairs(names.persons(df)).collect()}
    assert got == {*itertools.combinations(chain, 2), *itertools.combinations(slips, 2)}


def test_segments_of_short_keys_travel_as_numbers(spark):
    keys = ["a", "b", "ab", "ba", "abc", "abd", "abcd", "éabc", "𐐀bcd", "abcdefgh", "abcdefxx"]
    df = spark.createDataFrame([(o, k) for o in ("o", "p") for k in keys], "org string, key string")
    got = sorted((x.org, x.key, x.other, x.mark) for x in names.alike(df, df.withColumn("mark", F.upper("org"))).collect())
    want = [(o, a, b, o.upper()) for o in ("o", "p") for a, b in itertools.permutations(keys, 2) if levenshtein(a, b) <= (2 if len(a) >= 8 else 1)]
    assert got == sorted(want)
    # a lambda under the generator would have the whole of it interpreted, row by row
    for cut in (names.query_segments(df, 2), names.index_segments(df, 2)):
        assert "lambda" not in cut._jdf.queryExecution().executedPlan().toString() and cut.columns == ["org", "key", "at"]


def test_open_keys_are_joined_once(spark, monkeypatch):
    calls, alike = [], names.alike
    monkeypatch.setattr(names, "alike", lambda *a, **k: calls.append(a) or alike(*a, **k))
    rows = [("dora kalinski", "redoak", "dora@x.org"), ("dora kalinzzi", "redoak", None), ("yul briner", "redoak", None), ("yul brinner", "redoak", None), ("b2 lomax", "redoak", None), ("b2 lomaxx", "redoak", None)]
    df = spark.createDataFrame(rows, "spelling string, org string, email string")
    got = {tuple(x) for x in names.spelling_pairs(names.persons(df)).collect()}
    assert got == {("dora kalinski", "dora kalinzzi"), ("yul briner", "yul brinner")} and len(calls) == 1
