import random

from hypothesis import given, settings
from hypothesis import strategies as st

from orgextract.llm.editmetric import BKTree, levenshtein, within
from orgextract.llm.reference_match import SYNONYMS, Matcher, map_to_sharded_reference, match_reference

WORD = st.text(alphabet="abcd", max_size=9)
REF = [
    (1, "Chief Executive Officer", "CEO"), (2, "President & CEO", None), (3, "President", None), (15, "Vice President", "VP"),
    (17, "Vice President of Lending", None), (25, "Loan Officer", None), (43, "Treasurer", None),
]


def plain(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j - 1] + (x != y), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(WORD, WORD, st.integers(0, 4))
def test_distances(a, b, k):
    d = plain(a, b)
    assert levenshtein(a, b) == d and within(a, b, k) == (d <= k)


def test_bk_tree_returns_all_within():
    r = random.Random(1)
    words = {"".join(r.choice("abc") for _ in range(r.randint(1, 8))) for _ in range(300)}
    tree = BKTree({w: [w] for w in words})
    for q in ["", "abcabc", "ccc", "aaaaaaaa"]:
        for k in (0, 1, 3):
            assert {t for _, t in tree.query(q, k)} == {w for w in words if plain(q, w) <= k}


CASES = [
    (None, None), ("", None), (" ​", None), ("CEO", 1), ("c.e.o.", 1), ("Chf Exec Ofcr", 1), ("President and Chief Executive Officer", 2), ("presidnet", 3),
    ("V.P./Lending", 17), ("Lending VP", 17), ("Officer, Loans", 25), ("Interim Loan Officer | Main Office", 25), ("Treasurer since 2019", 43),
    ("Photographer", -1), ("?", -1), ("Mohan Wizun", -1), ("x" * 50_000, -1), ("Vice President", 15),
]


def test_both_plans_agree(spark):
    ref = spark.createDataFrame(REF, "role_ref_id int, canonical string, short string")
    df = spark.createDataFrame([(i, v, "x") for i, (v, _) in enumerate(CASES * 2)], "id int, role string, ref_id string")
    want = {(i, w) for i, (_, w) in enumerate(CASES * 2) if w is not None}
    assert {tuple(r) for r in match_reference(df, "id", "role", ref).collect()} == want
    assert {tuple(r) for r in map_to_sharded_reference(df, "id", "role", ref, SYNONYMS, 3).collect()} == want
    assert match_reference(df.filter("false"), "id", "role", ref).count() == 0


def test_ties_take_the_smaller_entry():
    m = Matcher([(9, "Abcd Manager", None), (4, "Abce Manager", None)], {})
    assert m.find("Abcf Manager") == (1, 4)
