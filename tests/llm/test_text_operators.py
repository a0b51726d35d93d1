import random

import numpy as np
from pyspark.sql import functions as F

from orgextract.llm import leaks, packing, sentences

DOCS = [
    ("Dr. Bo told me to wait 15 weeks. It cost $3.50 at 5 a.m. Then he left!", ["Dr. Bo told me to wait 15 weeks", "It cost $3.50 at 5 a.m", "Then he left"]),
    ('"Is it still open?" she asked. Well... maybe.', ['Is it still open?" she asked', "Well... maybe"]),
    ("Hi all,\nWe met at 3 p.m. near\nthe mill. J. Bo et al. agree", ["Hi all", "We met at 3 p.m. near\nthe mill", "J. Bo et al. agree"]),
    ("moss_1 said:\n> One.\n> Two\nReply", ["moss_1 said", "One", "Two", "Reply"]),
    ("- first entry\n- second\n\n-- \nA B Club\nSent by C", ["first entry", "second", "A B Club", "Sent by C"]),
    ("1. Has it.\n2. No <b>way</b>", ["1. Has it", "2. No <b>way"]),
    ("[quote=x_1]One &amp; two.[/quote]Three<p>Four<br><br>\nFive", ["One &amp; two", "Three", "Four", "Five"]),
    ("Am\n3. März war es zu. „Offen?“, fragte sie.", ["Am\n3. März war es zu", "Offen?“, fragte sie"]),
    ("M. Bo est là ! « Ouvert ? » a-t-elle dit.", ["M. Bo est là", "Ouvert ? » a-t-elle dit"]),
    ("—¿Sigue? —preguntó Bo. ¡Gracias!", ["Sigue? —preguntó Bo", "Gracias"]),
    ("她问：“还开门吗？”“明天再来吧。”他说。太好了！", ["她问：“还开门吗", "明天再来吧。”他说", "太好了"]),
    ("「まだ？」と聞いた。だめ…。はい", ["まだ？」と聞いた", "だめ", "はい"]),
    ("เขารอ 9 วัน ราคา 5 บาท ขอบคุณ มาก", ["เขารอ 9 วัน", "ราคา 5 บาท", "ขอบคุณ", "มาก"]),
    ("См. стр. 9 и т. е. всё. «Да?» — спросила она.", ["См. стр. 9 и т. е. всё", "Да?» — спросила она"]),
    ("यह है। कीमत रु. 5 थी।", ["यह ह", "कीमत रु. 5 थ"]),
    ("Left.Dr. Bo won. 😀 See https://a.org/b?c=1.html now!", ["Left", "Dr. Bo won", "See https://a.org/b?c=1.html now"]),
    ("[deleted]", ["deleted"]),
    ("", []), (None, []), ("?! ...", []), ("x", ["x"]),
]


def test_sentences(spark):
    df = spark.createDataFrame([(i, t, 0) for i, (t, _) in enumerate(DOCS)], "doc_id long, text string, first_char int")
    got = {}
    for r in sentences.sentence_units(df, "doc_id", "text").collect():
        got.setdefault(r.doc_id, []).append((r.first_char, r.last_char))
    for i, (text, want) in enumerate(DOCS):
        units = [text[a : b + 1] for a, b in sorted(got.get(i, []))]
        assert units == want, text


def test_sentences_long_and_native(spark):
    df = spark.range(1).select(F.col("id"), F.repeat(F.lit("It is so. "), 3000).alias("t"))
    x = sentences.sentence_units(df, "id", "t")
    assert x.count() == 3000 and x.agg(F.max("last_char")).first()[0] == 29997
    assert "Python" not in x._jdf.queryExecution().executedPlan().toString()
    assert sentences.sentence_units(df.filter("false"), "id", "t").count() == 0


def brute(doc, item, span=12, slips=1):
    return any(
        sum(a != b for a, b in zip(doc[i : i + span], item[j : j + span])) <= slips
        for i in range(len(doc) - span + 1)
        for j in range(len(item) - span + 1)
    )


def test_leaks_against_brute_force(spark):
    r = random.Random(2)
    vocab = [f"w{i}" for i in range(40)]
    items = [[r.choice(vocab) for _ in range(r.randint(8, 30))] for _ in range(12)]
    docs = []
    for _ in range(80):
        d = [r.choice(vocab) for _ in range(r.randint(0, 40))]
        it = r.choice(items)
        a = r.randrange(len(it))
        part = it[a : a + r.randint(9, 16)]
        for _ in range(r.randint(0, 2)):
            part[r.randrange(len(part))] = "zz"
        docs.append(d + part + d[::-1][: r.randint(0, 3)])
    D = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)] + [(900, None), (901, ""), (902, "a b")], "doc_id long, text string")
    D = D.withColumn("item", F.lit("clash"))
    I = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(99, None)], "item_id long, text string")  # noqa: E741
    got = {(x.doc_id, x.item_id) for x in leaks.find_leaks(D, "doc_id", I, "item_id").collect()}
    assert got == {(i, j) for i, d in enumerate(docs) for j, t in enumerate(items) if brute(d, t)} and got
    # every seed frequent: each is lengthened, and still no window is lost
    got = {(x.doc_id, x.item_id) for x in leaks.find_leaks(D, "doc_id", I, "item_id", frequent=0).collect()}
    assert got == {(i, j) for i, d in enumerate(docs) for j, t in enumerate(items) if brute(d, t)}
    assert leaks.find_leaks(D.filter("false"), "doc_id", I, "item_id").count() == 0


def test_a_frequent_seed_alone_ties_nothing(spark):
    item = "a b c d e f g h i j k l m n".split()
    stock = [["x", *item[4:10], "y", "z"] for _ in range(30)]
    real = [item[:9] + ["q"] + item[10:], item[1:13]]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(stock + real)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert sorted(x.doc_id for x in leaks.find_leaks(docs, "doc_id", items, "item_id", frequent=20).collect()) == [30, 31]
    w = lambda t: F.split(F.lit(" ".join(t)), " ")
    at = lambda doc, pos, ipos: spark.range(1).select(leaks._lengthened(w(doc), w(item), F.lit(pos), F.lit(ipos), 6).alias("x")).first().x
    assert not at(stock[0], 2, 5) and at(real[0], 1, 1) and at(item[1:13], 1, 2) and at(item[:6] + ["q"] + item[7:12], 1, 1) and not at(item[:6] + ["q"] + item[7:11], 1, 1)


def test_alignment_accepts_edited_copies(spark):
    item = [f"w{i}" for i in range(40)]
    dropped = [w for i, w in enumerate(item) if i % 10 != 9]
    inserted = [x for i, w in enumerate(item) for x in ([w, "zz"] if i % 10 == 9 else [w])]
    split = ["y"] * 9 + item[:6] + ["w", "6"] + item[7:13] + ["y"] * 9
    docs = [item, dropped, inserted, split, item[:6] + ["y"] * 20 + item[20:26], item[3:9]]
    D = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    I = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")  # noqa: E741
    got = {x.doc_id: x for x in leaks.find_copies(D, "doc_id", I, "item_id").collect()}
    assert set(got) == {0, 1, 2, 3} and got[0].score == 80 and got[2].score == 74
    assert all(got[i].longest < 12 for i in (1, 2, 3))
    assert [x.doc_id for x in leaks.find_leaks(D, "doc_id", I, "item_id").collect()] == [0]


def test_leak_words(spark):
    df = spark.createDataFrame([('> The <b>old</b>&nbsp;*mill*,\n> &quot;near&quot; [url=https://x]Bo[/url]&amp;co',)], "t string")
    assert df.select(leaks.words(F.col("t")).alias("w")).first().w == ["the", "old", "mill", "near", "bo", "co"]


def test_alignment_scores_edits():
    a = np.arange(20)
    b = np.concatenate([a[:8], [99], a[8:]])
    assert leaks.alignment(b, a, 0, 4) == 38 and leaks.alignment(a, a, 0, 4) == 40


def test_packing(spark):
    r = random.Random(4)
    sizes = [(i, r.choice([0, 1, 5, 300, 511, 512, 700, 1023, 1024, 1025, 5000])) for i in range(700)]
    df = spark.createDataFrame(sizes, "doc_id long, tokens int")
    out = packing.pack(df, "doc_id", 1024, 100).collect()
    fill, per_doc = {}, {}
    for x in out:
        fill[x.container] = fill.get(x.container, 0) + x.tokens
        per_doc.setdefault(x.doc_id, []).append((x.first_token, x.tokens))
    assert max(fill.values()) <= 1024
    for i, n in sizes:
        parts = sorted(per_doc[i])
        assert sum(t for _, t in parts) == n and (n > 1024 or len(parts) == 1)
        assert all(a + t == b for (a, t), (b, _) in zip(parts, parts[1:]))
    ideal = sum(n for _, n in sizes) / 1024
    assert len(fill) <= ideal * 1.03 + 1
    assert packing.pack(df.filter("false"), "doc_id").count() == 0


def test_local_search_drains_bins():
    bins = [[(600, 0)], [(500, 1), (100, 2)], [(400, 3)]]
    out = packing.local_search([list(b) for b in bins], 1024)
    assert sorted(x for b in out for x in b) == sorted(x for b in bins for x in b) and len(out) == 2


def test_the_search_does_the_work():
    """On mixes without small change the first pass wastes a twelfth; the search ends below best fit, longest first."""
    r = random.Random(1)
    for low, high in ((180, 700), (260, 620)):
        items = [(r.randint(low, high), i) for i in range(1500)]
        least = -(-sum(s for s, _ in items) // 1024)
        start = packing.first_pass(items, 1024)
        search = packing.SwapSearch(start, 1024)
        bins = search.run()
        decreasing = packing.first_pass(sorted(items, reverse=True), 1024)
        assert sorted(x for b in bins for x in b) == sorted(items) and max(sum(s for s, _ in b) for b in bins) <= 1024
        assert len(bins) <= len(decreasing) < len(start) and len(bins) <= 1.02 * least and len(start) > 1.05 * least
        assert search.done["moves"] and search.done["one for one"]
        squares = lambda bs: sum(sum(s for s, _ in b) ** 2 for b in bs)
        assert squares(bins) > squares(start)
    two = packing.SwapSearch([[(700, 0)], [(350, 1), (340, 2), (320, 3)]], 1024)
    assert sorted(sum(s for s, _ in b) for b in two.run()) == [690, 1020] and two.done["two for one"] == 1


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "<|endoftext|>")], "doc_id long, text string")
    got = {r.doc_id: r.tokens for r in packing.token_counts(df, "doc_id", "text").collect()}
    assert got[1] == 2 and got[2] == 0 and 3 not in got and got[4] > 1
