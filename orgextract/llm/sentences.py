"""Sentence units with code point positions, over mixed languages, scripts and markup (problem 10).

Everything is a built-in SQL expression over one row: markup, decimals, URLs, initials and
abbreviations are masked by private-use characters of the same length, boundaries are marked
by terminator rules per script, the text is cut at the marks, and running lengths give each
piece's place. As masks keep lengths, restoring a unit is a substring of the original text.
No shuffle; a document is handled whole whatever its length.

Defined results
* null and empty texts, and texts without a letter or digit, give no row;
* private-use characters already in a text count as neither letter nor digit;
* paragraphs, list entries, attribution, greeting and signature lines end a unit even
  without a terminator; wrapped lines don't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Masks: dropped markup, quotation entity, space entity, silenced terminator; marks: cut after, hard tag, cut here.
SOFT, QUOT, NBSP, DOT = "\ue010", "\ue011", "\ue012", "\ue013"
_KEPT = "\ue014"
CUT, HARD, HERE = "\ue020", "\ue021", "\ue022"
_ALIEN = "\ue0ff"
_W = rf"[\s>{SOFT}{NBSP}]"
_CLOSE = rf"[\"”»’“)\]{QUOT}{SOFT}]"

_HARD_TAG = (
    r"(?i)</?(?:p|blockquote|div|ul|ol|li|h[1-6]|hr|table|tr|td|th|pre|section|article)\b[^<>]*>"
    r"|\[/?(?:quote|list|code|\*)\b[^\[\]]*\]|\[\*\]|(?:<br\s*/?>\s*){2,}|(?<=\n)[ \t]*<br\s*/?>[ \t]*(?=\n)"
)
_SOFT_TAG = (
    r"(?i)</?[a-z][a-z0-9]*(?:\s[^<>]*)?/?>|<!--[^>]*-->|\[/?(?:b|i|u|s|url|img|color|size|font|center|email|spoiler|sup|sub)(?:=[^\[\]]*)?\]"
    r"|&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,30});"
)
_SIGNATURE = (
    rf"(?<![^\n{HARD}])[> \t{SOFT}]*(?:-- ?|_{{3,}}|~{{3,}}|={{3,}}|-{{3,}}|\*{{3,}})[ \t]*\n"
    rf"(?:[^\n{HARD}]*[^\n\s>{HARD}{SOFT}][^\n{HARD}]*(?:\n|$))+"
)

# Abbreviations that never end a sentence, those that end one before a capital, and months.
_ALWAYS = (
    "dr|dra|prof|mr|mrs|ms|mme|mlle|sr|sra|srta|approx|aprox|env|vs|al|pp|pág|págs|bzw|ca|nr|ggf|inkl|evtl|vgl|cf"
    "|ee|uu|стр|рис|руб|коп|см|гг|им|ул|тыс|млн|रु|डॉ|श्री"
)
_CASED = "St|Ste|Ave|Blvd|Rd|Jan|Feb|Mar|Apr|Aug|Sept|Sep|Oct|Nov|Dec|Mon|Tue|Tues|Wed|Thu|Thur|Thurs|Fri|Sat|Sun|Gen|Col|Lt|Sgt|Capt|Gov|Sen|Rep|Rev|Hon|Mt|Ft|Str|Fig|Vol"
_BEFORE_SMALL = "Inc|Co|Ltd|Corp|Jr|etc|usw"
_BEFORE_DIGIT = "no|nos|art|fig|vol|ch|sec|p|s|n"
_MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
#: Full stops inside these are part of them.
_DOTTED = r"(?i)https?://[^\s<>\[\]]*[^\s<>\[\].,!?;:)]|[\w.+-]++@[\w-]+(?:\.[\w-]+)+"
_GREETING = r"(?i)^[>\s]*(?:hi|hello|hey|dear|hallo|liebe|lieber|bonjour|salut|hola|guten tag)\b[^.!?:;]{0,40},\s*$"
_GOING_ON = "near|at|in|on|to|and|but|or|for|from|until|till|with|by|when|while|sharp|today|tomorrow|yesterday"


def _holds(*parts: str) -> Column:
    found = F.contains("_t", F.lit(parts[0]))
    for part in parts[1:]:
        found = found | F.contains("_t", F.lit(part))
    return found


def _each_span(df: DataFrame, pattern: str, change, *needs: str) -> DataFrame:
    """_t with `change` applied to every match of the pattern. Spans and gaps are columns of their own,
    so a text is matched once however deep the chain of steps is. Every match holds one of `needs`; a text
    without them isn't taken apart."""
    held = _holds(*needs)
    df = df.withColumn("_spans", F.when(held, F.regexp_extract_all("_t", F.lit(pattern), 0)))
    df = df.withColumn("_gaps", F.when(F.size("_spans") > 0, F.split("_t", pattern, -1)))
    joined = F.zip_with("_gaps", "_spans", lambda g, s: F.concat(g, F.coalesce(change(s), F.lit(""))))
    return df.withColumn("_t", F.when(F.col("_gaps").isNull(), F.col("_t")).otherwise(F.array_join(joined, ""))).drop("_spans", "_gaps")


def _lines(df: DataFrame) -> DataFrame:
    """Turns newlines that end a unit into cuts: blank lines, quote depth, list entries, greetings, signature marks."""
    depth = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, rf"^[>\s{SOFT}]*", 0), "[^>]", ""))
    odd = lambda x: x.rlike(rf"^[>\s{SOFT}{NBSP}]*+(?:$|[-*•–+_~\d])")  # noqa: E731  what the next tests need
    blank = lambda x: x.rlike(rf"^[>\s{SOFT}{NBSP}]*$")
    entry = lambda x: x.rlike(rf"^[>\s{SOFT}]*(?:[-*•–+]|\d{{1,3}}[.)](?!\s+(?:{_MONTHS})))\s+\S")
    reference = lambda x: x.rlike(r"(?iu)(?:^|[\s(])(?:p|pp|no|nr|art|pág|s|n|стр|рис)\.\s*$")
    mark = lambda x: x.rlike(rf"^[>\s{SOFT}]*(?:--|_{{3,}}|~{{3,}})\s*$")
    # what a line is gets tested once per line, then neighbours are compared
    seen = F.struct
    df = df.withColumn("_l", F.split("_t", "\n", -1)).withColumn(
        "_k",
        F.transform(
            "_l",
            lambda x: seen(
                x.alias("x"), F.when(F.contains(x, F.lit(">")), depth(x)).otherwise(0).alias("depth"),
                F.when(odd(x), F.when(blank(x), "blank").when(mark(x), "mark").when(entry(x), "entry")).alias("kind"),
                F.when(F.rtrim(x).endswith("."), reference(x)).alias("reference"), F.when(F.rtrim(x).endswith(","), x.rlike(_GREETING)).alias("greeting"),
            ),
        ),
    )
    following = F.slice("_k", F.lit(2), F.size("_k"))

    def joined(a: Column, b: Column) -> Column:
        apart = lambda line: F.coalesce(line["kind"].isin("blank", "mark"), F.lit(False))
        yes = lambda c: F.coalesce(c, F.lit(False))
        ends = apart(a) | apart(b) | (a["depth"] != b["depth"]) | (yes(b["kind"] == "entry") & ~yes(a["reference"])) | yes(a["greeting"])
        return F.when(b.isNull(), a["x"]).when(ends, F.concat(a["x"], F.lit(CUT))).otherwise(F.concat(a["x"], F.lit("\n")))

    return df.withColumn("_t", F.array_join(F.zip_with("_k", following, joined), "")).drop("_l", "_k")


def masked(df: DataFrame) -> DataFrame:
    """_t with markup and silent terminators masked, lengths kept."""
    rep = F.regexp_replace
    own = SOFT + QUOT + NBSP + DOT + _KEPT + CUT + HARD + HERE
    df = _where(df, _holds(*own), F.translate("_t", own, _ALIEN * 8))
    entities = rep(rep(rep("_t", r"(?i)&quot;", QUOT * 6), r"(?i)&nbsp;", NBSP * 6), r"(?i)&gt;", ">" + SOFT * 3)
    df = _where(df, _holds("&"), entities)
    df = _where(df, _holds("\r\n"), F.replace("_t", F.lit("\r\n"), F.lit(" \n")))
    for pattern, char, needs in ((_HARD_TAG, HARD, "<["), (_SOFT_TAG, SOFT, "<[&")):
        df = _each_span(df, pattern, lambda s, char=char: F.repeat(F.lit(char), F.length(s)), *needs)
    df = _each_span(df, _SIGNATURE, lambda s: F.translate(s, "\n", CUT), "--", "___", "~~~", "===", "***")
    df = _lines(df)
    df = _each_span(df, _DOTTED, lambda s: F.translate(s, ".!?", DOT * 3), "://", "@")
    # decimals, numbers of list entries and of days before a month
    numbers = rf"(?=\d)|(?=\s)(?<=(?:^|[\n{CUT}{HARD}])[>\s{SOFT}]{{0,8}}\d{{1,3}}\.)|(?={_W}+(?i:{_MONTHS})\b)"
    df = df.withColumn("_t", rep("_t", rf"\.(?<=\d\.)(?:{numbers})", DOT))
    t = F.col("_t")
    t = rep(t, rf"(?iu)([ap])\.m\.(?<![\p{{L}}\p{{M}}\p{{N}}][ap]\.m\.)(?={_W}*[,:;)]|[^\n{CUT}{HARD}]{{0,80}}[:：][ \t]*(?:[\n{CUT}{HARD}]|$)|{_W}+(?-i:{_GOING_ON}|{_GOING_ON.upper()})\b)", f"$1{DOT}m{DOT}")
    t = rep(t, r"(?iu)([ap])\.(m)\.(?<![\p{L}\p{M}\p{N}][ap]\.m\.)", f"$1{DOT}$2{_KEPT}")
    df = _where(df, _holds(".m.", ".M."), t)
    # initials, one after another
    t = rep("_t", rf"\.(?<=\p{{L}}\.)(?<![\p{{L}}\p{{M}}\p{{N}}]\p{{L}}\.)(?=\s|\p{{L}}\.|{_W}|[,;:])", DOT)
    df = df.withColumn("_t", rep(t, rf"\.(?<=[{DOT}]\p{{L}}\.)(?=\s|\p{{L}}|[,;:])", DOT))
    df = _where(df, _holds(_KEPT), F.replace("_t", F.lit(_KEPT), F.lit(".")))
    # abbreviations
    word = r"(?<![\p{L}\p{M}\p{N}])"
    short = (
        rf"(?=\s|{_W}|[,;:])(?:(?<=(?iu:{word}(?:{_ALWAYS})\.))|(?<={word}(?:{_CASED}|{_CASED.upper()})\.))|(?={_W}*\d)(?<=(?i:{word}(?:{_BEFORE_DIGIT})\.))"
        rf"|(?={_W}+[^\s\p{{Lu}}]|[,;:])(?<={word}(?:{_BEFORE_SMALL}|{_BEFORE_SMALL.upper()}|{_BEFORE_SMALL.lower()})\.)"
    )
    # speech inside a sentence doesn't end it
    asked = rf"[!?؟](?=[!?]*\s?{_CLOSE}+,?{_W}+[—–-]?{_W}*\p{{Ll}}|{_CLOSE}*{_W}+[—–]{_W}*\p{{Ll}})"
    said = rf"\.(?={_CLOSE}+{_W}+[—–]{_W}*\p{{Ll}})"
    df = df.withColumn("_t", rep(rep("_t", rf"\.(?:{short})", DOT), f"{asked}|{said}", DOT))
    df = _where(df, _holds("..."), rep("_t", rf"\.\.\.(?={_W}+\p{{Ll}})", DOT * 3))
    return _where(df, _holds(*"。！？"), rep("_t", r"[。！？](?=[”」』\"](?:と|って|[他她它我你您]们?(?:说|說|问|問|道|答|喊|叫)))", DOT))


_THAI = "[ก-๏]"


def _where(df: DataFrame, held: Column, changed: Column) -> DataFrame:
    """_t changed only where a cheap test says that it can match."""
    return df.withColumn("_t", F.when(held, changed).otherwise(F.col("_t")))


def bounded(df: DataFrame) -> DataFrame:
    """Marks the boundaries of masked texts _t: a cut replaces white space, HERE is inserted where there is none."""
    rep = F.regexp_replace
    blank = rf"[\s>{NBSP}]"
    ended = rf"[.!?؟।॥…](?:\s?[”»])?{_CLOSE}*(?={blank}(?!{_W}*[”»]))|[:;](?<![\p{{L}}\p{{N}}][:;])-?[()DP](?=\s)"
    glued = r"[.!?]{1,3}(?=[\p{Lu}(@“„«¿¡])(?<=[\p{Ll}\p{N})\]”»][.!?]{1,3})|[!?…](?=\p{L})"
    df = df.withColumn("_t", rep(rep("_t", f"({ended}){blank}", f"$1{CUT}"), f"({glued})", f"$1{HERE}"))
    east = rep(rep("_t", r"([。！？｡][”’」』）\"]{0,2})(?![。！？｡”’」』）\"…])", f"$1{HERE}"), r"(…)(?=[“「『])", f"$1{HERE}")
    df = _where(df, _holds(*"。！？｡…"), east)
    # scripts that part sentences by a space alone
    return _where(df, (F.octet_length("_t") > F.length("_t")) & F.col("_t").rlike(_THAI), rep("_t", rf"([ก-๏])\s(?={_W}*[ก-ฮเ-ไ])", f"$1{CUT}"))


def sentence_units(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, first_char, last_char for every unit, positions in code points of the original text."""
    x = masked(df.filter(F.col(text).rlike(r"[\p{L}\p{N}]")).select(doc_id, F.col(text).alias("_t")))
    x = bounded(x).select(doc_id, F.split("_t", rf"(?<=[{CUT}{HARD}])(?![{CUT}{HARD}])|{HERE}", -1).alias("_p"))
    starts = F.aggregate(
        F.transform("_p", F.length), F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
    )
    x = x.withColumn("_s", starts).select(doc_id, F.explode(F.zip_with("_p", "_s", lambda p, s: F.struct(p.alias("p"), s.alias("s")))).alias("_u"))
    x = x.filter("_u.p IS NOT NULL")
    lead = F.length(F.regexp_extract("_u.p", r"^[^\p{L}\p{N}]*", 0))
    trail = F.length(F.regexp_extract("_u.p", r"[^\p{L}\p{N}]*$", 0))
    return x.filter(F.col("_u.p").rlike(r"[\p{L}\p{N}]")).select(
        doc_id,
        (F.col("_u.s") + lead).cast("int").alias("first_char"),
        (F.col("_u.s") + F.length("_u.p") - trail - 1).cast("int").alias("last_char"),
    )
