"""Spellings of one person: evidence first, then a pigeonhole segment join (problem 7).

Sightings (spelling, organisation, e-mail) are reduced to distinct rows. An address names
one person, so spellings under one address belong together. Spellings never seen with an
address are tied to a person of the same organisation by their canonical key (nicknames
expanded, titles, suffixes and middle initials dropped, parts in sorted order), by initials
that fit one person only, or by a segment join; an initial whose own headline writes the
name in full is read as that name. In the segment join a key is cut into k+1 segments, so a key
within k edits shares at least one of them, found at a shifted place through an inverted
index on (organisation, length, segment); a banded edit distance (JVM) verifies. What is
left forms persons without an address: the connected components of the verified links. Initials that fit no addressed person are tied to
the one of these that they fit.

Everything but the composition of decomposed characters is built-in SQL. No group is
collected: every step is a keyed join or aggregation. An organisation with a third of all rows
is spread over its keys; a segment common to many of them, and a person with many spellings,
are cut into slices.

Defined results
* null, blank and one-word spellings, and texts with a word of a position, a page or an
  address, take no part;
* a spelling that fits two persons of an organisation equally well is tied to neither.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgextract.functions.unicode import nfc
from orgextract.llm.components import components
from orgextract.operators.skew import join_split
from orgextract.session import stored

# Forms of address, name suffixes, words that make a text no name, and short names.
ADDRESS = ["mr", "mrs", "ms", "miss", "dr", "hon", "prof", "rev", "jr", "sr", "ii", "iii", "iv", "cpa", "ccue", "cfa", "cfp", "mba", "phd", "esq", "jd"]
NO_NAME = (
    "chief officer ofcr president vice manager mgr mngr director chair chairman chairwoman chairperson treasurer treas secretary "
    "controller comptroller auditor teller supervisor supv supvr representative board committee cmte executive exec assistant "
    "asst branch loan loans lending mortgage marketing mktg operations oper ops finance financial compliance compl internal "
    "collections business development facilities services svcs svc information technology human resources risk operating "
    "ceo cfo coo cmo cio cto cro clo cco chro evp svp avp vp bdo msr hr it chf pres member members mbr head senior interim acting "
    "example com org http https www mailto email mail contact us team staff department annual meeting first central directors "
    "office info support customer tbd retired vacant unknown none translator notary public photographer security guard webmaster "
    "chaplain groundskeeper graphic designer guest columnist speaker poet residence scholarship winner receptionist emcee youth "
    "ambassador courier archivist summer intern interior decorator volunteer year event planner see bio founder grandson"
).split()
NICKNAMES = {
    "al": "albert", "alex": "alexander", "allie": "alison", "amy": "amelia", "andy": "andrew", "annie": "anne", "art": "arthur",
    "babs": "barbara", "barb": "barbara", "becca": "rebecca", "becky": "rebecca", "ben": "benjamin", "benny": "benjamin",
    "bernie": "bernard", "bert": "albert", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william",
    "bob": "robert", "bobby": "robert", "cam": "camila", "cathy": "catherine", "charlie": "charles", "chuck": "charles",
    "chris": "christopher", "cindy": "lucinda", "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah",
    "debbie": "deborah", "dick": "richard", "don": "donald", "drew": "andrew", "ed": "edward", "eddie": "edward", "liz": "elizabeth",
    "etta": "henrietta", "hettie": "henrietta", "frank": "francisco", "paco": "francisco", "pancho": "francisco", "fred": "frederick",
    "gabby": "gabriella", "gaby": "gabriella", "gabe": "gabriel", "greg": "gregory", "gus": "augustus", "hal": "harold",
    "hank": "henry", "harry": "harold", "jack": "john", "jake": "jacob", "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald",
    "gerry": "gerald", "jim": "james", "jimmy": "james", "joe": "joseph", "joey": "joseph", "jon": "jonathan", "johnny": "john",
    "josh": "joshua", "kate": "katherine", "kathy": "katherine", "kat": "katherine", "katie": "katherine", "ken": "kenneth",
    "larry": "lawrence", "len": "leonard", "lenny": "leonard", "leo": "leonard", "letty": "leticia", "lou": "louis", "lupe": "guadalupe",
    "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "marge": "margaret", "margie": "margaret", "matt": "matthew",
    "max": "maxwell", "mike": "michael", "mick": "michael", "mickey": "michael", "mitch": "mitchell", "nate": "nathaniel",
    "nat": "nathaniel", "nick": "nicholas", "pam": "pamela", "pat": "patricia", "patty": "patricia", "trish": "patricia",
    "tricia": "patricia", "pete": "peter", "phil": "philip", "ray": "raymond", "rich": "richard", "rick": "richard", "ric": "richard",
    "ricky": "richard", "rob": "robert", "ron": "ronald", "roz": "rosalind", "sam": "samantha", "sammy": "samantha", "sandy": "sandra",
    "steph": "stephanie", "steve": "steven", "sue": "susan", "susie": "susan", "ted": "theodore", "teddy": "theodore",
    "theo": "theodore", "terry": "terrence", "tim": "timothy", "timmy": "timothy", "tina": "bettina", "toby": "tobias",
    "tom": "thomas", "tommy": "thomas", "tony": "anthony", "val": "valerie", "vern": "vernon", "vic": "victoria", "vicky": "victoria",
    "viki": "victoria", "walt": "walter", "wes": "wesley", "will": "william", "wil": "wilhelmina", "willa": "wilhelmina",
    "mina": "wilhelmina", "zach": "zachary", "zack": "zachary", "zak": "zachary",
}
#: Latin letters with a mark, each over its base letter: by rule, from the decompositions.
_MARKED = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for c in range(0xE0, 0x250) if len(unicodedata.normalize("NFD", chr(c))) > 1}


def _folded(c: Column) -> Column:
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, "".join(_MARKED), "".join(_MARKED.values()))).otherwise(c)


def spelling(c: Column) -> Column:
    """NFC, lower case, zero-width dropped, other runs one space; plain texts take the short way."""
    plain_text = c.rlike("^[A-Za-z]++(?: [A-Za-z]++)*+$")
    t = F.regexp_replace(F.lower(nfc(F.when(~plain_text, c))), "[\\u200B\\uFEFF]", "")
    return F.when(plain_text, F.lower(c)).otherwise(F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " ")))


#: What tells a credit union from the other organisations a feed lists.
UNION_WORDS = r"(?i)\b(?:credit union|fcu|cu|credit co-?op)\b"
#: The two words before what kind of credit union it is, as headlines write it.
ORGANISATION_PHRASE = (
    r"(?i)(?:^|\s)((?!board of)[\p{L}'-]+ [\p{L}'-]+) (?:(?:federal|community|employees|members|teachers & nurses|teachers &amp; nurses) )?"
    r"(?:credit union|fcu|cu\b|city (?:&|&amp;) county|savings and credit)"
)


def plain(c: Column) -> Column:
    """Lower case with Latin letters freed of marks and the ampersand's entity resolved."""
    return F.regexp_replace(_folded(F.lower(c)), "&amp;|&nbsp;", " ")


def organisation(name: Column) -> Column:
    """The first two words of an organisation's name, letters and digits only; null if blank."""
    lead = F.regexp_extract(name, r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+(?:[^\p{L}\p{N}]+[\p{L}\p{N}]+)?)", 1)
    return F.nullif(F.regexp_replace(_folded(F.lower(lead)), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def address(email: Column) -> Column:
    """A cleaned e-mail address, or null where the text is none."""
    t = F.regexp_replace(F.regexp_replace(F.lower(email), r"mailto:|[^a-z0-9@._+%-]", ""), r"\.+$", "")
    whole = r"^[a-z0-9_+%-]++(?:\.[a-z0-9_+%-]++)*+@[a-z0-9-]++(?:\.[a-z0-9-]++)*\.[a-z]{2,}$"
    return F.when(email.rlike(whole), email).when(t.rlike(r"^[^@]++@[^@]+\.[a-z]{2,}$"), t)


def domain_organisation(host: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_replace(host, r"(?:-cu)?\.[a-z.]+$", ""), "[^a-z0-9]", ""), F.lit(""))


def with_keys(df: DataFrame) -> DataFrame:
    """Adds key (sorted full parts), short (part cut to letters) and rest for initials; drops what is no name.

    Where `told` has the name in full, it is read instead of the spelling.
    """
    nick = F.create_map(*[F.lit(x) for kv in NICKNAMES.items() for x in kv])
    parts = F.filter(F.split(_folded(F.coalesce("told", "spelling")), " "), lambda t: ~t.isin(ADDRESS))
    # `Katherine "Kathy" Genir`: a nickname beside its own full form is one part
    long_parts = F.transform(F.filter("_t", lambda t: F.length(t) > 1), lambda t: F.when(t.isin(list(NICKNAMES)), F.try_element_at(nick, t)).otherwise(t))
    x = df.withColumn("_t", parts).withColumn("_names", F.array_distinct(long_parts))
    named = (F.size("_t") >= 2) & (F.size("_names") >= 1) & ~F.exists("_t", lambda t: t.isin(NO_NAME)) & ~F.coalesce("told", "spelling").rlike(r"\p{N}")
    lead, tail, n = F.get("_t", F.lit(0)), F.element_at("_t", -1), F.size("_names")
    head, family = F.get("_names", F.lit(0)), F.array_join(F.slice("_names", F.lit(2), F.size("_names")), "")
    short = (
        F.when(F.length(lead) == 1, F.concat(lead, F.lit(">"), F.array_join("_names", "")))
        .when(F.length(tail) == 1, F.concat(tail, F.lit("<"), F.array_join("_names", "")))
        .when((n > 1) & (F.length(head) <= 3), F.concat(head, F.lit(">"), family))
    )
    cuts = [F.concat(F.substring(head, 1, i), F.lit(">"), family) for i in (1, 2, 3)] + [F.concat(F.substring(lead, 1, 1), F.lit(">"), family)]
    given = F.array_join(F.slice("_names", F.lit(1), n - 1), "")
    shorts = F.when(n >= 2, F.array(*cuts, F.concat(F.substring(F.element_at("_names", -1), 1, 1), F.lit("<"), given)))
    keys = F.struct(F.array_join(F.array_sort("_names"), "").alias("key"), (n >= 2).alias("whole"), short.alias("short"), shorts.alias("shorts"))
    # a generator, not a filter: a filter would be pushed below the steps and make them run twice
    return x.select(*df.columns, F.explode(F.when(named, F.array(keys))).alias("_k")).select(*df.columns, "_k.*")


def told_in_full(spelling: Column, headline: Column) -> Column:
    """The name a headline (as a spelling) writes out, for a spelling with one initial and a rest; else null."""
    lead, tail = spelling.rlike(r"^\p{L} \p{L}{2}"), spelling.rlike(r"\p{L}{2} \p{L}$")
    initial = F.when(lead, F.substring(spelling, 1, 1)).when(tail, F.substring(spelling, -1, 1))
    rest = F.regexp_replace(F.regexp_replace(spelling, r"^\p{L} | \p{L}$", ""), r"(?<= )\p{L} ", "")
    middle = F.lit(r" (?:\p{L} )?")
    given_first = F.call_function("regexp_extract", headline, F.concat(F.lit(r"(?:^| )("), initial, F.lit(r"\p{L}+"), middle, rest, F.lit(r")(?: |$)")), F.lit(1))
    rest_first = F.call_function("regexp_extract", headline, F.concat(F.lit(r"(?:^| )("), rest, middle, initial, F.lit(r"\p{L}+)(?: |$)")), F.lit(1))
    rest_first = F.when(tail, rest_first)
    return F.when(lead | tail, F.coalesce(F.nullif(given_first, F.lit("")), F.nullif(rest_first, F.lit(""))))


EDITS = 2
#: Keys shorter than this may differ in one letter only.
LONG = 8


def _with_cuts(keys: DataFrame, k: int, longer: range) -> DataFrame:
    """Adds _o (the organisation as a number) and the cuts as plain columns, so that no generator works them out again."""
    n = F.length("key")
    cuts = {f"_c{d - longer[0]}_{i}": F.floor((n + d) * i / (k + 1)).cast("int") for d in longer for i in range(k + 2)}
    return keys.withColumns({"_o": F.xxhash64("org"), **cuts})


def _at(n: Column, i: int, start: Column, size: Column) -> Column:
    """Organisation, length, place and segment as one number."""
    return F.xxhash64("_o", n, F.lit(i), F.substring("key", start + 1, size))


def index_segments(keys: DataFrame, k: int) -> DataFrame:
    """One row per segment of each key, at its number: the inverted index."""
    cut = [F.col(f"_c0_{i}") for i in range(k + 2)]
    rows = F.array(*[_at(cut[k + 1], i, cut[i], cut[i + 1] - cut[i]) for i in range(k + 1)])
    return _with_cuts(keys, k, range(1)).select(*keys.columns, F.explode(rows).alias("at"))


def query_segments(keys: DataFrame, k: int) -> DataFrame:
    """The numbers of the substrings of each key that can equal a segment of a key within k edits: for a length
    difference d and segment i, shifts reachable from both the left and the right part.

    Places outside the key are nulls that leave after the generator: a lambda in it would have all of it interpreted.
    """
    rows, n = [], F.col(f"_c{k}_{k + 1}")
    for d in range(-k, k + 1):
        cut = [F.col(f"_c{d + k}_{i}") for i in range(k + 2)]
        for i in range(k + 1):
            lo, hi = max(-i, -d - (k - i)), min(i, -d + (k - i))
            for shift in range(lo, hi + 1):
                inside = (cut[i] + shift >= 0) & (cut[i + 1] + shift <= n)
                rows.append(F.when(inside, _at(cut[k + 1], i, cut[i] + shift, cut[i + 1] - cut[i])))
    x = _with_cuts(keys, k, range(-k, k + 1)).select(*keys.columns, F.explode(F.array(*rows)).alias("at"))
    return x.filter("at IS NOT NULL")


def alike(asked: DataFrame, known: DataFrame, k: int = EDITS) -> DataFrame:
    """org, key, other, dist and what else `known` has: its keys (org, key) within k edits of each key asked, in the same organisation."""
    # what merely shares the number of a segment has another organisation or too many edits; it leaves where it is met
    more = [c for c in known.columns if c not in ("org", "key")]
    q = query_segments(asked.select("org", "key"), k)
    i = index_segments(known.select("org", "key", *more), k).withColumnsRenamed({"org": "_org", "key": "other"})
    pairs = join_split(q, i, ["at"]).filter("org = _org AND key <> other")
    pairs = pairs.withColumn("dist", F.levenshtein("key", "other", k)).filter((F.col("dist") >= 0) & ((F.col("dist") <= 1) | (F.length("key") >= LONG)))
    return pairs.select("org", "key", "other", "dist", *more).distinct()


def persons(sightings: DataFrame) -> DataFrame:
    """spelling, person: distinct. sightings: (spelling, org, email) and, if at hand, told; nullable but for spelling."""
    if "told" not in sightings.columns:
        sightings = sightings.withColumn("told", F.lit(None).cast("string"))
    base = with_keys(sightings.filter("spelling <> ''").distinct())
    base = stored(base, "names")
    addressed = base.filter("email IS NOT NULL")
    loose = base.filter("email IS NULL AND org IS NOT NULL").drop("email")
    first = addressed.select("spelling", F.col("email").alias("person"))

    seen = addressed.filter("org IS NOT NULL").select("org", "spelling").distinct()
    left = loose.filter("told IS NULL").join(seen, ["org", "spelling"], "left_anti").unionByName(loose.filter("told IS NOT NULL").distinct()).drop("told")

    # one address per (org, key), or none
    sole = lambda d, by: d.groupBy("org", by).agg(F.min("email").alias("email"), F.max("email").alias("_m")).filter("email = _m").drop("_m")
    whole = addressed.filter("whole AND org IS NOT NULL")
    by_key = stored(whole.groupBy("org", "key").agg(F.min("email").alias("email"), F.max("email").alias("_m")), "keys")
    in_short = stored(whole.select("org", "email", F.explode(F.array_distinct("shorts")).alias("short")).distinct(), "shorts")
    shorts = sole(in_short, "short")

    asked = stored(left.join(by_key.select("org", "key", "email", "_m"), ["org", "key"], "left"), "loose")
    exact = asked.filter("email = _m").select("spelling", F.col("email").alias("person"))
    open_ = asked.filter("email IS NULL")
    brief = open_.filter("short IS NOT NULL").join(shorts.select("org", "short", F.col("email").alias("_e")), ["org", "short"])
    brief = stored(brief.select("org", "spelling", "key", F.col("_e").alias("person")), "brief")
    rest = open_.filter("whole").join(brief.select("org", "spelling", "key"), ["org", "spelling", "key"], "left_anti").select("org", "spelling", "key", "short", "shorts")
    rest_keys = stored(rest.select("org", "key").distinct(), "rest")
    # one join finds the addressed and the open keys alike: an open key's segments travel once
    known_keys = by_key.filter("email = _m").select("org", "key", "email").unionByName(rest_keys.withColumn("email", F.lit(None).cast("string")))
    found = stored(alike(rest_keys, known_keys), "alike")
    best = found.filter("email IS NOT NULL").groupBy("org", "key").agg(F.min(F.struct("dist", "email")).alias("_b")).select("org", "key", F.col("_b.email").alias("person"))
    tied = stored(rest.join(best, ["org", "key"], "left"), "tied")
    fuzzy = tied.filter("person IS NOT NULL").select("spelling", "person")

    # persons without an address: keys joined by verified links, carried on; a link to one addressed person ties them all
    alone = tied.filter("person IS NULL").select("org", "spelling", "key", "short", "shorts")
    counts = alone.select("org", "key").distinct()
    tied_keys = best.select("org", F.col("key").alias("other"), F.col("person").alias("tied"))
    node = lambda c: F.concat("org", F.lit("/"), c)
    among = found.filter("email IS NULL").select("org", "key", "other").join(counts, ["org", "key"], "left_semi").join(tied_keys, ["org", "other"], "left")
    among = stored(among.select(node("key").alias("node"), node("other").alias("other"), "tied"), "links")
    groups = components(among.filter("tied IS NULL"), "node", "other")
    groups = counts.select("org", "key", node("key").alias("node")).join(groups, "node", "left").withColumn("head", F.coalesce("label", "node"))
    groups = stored(groups.drop("label"), "groups")
    reached = among.filter("tied IS NOT NULL").join(groups, "node").groupBy("head").agg(F.min("tied").alias("email"), F.max("tied").alias("_m"))
    centre = groups.join(reached.filter("email = _m").drop("_m"), "head", "left").select("org", "key", F.coalesce("email", "head").alias("person"))
    nameless = alone.join(centre, ["org", "key"]).select("org", "spelling", "short", "shorts", "person")
    nameless = stored(nameless, "nameless")
    # open initials and cut names: a person without an address, if one only and no addressed one fits
    fits = nameless.select("org", "person", F.explode(F.array_distinct("shorts")).alias("short")).distinct()
    initials = open_.filter("NOT whole AND short IS NOT NULL").select("org", "spelling", "short", F.lit("").alias("own"))
    cut = nameless.filter("short IS NOT NULL").select("org", "spelling", "short", F.col("person").alias("own"))
    unfit = initials.unionByName(cut).join(in_short.select("org", "short").distinct(), ["org", "short"], "left_anti")
    guessed = unfit.join(fits, ["org", "short"]).filter("person <> own").groupBy("org", "spelling", "short").agg(F.min("person").alias("person"), F.max("person").alias("_m"))
    guessed = guessed.filter("person = _m").select("spelling", "person")
    known = first.unionByName(exact).unionByName(brief.select("spelling", "person")).unionByName(fuzzy)
    return known.unionByName(nameless.select("spelling", "person")).unionByName(guessed).distinct()


def spelling_pairs(members: DataFrame) -> DataFrame:
    """name_a, name_b: every pair of different spellings of one person, from members (spelling, person; distinct).

    The pairs are the form asked for; `persons` gives the membership alone. A person with many spellings
    is cut into slices, so no task forms all of their pairs.
    """
    members = stored(members, "members")
    a = members.select("person", F.col("spelling").alias("name_a"))
    b = members.select("person", F.col("spelling").alias("name_b"))
    return join_split(a, b, ["person"]).filter("name_a < name_b").select("name_a", "name_b").distinct()
