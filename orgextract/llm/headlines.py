"""What an announcement's headline says: its own words with a bit-difference fingerprint, and, to compare two of
them in full, person, position and organisation."""

from __future__ import annotations

import html
import re
import unicodedata

from orgextract.llm.reference_match import Matcher, plain

# How feeds decorate a headline, and the wordings of an appointment.
_LEAD = re.compile(
    r"^(?:\[[^\]]*\]\s*|\((?:update|video|corrected)\)\s*"
    r"|(?:updated?|reminder|correct(?:ion|ed)|breaking|exclusive|video|photos?|watch|news|just in|repost|alert)\s*[:–—|-]+\s*)+",
    re.I,
)
_TAIL = re.compile(r"\s*(?:(?:::|\||\s[–—-])\s*[A-Z][\w&]*(?:\s[\w&]+){0,3}|,? effective (?:next|this|immediately)[\w ]*|\((?:update|video|corrected)\))\s*$")
_CUT = re.compile(r"(?:…|\.\.\.|\[(?:\.\.\.|…)\])\s*$")
_WORDINGS = [
    re.compile(w, re.I)
    for w in (
        r"^(?:the )?board of (?P<o>.+?) (?:selects|picks|chooses) (?P<p>.+?) (?:for|as) (?P<r>.+)$",
        r"^(?P<o>.+?) (?:names|announces|welcomes|introduces)(?: its)? new (?P<r>.+?): (?P<p>.+)$",
        r"^(?P<o>.+?) (?:appoints|names|hires|taps|elects|welcomes) (?P<p>.+?) (?:as|to) (?P<r>.+)$",
        r"^(?P<o>.+?) (?:promotes|elevates) (?P<p>.+?) to (?P<r>.+)$",
        r"^(?P<p>.+?) (?:joins|rejoins) (?P<o>.+?) as (?P<r>.+)$",
        r"^(?P<p>.+?) takes over as (?P<r>.+?) at (?P<o>.+)$",
        r"^(?P<p>.+?) (?:elected|appointed|promoted to|hired as|becomes|to become) (?P<r>.+?) at (?P<o>.+)$",
        r"^(?P<p>.+?) (?:takes over as|elected|appointed|promoted to|hired as|becomes|to become) (?P<r>.+) (?:of|by) (?P<o>.+)$",
        r"^(?P<p>.+?) (?:named|appointed) (?P<r>.+) (?:of|at) (?P<o>.+)$",
    )
]
_VERBS = ["selects", "names", "appoints", "promotes", "joins", "elected", "named", "takes", "board"]
_TITLES = {"mr", "mrs", "ms", "dr", "hon", "prof", "rev", "jr", "sr", "ii", "iii", "iv", "cpa", "ccue", "cfa", "mba"}


#: A headline that ends in the organisation still states the position when it is cut short.
_ENDS_IN_ORG = range(5, 9)


def fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).lower()


def clean(title: str) -> str:
    text = html.unescape(title) if "&" in title else title
    if not text.isascii():
        text = re.sub("[\u200B\uFEFF\u00AD]", "", unicodedata.normalize("NFC", text)).replace("’", "'")
    if "<" in text:
        text = re.sub(r"<[^>]*>", "", text)
    return " ".join(text.replace("`", "'").split())


def parse(title: str, matcher: Matcher) -> tuple[str, str, int, str, bool] | None:
    """(person letters, middle initials, position, organisation's first two words, cut short) or None where nobody is named.

    A position outside the reference list gets a negative code of its wording.
    """
    text = _LEAD.sub("", clean(title)).strip(" \"'“”*")
    cut = bool(_CUT.search(text))
    text = _CUT.sub("", text).rstrip()
    for t in dict.fromkeys((_TAIL.sub("", text).rstrip("!. "), text)):
        hit = _parts(t if cut else t.rstrip("!. "), matcher, cut)
        if hit:
            return hit
    return None


def _parts(text: str, matcher: Matcher, cut: bool):
    for attempt in (text, _respell(text)):
        for k, w in enumerate(_WORDINGS):
            m = w.match(attempt)
            if not m or (cut and k not in _ENDS_IN_ORG):
                continue
            role = re.sub(r"^(?:its |the )?new ", "", m["r"], flags=re.I)
            role = re.sub(r",? effective .*$| pos?o?s?t\b.*$", "", role, flags=re.I)
            role = _TAIL.sub("", role)
            found = matcher.find(role)
            if found is None:
                if cut:
                    return None
                code = -1 - (sum(ord(c) * 31**i for i, c in enumerate(plain(role))) % 1_000_000_007)
            else:
                code = found[1]
            org = fold(m["o"])
            core = "".join(re.findall(r"[a-z0-9]+", org)[:2])
            names = [re.sub(r"[^a-z]", "", x) for x in fold(m["p"]).split()]
            names = [x for x in names if x and x not in _TITLES]
            if "," in m["p"] and len(names) > 1:
                names = names[1:] + names[:1]
            inner = "".join(x for x in names[1:-1] if len(x) == 1)
            person = "".join(x for i, x in enumerate(names) if len(x) > 1 or i in (0, len(names) - 1))
            if len(person) >= 3 and core:
                return person, inner, code, core, cut
    return None


class Remembering:
    """A matcher that looks each wording of a position up once."""

    def __init__(self, matcher: Matcher):
        self.matcher, self.known = matcher, {}

    def find(self, raw: str) -> tuple[int, int] | None:
        if raw not in self.known:
            if len(self.known) > _REMEMBERED:
                self.known.clear()
            self.known[raw] = self.matcher.find(raw)
        return self.known[raw]


def _respell(text: str) -> str:
    """A slip in the verb itself: words within two letters of a known verb become it."""
    from orgextract.llm.editmetric import within

    out = []
    for w in text.split():
        lower = w.lower()
        slips = lambda v: within(lower, v, 2 if len(v) > 5 or sorted(v) == sorted(lower) else 1)
        near = next((v for v in _VERBS if len(lower) >= 4 and w[:1].islower() and slips(v)), None)
        out.append(near or w)
    return " ".join(out)


# Words of the wordings, of kinds of organisations and of decorations. With the words of
# positions they are common to many announcements and tell none from another.
_COMMON = (
    "the a an of at as to by for in on and its new over post board names named naming announces announced welcomes introduces "
    "appoints appointed hires hired taps elects elected promotes promoted elevates joins rejoins takes becomes become selects "
    "picks chooses effective next this month immediately update updated reminder correction breaking exclusive video watch "
    "news alert repost credit union unions federal community employees members teachers nurses city county savings fcu cu "
    "coop co op inc ltd mr mrs ms dr hon prof rev jr sr ii iii iv cpa ccue cfa mba"
).split()
#: Words remembered by a worker; beyond that it starts over.
_REMEMBERED = 200_000


def _shorter(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


class CommonWords:
    """The words of wordings, organisations' kinds and positions. One of four letters or more (or a company's
    short form) may have a slip: it is found by the words with one letter left out that both share."""

    def __init__(self, matcher: Matcher):
        positions = {w for form in matcher.tree.values for w in form.split()}
        self.words = {*_COMMON, *positions, *matcher.lexicon.abbreviations}
        self.near = {d for w in self.words if len(w) >= 4 or w in ("inc", "ltd") for d in (w, *_shorter(w))}
        self.known: dict[str, bool] = {}

    def __contains__(self, word: str) -> bool:
        hit = self.known.get(word)
        if hit is None:
            if len(self.known) > _REMEMBERED:
                self.known.clear()
            hit = self.known[word] = word in self.words or (len(word) >= 3 and (word in self.near or not self.near.isdisjoint(_shorter(word))))
        return hit


def normal(title: str, common: CommonWords) -> tuple[str, list[str]]:
    """(the headline's words in order, without decoration; its own words, sorted). The last word of a headline cut short is dropped."""
    text = _LEAD.sub("", clean(title)).strip(" \"'“”*")
    cut = bool(_CUT.search(text))
    text = fold(_TAIL.sub("", _CUT.sub("", text).rstrip()))
    words = re.findall(r"[^\W_]+", re.sub(r"['.\u2010\u2011-]", "", text))
    own = sorted(w for w in (words[:-1] if cut else words) if len(w) > 1 and w not in common)
    return " ".join(words), own


#: A fingerprint has two halves of three blocks. Letters are dealt to the blocks by how common they are.
HALF, BLOCK = 27, 9
_PLACE = {c: r % 3 * BLOCK + r // 3 for r, c in enumerate("eaionrlstudhmgbcpfkwvyzxjq")}
_ELSE = HALF - 1


def fingerprint(own: list[str]) -> int:
    """Parity bits, so that little changes flip few of them: one per letter over the headline's own words, and
    one per letter over the first letters of these words. In the first half a wrong letter flips two bits,
    a missing or added one flips one, swapped letters none; in the second at most two."""
    bits = 0
    for w in own:
        for c in w:
            bits ^= 1 << _PLACE.get(c, _ELSE)
        bits ^= 1 << (HALF + _PLACE.get(w[0], _ELSE))
    return bits
