from orgextract.llm import headlines
from orgextract.llm.reference_match import SYNONYMS, Matcher


def test_cut_headlines_of_the_last_wording():
    m = Matcher([(25, "Loan Officer", None)], SYNONYMS)
    assert headlines.parse("Rebecca Vozik named Loan Officer of Totun Bridge Memb...", m) == ("rebeccavozik", "", 25, "totunbridge", True)
    assert headlines.parse("Rebecca Vozik named Grand Vizier of Totun Bridge Memb...", m) is None
