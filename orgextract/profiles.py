"""Extraction profiles as data: word lists, patterns, windows and keys per rule set (A, B, C).

Profile C is the default. The values are fixed: results depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass

# URL family.
TLD_FIXES = [(".or", ".org"), (".coo", ".coop"), (".coom", ".com"), (".con", ".com"), (".og", ".org"), (".cm", ".com")]
BAD_HOSTS = ["facebook.com", "www.facebook.com", "wixsite.com", "linktr.ee"]
ALLOWED_PATHS_A = ["/contact", "/about", "/leadership", "/management", "/executive", "/board", "/team", "/staff", "/who-we-are",
                   "/our-team", "/meet", "/people", "/directory", "/governance"]
PEOPLE_ALLOW = ["about", "leadership", "board", "management", "executive", "team", "staff", "directory", "contact", "careers",
                "employment", "who-we-are", "locations", "branch", "community"]
PEOPLE_DENY = ["checking", "savings", "loans", "mortgage", "auto", "credit-card", "rates", "calculator", "re-order", "personal-loans",
               "student-loans", "apply", "specials", "promo", "blog", "faq"]
#: Tested on the path alone; the words above on the whole URL.
PEOPLE_DENY_PATHS = ["/accounts/", "/loans/", "/loan-", "/calculator", "/rates"]
TEXT_CONTENT_TYPES = ["text/html", "application/json", "text/plain", "application/xhtml+xml", "application/xml"]
#: Requests a crawl doesn't make, on any profile, and the tracker that only B and C list.
BLOCKED = [r"\.(?:png|jpe?g|gif|webp|svg|ico)(?:\?.*)?$", r"\.(?:woff2?|ttf|otf)(?:\?.*)?$", r"/(?:gtm|googletagmanager)\.com/", r"/google-analytics\.com/",
           r"doubleclick\.net/", r"/facebook\.com/tr/", r"/hotjar\.com/"]
BLOCKED_BC = [*BLOCKED, r"/snapchat\.com/"]

# E-mail family.
EMAIL = r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b"
PLACEHOLDER = "user@example.com"
GENERIC_A = ["info", "contact", "support", "customerservice", "hello"]
GENERIC_C = [*GENERIC_A, "service"]

# Roles and names.
ROLES_A = (
    r"(?i)\b(Chief\s+Executive\s+Officer|CEO|President|Chief\s+Financial\s+Officer|CFO|Chief\s+Operating\s+Officer|COO"
    r"|Chief\s+Information\s+Officer|CIO|Chief\s+Technology\s+Officer|CTO|Chief\s+Risk\s+Officer|CRO|Chief\s+Lending\s+Officer|CLO"
    r"|Chief\s+Marketing\s+Officer|CMO|Executive\s+Vice\s+President|EVP|Senior\s+Vice\s+President|SVP"
    r"|Vice\s*President(?:\s+of\s+[A-Za-z &]+)?|VP(?:\s+of\s+[A-Za-z &]+)?|Director(?:\s+of\s+[A-Za-z &]+)?|Manager"
    r"|Board\s+Chair|Chair|Treasurer|Secretary|Board\s+Member)\b"
)
ROLES_B = [
    r"chief\s+executive\s+officer", r"ceo", r"president", r"president\s*&\s*ceo", r"vice\s+president", r"vp", r"svp", r"evp", r"manager",
    r"branch\s+manager", r"chief\s+financial\s+officer", r"cfo", r"chief\s+operating\s+officer", r"coo", r"chief\s+marketing\s+officer",
    r"cmo", r"chief\s+information\s+officer", r"cio", r"cto", r"chair", r"chairman", r"chairperson", r"board", r"director", r"treasurer",
    r"secretary", r"compliance\s+officer", r"loan\s*officer", r"member\s*services",
]
ROLES_C = (
    r"(?i)\b(Chief Executive Officer|CEO|COO|CFO|CMO|CTO|Vice President|VP|Assistant Vice President|AVP|Manager|Director|Supervisor|Officer"
    r"|Loan Officer|Branch Manager|Member Services|Operations|Lending|Marketing|HR|Compliance|Chief Lending Officer|CLO|SVP|EVP|Chair"
    r"|Board Chair|Treasurer|Secretary)\b"
)
NAME_A = r"\b([A-Z][A-Za-z.'\-]+(?:\s+[A-Z][A-Za-z.'\-]+)+)\b"
NAME_B = r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,3}(?:\s+[A-Z][a-z]+)?)\b"
NAME_C = r"\b([A-Z][a-z]+(?:\s+[A-Z]\.)?(?:\s+[A-Z][a-z]+){0,2}(?:-[A-Z][a-z]+)?)\b"
SERVICE_ROLES = ["bill payer", "online banking", "mobile deposit", "digital banking", "branch manager", "loan officer"]
BAD_NAME_TOKENS = ["Email", "E-mail", "Mail", "St", "Street", "Hours", "Support", "Customer", "Service", "Info", "Contact", "Us", "Department"]
SENIOR_TITLES = ["Chief Executive Officer", "CEO", "President", "Chief Financial Officer", "CFO", "Chief Operating Officer", "COO",
                 "Chief Information Officer", "CIO", "Chief Technology Officer", "CTO", "Chief Risk Officer", "CRO", "Chief Lending Officer",
                 "CLO", "Chief Marketing Officer", "CMO", "Executive Vice President", "EVP", "Senior Vice President", "SVP",
                 "Vice President", "VP", "Board Chair", "Chair"]
ANNOUNCEMENT = r"(?i)\b(?:appointed|named|ceo|chief executive|president|executive change|promotion|joins as ceo|leadership team)\b"
STRUCTURED_ROLES = (
    r"CEO|Chief\s+Executive\s+Officer|President|Vice\s*President|VP|AVP|Branch\s*Manager|Manager|Director|Supervisor|Officer"
    r"|Loan\s*Officer|Member\s*Services"
)
#: The role alone ignores case; a name must be capitalised. The literal variant lets the whole pattern ignore case.
STRUCTURED = rf"\b((?i:{STRUCTURED_ROLES}))\b[\s·:\-]*([A-Z][a-z]+(?:\s+[A-Z][a-z]+){{0,2}})[\s·:\-]*({EMAIL[2:-2]})"
STRUCTURED_LITERAL = r"(?is)" + STRUCTURED

# Confidence by extractor tag, first hit wins.
CONFIDENCE_C = [(("leadership-text",), 0.90), (("leadership-mailto", "leadership-structured"), 0.85), (("pdf-window",), 0.80),
                (("json-ld",), 0.70), (("support-mailto", "click-here", "cfemail"), 0.70)]
#: (confidence without a leading role, with one)
CONFIDENCE_B = {"HTML": (0.5, 0.7), "network": (0.5, 0.7), "pdf": (0.5, 0.8), "support-mailto": (0.5, 0.7),
                "leadership-mailto": (0.6, 0.85), "leadership-text": (0.9, 0.9), "json-ld": (0.7, 0.7), "click-here": (0.7, 0.7),
                "cfemail": (0.7, 0.7), "onclick": (0.7, 0.7)}


# Site-specific blocks, and headings that lead to one.
STRICT_A = r"(?i:(?:\b(Chief\s+Executive\s+Officer|CEO|President)\b))\s*([A-Z][A-Za-z.'\-]+(?:\s+[A-Z][A-Za-z.'\-]+)+)\s+([A-Za-z0-9._%+\-\s]+@\s*[A-Za-z0-9.\-]+\s*\.\s*[A-Za-z]{2,})"
TEXT_B = r"(?is)\b(CEO|Loan\s*Officer|Member\s*Services)\b[\s:\-]*([A-Za-z][A-Za-z .'\-]+?)[\s:\-]+([A-Za-z0-9._%+-]+@{domain})\b"
STAFF_HEADING = "meet our staff"
OTHER_HEADINGS = ["meet our team", "leadership"]
CLICK_HERE = "click here"
PROTECTED_LINK = "/cdn-cgi/l/email-protection"
#: Marks in a path (A) or URL (B) of pages a site's own extractor reads.
HOOK_MARKS_A, HOOK_MARKS_B = ["/contact", "/staff"], ["/support", "/contact"]


@dataclass(frozen=True)
class Profile:
    name: str
    depth: int
    fanout: int | None
    page_cap: int | None
    behind: int
    after: int
    lower_email: bool
    needs_email: bool
    pdf_pages: int | None
    pdf_per_host: int | None
    dedup: tuple[str, ...]


PROFILES = {
    "A": Profile("A", 4, None, 50, 300, 300, False, False, 0, 0, ("role", "name", "email", "source_url", "credit_union")),
    "B": Profile("B", 2, 40, None, 160, 0, False, True, None, None, ("role", "name", "email", "source_url")),
    "C": Profile("C", 3, 40, None, 400, 200, True, False, 3, 2, ("role", "name", "email", "source_url")),
}
