"""Text out of markup and signals out of text, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import is_missing  # noqa: F401  (callers take both from here)

# What an email looks like, and marks of those that nobody answers: domains, begins, parts of sample addresses.
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
BAD_EMAIL_DOMAINS = ("godaddy.com", "example.com", "yourdomain.com", "domain.com", "yourwebsite.com", "website.com", "email.com", "test.com", "placeholder.com", "sampleemail.com")
BAD_EMAIL_PREFIXES = ("filler", "placeholder", "test", "demo", "admin@example", "info@example", "noreply", "no-reply", "donotreply")
PLACEHOLDER_PARTS = ("email@", "name@", "user@")
PHONE = r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}"
STREET = r"[0-9]{1,6} (?:[A-Z][A-Za-z0-9.]* ){1,4}(?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Drive|Dr|Lane|Ln|Way|Court|Ct|Place|Pl|Parkway|Pkwy|Highway|Hwy)"
#: A whole address: number, street, city, state, zip code.
ADDRESS = r"\b[0-9]{2,5}\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,3}\s*,\s*[A-Z][a-zA-Z\s]+,\s*[A-Z]{2}\s+[0-9]{5}"

#: Order matters: whole elements first, then tags, then white space.
STRIP = (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?is)<noscript[^>]*>.*?</noscript>", r"(?s)<!--.*?-->")
CHROME = (r"(?is)<nav[^>]*>.*?</nav>", r"(?is)<header[^>]*>.*?</header>", r"(?is)<footer[^>]*>.*?</footer>")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(values) -> Column:
    """An array of strings as one literal: a vocabulary is one node of a plan, not one a word."""
    return F.expr(f"array({', '.join(map(quoted, values))})") if len(values) else F.array().cast("array<string>")


def visible_text(html: Column | str, body: bool = False) -> Column:
    """Lower-cased text of a page without tags, scripts and comments; body: without navigation, header and footer too.

    Entities stay as they are; the parser in ``html.py`` decodes them.
    """
    c = F.coalesce(_col(html), F.lit(""))
    for pattern in STRIP + (CHROME if body else ()):
        c = F.regexp_replace(c, pattern, " ")
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    return F.lower(F.trim(F.regexp_replace(c, r"[ \t\n\r\f]+", " ")))


def count_keyword(text: Column | str, word: Column | str, cap: int | None = None) -> Column:
    """How often a literal occurs, left to right without overlaps; at most ``cap``."""
    t, w = _col(text), F.lit(word) if isinstance(word, str) else word
    n = ((F.length(t) - F.length(F.replace(t, w, F.lit("")))) / F.length(w)).cast("long")
    n = F.when(F.contains(t, w), n).otherwise(F.lit(0)).cast("long")  # a search is far cheaper than a replacement; most words aren't there
    return F.least(n, F.lit(cap)).cast("long") if cap is not None else n


def keyword_sum(text: Column | str, words: list[str], cap: int | None = None) -> Column:
    """Sum of capped counts over words. Words may overlap on purpose; each counts."""
    return once(_col(text), lambda t: F.aggregate(literals(words), F.lit(0).cast("long"), lambda a, w: a + count_keyword(t, w, cap))) if words else F.lit(0).cast("long")


def any_keyword(text: Column | str, words: list[str]) -> Column:
    """Whether any literal occurs."""
    return F.coalesce(once(_col(text), lambda t: F.exists(literals(words), lambda w: F.contains(t, w))), F.lit(False)) if words else F.lit(False)


def spaced(text: Column | str) -> Column:
    """Hyphens as spaces: text and keywords take the same form before they are compared."""
    return F.regexp_replace(F.lower(_col(text)), "-", " ")


def whole_word(text: Column | str, word: str) -> Column:
    """Whether a lower-case word stands alone (ASCII borders)."""
    return F.coalesce(_col(text).rlike(f"(^|[^a-z0-9]){word}([^a-z0-9]|$)"), F.lit(False))


def is_bad_email(email: Column, placeholders: bool = False) -> Column:
    """Whether an address is on the blocklist: its domain, its begin; with ``placeholders`` also parts of sample addresses."""
    domains, begins = ("|".join(x.replace(".", "[.]") for x in xs) for xs in (BAD_EMAIL_DOMAINS, BAD_EMAIL_PREFIXES))
    bad = rf"(?i)^(?:{begins})|@(?:{domains})$" + (f"|{'|'.join(PLACEHOLDER_PARTS)}" if placeholders else "")
    return F.trim(email).rlike(bad)


def once(value: Column, make: Callable[[Column], Column]) -> Column:
    """An expression of a value that is worked out once, however often it occurs there.

    What a lambda function names but doesn't take is worked out again for every
    element it sees, so it should be bound by this first.
    """
    return F.element_at(F.transform(F.array(value), make), 1)


def emails(text: Column | str) -> Column:
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(EMAIL), F.lit(0))


def first_email(text: Column | str, policy: str = "first") -> Column:
    """An email out of text, NULL if none.

    ``any``: the first that isn't on the blocklist. ``first``: the first match,
    if it isn't on the blocklist (later ones aren't tried). ``plain``: the
    first match without a blocklist.
    """
    if policy == "any":
        return F.try_element_at(F.filter(emails(text), lambda e: ~is_bad_email(e, True)), F.lit(1))
    one = F.nullif(F.regexp_extract(F.coalesce(_col(text), F.lit("")), EMAIL, 0), F.lit(""))
    return one if policy == "plain" else once(one, lambda e: F.when(~is_bad_email(e), e))


def decode_hidden_email(code: Column | str) -> Column:
    """An email hidden as hex: the first byte is XORed onto each of the others."""

    def decoded(c: Column) -> Column:
        byte = lambda k: F.conv(F.substring(c, k, F.lit(2)), 16, 10).cast("int")
        places = F.sequence(F.lit(3), F.length(c) - 1, F.lit(2))
        text = once(byte(F.lit(1)), lambda key: F.array_join(F.transform(places, lambda k: F.char(byte(k).bitwiseXOR(key))), ""))
        return F.when(c.rlike("^(?:[0-9a-f]{2}){2,}$"), text)

    return once(F.lower(_col(code)), decoded)


def email_by_priority(hidden: Column, mailtos: Column, text: Column, blocks: Column) -> Column:
    """The first good one of hidden links, then of mail links, then the first in the text, then of contact blocks; bad ones give way."""
    good = lambda es: F.try_element_at(F.filter(es, lambda e: F.contains(e, F.lit("@")) & ~is_bad_email(e)), F.lit(1))
    return F.coalesce(good(F.transform(hidden, decode_hidden_email)), good(F.transform(mailtos, F.trim)), once(first_email(text, "plain"), lambda e: F.when(~is_bad_email(e), e)), good(blocks))


def first_phone(text: Column | str) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(_col(text), F.lit("")), PHONE, 0), F.lit(""))


def first_street(text: Column | str) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(_col(text), F.lit("")), STREET, 0), F.lit(""))


# Statuses and marks of pages that a guard put in the page's place.
BLOCKED_STATUS = (202, 403, 429, 503)
CHALLENGE_MARKS = ("sgcaptcha", "robot challenge", "just a moment", "checking your browser", "cloudflare", "cf-ray", "enable javascript", "web server is returning an unknown error")
LOGIN_MARKS = {
    "facebook": ("log in to facebook", "log into facebook", "you must log in", "you must be logged in", '"loginrequired":true', "checkpoint/block"),
    "instagram": ("log in to instagram", "loginform"),
}


def is_challenge(html: Column | str, status: Column | None = None, url: Column | None = None, reach: int = 2000) -> Column:
    """Whether a page is a guard's: by status, by the begin of an answer (200, or an error of the server), by its address."""
    marked = once(F.lower(F.substring(F.coalesce(_col(html), F.lit("")), 1, reach)), lambda head: any_keyword(head, list(CHALLENGE_MARKS)))
    hit = marked
    if status is not None:
        hit = F.coalesce(status.isin(*BLOCKED_STATUS), F.lit(False)) | (marked & F.coalesce((status == 200) | (status >= 500), F.lit(True)))
    if url is not None:
        u = F.lower(F.coalesce(url, F.lit("")))
        hit = hit | F.contains(u, F.lit("sgcaptcha")) | (F.contains(u, F.lit("captcha")) & F.contains(u, F.lit("challenge")))
    return hit


def is_script_shell(html: Column | str) -> Column:
    """A page that only scripts would fill: an empty root element, little markup, hardly any text."""
    h = F.coalesce(_col(html), F.lit(""))
    return h.rlike(r"(?is)<div[^>]*id=[\"'](root|app|__next)[\"'][^>]*>\s*</div>") & (F.length(h) < 50_000) & (F.length(visible_text(h)) < 300)


def is_login_wall(html: Column | str, site: str) -> Column:
    return any_keyword(F.lower(F.coalesce(_col(html), F.lit(""))), list(LOGIN_MARKS[site]))


# Phrases that speak of several places, link texts and paths of a page of places.
PLACE_PHRASES = (
    "multiple locations", "multiple offices", "multiple clinics", "two locations", "three locations", "four locations", "five locations", "six locations", "seven locations", "all locations", "all offices",
    "our locations", "find a location", "find our offices", "locate an office", "2 convenient", "3 convenient", "4 convenient", "5 convenient", "visit us at either", "both of our", "all of our locations",
    "serving multiple", "several locations", "many locations", "locations near you", "offices near you", "choose your location", "select your location",
)
PLACE_LINK, PLACE_PATH = r"(?i)^(?:locations?|our\s+offices?|find\s+us)$", r"(?i)/(?:locations?|offices?|our-offices?|find-us|clinics?)/?$"


def locations(text: Column | str, links: Column | str | None = None) -> Column:
    """How many places a site speaks of: "3 locations" (2 to 25, or 1), a number word, "Multiple" by a phrase, whole addresses (cased text), "Multiple" by a link, else 1."""
    t = F.coalesce(_col(text), F.lit(""))
    kinds = r"\s+(?:convenient\s+)?(?:locations?|offices?|clinics?|sites?)\b"
    words = ("two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")

    def told(low: Column) -> Column:
        said = F.regexp_extract(low, rf"\b([0-9]{{1,2}}){kinds}", 1).try_cast("int")
        word = F.regexp_extract(low, rf"\b({'|'.join(words)}){kinds}", 1)
        number = F.array_position(F.array(*[F.lit(w) for w in words]), word) + 1
        return F.when(said.between(1, 25), said.cast("string")).when(word != "", number.cast("string")).when(any_keyword(low, list(PLACE_PHRASES)), F.lit("Multiple"))

    streets = F.size(F.regexp_extract_all(t, F.lit(f"({ADDRESS})"), F.lit(1)))
    linked = F.exists(links, lambda x: F.trim(x["text"]).rlike(PLACE_LINK) | x["href"].rlike(PLACE_PATH)) if links is not None else F.lit(False)
    return F.coalesce(once(F.lower(t), told), F.when(streets >= 2, streets.cast("string")), F.when(linked, F.lit("Multiple")), F.lit("1"))
