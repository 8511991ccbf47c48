"""Web addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import literals

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_scheme(url: Column | str) -> Column:
    u = F.trim(_col(url))
    return F.when(u.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), u).otherwise(F.concat(F.lit("https://"), u))


def netloc(url: Column | str) -> Column:
    """Host with port, lower-cased; empty for a blank address."""
    return F.when(F.trim(_col(url)) == "", F.lit("")).otherwise(F.lower(F.regexp_extract(with_scheme(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)))


def domain_key(url: Column | str) -> Column:
    """The host without ``www.`` (or ``www2.``): one key for all spellings of a site."""
    return F.regexp_replace(netloc(url), r"^www[0-9]*\.", "")


def homepage(url: Column | str) -> Column:
    return F.concat(F.regexp_extract(with_scheme(url), r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1), F.lit("://"), netloc(url), F.lit("/"))


def without_fragment(url: Column | str) -> Column:
    return F.regexp_replace(_col(url), "#.*$", "")


def path(url: Column | str) -> Column:
    return F.regexp_extract(with_scheme(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def variants(url: Column | str) -> Column:
    """Spellings to try, in order: as given; the other of www and bare over https; both over http; with "dental." where a host says "dent."."""
    host = F.regexp_extract(with_scheme(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    bare, rest = F.regexp_replace(host, r"^www\.", ""), F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    made = lambda scheme, h: F.concat(F.lit(scheme), h, rest)
    www = F.concat(F.lit("www."), bare)
    other = F.when(host == bare, F.array(made("https://", www), made("http://", bare), made("http://", www))).otherwise(F.array(made("https://", bare), made("http://", bare), made("http://", www)))
    full = F.regexp_replace(bare, r"^(.*?)dent\.", "$1dental.")
    longer = F.when(F.contains(bare, F.lit("dent.")) & ~F.contains(bare, F.lit("dental.")), F.array(made("https://", full), made("https://www.", full))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(with_scheme(url)), other, longer))


def username(url: Column | str) -> Column:
    """The account of a profile address."""
    return F.nullif(F.regexp_extract(path(url), r"^/@?([A-Za-z0-9._-]+)", 1), F.lit(""))


def mobile(url: Column | str, host: str = "m") -> Column:
    """The address on a light host (``m`` or ``mbasic``)."""
    return F.regexp_replace(_col(url), r"^(https?://)(?:www\.|m\.|mbasic\.)?(facebook\.com)", f"$1{host}.$2")


def place_parts(url: Column | str) -> Column:
    """``state, city, slug, number`` of an address like /offices/state/city/123-main-st/."""
    parts = F.filter(F.split(path(url), "/"), lambda p: p != "")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    return F.struct(F.upper(at(-3)).alias("state"), F.initcap(F.regexp_replace(at(-2), "-", " ")).alias("city"), at(-1).alias("slug"), F.nullif(F.regexp_extract(at(-1), "^([0-9]+)", 1), F.lit("")).alias("number"))


# Street words in slugs.
STREET_WORDS = {"st": "St", "ave": "Ave", "rd": "Rd", "blvd": "Blvd", "dr": "Dr", "ln": "Ln", "hwy": "Hwy", "pkwy": "Pkwy", "ct": "Ct", "pl": "Pl", "n": "N", "s": "S", "e": "E", "w": "W", "ne": "NE", "nw": "NW", "se": "SE", "sw": "SW", "ste": "Ste"}


def slug_address(slug: Column | str) -> Column:
    """"123-n-main-st" as "123 N Main St"."""
    words = F.create_map(*[F.lit(x) for kv in STREET_WORDS.items() for x in kv])
    return F.array_join(F.transform(F.filter(F.split(F.lower(_col(slug)), "-"), lambda w: w != ""), lambda w: F.coalesce(words[w], F.initcap(w))), " ")


SITES = ("facebook", "instagram", "tiktok", "linkedin")
# Begins of paths that are no profile (a trailing $ marks a whole path).
NOT_PROFILES = (
    "/plugins/", "/feeds/", "/tr/", "/events$", "/events/$", "/groups$", "/groups/$", "/pages$", "/pages/$", "/photo/", "/video/", "/watch", "/gaming", "/marketplace", "/dialog/", "/l.php", "/login", "/policy",
    "/explore", "/reels$", "/reels/$",
)
# Parts of addresses in raw markup that share something or belong to a builder of sites.
NOT_OWN = ("sharer", "/share", "intent/tweet", "api.", "/policy", "/help", "/login", "/signup", "/apps", "oauth", "/squarespace", "/wix.com", "/weebly", "/godaddy", "/wordpress", "/webflow", "/jimdo")
# Companies above practices, as LinkedIn names them.
PARENT_COMPANIES = (
    "smile-brands-inc", "smile-brands", "dental-care-alliance", "dental-care-alliance-inc", "heartland-dental", "aspen-dental-management", "pacific-dental-services", "midwest-dental", "western-dental-services",
    "dentalworks", "great-expressions-dental-centers", "kool-smiles", "mb2-dental", "mb2-dental-solutions", "sage-dental", "advantage-dental", "brident-dental", "bright-now-dental", "castle-dental", "monarch-dental",
    "comfort-dental", "greenberg-dental", "christie-dental", "leap-kids-dental", "merit-dental", "familia-dental", "dental-depot", "perfect-teeth", "western-dental", "towncare-dental", "smiledirectclub", "dentalcorp",
    "clear-choice-dental-implant-centers", "affordable-care",
)


def is_profile(url: Column | str, site: str) -> Column:
    """Whether an address is a profile on a site: a path whose first part has a letter, no path of the site's own, no parent company."""
    low = F.lower(F.coalesce(_col(url), F.lit("")))
    way = F.regexp_extract(low, r"^(?:[a-z][a-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    first = F.element_at(F.split(F.regexp_replace(way, "^/+", ""), "/"), 1)
    own = F.exists(literals(NOT_PROFILES), lambda p: F.when(F.endswith(p, F.lit("$")), way == F.rtrim(p, F.lit("$"))).otherwise(F.startswith(way, p)))
    fine = F.contains(low, F.lit(f"{site}.com")) & first.rlike("[a-z]") & ~way.rlike("^/[0-9]{4}/") & ~own
    if site == "linkedin":
        fine = fine & ~F.array_contains(literals(PARENT_COMPANIES), F.rtrim(F.regexp_replace(F.regexp_extract(low, r"linkedin\.com/company/([^/?#]+)", 1), r"^\.+|\.+$", ""), F.lit("-")))
    return fine


def first_profile(html: Column | str, site: str) -> Column:
    """The first profile's address in raw markup that shares nothing and is no builder's."""
    found = F.regexp_extract_all(F.coalesce(_col(html), F.lit("")), F.lit(rf"((?i)https?://(?:www\.)?{site}\.com/[a-z0-9._\-/@%]+)"), F.lit(1))
    found = F.transform(found, lambda u: F.rtrim(u, F.lit("/")))
    strange = lambda u: F.exists(literals(NOT_OWN), lambda x: F.contains(F.lower(u), x))
    return F.try_element_at(F.filter(found, lambda u: is_profile(u, site) & ~strange(u)), F.lit(1))


# Parts of paths under which articles stand, and of addresses that aren't a practice's own site.
CONTENT_PARTS = (
    "news", "blog", "blogs", "article", "articles", "post", "posts", "press-release", "press", "media", "updates", "announcements", "events", "resources", "newsletter", "podcast", "dental-tips", "dental-blog",
    "health-tips", "patient-education", "dental-care-tips", "case-stud",
)
PORTALS = ("kaiser", "healthgrades", "zocdoc", "vitals.com", "yelp.com", "google.com", "doctors-locations", "find-a-physician", "find-a-doctor", "kyruus", "adventhealth.com/find", "mdvip", "webmd")


def is_content(url: Column | str) -> Column:
    """Blog and news pages: not a place to look for staff."""
    return F.coalesce(F.lower(_col(url)).rlike(f"/(?:{'|'.join(CONTENT_PARTS)})(?:/|$)"), F.lit(False))


def is_portal(url: Column | str) -> Column:
    """Addresses of portals and directories."""
    return F.coalesce(F.exists(literals(PORTALS), lambda p: F.contains(F.lower(_col(url)), p)), F.lit(False))


def folder_slug(name: Column | str, index: Column | None = None) -> Column:
    """A name as a folder: other characters as _, 30 at most; with an index as three digits before it."""
    slug = F.regexp_replace(F.left(F.regexp_replace(_col(name), r"[^A-Za-z0-9_]+", "_"), F.lit(30)), r"^_+|_+$", "")
    return slug if index is None else F.concat(F.when(index < 1000, F.lpad(index.cast("string"), 3, "0")).otherwise(index.cast("string")), F.lit("_"), slug)
