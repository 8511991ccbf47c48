"""People in running text and in headings: names, what is said of them, and hints of their field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import is_found_name, last_name
from .text import literals, once

NAME = r"[A-ZÀ-Þ][a-zà-ÿ'-]+(?: [A-ZÀ-Þ]\.?)?(?: [A-ZÀ-Þ][a-zà-ÿ'-]+){1,2}"
TITLED = rf"Dr\.? +({NAME})"
CREDENTIALED = rf"({NAME}),? +(?:DDS|DMD|D\.D\.S\.?|D\.M\.D\.?)(?:[^A-Za-z]|$)"
# Phrases of articles' headings; stems that tell a field; parts of navigation; credentials that end a name.
ARTICLE_PHRASES = (
    "conversation with", "interview with", "Q&A with", "QA with", "candid talk with", "written by", "featuring dr", "spotlight on", "in the words of", "a chat with", "a day in the life of", "behind the mask",
    "behind the desk", "getting to know dr", "ask the dr", "ask dr",
)
HINT_STEMS = (
    "dentistry", "dentist", "dds", "dmd", "orthodon", "periodon", "endodon", "prosthodon", "oral surg", "hygien", "implant", "cosmetic", "pediatric", "restorat", "preventi", "specialist", "surgeon", "general", "family",
    "comprehensive", "aesthetic", "esthetic", "holistic", "biolog", "invisalign", "aligner", "prosthet",
)
NAVIGATION = ("about us", "our dent", "our doctor", "meet the", "meet our", "our team", "our staff", "our provider", "patient portal", "request appoint")
NAME_ENDS = ("DDS", "DMD", "MD", "MS", "FAGD", "MAGD", "FICOI")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def names_in(text: Column | str, most: int = 6) -> Column:
    """Distinct names with a title, then with a credential, in text order; those that can be people's, at most ``most``."""
    t = F.coalesce(_col(text), F.lit(""))
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in (TITLED, CREDENTIALED)])
    found = F.filter(F.transform(found, lambda n: F.trim(n)), is_found_name)
    distinct = F.aggregate(found, F.array().cast("array<string>"), lambda out, n: F.when(F.exists(out, lambda o: F.lower(o) == F.lower(n)), out).otherwise(F.concat(out, F.array(n))))
    return F.slice(distinct, 1, most)


# Words that stand before a name and aren't part of it.
ROLE_WORDS = (
    "dentist", "doctor", "dr", "orthodontist", "periodontist", "endodontist", "prosthodontist", "surgeon", "specialist", "director", "coordinator", "assistant", "manager", "receptionist", "founder", "owner",
    "provider", "physician", "associate", "general", "pediatric", "cosmetic", "family", "lead", "attending", "chief", "principal", "meet", "our", "the",
)


def extended_names(text: Column | str, most: int = 30) -> Column:
    """Distinct names with a credential, with the given names that stand before what a name usually has; words of roles before them are left out."""
    t = F.coalesce(_col(text), F.lit(""))
    found = F.regexp_extract_all(t, F.lit(rf"((?:[A-Z][a-z]{{1,20}} ){{0,4}}{NAME}),? +(?:DDS|DMD|D\.D\.S\.?|D\.M\.D\.?)(?:[^A-Za-z]|$)"), F.lit(1))
    roles = literals(ROLE_WORDS)

    def bare(name: Column) -> Column:
        words = F.split(name, " ")
        last = F.array_max(F.transform(words, lambda w, k: F.when(F.array_contains(roles, F.lower(w)), k + 1).otherwise(0)))
        return F.array_join(F.slice(words, last + 1, F.size(words)), " ")

    fine = F.filter(F.transform(found, bare), lambda n: F.length(n).between(5, 70) & is_found_name(n))
    distinct = F.aggregate(fine, F.array().cast("array<string>"), lambda out, n: F.when(F.exists(out, lambda o: F.lower(o) == F.lower(n)), out).otherwise(F.concat(out, F.array(n))))
    return F.slice(distinct, 1, most)


# Services that a dump of a site's text is searched for.
DUMP_SERVICES = (
    "Dentures", "Dental implants", "Dental cleaning", "Root canal", "Teeth whitening", "Invisalign", "Clear aligners", "Crowns", "Bridges", "Veneers", "Extractions", "Emergency dental", "Sedation", "Pediatric",
    "Orthodontics", "Oral surgery", "Wisdom tooth", "Cosmetic dentistry", "Fillings", "Bonding", "Night guards", "Sleep apnea", "Gum disease", "Periodontal", "Implant dentures", "Full arch", "All-on-4",
)


def dump_fields(text: Column | str) -> Column:
    """``doctors, phone, rating, services, address`` out of the whole text of a site; what isn't there is NULL."""
    t = F.coalesce(_col(text), F.lit(""))
    one = lambda p, g=0: F.nullif(F.trim(F.regexp_extract(t, p, g)), F.lit(""))
    names = F.transform(F.regexp_extract_all(t, F.lit(r"\b[Dd][Rr]\.?\s+([A-Z][a-z]+(?:\s+[A-Z]\.?)?\s+[A-Z][A-Za-z'-]+)"), F.lit(1)), lambda n: F.concat(F.lit("Dr. "), F.regexp_replace(n, r"\s+", " ")))
    services = once(F.lower(t), lambda low: F.array_compact(F.array(*[F.when(F.contains(low, F.lit(s.lower())), F.lit(s)) for s in DUMP_SERVICES])))
    return F.struct(
        F.array_distinct(names).alias("doctors"), one(r"\(?[0-9]{3}\)?[\s.-]?[0-9]{3}[\s.-]?[0-9]{4}").alias("phone"), one(r"(?i)([0-9]\.[0-9])\s*(?:stars?|out of 5|★)", 1).try_cast("double").alias("rating"),
        F.nullif(F.array_join(services, ", "), F.lit("")).alias("services"), one(r"[0-9]+\s+[A-Z][a-zA-Z0-9\s.,]+(?:Blvd|Ave|St|Rd|Dr|Way|Ln|Pkwy|Suite|Ste)[^\n]{0,60}").alias("address"),
    )


def names_in_headings(headings: Column | str, most: int = 12) -> Column:
    """Names out of headings alone; titles of articles don't count."""
    own = F.filter(_col(headings), lambda h: ~is_article(h["text"]))
    return names_in(F.array_join(F.transform(own, lambda h: h["text"]), " ; "), most)


def _plain(text: Column | str) -> Column:
    return F.lower(F.regexp_replace(F.trim(F.coalesce(_col(text), F.lit(""))), r"\s+", " "))


def is_article(heading: Column | str) -> Column:
    """Whether a heading is an article's: one of the phrases stands in it, as words."""
    phrases = "|".join(p.lower().replace("dr", "dr\\.?") if p.endswith("dr") else p.lower() for p in ARTICLE_PHRASES)
    return _plain(heading).rlike(rf"(^|[^a-z0-9])(?:{phrases})($|[^a-z0-9])")


def is_hint(text: Column | str) -> Column:
    """Whether a short line beside a name can tell a field: 5 to 90 characters, a word with a telling stem, no navigation, no name with its credential.

    Stems may have endings ("orthodontist"), which a whole-word search would miss.
    """

    def tells(t: Column) -> Column:
        told = once(F.concat(F.lit(" "), F.regexp_replace(t, "[^a-z]+", " ")), lambda spaced: F.exists(literals([f" {s}" for s in HINT_STEMS]), lambda s: F.contains(spaced, s)))
        passed = F.exists(literals(NAVIGATION), lambda x: F.contains(t, x)) | t.rlike(r"(^|[^a-z])home($|[^a-z])")
        return F.length(t).between(5, 90) & told & ~passed & ~t.rlike(rf",\s*(?:{'|'.join(NAME_ENDS).lower()})($|[^a-z])")

    return once(_plain(text), tells)


def fuller_name(name: Column | str, headings: Column | str) -> Column:
    """The most complete of a name and the names in a page's headings that share its last name."""
    from .names import completeness

    n = _col(name)
    last = last_name(n)
    others = F.filter(names_in_headings(headings, 30), lambda h: F.contains(F.lower(h), last))
    return F.array_max(F.transform(F.concat(F.array(n), others), lambda x: F.struct(completeness(x).alias("c"), F.length(x).alias("l"), x.alias("name"))))["name"]
