"""What lies in what on a page: predicates over its elements' intervals.

The parser numbers elements in the order they open (``pre``) and tells for each
the number of the last element inside it (``last``), its depth, and where its
text begins and ends in the page's text. An element lies inside another if its
number is above the other's and not above the other's ``last``; its siblings
are the elements of its depth that its parent holds. So what takes a walk
through a tree elsewhere is a filter over an array here, within one row.

A page's ``elements`` and its ``text`` go together as one struct (``tree``).
Null pages and pages without elements have no element that fits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .people import is_article, is_hint
from .signals import FULL_NAME, HYGIENIST_TITLE
from .text import once

HEADINGS = ("h1", "h2", "h3", "h4", "h5")
CONTAINERS = ("div", "section", "article", "li", "td", "tr")
# A heading that speaks of a doctor; classes of staff's containers; words of links and link texts to a person's page.
DOCTOR = r"(?i)\b(?:Dr\.?|DDS|DMD|Doctor)\b"
STAFF_CLASS = r"team|doctor|provider|dentist|member|staff|bio|card|person|profile"
BIO_ADDRESS = r"team|doctor|provider|staff|bio|profile|meet|about|physician"
BIO_TEXT = r"bio|learn\s+more|meet|read\s+more|view\s+more|profile|about\s+dr|about\s+the|our\s+doctor|more\s+about"
#: Elements in which a hygienist's role stands, elements of their cards, elements with name and role in a line.
ROLE_LINES = ("p", "span", "div", "h4", "h5", "small", "em", "strong", "li")
CARDS = ("article", "section", "li", "div")
NAME_LINES = (*HEADINGS, "strong", "b")
LINES = (*HEADINGS, "p", "span", "li", "a", "strong", "b")


def tree(elements: Column | str = "elements", text: Column | str = "text") -> Column:
    col = lambda c: F.col(c) if isinstance(c, str) else c
    none = F.array().cast("array<struct<pre:int,last:int,depth:int,tag:string,cls:string,start:int,stop:int>>")
    return F.struct(F.coalesce(col(elements), none).alias("all"), F.coalesce(col(text), F.lit("")).alias("text"))


def said(t: Column, e: Column) -> Column:
    """An element's text."""
    return F.substring(t["text"], e["start"] + 1, e["stop"] - e["start"])


def size(e: Column) -> Column:
    return e["stop"] - e["start"]


def inside(e: Column, a: Column) -> Column:
    return (e["pre"] > a["pre"]) & (e["pre"] <= a["last"])


def ancestors(t: Column, e: Column, tags: tuple[str, ...] = CONTAINERS) -> Column:
    """Elements that hold an element, the narrowest first."""
    return F.reverse(F.filter(t["all"], lambda a: inside(e, a) & a["tag"].isin(*tags)))


def parent(t: Column, e: Column) -> Column:
    """The element next above; the whole page where there is none."""
    page = F.struct(*[F.lit(v).cast(k).alias(n) for n, k, v in (("pre", "int", 0), ("last", "int", 2**31 - 1), ("depth", "int", 0), ("tag", "string", ""), ("cls", "string", ""), ("start", "int", 0))], F.length(t["text"]).cast("int").alias("stop"))
    return F.coalesce(F.try_element_at(F.filter(t["all"], lambda a: inside(e, a) & (a["depth"] == e["depth"] - 1)), F.lit(-1)), page)


def siblings(t: Column, e: Column) -> Column:
    """The elements after an element in the same parent, in order."""
    return once(parent(t, e), lambda p: F.filter(t["all"], lambda s: (s["depth"] == e["depth"]) & (s["pre"] > e["last"]) & inside(s, p)))


def doctor_headings(t: Column) -> Column:
    """Headings below the first level that speak of a doctor: they part what belongs to one person from what belongs to another."""
    return F.filter(t["all"], lambda h: h["tag"].isin(*HEADINGS[1:]) & said(t, h).rlike(DOCTOR))


def after(t: Column, e: Column, others: Column) -> Column:
    """An element's text and what follows it in its parent, up to the next sibling that is one of ``others``."""
    stops = F.transform(F.filter(siblings(t, e), lambda s: F.exists(others, lambda o: o["pre"] == s["pre"])), lambda s: s["start"])
    until = F.coalesce(F.array_min(stops), parent(t, e)["stop"])
    return F.trim(F.substring(t["text"], e["start"] + 1, until - e["start"]))


def own_text(t: Column, e: Column, least: Column | int = 31, others: Column | None = None) -> Column:
    """What a page says of the person of a heading alone.

    The text of the narrowest container around it that has at least ``least``
    characters and no other doctor's heading; without one, the heading and
    what follows it up to the next doctor's heading.
    """

    def told(foreign: Column) -> Column:
        fits = F.filter(ancestors(t, e), lambda a: (size(a) >= least) & ~F.exists(foreign, lambda o: inside(o, a)))
        # what lies around a narrower container that is too short may not reach over a broader one with others in it: intervals nest, so the first that fits is it
        return once(F.try_element_at(fits, F.lit(1)), lambda narrow: F.when(narrow.isNotNull(), said(t, narrow)).otherwise(after(t, e, foreign)))

    return once(F.filter(doctor_headings(t) if others is None else others, lambda o: o["pre"] != e["pre"]), told)


def heading_of(t: Column, name: Column) -> Column:
    """The first heading that names a person: the whole name, its last name (five letters or more); NULL if none."""

    def first(n: Column) -> Column:
        low, last = n["low"], n["last"]
        fits = lambda h: once(F.lower(said(t, h)), lambda s: F.contains(s, low) | ((F.length(last) >= 5) & F.contains(s, last)))
        return F.when(low != "", F.try_element_at(F.filter(t["all"], lambda h: h["tag"].isin(*HEADINGS) & fits(h)), F.lit(1)))

    return once(F.lower(name), lambda low: once(F.struct(low.alias("low"), _last(low).alias("last")), first))


def _last(low: Column) -> Column:
    """The last word; an empty text without one."""
    return F.coalesce(F.try_element_at(F.filter(F.split(low, r"\s+"), lambda w: w != ""), F.lit(-1)), F.lit(""))


def scoped_text(t: Column, name: Column) -> Column:
    """What a page says of a person alone; NULL if no heading names them."""
    return once(heading_of(t, name), lambda h: F.when(h.isNotNull(), own_text(t, h)))


def hint(t: Column, e: Column) -> Column:
    """The first short line after a heading that tells a field; the next heading, or a text of over 200 characters, ends the search."""
    lines = F.filter(siblings(t, e), lambda s: size(s) >= 5)
    long = F.transform(F.filter(lines, lambda s: (size(s) > 200) | s["tag"].isin(*HEADINGS)), lambda s: s["pre"])
    near = F.filter(lines, lambda s: (s["pre"] < F.coalesce(F.array_min(long), F.lit(2**31 - 1))) & is_hint(said(t, s)))
    return once(F.try_element_at(near, F.lit(1)), lambda s: F.when(s.isNotNull(), F.trim(said(t, s))))


def person_link(t: Column, e: Column, links: Column, name: Column) -> Column:
    """The link from a heading's container to the person's page: by its address or text, by a word of the name, else the first; NULL if none."""
    words = F.filter(F.split(F.lower(name), r"[^a-z0-9_]+"), lambda w: (F.length(w) >= 4) & ~w.isin("doctor", "dental", "dentist", "smith"))
    marked = F.filter(t["all"], lambda a: inside(e, a) & a["tag"].isin("div", "section", "article", "li") & a["cls"].rlike(STAFF_CLASS))
    near = F.coalesce(F.try_element_at(marked, F.lit(-1)), F.try_element_at(ancestors(t, e, ("div", "article", "li")), F.lit(1)), e)
    own = lambda box: F.filter(links, lambda x: (x["pre"] > box["pre"]) & (x["pre"] <= box["last"]) & ~x["href"].rlike("^(?:#|mailto:|tel:|javascript:)"))
    tells = lambda x: once(F.lower(x["href"]), lambda href: href.rlike(BIO_ADDRESS) | F.lower(x["text"]).rlike(BIO_TEXT) | F.exists(words, lambda w: F.contains(href, w)))
    both = once(near, lambda box: F.concat(own(box), once(parent(t, e), own)))
    return once(both, lambda xs: F.coalesce(F.try_element_at(F.filter(xs, tells), F.lit(1)), F.try_element_at(xs, F.lit(1)))["href"])


def bio_block(t: Column, name: Column, most: int = 200) -> Column:
    """The first of a page's first sections, articles and divisions that speaks of a person: over 100 characters, less than 85 % of the page; the page's text without one."""
    blocks = F.slice(F.filter(t["all"], lambda b: b["tag"].isin("section", "article", "div")), 1, most)
    fits = lambda n: F.filter(blocks, lambda b: (n["last"] != "") & (size(b) > 100) & (size(b) < n["most"]) & F.contains(F.lower(said(t, b)), n["last"]))
    first = once(F.struct(_last(F.lower(name)).alias("last"), (F.length(t["text"]) * 0.85).alias("most")), lambda n: F.try_element_at(fits(n), F.lit(1)))
    return once(first, lambda b: F.when(b.isNotNull(), said(t, b)).otherwise(t["text"]))


ROLE = rf"\bR\.?D\.?H\.?(?:\b|$)|{HYGIENIST_TITLE}"
NAME = rf"\b({FULL_NAME})\b"
#: The role's own words ("Registered Dental Hygienist") are no name.
ROLE_WORDS = "registered|licensed|dental|hygienist"
SINGLE = rf"\b([A-Z][a-z]{{2,}})\s*,?\s*{HYGIENIST_TITLE}"


def hygienist_names(t: Column) -> Column:
    """Distinct hygienists of a page, lower-cased.

    A card is a container of 21 to 699 characters with a role in a line of at
    most 80 characters; its name is that of the first heading in it that has
    one, else of its text. Then lines of at most 200 characters with name and
    role.
    """

    def name_in(s: Column) -> Column:
        own = lambda p: F.filter(F.transform(F.regexp_extract_all(s, F.lit(p), F.lit(1)), lambda n: F.lower(F.trim(n))), lambda n: ~n.rlike(ROLE_WORDS))
        return F.coalesce(*[F.try_element_at(own(p), F.lit(1)) for p in (NAME, SINGLE)])

    roles = F.filter(t["all"], lambda r: r["tag"].isin(*ROLE_LINES) & size(r).between(1, 80) & said(t, r).rlike(ROLE))

    def carded(found: Column) -> Column:
        cards = F.filter(t["all"], lambda c: c["tag"].isin(*CARDS) & size(c).between(21, 699) & F.exists(found, lambda r: inside(r, c)))

        def of(c: Column) -> Column:
            heads = F.transform(F.filter(t["all"], lambda h: inside(h, c) & h["tag"].isin(*NAME_LINES)), lambda h: name_in(said(t, h)))
            return F.coalesce(F.try_element_at(F.array_compact(heads), F.lit(1)), name_in(said(t, c)))

        return F.transform(cards, of)

    lines = F.filter(t["all"], lambda r: r["tag"].isin(*LINES) & size(r).between(1, 200) & said(t, r).rlike(ROLE))
    none = F.array().cast("array<string>")
    in_cards = once(roles, lambda r: F.when(F.size(r) > 0, carded(r)).otherwise(none))
    found = F.array_distinct(F.array_compact(F.concat(in_cards, F.transform(lines, lambda r: name_in(said(t, r))))))
    return F.when(t["text"].rlike(ROLE), found).otherwise(none)  # most pages speak of nobody: one search spares a look at every element


def anonymous_hygienists(t: Column) -> Column:
    """Lines of at most 200 characters that speak of a hygienist: names, and where there is none the begin of the line."""
    tags = ("h1", "h2", "h3", "h4", "h5", "p", "span", "div", "li", "a", "strong", "b")
    lines = F.filter(t["all"], lambda r: r["tag"].isin(*tags) & size(r).between(1, 200) & said(t, r).rlike(ROLE))
    name = lambda s: F.try_element_at(F.filter(F.transform(F.regexp_extract_all(s, F.lit(f"({FULL_NAME})"), F.lit(1)), lambda n: F.lower(n)), lambda n: ~n.rlike(ROLE_WORDS)), F.lit(1))
    found = F.array_distinct(F.transform(lines, lambda r: F.coalesce(name(said(t, r)), F.left(F.lower(F.regexp_replace(said(t, r), r"\s+", " ")), F.lit(60)))))
    return F.when(t["text"].rlike(ROLE), found).otherwise(F.array().cast("array<string>"))


def people(t: Column, links: Column, pattern: str, titled) -> Column:
    """People of a page's headings: ``name, ord, own`` (the text that is theirs alone), ``hint, link``; headings of articles don't count.

    ``pattern`` takes the name out of a heading, ``titled`` tells which headings can have one.
    """
    heads = F.filter(F.filter(t["all"], lambda h: h["tag"].isin(*HEADINGS)), lambda h: titled(said(t, h)) & ~is_article(said(t, h)))
    nobody = F.array().cast("array<struct<name:string,ord:int,own:string,hint:string,link:string>>")

    def of(heads: Column, d: Column) -> Column:
        def told(h: Column) -> Column:
            name = F.trim(F.regexp_replace(F.regexp_extract(said(t, h), pattern, 1), r"\s+", " "))
            return F.struct(name.alias("name"), h["pre"].alias("ord"), own_text(t, h, size(h) + 40, d).alias("own"), hint(t, h).alias("hint"), person_link(t, h, links, name).alias("link"))

        return F.transform(heads, told)

    return once(heads, lambda own: F.when(F.size(own) > 0, once(doctor_headings(t), lambda d: of(own, d))).otherwise(nobody))
