"""Which links to follow next: pure selection over a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import literals
from ..functions.urls import is_content, is_portal, path, without_fragment

# Begins of path parts that tell a page of services, of the team, of testimonials; words of links to the team; budgets a level (full, small).
SERVICE = ("service", "treatment", "technology", "tech", "procedure", "offer", "speciali", "invisalign", "implant", "veneer", "whitening", "cerec", "laser", "sedation", "cbct", "intraoral", "aligner")
TEAM = ("team", "staff", "about", "hygien", "doctor", "provider", "meet")
TESTIMONIAL = ("testimonial", "review", "patient", "feedback")
TEAM_TEXTS = (
    "our dentist", "our doctor", "meet the team", "meet our team", "meet the doctor", "our team", "our provider", "our staff", "the team", "about the doctor", "our doctors", "about us", "about our team", "our hygienist",
    "meet your dentist", "meet our dentist", "our location", "our physicians", "our practitioners", "our providers", "dental team", "dental staff", "clinical team", "meet our doctors", "meet the dentist", "meet dr",
    "our associates", "our specialists",
)
TEAM_ADDRESSES = (
    "doctor", "dentist", "team", "provider", "staff", "meet-the", "about-us", "about_us", "who-we-are", "our-doctor", "our-dentist", "hygienist", "hygiene-team", "about", "physician", "practitioner", "clinician",
    "associate", "dental-team", "our-team", "meet-dr", "our-provider", "/location/", "/locations/", "/office/", "/offices/", "/our-location", "/our-office", "/find-us", "/visit-us",
)
BUDGETS = {"nav": (60, 20), "sitemap": (40, 15), "level1": (60, 20), "level2": (40, 12), "level3": (30, 8)}
UNWANTED = r"\.(?:pdf|jpe?g|png|gif|svg|webp|zip|docx?|mp4)(?:$|\?)|/(?:wp-login|cart|checkout|login|feed)"
OTHER = 9


def priority(url: Column) -> Column:
    """1 services, 2 team, 3 testimonials, 9 the rest: by what begins a part of the path."""
    way = F.lower(F.when(url.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), path(url)).otherwise(F.regexp_extract(url, "^([^?#]*)", 1)))
    of = lambda words: F.exists(literals([f"/{w}" for w in words]), lambda w: F.contains(way, w))
    return F.when(of(SERVICE), 1).when(of(TEAM), 2).when(of(TESTIMONIAL), 3).otherwise(OTHER)


def select_links(links: DataFrame, key: list[str], limit: int = 10, keep_rest: bool = False, href: str = "href", seen: DataFrame | None = None) -> DataFrame:
    """The pages to visit next of each key: by priority, then address; the others only fill up if asked for."""
    rows = links.withColumn("url", without_fragment(href)).filter(~F.lower(F.col("url")).rlike(UNWANTED) & ~is_portal("url"))
    rows = rows.withColumn("priority", priority(F.col("url")))
    if not keep_rest:
        rows = rows.filter(F.col("priority") < OTHER)
    rows = rows.groupBy(*key, "url").agg(F.min("priority").alias("priority"))
    if seen is not None:
        rows = rows.join(seen.select(*key, "url").distinct(), [*key, "url"], "left_anti")
    w = Window.partitionBy(*key).orderBy("priority", "url")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def budget(level: str, small: bool = False) -> int:
    return BUDGETS[level][int(small)]


def staff_links(links: DataFrame, key: list[str], limit: int = 12, href: str = "href", text: str = "text", pos: str | None = None) -> DataFrame:
    """Pages that may show staff, in the order of their links (``pos``; by address without it): a phrase in the link's text or a word in its address; no blogs or news."""
    has = lambda c, words: F.exists(literals(words), lambda w: F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), w))
    rows = links.filter(~is_content(href) & (has(text, TEAM_TEXTS) | has(href, TEAM_ADDRESSES))).withColumn("url", without_fragment(href))
    first = rows.groupBy(*key, "url").agg((F.min(pos) if pos else F.lit(0)).alias("first"))
    w = Window.partitionBy(*key).orderBy("first", "url")
    return first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit).select(*key, "url", "rank")


def best_link(people: DataFrame, links: DataFrame, key: list[str], name: str = "name", least: int = 8) -> DataFrame:
    """The link that fits each person best, the first of equals, if it scores enough.

    What scores enough has the last name in its address or text, so people meet
    links by the first letters of it, which are a piece of those texts; a key's
    people and links aren't multiplied.
    """
    from ..functions.names import link_score, normalised
    from .match import grams

    last = F.element_at(F.split(normalised(name), " "), -1)
    told = F.concat_ws(" ", F.lower("href"), F.lower("text"))
    met = people.withColumn("__gram", grams(last, False)).filter("__gram <> ''").join(links.withColumn("__gram", F.explode(grams(told))), [*key, "__gram"]).drop("__gram")
    pairs = met.withColumn("score", link_score(F.col(name), F.col("href"), F.col("text"))).filter(F.col("score") >= least)
    return pairs.groupBy(*key, name).agg(F.max_by(F.struct("href", "score"), F.struct(F.col("score"), -F.col("pos"))).alias("b")).select(*key, name, "b.href", "b.score")


# Paths of accounts, which sitemaps list and nobody needs.
MEMBER_PATHS = r"/m/|/members/|/login|/reset|/create-account"


def sitemap_links(xml: Column, host: Column) -> Column:
    """Addresses of a sitemap on the same host, without files and accounts."""
    from ..functions.urls import domain_key

    found = F.regexp_extract_all(xml, F.lit(r"(?s)<url>.*?<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))
    return F.filter(found, lambda u: (domain_key(u) == host) & ~F.lower(u).rlike(UNWANTED) & ~F.lower(u).rlike(MEMBER_PATHS))


def sitemap_children(xml: Column) -> Column:
    """An index's sitemaps, those of pages first."""
    found = F.regexp_extract_all(xml, F.lit(r"(?s)<sitemap>.*?<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))
    return F.concat(F.filter(found, lambda u: F.contains(u, F.lit("pages"))), F.filter(found, lambda u: ~F.contains(u, F.lit("pages"))))


def sitemap_pages(sitemaps: DataFrame, roots: DataFrame, depth: int = 4) -> DataFrame:
    """``host, url`` of all pages that stored sitemaps (``url, xml``) list below the roots (``host, url``), over indexes of indexes up to a depth.

    A level is one join by address; an address is opened once a host.
    """
    level = roots.select("host", "url")
    seen, out = level, None
    for k in range(depth + 1):
        opened = level.join(sitemaps.select("url", "xml"), "url")
        found = opened.select("host", F.explode(sitemap_links(F.col("xml"), F.col("host"))).alias("url"))
        out = found if out is None else out.unionByName(found)
        if k < depth:
            level = opened.select("host", F.explode(sitemap_children(F.col("xml"))).alias("url")).distinct().join(seen, ["host", "url"], "left_anti")
            seen = seen.unionByName(level)
    return out.distinct()


def provider_names(links: DataFrame, pages: DataFrame, key: list[str], most: int = 12) -> DataFrame:
    """``key, name``: the doctor each linked provider page (of a key the first ``most`` by address) names, once a key.

    ``links`` has the key, ``page_url`` and ``href``; ``pages`` the ``url`` and ``text`` of stored pages.
    """
    from ..functions.urls import domain_key

    url = F.regexp_replace(F.regexp_replace("href", r"[?#].*$", ""), "/+$", "")
    own = links.filter(F.contains("href", F.lit("/providers/")) & (domain_key("href") == domain_key("page_url"))).select(*key, url.alias("url")).distinct()
    first = own.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy("url"))).filter(F.col("__k") <= most)
    name = F.regexp_extract(F.regexp_replace("text", r"\s+", " "), r"Dr\. ([A-Z][a-z]+(?: [A-Z][a-z]+){1,3})", 1)
    found = first.join(pages.select(F.regexp_replace("url", "/+$", "").alias("url"), name.alias("name")).filter("name <> ''"), "url")
    return found.groupBy(*key, F.lower("name").alias("__low")).agg(F.min_by("name", "__k").alias("name")).drop("__low")


# Where an email is looked for, in order.
EMAIL_PATHS = ("/contact", "/contact-us", "/contact-us/", "/about", "/about-us", "/reach-us", "/get-in-touch", "/")


def email_by_paths(pages: DataFrame, key: list[str]) -> DataFrame:
    """``key, email``: of a site's stored pages (``url, html, text, hidden``) at the paths where addresses stand, the first good one: in the markup, a hidden link, the text."""
    from ..functions.text import decode_hidden_email, first_email, is_bad_email, once
    from ..functions.urls import path

    at = F.array_position(F.array(*[F.lit(p) for p in EMAIL_PATHS]), F.when(path("url") == "", F.lit("/")).otherwise(path("url")))
    good = lambda c: once(first_email(c, "plain"), lambda e: F.when(~is_bad_email(e, True), e))
    hidden = F.try_element_at(F.filter(F.transform("hidden", decode_hidden_email), lambda e: F.coalesce(~is_bad_email(e), F.lit(False))), F.lit(1))
    rows = pages.select(*key, at.alias("__at"), F.coalesce(good("html"), hidden, good("text")).alias("email")).filter("__at > 0 AND email IS NOT NULL")
    return rows.groupBy(*key).agg(F.min_by("email", "__at").alias("email"))


def best_first(starts: DataFrame, links: DataFrame, key: list[str], limit: int = 10, pages: DataFrame | None = None) -> DataFrame:
    """``key, rank, priority, url``: the pages a crawl of each site visits, always the best it knows of, up to ``limit``.

    A site's queue begins with its start (``key, url``); the page of the best
    priority, then smallest address, leaves it; the page's links on the same
    host that lead to services, team or testimonials join it, unless they were
    visited. All sites go a step at a time: a step is an aggregation (each
    site's best) and a join by page (what the best ones link to), so a site of
    very many links is spread like any other. ``links``: ``key, page, href``
    (whole addresses). With ``pages`` (``key, url``), what isn't stored counts
    as not answering: it takes no place among the pages. Starts on portals
    aren't followed.
    """
    from ..functions.urls import domain_key
    from ..staging import staged

    plain = lambda c: F.rtrim(without_fragment(c), F.lit("/"))
    begin = starts.filter(~is_portal("url")).select(*key, plain("url").alias("url")).filter("url <> ''").distinct().withColumn("priority", F.lit(0))
    edges = links.filter(~F.lower("href").rlike("^(?:mailto|tel):") & (domain_key("page") == domain_key("href")))
    edges = edges.select(*key, plain("page").alias("from"), plain("href").alias("url")).withColumn("priority", priority(F.col("url"))).filter((F.col("priority") < OTHER) & (F.col("url") != "")).distinct()
    if pages is not None:
        stored = pages.select(*key, plain("url").alias("url")).distinct()
        begin, edges = begin.join(stored, [*key, "url"], "left_semi"), edges.join(stored, [*key, "url"], "left_semi")
    edges, open_, visited = staged(edges, "edges"), staged(begin, "queue"), None
    for rank in range(1, limit + 1):
        best = staged(open_.groupBy(*key).agg(F.min(F.struct("priority", "url")).alias("b")).select(*key, F.lit(rank).alias("rank"), "b.priority", "b.url"), "best")
        if rank > 1 and best.isEmpty():
            break
        visited = best if visited is None else visited.unionByName(best)
        if rank == limit:
            break
        found = best.select(*key, F.col("url").alias("from")).join(edges, [*key, "from"]).select(*key, "url", "priority")
        rest = open_.unionByName(found).groupBy(*key, "url").agg(F.min("priority").alias("priority"))
        open_ = staged(rest.join(visited.select(*key, "url"), [*key, "url"], "left_anti"), "queue")
    return visited
