"""Ratings, followers and other numbers out of stored pages and API answers, as column expressions.

Every extractor is a cascade: the first method that finds something wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


from .text import once


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _one(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group), F.lit(""))


def _count(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("long")


def located(text: Column | str, pattern: str) -> Column:
    """All matches of a pattern with one group: ``value, at``; ``at`` is where the match ends."""
    t = F.coalesce(_col(text), F.lit(""))
    whole, gaps = F.regexp_extract_all(t, F.lit(f"(?:{pattern})"), F.lit(0)), F.split(t, f"(?:{pattern})", -1)
    values = F.regexp_extract_all(t, F.lit(pattern), F.lit(1))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<value:string,at:int>>").alias("out"))
    parts = F.arrays_zip(whole.alias("w"), values.alias("v"), F.slice(gaps, 1, F.size(whole)).alias("g"))

    def step(acc: Column, p: Column) -> Column:
        at = acc["at"] + F.length(p["g"]) + F.length(p["w"])
        return F.struct(at.alias("at"), F.concat(acc["out"], F.array(F.struct(p["v"].alias("value"), at.alias("at")))).alias("out"))

    return F.when(F.size(whole) > 0, F.aggregate(parts, zero, step, lambda a: a["out"])).otherwise(F.array().cast("array<struct<value:string,at:int>>"))


RATING, REVIEWS = r"([1-5]\.[0-9])", r"([0-9][0-9,]*) (?:reviews|ratings|google reviews)"


def rating(html: Column | str) -> Column:
    """``rating double, reviews long, method`` of a listing page, by eight methods in order.

    Structured data, labels, data attributes, microdata and texts of growing
    looseness; last, the largest count on the page with the rating nearest to it.
    """
    h = F.coalesce(_col(html), F.lit(""))
    low = F.lower(h)
    pairs = [
        ("jsonld", _one(h, r'"ratingValue"\s*:\s*"?([0-9.]+)'), _one(h, r'"(?:reviewCount|ratingCount)"\s*:\s*"?([0-9,]+)')),
        ("label", _one(low, r'aria-label="' + RATING + r" stars?[^\"]*\""), _one(low, r'aria-label="[^"]*?' + REVIEWS)),
        ("data", _one(low, r'data-value="' + RATING + '"'), _one(low, r'data-count="([0-9,]+)"')),
        ("microdata", _one(low, r'itemprop="ratingvalue"[^>]*content="([0-9.]+)"'), _one(low, r'itemprop="(?:reviewcount|ratingcount)"[^>]*content="([0-9,]+)"')),
        ("brackets", _one(low, RATING + r" ?\([0-9,]+\)"), _one(low, r"[1-5]\.[0-9] ?\(([0-9,]+)\)")),
        ("stars", _one(low, RATING + r" stars? [^0-9]{0,20}[0-9,]+ (?:reviews|ratings)"), _one(low, r"[1-5]\.[0-9] stars? [^0-9]{0,20}([0-9,]+) (?:reviews|ratings)")),
        ("rated", _one(low, r"rated " + RATING + r" (?:out of|/) ?5"), _one(low, r"(?:based on|from) ([0-9,]+) (?:reviews|ratings)")),
    ]
    tried = [_bound(F.struct(v.try_cast("double").alias("rating"), _count(n).alias("reviews"), F.lit(name).alias("method")), _is_rating) for name, v, n in pairs]
    counts = F.transform(located(low, REVIEWS), lambda x: F.struct(_count(x["value"]).alias("n"), (-x["at"]).alias("back")))
    marks = located(low, RATING)

    def nearest(most: Column) -> Column:
        best = F.array_min(F.transform(marks, lambda m: F.struct(F.abs(m["at"] + most["back"]).alias("d"), m["at"].alias("at"), m["value"].alias("value"))))
        return F.struct(best["value"].try_cast("double").alias("rating"), most["n"].alias("reviews"), F.lit("nearest").alias("method"))

    # the largest count, the first of equals, worked out once
    last = F.filter(F.transform(F.array(F.array_max(counts)), lambda most: F.when(most.isNotNull(), nearest(most))), lambda s: s.isNotNull() & _is_rating(s))
    return F.coalesce(*tried, F.try_element_at(last, F.lit(1)))


def _is_rating(s: Column) -> Column:
    return F.coalesce(s["rating"].between(1, 5), F.lit(False))


def _bound(value: Column, test) -> Column:
    """A value if it passes a test, else NULL; worked out once (a column used twice is worked out twice)."""
    return F.try_element_at(F.filter(F.array(value), test), F.lit(1))


def search_rating(html: Column | str) -> Column:
    """The shorter cascade for search result pages: structured data, label, data value, microdata, text."""
    return _bound(rating(html), lambda r: r["method"].isin("jsonld", "label", "data", "microdata", "brackets", "stars"))


def yelp_rating(html: Column | str) -> Column:
    low = F.lower(F.coalesce(_col(html), F.lit("")))
    return F.struct(_one(low, r'aria-label="([1-5](?:\.[0-9])?) star rating"').try_cast("double").alias("rating"), _count(_one(low, r"([0-9,]+) reviews")).alias("reviews"))


def place_pick(candidates: Column | str, city: Column | str, state: Column | str) -> Column:
    """Of listing candidates: the first in the city or state with a rating, else the first."""
    c = _col(candidates)
    near = F.filter(c, lambda p: p["rating"].isNotNull() & (F.contains(F.lower(p["formatted_address"]), F.lower(_col(city))) | F.contains(p["formatted_address"], _col(state))))
    return F.when(F.size(near) > 0, F.element_at(near, 1)).when(F.size(c) > 0, F.element_at(c, 1))


def place_text_pick(candidates: Column | str, city: Column | str, state: Column | str) -> Column:
    """Text search: of the first three, the first in the city or state; NULL if none is."""
    near = F.filter(F.slice(_col(candidates), 1, 3), lambda p: F.contains(F.lower(p["formatted_address"]), F.lower(_col(city))) | F.contains(p["formatted_address"], _col(state)))
    return F.when(F.size(near) > 0, F.element_at(near, 1))


# What stands before a page's number of followers in its data, in order of trust.
FOLLOWER_MARKS = (
    r'"followers_count"\s*:\s*', r'"fan_count"\s*:\s*', r'"subscriber_count"\s*:\s*', r'"like_count"\s*:\s*', r'"page_likers"\s*:\s*\{"count"\s*:\s*', r'"likers"\s*:\s*\{"count"\s*:\s*',
    r'"profile_plus_follower_count"\s*:\s*', r'"connected_users_count"\s*:\s*',
)
SOCIAL_CONTEXT = r'(?i)"social_context"[^}]*?"([0-9]+)\s*(?:people\s+)?follow'


def facebook_followers(html: Column | str) -> Column:
    """Numbers in data in order (each mark's first, above 0), then "N followers", then "N likes"; compact forms count."""
    from .formats import from_compact

    h = F.coalesce(_col(html), F.lit(""))
    told = [_one(h, rf"(?i){mark}([0-9]+)") for mark in FOLLOWER_MARKS] + [_one(h, SOCIAL_CONTEXT)]
    seen = lambda verb: from_compact(_one(h, rf"(?i)([0-9,]+(?:\.[0-9]+)?[KMB]?)\s*(?:people\s+)?{verb}"))
    return F.coalesce(*[_bound(_count(n), lambda v: v > 0) for n in told], seen("follow"), seen("like"))


def instagram_counts(html: Column | str) -> Column:
    """``posts, followers``: state blobs, then the page's description, then its text."""
    from .formats import from_compact

    h = F.coalesce(_col(html), F.lit(""))
    blob = [("edge_owner_to_timeline_media\"\\s*:\\s*\\{\\s*\"count", "edge_followed_by\"\\s*:\\s*\\{\\s*\"count"), ("media_count", "follower_count"), ("mediaCount", "followerCount"), ("posts_count", "followers_count"), ("postCount", "followersCount")]
    number = lambda k: _count(_one(h, rf'"{k}"\s*:\s*"?([0-9]+)'))
    posts = [number(p) for p, _ in blob] + [from_compact(_one(h, r"(?i)([0-9][0-9.,]*[KMB]?) posts"))]
    fans = [number(f) for _, f in blob] + [from_compact(_one(h, r"(?i)([0-9][0-9.,]*[KMB]?) followers"))]
    return F.struct(F.coalesce(*posts).alias("posts"), F.coalesce(*fans).alias("followers"))


def tiktok_counts(html: Column | str) -> Column:
    h = F.coalesce(_col(html), F.lit(""))
    number = lambda *ks: F.coalesce(*[_count(_one(h, rf'"{k}"\s*:\s*"?([0-9]+)')) for k in ks])
    return F.struct(number("videoCount", "video_count").alias("videos"), number("followerCount", "follower_count").alias("followers"))


def profile_api_counts(answer: Column | str) -> Column:
    """A profile API's JSON: ``posts, followers``; 0 is a value."""
    a = _col(answer)
    get = lambda *paths: F.coalesce(*[F.get_json_object(a, p).try_cast("long") for p in paths])
    return F.struct(get("$.data.user.edge_owner_to_timeline_media.count", "$.data.user.media_count").alias("posts"), get("$.data.user.edge_followed_by.count", "$.data.user.follower_count").alias("followers"))


# Provider tiers, best first.
TIERS = ("Diamond Plus", "Diamond", "Platinum Plus", "Platinum", "Gold Plus", "Gold", "Silver Plus", "Silver", "Bronze Plus", "Bronze")


def tier(text: Column | str, name: Column | str, reach: int = 600) -> Column:
    """The first tier that stands anywhere near a word of the name (four letters or more); else the first tier at all, to be verified; NULL if there is none."""
    words = F.filter(F.split(F.lower(_col(name)), r"\s+"), lambda w: F.length(w) >= 4)

    def told(s: Column) -> Column:
        near, any_ = [], []
        for label in TIERS:
            low = label.lower()
            parts = F.split(s["low"], low, -1)
            # where the label stands: before it are the parts up to it and the labels between them
            places = F.aggregate(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<int>"), lambda out, p: F.concat(out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)) + len(low), F.lit(0)) + F.length(p))))
            around = lambda at: F.substring(s["low"], F.greatest(at - reach, F.lit(0)) + 1, F.least(at, F.lit(reach)) + reach)  # noqa: B023, E731
            near.append(F.when(F.exists(places, lambda at: once(around(at), lambda c: F.exists(s["words"], lambda w: F.contains(c, w)))), F.lit(label)))
            any_.append(F.when(F.contains(s["low"], F.lit(low)), F.lit(f"{label} (verify name match)")))
        return F.coalesce(*near, *any_)

    return once(F.struct(F.lower(F.coalesce(_col(text), F.lit(""))).alias("low"), words.alias("words")), told)


# How texts tell a number of hygienists, and a hygienist's credential.
HYGIENIST_NUMBERS = (
    r"\b([0-9]+)\s+(?:registered\s+)?(?:dental\s+)?hygienists?", r"\b([0-9]+)\s+r\.?d\.?h\.?s?\b", r"hygienists?\s*(?:on\s+(?:staff|our\s+team|the\s+team))?[:\s]+([0-9]+)",
    r"\b([0-9]+)\s+(?:licensed\s+)?dental\s+hygiene\s+(?:specialists?|therapists?|professionals?)",
)
HYGIENIST_TITLE = r"(?i:R\.?D\.?H\.?|BSDH|RDHAP|Registered\s+Dental\s+Hygienist|Licensed\s+Dental\s+Hygienist|Dental\s+Hygienist)"
FULL_NAME = r"[A-Z][a-z]+(?:\s+[A-Z]\.?)?\s+[A-Z][a-z]+"


def hygienists(text: Column | str) -> Column:
    """Number of hygienists a text tells: a number, else distinct full names before the credential, else distinct first names before it; NULL if none.

    Names are looked for in cased text, so a sentence about "our gentle dental
    hygienist" names nobody.
    """
    t = F.coalesce(_col(text), F.lit(""))
    said = F.coalesce(*[_count(_one(t, f"(?i){p}")) for p in HYGIENIST_NUMBERS])
    names = lambda p: F.nullif(F.size(F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(p), F.lit(1)), lambda n: F.lower(n)))), F.lit(0))
    return F.coalesce(said, names(rf"({FULL_NAME})\s*,?\s*{HYGIENIST_TITLE}"), names(rf"\b([A-Z][a-z]{{2,}})\s*,?\s+{HYGIENIST_TITLE}")).cast("long")


def json_find(json: Column | str, key: str, paths: tuple[str, ...] = ()) -> Column:
    """A key's value at the given paths, else wherever the key first stands in the text."""
    j = _col(json)
    tried = [F.get_json_object(j, p) for p in paths]
    return F.coalesce(*tried, _one(j, rf'"{key}"\s*:\s*"([^"]*)"'), _one(j, rf'"{key}"\s*:\s*(-?[0-9.]+|true|false)'))
