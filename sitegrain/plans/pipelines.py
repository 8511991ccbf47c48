"""The update pipelines: parse once, derive, merge, compare. Page fetching lies outside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as nm
from ..functions import tree
from ..functions.html import parse_pages
from ..functions.people import names_in
from ..functions.signals import hygienists, rating
from ..functions.text import email_by_priority, first_phone, locations, once
from ..functions.urls import SITES, is_content, is_profile, netloc, path, without_fragment
from ..operators import entity, features, merge
from ..operators.diff import field_diff, roster_diff
from ..schema import COUNTS, FLAGS
from ..staging import staged

DOCTOR_HEADING = r"^(?:Dr\.? +)?([A-ZÀ-Þ][A-Za-zÀ-ÿ'.-]+(?: [A-ZÀ-Þ][A-Za-zÀ-ÿ'.-]*){1,3})(?:,? *(?:DDS|DMD|D\.D\.S\.?|D\.M\.D\.?|MD|PhD|MS))*$"
#: People told, a key.
TOLD = 30


def page_people() -> Column:
    """People of a parsed page's headings, with what the page says of each alone."""
    return tree.people(tree.tree(), F.col("links"), DOCTOR_HEADING, nm.looks_titled)


def staff(parsed: DataFrame, key: list[str], cap: int = TOLD) -> DataFrame:
    """People named by headings with a title or credential, then by cards of staff; a row a person and key: rank, name, what is said of them, a hint, a link, the page. No blogs, no "names" made of the site's own address.

    The same spelling is taken once a key (its first place); names whose words
    are all in a longer one go. Neither step brings a key's names together, so a
    directory of very many people is spread over tasks until its first ``cap``,
    longest names first, are left.
    """
    rows = parsed.filter(~is_content("url"))
    if "people" not in rows.columns:
        rows = rows.withColumn("people", page_people())
    at = lambda kind: F.struct(F.col("page_ord").cast("long").alias("page_ord"), F.lit(kind).alias("kind"), F.col("ord").cast("int").alias("ord")).alias("pos")
    heads = rows.select(*key, "url", "page_ord", F.explode("people").alias("p")).select(*key, "url", "page_ord", "p.*")
    heads = heads.select(*key, "url", at(0), "name", F.col("own").alias("bio"), "hint", "link")
    if "cards" in parsed.columns:
        none = F.lit(None).cast("string")
        cards = rows.select(*key, "url", "page_ord", F.posexplode("cards").alias("ord", "card"))
        cards = cards.select(*key, "url", at(1), F.try_element_at(names_in("card", 1), F.lit(1)).alias("name"), F.col("card").alias("bio"), none.alias("hint"), none.alias("link")).filter("name IS NOT NULL")
        heads = heads.unionByName(cards)
    named = heads.filter(nm.is_found_name("name") & ~nm.in_host("name", netloc("url")))
    once = named.groupBy(*key, F.lower("name").alias("__low")).agg(F.min_by(F.struct("pos", "name", "bio", "hint", "link", "url"), "pos").alias("x"))
    kept = entity.longest(once.select(*key, "x.*"), key)
    first = Window.partitionBy(*key).orderBy(F.desc("n_words"), "pos", "name")
    ranked = kept.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= cap)
    return ranked.select(*key, (F.col("rank") - 1).alias("rank"), "name", "bio", "hint", "link", "url")


#: Where a person's specialty and memberships are looked for, in order of trust.
EVIDENCE = ("card", "slug page", "bio page", "scoped text", "whole site", "hint")


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9à-ÿ]+"), lambda w: F.length(w) >= 2))


def evidence(people: DataFrame, pages: DataFrame, key: list[str]) -> DataFrame:
    """Every text that may tell a person's specialty and memberships: ``rank, name, source, page_ord, specialty, associations``.

    Who is told in full by their own card is looked for nowhere else. ``source`` counts EVIDENCE from 1: the text of the person's own card or heading; pages with the last name in their
    address; the page a card links to; what other pages' headings with the last name say; the whole site, where it has one
    person; the hint beside the name. People meet pages by equal words (last name and word of the address or of
    a heading), not one by one. ``pages`` are parsed pages; people are those of ``staff``.

    Both are read from written tables, whose files are many times smaller than
    their rows: Spark would broadcast by the files' size what the driver can't
    hold, so these joins are by sorting.
    """
    none = F.array().cast("array<string>")
    said = lambda c: [F.nullif(features.specialty(F.col(c), policy="all"), F.lit("")).alias("specialty"), features.associations(F.col(c), sections=True).alias("associations")]
    cards = staged(people.select(*key, "rank", "name", F.lit(1).alias("source"), F.lit(0).cast("long").alias("page_ord"), "hint", "link", *said("bio")), "cards")
    own = cards.drop("hint", "link")
    rest = cards.filter("specialty IS NULL OR size(associations) = 0")
    who = rest.select(*key, "rank", "name", F.element_at(F.split(nm.normalised("name"), " "), -1).alias("__last"), without_fragment("link").alias("__link")).hint("merge")
    hints = rest.filter("hint IS NOT NULL").select(*key, "rank", "name", F.lit(6).alias("source"), F.lit(0).cast("long").alias("page_ord"), F.coalesce(F.nullif(features.specialty(F.col("hint"), policy="all"), F.lit("")), F.col("hint")).alias("specialty"), none.alias("associations"))
    usable = pages.filter(~is_content("url")).select(*key, "url", F.col("page_ord").cast("long").alias("page_ord"), "text", "elements", "headings").hint("merge")
    keyed = usable.select(*key, "page_ord", without_fragment("url").alias("__url"), tokens(path("url")).alias("__way"), tokens(F.array_join(F.transform("headings", lambda h: h["text"]), " ")).alias("__heads"))
    slugs = keyed.select(*key, "page_ord", F.explode("__way").alias("__last")).join(who, [*key, "__last"]).select(*key, "page_ord", "rank", "name", F.lit(2).alias("source"))
    links = keyed.select(*key, "page_ord", F.col("__url").alias("__link")).join(who, [*key, "__link"]).select(*key, "page_ord", "rank", "name", F.lit(3).alias("source"))
    heads = keyed.select(*key, "page_ord", F.explode("__heads").alias("__last")).join(who, [*key, "__last"]).select(*key, "page_ord", "rank", "name", F.lit(4).alias("source"))
    alone = cards.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.first("rank").alias("rank"), F.first("name").alias("name")).filter("__n = 1").join(who.select(*key), key, "left_semi")
    whole = keyed.select(*key, "page_ord").join(alone.drop("__n"), key).select(*key, "page_ord", "rank", "name", F.lit(5).alias("source"))
    asked = slugs.unionByName(links).unionByName(heads).unionByName(whole).distinct()
    t, of = tree.tree(), nm.normalised("name")
    text = F.when(F.col("source") == 5, F.col("text")).otherwise(once(of, lambda n: F.coalesce(tree.scoped_text(t, n), F.when(F.col("source") != 4, tree.bio_block(t, n)))))
    met = asked.join(usable, [*key, "page_ord"]).select(*key, "rank", "name", "source", "page_ord", F.coalesce(text, F.lit("")).alias("__t"))
    return own.unionByName(hints).unionByName(met.select(*key, "rank", "name", "source", "page_ord", *said("__t")))


def doctors(parsed: DataFrame, key: list[str]) -> DataFrame:
    """Per-doctor fields: specialty and memberships, each from the first source by trust, then by page, that tells any."""
    people = staged(staff(parsed, key), "people")
    rows = evidence(people, parsed, key)
    order = F.struct("source", "page_ord")
    best = rows.groupBy(*key, "rank", "name").agg(
        F.min_by("specialty", F.when(F.col("specialty").isNotNull(), order)).alias("specialty"),
        F.min_by("associations", F.when(F.size("associations") > 0, order)).alias("associations"),
    )
    return best.select(*key, "rank", "name", "specialty", F.coalesce("associations", F.array().cast("array<string>")).alias("associations"))


def page_socials() -> list[Column]:
    """A page's first valid profile address of each site, by link order."""
    first = lambda s: F.try_element_at(F.transform(F.filter("links", lambda x: is_profile(x["href"], s)), lambda x: x["href"]), F.lit(1)).alias(f"{s}_url")
    return [first(s) for s in SITES]


#: How hygienists are counted: by texts unless markup names some; by texts, else the first page that names some; by texts, else lines that speak of one.
HYGIENIST_POLICIES = ("scrape", "reprocess", "refresh")


def page_contact(policy: str = "scrape") -> list[Column]:
    """A page's email by priority (hidden links, mail links, text, contact blocks), phone, places, hygienists in its text and in its markup."""
    team = tree.anonymous_hygienists(tree.tree()) if policy == "refresh" else tree.hygienist_names(tree.tree())
    return [
        email_by_priority(F.col("hidden"), F.col("mailtos"), F.col("text"), F.col("contacts")).alias("email"), first_phone("text").alias("phone"), F.nullif(locations("text", F.col("links")), F.lit("1")).alias("locations_count"),
        hygienists("text").alias("hygienists"), team.alias("team"),
    ]


def count_hygienists(slim: DataFrame, key: list[str], policy: str = "scrape") -> DataFrame:
    """``hygienists`` a key, of pages' ``hygienists`` (texts) and ``team`` (names or lines of markup)."""
    told = slim.groupBy(*key).agg(F.min_by("hygienists", F.when(F.col("hygienists").isNotNull(), F.col("page_ord"))).alias("__told"), F.min_by(F.size("team"), F.when(F.size("team") > 0, F.col("page_ord"))).alias("__page"))
    team = slim.select(*key, F.explode("team").alias("who")).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("__team"))
    order = {"scrape": ("__team", "__told"), "reprocess": ("__told", "__page", "__team"), "refresh": ("__told", "__team")}[policy]
    return told.join(team, key, "left").select(*key, F.coalesce(*[F.nullif(F.col(c).cast("long"), F.lit(0).cast("long")) for c in order]).alias("hygienists"))


def extract(pages: DataFrame, key: list[str] = ["practice_id"], policy: str = "scrape") -> DataFrame:  # noqa: B006
    """Re-extraction: one row a practice with counts, flags, contact, socials, testimonials, hygienists and doctors, out of stored pages.

    Each page is parsed once; what later steps need of it is written as a table
    of which each step reads its own columns, so that neither lost executors
    nor several readers parse a page again (``staging.clear`` deletes it). A
    null key is a practice of its own.
    """
    from ..rules import SERVICES, TECHNOLOGY

    inner = [f"__key{k}" for k in range(len(key))]
    named = pages.withColumns({i: F.struct(F.col(k).alias("v")) for i, k in zip(inner, key)})  # a struct is never null, so joins keep null keys
    parsed = features.prepared(parse_pages(named))
    hyg = policy if policy in HYGIENIST_POLICIES else "scrape"
    slim = parsed.select(*inner, "url", "page_ord", "headings", "cards", "text", "elements", page_people().alias("people"), *features.page_counts(policy), *features.page_flags(policy), *page_contact(hyg), *page_socials(), features.page_testimonials(policy if policy in ("scrape", "reprocess", "refresh") else "scrape").alias("said"))
    slim = staged(slim, "pages")
    counts = features.sum_counts(slim, inner, policy, list(SERVICES)).withColumn("dental_plan", features.mentioned(F.col("dental_plan")))
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("page_ord"))).alias(c) for c in ("email", "phone", "locations_count", *[f"{s}_url" for s in SITES])]
    rest = slim.groupBy(*inner).agg(*[F.max(c).alias(c) for c in TECHNOLOGY], *firsts).withColumn("locations_count", F.coalesce("locations_count", F.lit("1")))
    people = doctors(slim, inner).groupBy(*inner).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "name", "specialty", "associations"))), lambda d: F.struct(d["name"].alias("name"), d["specialty"].alias("specialty"), d["associations"].alias("associations"))).alias("doctors"))
    people = people.withColumn("doctor_names", F.array_join(F.transform("doctors", lambda d: d["name"]), ", "))
    out = counts.join(rest, inner, "left").join(count_hygienists(slim, inner, hyg), inner, "left").join(features.count_testimonials(slim, inner), inner, "left").join(people, inner, "left")
    return out.select(*[F.col(f"{i}.v").alias(k) for i, k in zip(inner, key)], *[c for c in out.columns if c not in inner])


def refresh(batch: DataFrame, extracted: DataFrame, key: str = "idx") -> tuple[DataFrame, DataFrame]:
    """Batch rows with counts and flags that never get less, and the comparison of before and after."""
    fields = [c for c in [*FLAGS, *COUNTS, "dental_plan", "testimonials", "hygienists"] if c in batch.columns and c in extracted.columns]
    own = merge.monotone(batch.select(key, *fields).unionByName(extracted.select(key, *[F.col(f).cast(batch.schema[f].dataType) for f in fields])), [key])
    after = batch.drop(*fields).join(own, key, "left").select(*batch.columns)
    first = batch.groupBy(key).agg(*[F.min_by(f, "pos").alias(f) for f in fields]) if "pos" in batch.columns else batch.groupBy(key).agg(*[F.max(f).alias(f) for f in fields])
    return after, field_diff(first, own, key, fields)


def refresh_doctors(batch: DataFrame, people: DataFrame, key: str = "idx") -> tuple[DataFrame, DataFrame]:
    """Practices for which doctors were found get a row for each, on their first row as a template; the others keep theirs."""
    first = batch.groupBy(key).agg(F.min_by(F.struct(*[c for c in batch.columns if c != key]), "pos").alias("t"))
    new = first.join(people.select(key, "rank", "name", "specialty", "associations"), key)
    cells = {"doctor_name": F.col("name"), "specialty": F.coalesce("specialty", F.lit("Not Found")), "associations": F.coalesce(F.nullif(F.array_join("associations", ", "), F.lit("")), F.lit("Not Found")), "pos": F.struct(F.col("t.pos").cast("long").alias("row"), F.col("rank").cast("long").alias("rank"))}
    rows = new.select(*[cells[c].alias(c) if c in cells else F.col(key) if c == key else F.col(f"t.{c}").alias(c) for c in batch.columns])
    after = merge.replace_rows(batch.withColumn("pos", F.struct(F.col("pos").cast("long").alias("row"), F.lit(0).cast("long").alias("rank"))), rows, key)
    return after, roster_diff(batch, after, key)


def dedup_doctors(batch: DataFrame, key: str = "idx") -> DataFrame:
    """A batch with one row a person: names that are the practice's go if others are there; clusters by PERSON; practice cells from the first row, filled from later ones."""
    marked = batch.withColumn("__own", nm.person_form("practice_name") == nm.person_form("doctor_name"))
    alone = marked.groupBy(key).agg(F.min("__own").alias("__all"))
    rows = marked.join(alone, key).filter(~F.col("__own") | F.col("__all")).drop("__own", "__all")
    people = entity.person(rows.select(key, "pos", F.col("doctor_name").alias("name"), "specialty", "associations"), key)
    fields = [c for c in batch.columns if c not in (key, "pos", "doctor_name", "specialty", "associations")]
    shared = merge.template(rows, key, fields)
    return people.join(shared, key).select(*[F.col("name").alias("doctor_name") if c == "doctor_name" else F.col(c) for c in batch.columns])


def fill_specialty(batch: DataFrame, found: DataFrame, key: str = "idx") -> DataFrame:
    """Missing specialty and memberships from what was found for that doctor of that practice."""
    return merge.fill_where(batch, found, [key, "doctor_name"], ["specialty", "associations"])


def fill_social(batch: DataFrame, found: DataFrame, site: str, key: str = "idx") -> DataFrame:
    """Counts of a profile where it is known and they aren't; a blank partner becomes "See Page"."""
    from ..functions.missing import is_missing

    where = ~is_missing(f"{site}_url", "social") & is_missing(f"{site}_followers", "social")
    filled = merge.fill_where(batch, found, [key], [f"{site}_posts", f"{site}_followers"], where, "social")
    return filled.withColumn(f"{site}_posts", F.when(~is_missing(f"{site}_url", "social") & is_missing(f"{site}_posts", "social") & ~is_missing(f"{site}_followers", "social"), F.lit("See Page")).otherwise(F.col(f"{site}_posts")))


def ratings(batch: DataFrame, answers: DataFrame) -> DataFrame:
    """Ratings looked up once a domain (answers: ``domain_key, html``) for all rows of it."""
    from ..functions.urls import domain_key

    found = answers.select(F.col("domain_key"), rating("html").alias("r")).filter("r IS NOT NULL").select("domain_key", F.col("r.rating").alias("google_rating"), F.col("r.reviews").cast("int").alias("google_reviews"))
    return merge.back_join(batch, domain_key("website"), found, "domain_key", ["google_rating", "google_reviews"])


def supplement(have: Column, found: Column, most: int = 5) -> Column:
    """More doctors from other pages, unless there are enough."""
    from ..operators.match import union_names

    return F.when(F.size(have) >= most, have).otherwise(union_names(have, found))


def chain_locations(pages: DataFrame, states: DataFrame, people: DataFrame | None = None, key: str = "idx") -> DataFrame:
    """A chain's locations: each field from the embedded state, else from JSON-LD, else from the page's address; people likewise, else from the text, else from the registry.

    ``pages`` are parsed pages with ``jsonld``, ``text`` and ``url``; ``states``
    has the key and a JSON text ``state``.
    """
    from ..functions.structured import organisations, page_states
    from ..functions.urls import place_parts, slug_address

    fields = ["phone", "street", "city", "state", "zip", "rating", "reviews"]
    place = place_parts("url")
    own = pages.select(key, first_phone("text").alias("phone"), F.nullif(slug_address(place["slug"]), F.lit("")).alias("street"), place["city"].alias("city"), place["state"].alias("state"), F.lit(None).cast("string").alias("zip"), F.lit(None).cast("double").alias("rating"), F.lit(None).cast("long").alias("reviews"))
    told = merge.fill_empty(page_states(states, [key]).select(key, *fields), organisations(pages, [key]).select(key, *fields), own, key=[key])
    rows = told.join(page_states(states, [key]).select(key, F.col("people").alias("a")), key, "left").join(organisations(pages, [key]).select(key, F.col("people").alias("b")), key, "left").join(pages.select(key, names_in("text").alias("c")), key, "left")
    if people is not None:
        rows = rows.join(people.groupBy(key).agg(F.sort_array(F.collect_set("person")).alias("d")), key, "left")
    lists = [F.when(F.size(c) > 0, F.col(c)) for c in ("a", "b", "c", *(["d"] if people is not None else []))]
    return rows.select(key, *fields, F.coalesce(*lists, F.array().cast("array<string>")).alias("people"))


def cascade(primary: DataFrame, *fallbacks: DataFrame, key: str = "idx", policy: str = "bypass") -> DataFrame:
    """Fallback acquisitions in order of trust: a practice that the first couldn't reach or found nothing of takes each missing field from the first fallback that has it.

    Adds ``filled_from``: how many sources were needed (0: the first alone).
    Practices that the first reached stay as they are.
    """
    from ..functions.missing import is_missing
    from ..sources.listings import blocked, empty_result

    counts = tuple(c for c in ("implants", "veneers", "invisalign", "whitening", "sedation") if c in primary.columns)
    poor = primary.filter(blocked(primary, policy) | empty_result(counts, policy))
    fields = [c for c in primary.columns if c != key]
    filled = merge.fill_empty(poor, *[f.join(poor.select(key), key, "left_semi") for f in fallbacks], key=[key], policy=policy)
    rank = None
    for k, f in enumerate(fallbacks, 1):
        known = F.lit(False)
        for c in fields:
            if c in f.columns:
                known = known | ~is_missing(F.col(c), policy)
        own = f.select(key, F.when(known, F.lit(k)).alias("k"))
        rank = own if rank is None else rank.unionByName(own)
    used = rank.groupBy(key).agg(F.max("k").alias("filled_from"))
    rows = filled.select(key, *[F.col(c).cast(primary.schema[c].dataType).alias(c) for c in fields]).join(used, key, "left").withColumn("filled_from", F.coalesce("filled_from", F.lit(0)))
    kept = primary.join(poor.select(key), key, "left_anti").withColumn("filled_from", F.lit(0))
    return kept.unionByName(rows)
