"""Features of a practice out of its pages' texts, by rule packs and policies.

Input is a table with a row a page: a key, an order, ``url``, and texts. Counts
and flags are computed per page by one pass of all words over its texts (no row
blow-up, no join), then summed by key with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.formats import title
from ..functions.keywords import capped_sum, hits, listed, of_category
from ..functions.text import keyword_sum, literals, once, quoted, whole_word
from ..functions.urls import without_fragment
from ..rules import ASSOCIATIONS, BROAD_SPECIALTIES, CASED_CODES, COUNT_POLICIES, EDUCATION, EDUCATION_WORDS, FALLBACK, FLAG_POLICIES, NO_CODES, SERVICES, SPECIALTIES, TECHNOLOGY, TESTIMONIAL_POLICIES, WHOLE_WORDS


def one_per_page(pages: DataFrame, key: list[str], policy: str, url: str = "url", order: str = "page_ord") -> DataFrame:
    """One row for each page of a key; pages are the same by address, with or without its fragment. The first by order stays.

    The whole rows go through the aggregation, so they should be narrow (counts, no texts).
    """
    page = without_fragment(url) if COUNT_POLICIES[policy]["page_key"] == "no_fragment" else F.col(url)
    others = [c for c in pages.columns if c not in key]
    kept = pages.withColumn("__page", F.coalesce(page, F.col(order).cast("string"))).groupBy(*key, "__page").agg(F.min_by(F.struct(*others), F.struct(F.col(order), F.xxhash64(*others))).alias("__first"))
    return kept.select(*key, "__first.*")


def prepared(pages: DataFrame, body: str = "body_text", full: str = "text", augmented: str = "aug_text", services: dict[str, list[str]] = SERVICES, technology: dict[str, list[str]] = TECHNOLOGY) -> DataFrame:
    """Adds the texts that keywords are looked for in, each made once a page: ``__body``, ``__full``, ``__aug`` lower-cased, ``__spaced`` with hyphens as spaces.

    And what of the vocabularies occurs in them, each text read once for all
    words (a text nobody asks about isn't read).
    """
    whole = F.col(augmented) if augmented in pages.columns else F.col(full)
    rows = pages.withColumns({"__body": F.lower(body), "__full": F.lower(full), "__aug": F.lower(whole)})
    rows = rows.withColumn("__spaced", F.regexp_replace("__aug", "-", " "))
    words, tools = listed(services)[0], listed(technology)[0]
    own = {f"__words{t}": hits(t, words) for t in ("__body", "__full", "__aug")}
    own |= {"__tools__full": hits("__full", [w.lower() for w in tools]), "__tools__spaced": hits("__spaced", [w.lower().replace("-", " ") for w in tools])}
    return rows.withColumns(own)


def page_counts(policy: str, services: dict[str, list[str]] = SERVICES) -> list[Column]:
    """A prepared page's capped mentions: ``b_<category>`` in its body, ``f_<category>`` in its whole text; ``words``: every word's count in the whole text, where a policy asks for it."""
    p = COUNT_POLICIES[policy]
    words, spans = listed(services)
    whole = F.col("__words__aug" if p["augmented"] else "__words__full")
    if p["combine"] == "best_word":
        most = lambda c: F.array_max(F.transform(of_category(whole, spans[c]), lambda x: F.least(x["n"], F.lit(p["full_cap"]))))
        return [F.coalesce(most(c), F.lit(0)).cast("long").alias(f"f_{c}") for c in services]
    out = [capped_sum(whole, spans[c], p["full_cap"]).alias(f"f_{c}") for c in services]
    if p["combine"] != "full":
        out += [capped_sum(F.col("__words__body"), spans[c], p["body_cap"]).alias(f"b_{c}") for c in services]
    if p.get("extra_page"):
        most = max(p["body_cap"], p["full_cap"])
        names, literal = literals([c for c in services for _ in services[c]]), literals(words)
        out.append(F.transform("__words__full", lambda x: F.struct(names[x["w"]].alias("c"), literal[x["w"]].alias("w"), F.least(x["n"], F.lit(most)).cast("long").alias("n"))).alias("words"))
    return out


def sum_counts(pages: DataFrame, key: list[str], policy: str, categories: list[str], url: str = "url", order: str = "page_ord") -> DataFrame:
    """A row a key: the counts of its distinct pages summed, then body and whole text combined, and capped where the policy says.

    The extra page of all texts together counts each word up to its cap: the
    words that pages have are summed by key and word (small rows, added up
    before the shuffle).
    """
    p = COUNT_POLICIES[policy]
    sums = [c for c in pages.columns if c[:2] in ("b_", "f_")]
    rows = one_per_page(pages.select(*key, url, order, *sums, *(["words"] if p.get("extra_page") else [])), key, policy, url, order)
    top = F.max if p["combine"] == "best_word" else F.sum
    if p.get("extra_page"):
        spread = rows.select(*key, *sums, F.explode(F.concat(F.array(F.struct(F.lit(None).cast("string").alias("c"), F.lit(None).cast("string").alias("w"), F.lit(0).cast("long").alias("n"))), F.col("words"))).alias("x"))
        first = F.col("x.c").isNull()
        per_word = spread.groupBy(*key, F.col("x.c").alias("c"), F.col("x.w").alias("w")).agg(*[F.sum(F.when(first, F.col(s))).alias(s) for s in sums], F.sum("x.n").alias("n"))
        capped = {"b": F.least("n", F.lit(p["body_cap"])), "f": F.least("n", F.lit(p["full_cap"]))}
        own = per_word.groupBy(*key).agg(*[(F.coalesce(F.sum(s), F.lit(0)) + F.coalesce(F.sum(F.when(F.col("c") == s[2:], capped[s[0]])), F.lit(0))).alias(s) for s in sums])
    else:
        own = rows.groupBy(*key).agg(*[top(s).alias(s) for s in sums])

    def both(c: str) -> Column:
        whole = F.col(f"f_{c}")
        if p["combine"] == "max":
            whole = F.greatest(F.col(f"b_{c}"), whole)
        elif p["combine"] == "body_first":
            whole = F.when(F.col(f"b_{c}") > 0, F.col(f"b_{c}")).otherwise(whole)
        if "field_cap" in p:
            whole = F.least(F.greatest(whole, F.lit(p.get("least", 0))), F.lit(p["field_cap"]))
        return F.coalesce(whole, F.lit(0)).cast("long").alias(c)

    return own.select(*key, *[both(c) for c in categories])


def service_counts(pages: DataFrame, key: list[str], policy: str = "scrape", services: dict[str, list[str]] = SERVICES, body: str = "body_text", full: str = "text", augmented: str = "aug_text", url: str = "url", order: str = "page_ord") -> DataFrame:
    """A row a key: mentions of every category over its distinct pages."""
    rows = prepared(pages, body, full, augmented, services).select(*key, url, order, *page_counts(policy, services))
    return sum_counts(rows, key, policy, list(services), url, order)


def fallback_counts(page: Column | str, known: dict[str, Column], terms: dict[str, tuple[list[str], int]] = FALLBACK) -> list[Column]:
    """Counts that are 0 or unknown, from one page's lower-cased text: mentions of a field's words, capped a field; known counts stay."""
    own = lambda f, words, cap: F.least(keyword_sum(page, words), F.lit(cap)).cast("long")
    return [F.when(F.coalesce(known[f].cast("long"), F.lit(0)) == 0, own(f, *terms[f])).otherwise(known[f].cast("long")).alias(f) for f in known if f in terms]


def page_flags(policy: str = "scrape", technology: dict[str, list[str]] = TECHNOLOGY, whole_words: dict[str, str] = WHOLE_WORDS) -> list[Column]:
    """Whether a prepared page speaks of each category. Text and words take the same form."""
    p = FLAG_POLICIES[policy]
    text = "__spaced" if p["spaced"] else "__full"
    flags, (_, spans) = [], listed(technology)
    for c in technology:
        hit = F.size(of_category(F.col(f"__tools{text}"), spans[c])) > 0
        if p["whole_words"] and c in whole_words:
            hit = hit | whole_word(text, whole_words[c])
        flags.append(hit.alias(c))
    return flags


def technology_flags(pages: DataFrame, key: list[str], policy: str = "scrape", technology: dict[str, list[str]] = TECHNOLOGY, whole_words: dict[str, str] = WHOLE_WORDS, body: str = "body_text", full: str = "text", augmented: str = "aug_text") -> DataFrame:
    """A row a key: whether any of its pages speaks of each category."""
    rows = prepared(pages, body, full, augmented, technology=technology).select(*key, *page_flags(policy, technology, whole_words))
    return rows.groupBy(*key).agg(*[F.max(c).alias(c) for c in technology])


def mentioned(count: Column) -> Column:
    return F.when(count > 0, F.lit("Mentioned")).otherwise(F.lit(""))


def page_testimonials(policy: str = "scrape") -> Column:
    """A page's testimonials: whether marked as such, and the begin of the text."""
    p = TESTIMONIAL_POLICIES[policy]
    has = lambda c, marks: c.rlike("|".join(marks)) if marks else F.lit(False)
    of_item = lambda r: F.contains(r["item"], F.lit("review")) if p["item"] else F.lit(False)
    marked = F.filter("reviews", lambda r: (r["tag"].isin(*p["tags"]) & has(r["cls"], p["marks"])) | has(r["data"], p["data"]) | has(r["id"], p["id"]) | of_item(r))
    begin = lambda t: F.left(F.trim(t), F.lit(p["prefix"]))
    return F.array_distinct(F.concat(F.transform(marked, lambda r: F.struct(F.lit(True).alias("m"), begin(r["text"]).alias("t"))), F.transform("quotes", lambda q: F.struct(F.lit(False).alias("m"), begin(q).alias("t")))))


def count_testimonials(pages: DataFrame, key: list[str], column: str = "said") -> DataFrame:
    """Distinct testimonials a key; quotes count where no marked element does."""
    rows = pages.select(*key, F.explode(column).alias("x")).select(*key, "x.m", "x.t").filter("t != ''").distinct()
    return rows.groupBy(*key).agg(F.when(F.count_if("m") > 0, F.count_if("m")).otherwise(F.count(F.lit(1))).cast("int").alias("testimonials"))


def testimonials(pages: DataFrame, key: list[str], policy: str = "scrape") -> DataFrame:
    return count_testimonials(pages.select(*key, page_testimonials(policy).alias("said")), key)


def quoted_list(values) -> str:
    return ", ".join(map(quoted, values))


def associations(text: Column, rules: dict[str, list[str]] = ASSOCIATIONS, sections: bool = False) -> Column:
    """Codes of memberships a text names: a code alone in capitals or a full name, in rule order; then schools, in a text about somebody's education.

    With ``sections``, also every word of two to seven capitals in what follows
    a heading of memberships (cased text is needed), common words apart.
    """

    def told(s: Column) -> Column:
        def hit(rules: dict[str, list[str]]) -> Column:
            # codes in the text's words by one intersection; then, in rule order, those or their full names
            plain = F.array_intersect(literals([c.upper() for c in rules if c not in CASED_CODES]), s["capitals"])
            present = F.concat(plain, F.array_intersect(literals([c for c in rules if c in CASED_CODES]), s["cased"]))
            forms = {c: c if c in CASED_CODES else c.upper() for c in rules}
            rows = F.expr(f"array({', '.join(f'struct({quoted(c)} AS code, {quoted(forms[c])} AS form, array({quoted_list(names)}) AS names)' for c, names in rules.items())})")
            return once(present, lambda own: F.transform(F.filter(rows, lambda r: F.array_contains(own, r["form"]) | F.exists(r["names"], lambda n: F.contains(s["low"], n))), lambda r: r["code"]))

        schooled = s["low"].rlike(rf"\b(?:{'|'.join(EDUCATION_WORDS[:10])})\b|\b(?:{'|'.join(EDUCATION_WORDS[10:])})")
        found = F.concat(hit(rules), F.when(schooled, hit(EDUCATION)).otherwise(F.array().cast("array<string>")))
        if sections:
            words = F.flatten(F.transform(F.regexp_extract_all(s["text"], F.lit(SECTION), F.lit(1)), lambda x: F.regexp_extract_all(x, F.lit(r"\b([A-Z]{2,7})\b"), F.lit(1))))
            found = F.concat(found, F.filter(words, lambda w: ~F.array_contains(literals(NO_CODES), w)))
        return F.array_distinct(found)

    forms = lambda t: F.struct(t.alias("text"), F.lower(t).alias("low"), F.split(F.upper(t), "[^A-Z0-9_]+").alias("capitals"), F.split(t, "[^A-Za-z0-9_]+").alias("cased"))
    return once(F.coalesce(text, F.lit("")), lambda t: once(forms(t), told))


#: A heading of memberships and up to twenty lines after it.
SECTION = r"(?i)(?:member(?:ship)?s?|associations?|affiliations?|credentials?|professional organi[sz]ations?)(?:\s+(?:of|in))?\s*[:–-]?\s*((?:[^\n]{2,200}\n?){1,20})"

# What a sentence says before it names a field, in order of trust, and how many characters of the field are read.
FIELD_TRIGGERS = (
    ("certificate in", 120), ("certificates in", 120), ("certification in", 120), ("certified in", 100), ("additional training in", 100), ("training in", 100), ("continuing education in", 100),
    ("area of specialty", 90), ("area of specialization", 90), ("area of focus", 90), ("area of interest", 90), ("area of expertise", 90),
    ("areas of specialty", 90), ("areas of specialization", 90), ("areas of focus", 90), ("areas of interest", 90), ("areas of expertise", 90),
    ("specializes in", 80), ("specialize in", 80), ("specializing in", 80), ("specialization in", 80), ("specialty is", 70), ("specialty includes", 70), ("specialty include", 70), ("specialty:", 70), ("specialist in", 70),
    ("board-certified", 70), ("board certified", 70), ("expertise in", 70),
)
# Stems of words that a field has one of; words and begins of phrases that it has none of; whole texts that are no field; what ends it.
FIELD_STEMS = (
    "implant", "cosmetic", "esthetic", "orthodont", "invisalign", "aligner", "periodon", "endodon", "prosthodon", "oral surg", "pediat", "sleep apnea", "tmj", "root canal", "extract", "veneer", "whitening", "crown",
    "bridge", "laser", "sedation", "restorat", "preventi", "preventa", "biomimetic", "holistic", "biolog", "clear aligner", "dental implant",
)
NO_FIELD_WORDS = ("dr.", "dds", "dmd", "md", "c-fnp", "np", "pa", "lisw", "lcsw", "aprn", "aspects", "continuing education", "career", "institute", "university", "quote")
NO_FIELD_BEGINS = (
    "view profile", "healthsource", "schedule", "appointment", "every age", "every patient", "for all ages", "of all ages", "all ages", "highest standard", "highest level", "constant pursuit", "committed to",
    "commitment to", "patient care", "our team", "our practice", "throughout my", "throughout her", "throughout his", "i have found", "rewarding", "challenging", "from the", "at the", "and is committ", "and has spoken",
    "passionate about", "dedicated to", "mission is", "believe in", "goal is", "philosophy", "i am very",
)
FILLER = ("dentistry", "dental care", "dental health", "patients", "all patients", "our patients", "patient care", "the best care", "quality care", "comprehensive care", "the community")
FIELD_ENDS = ("while", "as well as", "in addition to", "for every", "when he", "when she", "when they", "and is", "and has", "and was")


def specialty_phrase(text: Column, cap: int = 80, words: int = 9) -> Column:
    """The field a text names after one of the triggers, the first in their order that is one.

    A field is what follows a trigger's first place up to the sentence's end,
    cut where the sentence goes on. It has a word that begins with one of the
    stems (whatever its ending: "implants", "orthodontics"), nothing that prose
    has, at least five characters and at most ``words`` words.
    """
    tidy = lambda c: F.regexp_replace(c, r"^[\s:,;.]+|[\s,;.]+$", "")

    def after(low: Column, trigger: Column) -> Column:
        def clause(at: Column) -> Column:
            own = F.split(F.substring(low, at + F.length(trigger["words"]), trigger["reach"]), r"[.;\n]", 2)[0]
            return F.when(at > 0, tidy(F.regexp_replace(tidy(own), r"^(?:in|includes?)\s+", "")))

        return once(F.instr(low, trigger["words"]), clause)

    def ended(c: Column) -> Column:
        c = F.concat(c, F.lit(" "))
        for end in FIELD_ENDS:
            c = F.substring_index(c, f" {end} ", 1)
        return tidy(F.left(tidy(c), F.lit(cap)))

    def fine(c: Column) -> Column:
        begins = lambda padded, values: F.exists(literals([f" {v}" for v in values]), lambda v: F.contains(padded, v))
        plain = F.concat(F.lit(" "), F.regexp_replace(c, r"[\s,:()/]+", " "), F.lit(" "))
        return once(plain, lambda p: begins(p, FIELD_STEMS) & ~begins(p, NO_FIELD_BEGINS) & ~begins(p, [f"{w} " for w in NO_FIELD_WORDS])) & (F.size(F.split(c, r"\s+")) <= words)

    triggers = F.expr(f"array({', '.join(f'struct({quoted(w)} AS words, {n} AS reach)' for w, n in FIELD_TRIGGERS)})")
    found = once(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[ \t]+", " "), lambda low: F.transform(triggers, lambda t: after(low, t)))
    whole = F.filter(found, lambda c: (F.length(c) >= 5) & ~F.array_contains(literals(FILLER), c))
    return title(F.try_element_at(F.filter(F.transform(whole, ended), fine), F.lit(1)))


def specialty(text: Column, rules: list[tuple[str, list[str]]] = SPECIALTIES, policy: str = "labels5") -> Column:
    """Labels in rule order, joined by " / ".

    ``labels5``: a phrase wins; the broad labels go where two others are; five
    at most; "Not Found" if none. ``all``: every label, "" if none.
    """
    labels = F.expr(f"array({', '.join(f'struct({quoted(label)} AS label, array({quoted_list(words)}) AS words)' for label, words in rules)})")
    found = once(F.lower(F.coalesce(text, F.lit(""))), lambda low: F.transform(F.filter(labels, lambda r: F.exists(r["words"], lambda w: F.contains(low, w))), lambda r: r["label"]))
    if policy == "all":
        return F.array_join(found, " / ")
    narrow = lambda every: once(F.filter(every, lambda x: ~x.isin(*BROAD_SPECIALTIES)), lambda own: F.when(F.size(own) >= 2, own).otherwise(every))
    labels = F.array_join(F.slice(once(found, narrow), 1, 5), " / ")
    return F.coalesce(specialty_phrase(text), F.nullif(labels, F.lit("")), F.lit("Not Found"))
