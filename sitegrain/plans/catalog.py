"""The catalogue: a query for each operator that the driver's tables can show, and the SQL that must give the same rows.

Listings are derived from the driver's tables by portable SQL (``INPUTS``), so
both sides start from the same rows; the Spark side then goes through the
operators, the other side is plain SQL with values of its own: nothing that an
operator decides by is taken from the operators' modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formats, names, people, signals, text, urls
from ..functions.missing import is_missing, render
from ..operators import diff, entity, features, frontier, match, merge, qa
from ..session import spread
from ..sources import listings, sinks

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = sql.strip()
        return f

    return keep


#: Tables of few bytes a row from which queries make texts, pages and names: what is done to a row costs far more than reading it.
NARROW = ("customer", "supplier", "part")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in NARROW else rows


# ---- inputs, the same text for both sides ------------------------------------------------------------

BATCH = """
SELECT c_custkey AS pos, CAST(floor(c_custkey / 3.0) AS INT) AS idx,
  CASE WHEN floor(c_custkey / 3.0) % 13 = 0 THEN '' ELSE c_mktsegment || ' Dental ' || CAST(CAST(floor(c_custkey / 3.0) AS INT) AS STRING) END AS practice_name,
  CASE c_custkey % 9 WHEN 0 THEN 'Not Found' WHEN 1 THEN 'Dr. Anna Weber' WHEN 2 THEN 'JOHN SMITH' WHEN 3 THEN 'Single' WHEN 4 THEN 'Bright Dental Group' WHEN 5 THEN 'Dr. A. B. Carter, DDS' WHEN 6 THEN 'info@x.com' WHEN 7 THEN '' ELSE 'Maria de la Cruz' END AS doctor_name,
  CASE WHEN c_custkey % 7 = 0 THEN 'N/A' ELSE 'https://www.site' || CAST(c_nationkey AS STRING) || '.com/x' END AS website,
  CASE WHEN c_custkey % 5 IN (0, 3) THEN 'Not Found' ELSE 'a' || CAST(c_custkey AS STRING) || '@b.org' END AS email,
  CASE c_custkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '3.0' WHEN 2 THEN 'two' ELSE CAST(c_custkey % 6 AS STRING) END AS hygienists,
  CASE WHEN c_acctbal < 500 THEN 'Not Found' ELSE 'General Dentistry' END AS specialty,
  CASE WHEN c_acctbal < 1500 THEN NULL ELSE '4.' || CAST(c_custkey % 10 AS STRING) END AS google_rating,
  CASE WHEN c_acctbal < 1500 THEN '0' ELSE CAST(c_custkey % 300 AS STRING) END AS google_reviews,
  CASE WHEN c_custkey % 6 = 0 THEN 'ADA' ELSE 'Not Found' END AS associations,
  CASE WHEN c_custkey % 8 < 3 THEN 'https://facebook.com/p' || CAST(c_custkey AS STRING) ELSE '' END AS facebook_url,
  CAST(c_custkey % 3 AS STRING) AS testimonials,
  CASE WHEN c_custkey % 10 < 4 THEN 'X' ELSE '' END AS cerec, CASE WHEN c_custkey % 10 = 7 THEN 'X' ELSE '' END AS cbct,
  CAST(c_custkey % 5 AS STRING) AS invisalign, CASE WHEN c_custkey % 4 = 1 THEN '7' ELSE '' END AS implants, '' AS veneers,
  CASE WHEN c_custkey % 2 = 0 THEN 'Mentioned' ELSE '' END AS dental_plan, 'City' || CAST(c_nationkey AS STRING) AS city,
  CASE WHEN c_custkey % 11 < 6 THEN 'https://instagram.com/p' || CAST(c_custkey AS STRING) ELSE 'Not Found' END AS instagram_url, CASE WHEN c_custkey % 4 = 2 THEN '3.5' ELSE 'N/A' END AS yelp_rating, CASE WHEN c_custkey % 2 = 0 THEN 'Multiple' ELSE '1' END AS locations_count
FROM customer"""
FIELDS = ["practice_name", "website", "email", "hygienists", "specialty", "google_rating", "google_reviews", "associations", "facebook_url", "testimonials", "cerec", "cbct", "invisalign", "implants", "veneers", "dental_plan", "city", "doctor_name", "instagram_url", "yelp_rating", "locations_count"]
VISITS = """
SELECT o_custkey AS idx, o_orderkey AS pos, o_orderpriority AS status, o_totalprice AS total,
  o_totalprice > 300000 AS cerec, o_totalprice < 2000 AS cbct, CAST(floor(o_totalprice) AS BIGINT) % 7 AS invisalign, CAST(floor(o_totalprice) AS BIGINT) % 11 AS implants,
  CASE WHEN o_orderstatus = 'F' THEN 'Mentioned' ELSE '' END AS dental_plan, CAST(CAST(floor(o_totalprice) AS BIGINT) % 4 AS STRING) AS hygienists
FROM orders"""


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BATCH.replace("FROM customer", "FROM {customer}"), customer=load(spark, sf_dir, "customer"))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VISITS.replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: Tokens that stand for "missing" and how they are compared, as the SQL side states them.
MISSING = {
    "qa": ("either", "'', 'Not Found', 'N/A', 'nan', 'None', 'none', 'ERROR', 'N/A – Not Offered', '0', 'not found', 'n/a'"),
    "patch": ("lower", "'', 'not found', 'n/a', 'none', 'error', '-'"),
    "social": ("lower", "'', 'not found', 'n/a', 'none', 'false', 'no', 'blocked', '0'"),
    "rating": ("exact", "'Not Found', 'See Website', 'See Profile', 'Blocked', 'ERROR', '', 'N/A'"),
    "dedup": ("exact", "'', 'Not Found', 'ERROR'"),
    "bypass": ("lower", "'not found', '', 'none', 'n/a', '0'"),
    "refresh": ("exact", "'', 'Not Found', 'ERROR'"),
}


def sql_missing(col: str, policy: str = "qa") -> str:
    mode, own = MISSING[policy]
    c = f"CAST({col} AS VARCHAR)"
    test = {"lower": f"lower(trim({c})) IN ({own})", "either": f"(trim({c}) IN ({own}) OR lower(trim({c})) IN ({own}))", "exact": f"{c} IN ({own})"}[mode]
    return f"({col} IS NULL OR {test})"


# ---- pages: text, counts, flags, links ---------------------------------------------------------------


def sql_strip(html: str, body: bool = False) -> str:
    c = f"coalesce({html}, '')"
    for tag in ["script", "style", "noscript"]:
        c = f"regexp_replace({c}, '(?is)<{tag}[^>]*>.*?</{tag}>', ' ', 'g')"
    c = f"regexp_replace({c}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ["nav", "header", "footer"] if body else []:
        c = f"regexp_replace({c}, '(?is)<{tag}[^>]*>.*?</{tag}>', ' ', 'g')"
    return rf"lower(trim(regexp_replace(regexp_replace({c}, '<[^>]*>', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g')))"


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    return pages.select(urls.domain_key("url").alias("host"), "url", F.col("page_id").alias("page_ord"), text.visible_text("html").alias("text"), text.visible_text("html", body=True).alias("body_text"))


NETLOC = r"lower(regexp_extract(CASE WHEN regexp_matches(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN trim(url) ELSE 'https://' || trim(url) END, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))"
HOST = f"regexp_replace({NETLOC}, '^www[0-9]*\\.', '')"
TEXTS = f"SELECT {HOST} AS host, url, page_id AS page_ord, {sql_strip('html')} AS text, {sql_strip('html', True)} AS body_text FROM pages"
PACK = {"alpha": ["the", "tion", "ment"], "beta": ["que", "ing", "lich"], "gamma": ["der", "es ", "th"]}
TECH = {"one": ["zau", "elle"], "two": ["ciónes", "x-ray"], "three": ["thth"]}


def sql_count(t: str, word: str, cap: int | None) -> str:
    n = f"CAST((length({t}) - length(replace({t}, {lit(word)}, ''))) / {len(word)} AS BIGINT)"
    return f"least({n}, {cap})" if cap is not None else n


@query("page_visible_text_stats", f"WITH t AS ({TEXTS}) SELECT page_ord, length(text) AS n_chars, length(body_text) AS n_body, length(text) - length(replace(text, ' ', '')) + 1 AS n_words FROM t")
def _(spark, sf):
    n = F.length(F.col("text")) - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    return page_texts(spark, sf).select("page_ord", F.length("text").cast("long").alias("n_chars"), F.length("body_text").cast("long").alias("n_body"), n.cast("long").alias("n_words"))


def _mentions_sql(page: str, whole: str, body_cap: int | None, full_cap: int | None, extra: bool = False, best: bool = False) -> str:
    """Counts by host: ``whole`` combines the body's sum ``b`` and the whole text's sum ``f`` of a category."""
    cols, inner = [], []
    for c, words in PACK.items():
        b, f = ([sql_count(t, w, cap) for w in words] for t, cap in (("body_text", body_cap), ("text", full_cap)))
        inner += [f"({' + '.join(b)}) AS b_{c}", f"({' + '.join(f)}) AS f_{c}" if not best else f"greatest({', '.join(f)}) AS f_{c}"]
        plus = lambda cap: " + ".join(f"least(sum({sql_count('text', w, None)}), {cap})" for w in words)  # noqa: B023, E731
        top = "max" if best else "sum"
        e = whole.replace("<b>", f"(sum(b_{c})" + (f" + {plus(body_cap)})" if extra else ")")).replace("<f>", f"({top}(f_{c})" + (f" + {plus(full_cap)})" if extra else ")"))
        cols.append(f"CAST({e} AS BIGINT) AS {c}")
    return f"WITH t AS ({TEXTS}), one AS (SELECT host, {page} AS page, arg_min(text, page_ord) AS text, arg_min(body_text, page_ord) AS body_text FROM t GROUP BY 1, 2), n AS (SELECT host, text, {', '.join(inner)} FROM one) SELECT host, {', '.join(cols)} FROM n GROUP BY host"


NO_FRAGMENT = "regexp_replace(url, '#.*$', '')"
for _policy, _sql in {
    "scrape": _mentions_sql(NO_FRAGMENT, "greatest(<b>, <f>)", 5, 3, extra=True),
    "reprocess": _mentions_sql(NO_FRAGMENT, "CASE WHEN <b> > 0 THEN <b> ELSE <f> END", 3, 2),
    "refresh": _mentions_sql("url", "greatest(<b>, <f>)", 5, 3),
    "fill": _mentions_sql("url", "least(<f>, 99)", None, None),
    "hint": _mentions_sql("url", "<f>", 5, 5, best=True),
    "chain": _mentions_sql("url", "least(greatest(<f>, 1), 20)", None, None),
}.items():
    query(f"keyword_mentions_{_policy}", _sql)(lambda spark, sf, p=_policy: features.service_counts(page_texts(spark, sf), ["host"], p, PACK))


def _flags_sql(spaced: bool) -> str:
    t = "regexp_replace(lower(text), '-', ' ', 'g')" if spaced else "lower(text)"
    form = (lambda w: w.replace("-", " ")) if spaced else (lambda w: w)
    cols = [f"bool_or({' OR '.join(f'contains({t}, {lit(form(w))})' for w in words)}) AS {c}" for c, words in TECH.items()]
    return f"WITH t AS ({TEXTS}) SELECT host, {', '.join(cols)} FROM t GROUP BY host"


for _policy, _spaced in (("scrape", True), ("reprocess", False)):
    query(f"technology_flags_{_policy}", _flags_sql(_spaced))(lambda spark, sf, p=_policy: features.technology_flags(page_texts(spark, sf), ["host"], p, TECH, {}))


@query("page_title_h1", r"SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, length(regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)) AS h1_chars FROM pages")
def _(spark, sf):
    return load(spark, sf, "pages").select("page_id", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"), F.length(F.regexp_extract("html", r"(?is)<h1>(.*?)</h1>", 1)).cast("long").alias("h1_chars"))


@query("page_links_by_host", f"""SELECT {HOST} AS host, CAST(count(*) AS BIGINT) AS pages, CAST(sum(len(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS BIGINT) AS links FROM pages GROUP BY 1""")
def _(spark, sf):
    n = F.size(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))
    return load(spark, sf, "pages").groupBy(urls.domain_key("url").alias("host")).agg(F.count(F.lit(1)).alias("pages"), F.sum(n).cast("long").alias("links"))


@query("url_parts", f"SELECT page_id, {HOST} AS host, regexp_extract(url, '^([a-zA-Z]+)://', 1) || '://' || {NETLOC} || '/' AS home, regexp_replace(url, '#.*$', '') AS page, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_matches(url, '(?i)/(?:news|blog|blogs|article|articles|post|posts|press-release|press|media|updates|announcements|events|resources|newsletter|podcast|dental-tips|dental-blog|health-tips|patient-education|dental-care-tips|case-stud)(?:/|$)') AS content FROM pages")
def _(spark, sf):
    return load(spark, sf, "pages").select("page_id", urls.domain_key("url").alias("host"), urls.homepage("url").alias("home"), urls.without_fragment("url").alias("page"), urls.path("url").alias("path"), urls.is_content("url").alias("content"))


@query("url_canonical_dedupe", f"SELECT {HOST} AS host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path, min(page_id) AS first_page, count(*) AS copies FROM pages GROUP BY 1, 2")
def _(spark, sf):
    return load(spark, sf, "pages").groupBy(urls.domain_key("url").alias("host"), urls.path("url").alias("path")).agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("copies"))


@query("url_variants", """
WITH u AS (SELECT page_id, url, regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) AS host, coalesce(nullif(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), ''), '/') AS p FROM
  (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '://(?:www[.])?([^./]*)', '://www.\\1dent') ELSE regexp_replace(url, '://(?:www[.])?([^./]*)', '://\\1dent') END AS url FROM pages)),
 a AS (SELECT *, CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END AS bare FROM u),
 l AS (SELECT page_id, list_concat([url], CASE WHEN host <> bare THEN ['https://' || bare || p, 'http://' || bare || p, 'http://' || host || p] ELSE ['https://www.' || host || p, 'http://' || host || p, 'http://www.' || host || p] END,
  CASE WHEN contains(bare, 'dent.') AND NOT contains(bare, 'dental.') THEN ['https://' || regexp_replace(bare, 'dent[.]', 'dental.') || p, 'https://www.' || regexp_replace(bare, 'dent[.]', 'dental.') || p] ELSE [] END) AS l FROM a)
SELECT page_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') AS spellings FROM l""")
def _(spark, sf):
    """Every page's address, two of three with a host that ends in "dent"."""
    k = F.col("page_id") % 3
    made = F.when(k == 0, F.col("url")).when(k == 1, F.regexp_replace("url", r"://(?:www[.])?([^./]*)", "://www.$1dent")).otherwise(F.regexp_replace("url", r"://(?:www[.])?([^./]*)", "://$1dent"))
    return load(spark, sf, "pages").select("page_id", F.array_join(urls.variants(made), " ").alias("spellings"))


@query("page_challenges", """SELECT page_id, list_aggregate(list_transform(['sgcaptcha', 'robot challenge', 'just a moment', 'checking your browser', 'cloudflare', 'cf-ray', 'enable javascript', 'web server is returning an unknown error'], lambda m: contains(lower(substr(h, 1, 2000)), m)), 'bool_or') AS challenge,
 regexp_matches(h, '(?is)<div[^>]*id=["''](root|app|__next)["''][^>]*>[ \t\n\r\f]*</div>') AND length(h) < 50000 AND length(%s) < 300 AS shell
FROM (SELECT page_id, CASE page_id %% 5 WHEN 0 THEN '<title>Just a Moment</title>' || html WHEN 1 THEN '<div id="root"></div><script>' || substr(html, 1, 400) || '</script>' WHEN 2 THEN '<div id="app"> </div>' || html ELSE html END AS h FROM pages)""" % sql_strip("h"))
def _(spark, sf):
    """Every page, some of them behind a made-up guard or with a shell's markup."""
    k, h = F.col("page_id") % 5, F.col("html")
    made = F.when(k == 0, F.concat(F.lit("<title>Just a Moment</title>"), h)).when(k == 1, F.concat(F.lit('<div id="root"></div><script>'), F.substring(h, 1, 400), F.lit("</script>"))).when(k == 2, F.concat(F.lit('<div id="app"> </div>'), h)).otherwise(h)
    return load(spark, sf, "pages").select("page_id", made.alias("h")).select("page_id", text.is_challenge("h").alias("challenge"), text.is_script_shell("h").alias("shell"))


@query("link_frontier", f"""
WITH l AS (SELECT page_id, ['', '/whitening', '/sedation', '/patient-feedback', '/meet', '/offers'][page_id % 6 + 1] || unnest(regexp_extract_all(html, 'href="(/[^"#?]+)', 1)) AS href FROM pages),
 p AS (SELECT DISTINCT page_id, href AS url, CASE WHEN regexp_matches(href, '(?i)/(service|treatment|technology|tech|procedure|offer|speciali|invisalign|implant|veneer|whitening|cerec|laser|sedation|cbct|intraoral|aligner)') THEN 1 WHEN regexp_matches(href, '(?i)/(team|staff|about|hygien|doctor|provider|meet)') THEN 2 WHEN regexp_matches(href, '(?i)/(testimonial|review|patient|feedback)') THEN 3 ELSE 9 END AS priority FROM l WHERE NOT regexp_matches(lower(href), '\\.(?:pdf|jpe?g|png|gif|svg|webp|zip|docx?|mp4)(?:$|\\?)|/(?:wp-login|cart|checkout|login|feed)')),
 r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY priority, url) AS rank FROM p) SELECT page_id, url, priority, rank FROM r WHERE rank <= 5""")
def _(spark, sf):
    links = load(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"#?]+)'), F.lit(1))).alias("href"))
    before = F.element_at(F.array(*[F.lit(x) for x in ("", "/whitening", "/sedation", "/patient-feedback", "/meet", "/offers")]), (F.col("page_id") % 6 + 1).cast("int"))
    links = links.withColumn("href", F.concat(before, "href"))
    return frontier.select_links(links, ["page_id"], 5, keep_rest=True).select("page_id", "url", "priority", "rank")


# ---- documents: contact, categories ------------------------------------------------------------------

MAIL = "'[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}'"
BAD = """(regexp_extract(lower(e), '[^@]*$', 0) IN ('godaddy.com', 'example.com', 'yourdomain.com', 'domain.com', 'yourwebsite.com', 'website.com', 'email.com', 'test.com', 'placeholder.com', 'sampleemail.com')
 OR regexp_matches(lower(e), '^(filler|placeholder|test|demo|admin@example|info@example|noreply|no-reply|donotreply)') OR contains(lower(e), 'email@') OR contains(lower(e), 'name@') OR contains(lower(e), 'user@'))"""


@query("doc_email", f"SELECT doc_id, nullif(regexp_extract(text, {MAIL}, 0), '') AS plain, list_extract(list_filter(regexp_extract_all(text, {MAIL}, 0), lambda e: NOT {BAD}), 1) AS wanted, len(regexp_extract_all(text, {MAIL}, 0)) AS n FROM documents")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.first_email("text", "plain").alias("plain"), text.first_email("text", "any").alias("wanted"), F.size(text.emails("text")).cast("long").alias("n"))


STREETS = "'[0-9]{1,6} (?:[A-Z][A-Za-z0-9.]* ){1,4}(?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Drive|Dr|Lane|Ln|Way|Court|Ct|Place|Pl|Parkway|Pkwy|Highway|Hwy)'"


@query("doc_phone_street", rf"SELECT doc_id, nullif(regexp_extract(text, '\(?[0-9]{{3}}\)?[ .-]?[0-9]{{3}}[ .-][0-9]{{4}}', 0), '') AS phone, nullif(regexp_extract(text, {STREETS}, 0), '') AS street FROM documents")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.first_phone("text").alias("phone"), text.first_street("text").alias("street"))


LABELS = [("North", ["the ", "and "]), ("East", ["der ", "und "]), ("South", ["que ", "los "]), ("West", ["les ", "une "]), ("Wide", ["en", "es"])]


@query("doc_labels", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {' OR '.join(f'contains(lower(text), {lit(w)})' for w in words)} THEN {lit(c)} END" for c, words in LABELS) + "], lambda x: x IS NOT NULL), ' / ') AS labels FROM documents")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", features.specialty(F.col("text"), LABELS, "all").alias("labels"))


CODES = {"AN": ["the and"], "IT": ["it it"], "La": ["les la"]}


@query("doc_codes", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(upper(text), {lit(f'(^|[^A-Za-z0-9]){c.upper()}([^A-Za-z0-9]|$)')}) OR contains(lower(text), {lit(w[0])}) THEN {lit(c)} END" for c, w in CODES.items()) + "], lambda x: x IS NOT NULL), ', ') AS codes FROM documents")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", F.array_join(features.associations(F.col("text"), CODES), ", ").alias("codes"))


@query("doc_whole_word", "SELECT lang, CAST(count(*) FILTER (regexp_matches(lower(text), '(^|[^a-z0-9])in([^a-z0-9]|$)')) AS BIGINT) AS docs FROM documents GROUP BY lang")
def _(spark, sf):
    return load(spark, sf, "documents").groupBy("lang").agg(F.count_if(text.whole_word(F.lower("text"), "in")).alias("docs"))


# ---- listings: slices, joins, fills ------------------------------------------------------------------


@query("batch_slice", f"WITH b AS ({BATCH}) SELECT pos, idx, doctor_name FROM b WHERE pos BETWEEN 211 AND 300")
def _(spark, sf):
    return listings.batch_slice(batch(spark, sf), 3, start=11).select("pos", "idx", "doctor_name")


@query("row_pick_override", f"WITH b AS ({BATCH}) SELECT pos, CASE pos WHEN 5 THEN 'https://new.example.com' WHEN 9 THEN NULL ELSE website END AS website FROM b WHERE pos IN (5, 9, 12, 70)")
def _(spark, sf):
    rows = listings.pick_rows(batch(spark, sf), [70, 5, 9, 12, 5])
    return merge.override(rows, "pos", "website", {5: "https://new.example.com", 9: None}).select("pos", "website")


@query("resume_anti_join", f"WITH b AS ({BATCH}) SELECT pos, idx FROM b WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = b.pos AND o_totalprice > 100000)")
def _(spark, sf):
    done = load(spark, sf, "orders").filter("o_totalprice > 100000").select(F.col("o_custkey").alias("pos"))
    return listings.not_done(batch(spark, sf), done, "pos").select("pos", "idx")


@query("target_semi_join", f"WITH b AS ({BATCH}) SELECT pos, idx FROM b WHERE pos IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def _(spark, sf):
    return listings.targets(batch(spark, sf), load(spark, sf, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("pos")), "pos").select("pos", "idx")


@query("missing_policies", f"WITH b AS ({BATCH}) SELECT pos, " + ", ".join(f"{sql_missing('hygienists', p)} AS {p}_hyg, {sql_missing('website', p)} AS {p}_web" for p in MISSING) + " FROM b")
def _(spark, sf):
    return batch(spark, sf).select("pos", *[is_missing(c, p).alias(f"{p}_{n}") for p in MISSING for c, n in (("hygienists", "hyg"), ("website", "web"))])


@query("blocked_and_empty_rows", f"WITH b AS ({BATCH}) SELECT pos, NOT {sql_missing('website', 'bypass')} AND {sql_missing('doctor_name', 'bypass')} AND {sql_missing('email', 'bypass')} AS blocked, {sql_missing('doctor_name', 'bypass')} AND {sql_missing('email', 'bypass')} AND coalesce(try_cast(implants AS INT), 0) + coalesce(try_cast(veneers AS INT), 0) + coalesce(try_cast(invisalign AS INT), 0) = 0 AS empty FROM b")
def _(spark, sf):
    return batch(spark, sf).select("pos", listings.blocked(None).alias("blocked"), listings.empty_result(("implants", "veneers", "invisalign")).alias("empty"))


@query("needs_refresh", f"WITH b AS ({BATCH}) SELECT pos, NOT (cerec = 'X' AND cbct = 'X') OR coalesce(try_cast(invisalign AS DOUBLE), 0) = 0 OR {sql_missing('hygienists', 'refresh')} OR coalesce(try_cast(testimonials AS DOUBLE), 0) = 0 AS stale FROM b")
def _(spark, sf):
    rows = batch(spark, sf).withColumns({f: F.col(f) == "X" for f in ("cerec", "cbct")})
    return rows.select("pos", listings.needs_refresh(["cerec", "cbct"]).alias("stale"))


@query("lacking_rows", f"WITH b AS ({BATCH}) SELECT pos, specialty, associations FROM b WHERE {sql_missing('specialty', 'patch')} OR {sql_missing('associations', 'patch')}")
def _(spark, sf):
    return listings.lacking(batch(spark, sf), "specialty", "associations").select("pos", "specialty", "associations")


@query("fill_missing_last_wins", f"""
WITH b AS ({BATCH}), s AS (SELECT s_nationkey AS idx, s_suppkey AS pos, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'https://s' || s_suppkey || '.org' END AS website FROM supplier),
 l AS (SELECT idx, arg_max(trim(website), pos) AS w FROM s WHERE NOT {sql_missing('website', 'dedup')} GROUP BY idx), m AS (SELECT b.*, l.w, {sql_missing('trim(b.website)', 'dedup')} OR b.website = 'N/A' AS blank FROM (SELECT * REPLACE (CASE WHEN website = 'N/A' THEN ' ' ELSE website END AS website) FROM b) b LEFT JOIN l ON l.idx = b.idx % 40)
SELECT pos, CASE WHEN blank THEN w ELSE website END AS website, CASE WHEN NOT blank THEN 'skipped' WHEN w IS NULL THEN 'no_match' ELSE 'filled' END AS filled FROM m""")
def _(spark, sf):
    source = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("pos"), F.when(F.col("s_suppkey") % 4 == 0, "").otherwise(F.concat(F.lit("https://s"), F.col("s_suppkey").cast("string"), F.lit(".org"))).alias("website"))
    left = batch(spark, sf).select("pos", (F.col("idx") % 40).alias("k"), F.when(F.col("website") == "N/A", " ").otherwise(F.col("website")).alias("website"))
    return merge.fill_last(left, source, "k", "website").select("pos", "website", "filled")


@query("group_first_row_backjoin", f"WITH b AS ({BATCH}), g AS (SELECT regexp_replace(website, '^https://www[.]([^/]*).*$', '\\1') AS host, arg_min(practice_name, pos) AS lead, count(*) AS n FROM b GROUP BY 1) SELECT b.pos, g.lead, g.n FROM b JOIN g ON g.host = regexp_replace(website, '^https://www[.]([^/]*).*$', '\\1')")
def _(spark, sf):
    rows = batch(spark, sf).select("pos", "practice_name", "website")
    found = merge.groups(rows, urls.domain_key("website"), "pos").select("group_key", F.col("practice_name").alias("lead"), F.col("rows").alias("n"))
    return merge.back_join(rows, urls.domain_key("website"), found, "group_key", ["lead", "n"]).select("pos", "lead", "n")


@query("index_patch_first_found", f"""
WITH b AS ({BATCH}), r AS (SELECT o_custkey % 300 AS idx, o_orderkey AS ord, CASE WHEN o_orderstatus = 'P' THEN 'Not Found' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS rating FROM orders),
 f AS (SELECT idx, arg_min(rating, ord) AS rating FROM r WHERE NOT {sql_missing('rating', 'rating')} GROUP BY idx) SELECT b.pos, CASE WHEN {sql_missing('b.google_rating', 'rating')} THEN coalesce(f.rating, b.google_rating) ELSE b.google_rating END AS google_rating FROM b LEFT JOIN f USING (idx)""")
def _(spark, sf):
    r = load(spark, sf, "orders").select((F.col("o_custkey") % 300).cast("int").alias("idx"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderstatus") == "P", "Not Found").otherwise(F.floor("o_totalprice").cast("string")).alias("google_rating"))
    found = r.groupBy("idx").agg(merge.first_value(F.col("google_rating"), "ord", "rating").alias("google_rating"))
    return merge.fill_where(batch(spark, sf).select("pos", "idx", "google_rating"), found, ["idx"], ["google_rating"], policy="rating").select("pos", "google_rating")


@query("social_fill", f"WITH b AS ({BATCH}), f AS (SELECT DISTINCT o_custkey AS pos FROM orders WHERE o_totalprice > 400000) SELECT b.pos, CASE WHEN facebook_url <> '' AND f.pos IS NOT NULL THEN '12' END AS followers, CASE WHEN facebook_url <> '' AND f.pos IS NOT NULL THEN 'See Page' END AS posts FROM b LEFT JOIN f USING (pos)")
def _(spark, sf):
    from .pipelines import fill_social

    rows = batch(spark, sf).select("pos", "facebook_url", F.lit(None).cast("string").alias("facebook_posts"), F.lit(None).cast("string").alias("facebook_followers"))
    found = load(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("pos")).distinct().select("pos", F.lit("").alias("facebook_posts"), F.lit("12").alias("facebook_followers"))
    return fill_social(rows, found, "facebook", "pos").select("pos", F.col("facebook_followers").alias("followers"), F.col("facebook_posts").alias("posts"))


# ---- merging -----------------------------------------------------------------------------------------

NUMBER = "CAST(floor(abs(try_cast({c} AS DOUBLE))) AS BIGINT) * CASE WHEN try_cast({c} AS DOUBLE) < 0 THEN -1 ELSE 1 END"


def sql_best(c: str) -> str:
    ok, n = f"NOT {sql_missing(c)}", NUMBER.format(c=c)
    return f"CASE WHEN arg_min(({n}) IS NOT NULL, pos) FILTER ({ok}) THEN arg_max({c}, {{'n': {n}, 'p': -pos}}) FILTER ({ok} AND ({n}) IS NOT NULL) ELSE arg_min({c}, pos) FILTER ({ok}) END AS {c}"


ROLLUP = f"SELECT idx, {', '.join(sql_best(f) for f in FIELDS)}, count(*) AS row_count FROM ({BATCH}) GROUP BY idx"


@query("best_value_per_field", ROLLUP)
def _(spark, sf):
    return merge.rollup(batch(spark, sf), "idx", FIELDS)


@query("template_merge", f"WITH b AS ({BATCH}) SELECT idx, arg_min(doctor_name, pos) AS doctor_name, " + ", ".join(f"arg_min({c}, pos) FILTER (NOT {sql_missing(c, 'dedup')}) AS {c}" for c in ("website", "email", "specialty", "facebook_url")) + " FROM b GROUP BY idx")
def _(spark, sf):
    return merge.template(batch(spark, sf), "idx", ["doctor_name", "website", "email", "specialty", "facebook_url"], keep=("doctor_name",))


MONOTONE = "SELECT idx, bool_or(cerec) AS cerec, bool_or(cbct) AS cbct, CAST(max(invisalign) AS BIGINT) AS invisalign, CAST(max(implants) AS BIGINT) AS implants, CAST(max(CAST(hygienists AS BIGINT)) AS BIGINT) AS hygienists, CASE WHEN max(dental_plan) = 'Mentioned' THEN 'Mentioned' ELSE '' END AS dental_plan FROM ({0}) GROUP BY idx"


def monotone(rows: DataFrame) -> DataFrame:
    return merge.monotone(rows, ["idx"], ["cerec", "cbct"], ["invisalign", "implants"], others=("hygienists",))


@query("monotone_merge", MONOTONE.format(VISITS))
def _(spark, sf):
    return monotone(visits(spark, sf))


@query("before_after_diff", f"WITH b AS ({MONOTONE.format(VISITS + ' WHERE o_orderdate < TIMESTAMP ' + chr(39) + '1998-01-01' + chr(39))}), a AS ({MONOTONE.format(VISITS)}), j AS (SELECT idx, CAST(b.invisalign AS VARCHAR) AS b_invisalign, CAST(b.implants AS VARCHAR) AS b_implants, b.dental_plan AS b_dental_plan, CAST(a.invisalign AS VARCHAR) AS a_invisalign, CAST(a.implants AS VARCHAR) AS a_implants, a.dental_plan AS a_dental_plan FROM b JOIN a USING (idx)), l AS (SELECT *, list_filter([{', '.join(f'CASE WHEN a_{c} <> b_{c} AND a_{c} NOT IN ({lit(str())}, {lit(str(0))}) THEN {lit(c)} END' for c in ('invisalign', 'implants', 'dental_plan'))}], lambda x: x IS NOT NULL) AS l FROM j) SELECT * EXCLUDE (l), coalesce(array_to_string(l, ', '), '') AS improved, CAST(len(l) AS INT) AS n_improved FROM l")
def _(spark, sf):
    orders = load(spark, sf, "orders")
    both = [monotone(spark.sql(VISITS.replace("FROM orders", "FROM {o}"), o=o)) for o in (orders.filter("o_orderdate < TIMESTAMP '1998-01-01'"), orders)]
    return diff.field_diff(*both, "idx", ["invisalign", "implants", "dental_plan"])


@query("roster_diff", f"WITH b AS ({BATCH}), x AS (SELECT idx, string_agg(doctor_name, ' | ' ORDER BY pos) AS d, count(*) AS n FROM b GROUP BY idx), y AS (SELECT idx, string_agg(doctor_name, ' | ' ORDER BY pos) AS d, count(*) AS n FROM b WHERE doctor_name <> 'Single' GROUP BY idx) SELECT idx, x.d AS before, y.d AS after, x.d <> y.d AS changed, x.n || ' → ' || y.n AS count_change FROM x JOIN y USING (idx)")
def _(spark, sf):
    b = batch(spark, sf)
    return diff.roster_diff(b, b.filter("doctor_name != 'Single'"), "idx", fields=("doctor_name",)).select("idx", F.col("b_doctor_name").alias("before"), F.col("a_doctor_name").alias("after"), "changed", "count_change")


@query("fallback_merge", f"WITH b AS ({BATCH}) SELECT pos, coalesce(CASE WHEN NOT {sql_missing('email', 'bypass')} THEN email END, CASE WHEN NOT {sql_missing('facebook_url', 'bypass')} THEN facebook_url END) AS contact FROM b")
def _(spark, sf):
    b = batch(spark, sf)
    return merge.fill_empty(b.select("pos", F.col("email").alias("contact")), b.select("pos", F.col("facebook_url").alias("contact")), key=["pos"])


@query("replace_rows", f"WITH b AS ({BATCH}) SELECT pos, idx, doctor_name FROM b WHERE idx % 10 <> 0 UNION ALL SELECT DISTINCT CAST(0 AS BIGINT), idx, 'Dr. New Person' FROM b WHERE idx % 10 = 0")
def _(spark, sf):
    b = batch(spark, sf).select("pos", "idx", "doctor_name")
    return merge.replace_rows(b, b.filter("idx % 10 = 0").select(F.lit(0).cast("long").alias("pos"), "idx", F.lit("Dr. New Person").alias("doctor_name")).distinct(), "idx")


# ---- quality analysis --------------------------------------------------------------------------------

#: The fields of the analysis as the SQL side states them: tier, and the header under which a report shows them. NULL: the made-up batch has no such column.
TIERS = {
    "critical": {"doctor_name": "Doctor Name", "email": "Practice Email", "google_rating": "Google Reviews Ranking", "google_reviews": "Total # of Google Reviews"},
    "important": {"hygienists": "# of Hygienists", "facebook_url": "Facebook URL", "associations": "Associations / Memberships", "specialty": "Doctor Specialty"},
    "optional": {"instagram_url": "Instagram URL", "tiktok_url": "TikTok URL", "linkedin_url": "LinkedIn URL", "yelp_rating": "Yelp Rating", "yelp_reviews": "Total # of Yelp Reviews", "testimonials": "Testimonials (Number of)", "locations_count": "# of Locations"},
    "tech": ["cerec", "cbct", "lasers", "ai", "intraoral"],
    "service": ["invisalign", "clear_aligners", "veneers", "implants", "smile_makeovers", "whitening", "sedation", "holistic", "dental_plan", "cancer_screening"],
    "info": ["facebook_posts", "facebook_followers", "instagram_posts", "instagram_followers", "tiktok_posts", "tiktok_followers", "linkedin_posts", "linkedin_followers", "invisalign_tier"],
}
_gone = lambda f: sql_missing(f) if f in FIELDS else "true"
_list = lambda t: "list_filter([" + ", ".join(f"CASE WHEN {_gone(f)} THEN {lit(f)} END" for f in TIERS[t]) + "], lambda x: x IS NOT NULL)"
_any = lambda t: "(" + " OR ".join(f"NOT {_gone(f)}" for f in TIERS[t]) + ")"
_pct = lambda a, b: f"CAST(CASE WHEN {b} > 0 THEN round_even(CAST({a} AS DOUBLE) * 100.0 / CAST({b} AS DOUBLE), 0) ELSE 0 END AS BIGINT)"
SCORED = f"""SELECT *, {_pct('15 - len(cm) - len(im) - len(om)', '15')} AS fill,
 CASE WHEN NOT {sql_missing('website')} AND {sql_missing('email')} AND {sql_missing('google_rating')} AND {sql_missing('google_reviews')} AND {sql_missing('specialty')} AND {sql_missing('associations')} AND NOT tech_any AND NOT service_any THEN 'NOT SCRAPED'
  WHEN len(cm) > 0 THEN 'FAIL' WHEN len(im) >= 2 OR NOT tech_any OR NOT service_any THEN 'REVIEW' ELSE 'PASS' END AS status
 FROM (SELECT *, {_list('critical')} AS cm, {_list('important')} AS im, {_list('optional')} AS om, {_any('tech')} AS tech_any, {_any('service')} AS service_any FROM ({ROLLUP}))"""
FLAGGED = f"WITH s AS ({SCORED}), t AS (SELECT CASE WHEN count(*) < 5 THEN 40.0 ELSE greatest(20.0, avg(fill) - stddev_samp(fill)) END AS low_threshold FROM s) SELECT s.*, t.low_threshold, fill < low_threshold AND status <> 'NOT SCRAPED' AS low FROM s, t"
REASON = r"""CASE WHEN n IN ('', 'Not Found', 'N/A', 'nan', 'None', 'none', 'ERROR', 'N/A – Not Offered', '0', 'not found', 'n/a') THEN 'Empty / Not Found'
 WHEN contains(lower(n), 'http') OR contains(n, '@') OR contains(lower(n), '.com') OR contains(lower(n), '.org') THEN 'URL or email in name field'
 WHEN regexp_matches(n, '[0-9]') THEN 'Contains digits'
 WHEN length(regexp_replace(n, '[^a-zA-Z]', '', 'g')) > 4 AND NOT regexp_matches(n, '[a-z]') THEN 'All uppercase'
 WHEN len(words) = 1 THEN 'Single word — no first + last name'
 WHEN len(words) >= 6 THEN 'Too long (' || len(words) || ' words) — possibly a practice/office name'
 WHEN len(biz) > 0 THEN 'Business term(s): ' || array_to_string(biz, ', ') END"""
BIZ = "['dental', 'dentistry', 'dentist', 'care', 'group', 'center', 'centre', 'clinic', 'practice', 'office', 'associates', 'health', 'wellness', 'smile', 'smiles', 'studio', 'family', 'general', 'orthodontic', 'implant', 'cosmetic', 'pediatric', 'oral', 'surgery', 'specialist', 'specialists', 'advanced', 'premier', 'excellence', 'professional', 'and', 'the', 'of', 'for', 'at', 'your', 'our', 'team', 'services']"
NAMED = f"SELECT *, {REASON} AS reason FROM (SELECT *, list_filter(words, lambda w: list_contains({BIZ}, lower(w))) AS biz FROM (SELECT idx, pos, n, list_filter(list_transform(string_split(n, ' '), lambda w: trim(w, '.,;')), lambda w: length(w) > 1) AS words FROM (SELECT idx, pos, trim(coalesce(doctor_name, '')) AS n FROM ({BATCH}))))"
BADNAMES = f"SELECT idx, n AS doctor_name, min(pos) AS first, min(reason) AS reason FROM ({NAMED}) WHERE reason IS NOT NULL GROUP BY idx, n"
STATS = "SELECT field, tier, place, count(*) AS n, count(*) FILTER (filled) AS filled, count(*) FILTER (has_site) AS n_site, count(*) FILTER (filled AND has_site) AS filled_site FROM (" + " UNION ALL ".join(f"SELECT {lit(f)} AS field, {lit(t)} AS tier, {k} AS place, NOT {_gone(f)} AS filled, NOT {sql_missing('website')} AS has_site FROM r" for k, (t, f) in enumerate((t, f) for t in TIERS for f in TIERS[t])) + ") GROUP BY 1, 2, 3"
RATES = f"WITH r AS ({ROLLUP}), s AS ({STATS}) SELECT *, {_pct('filled', 'n')} AS rate, {_pct('filled_site', 'n_site')} AS rate_site, n_site - filled_site AS gap, CASE WHEN {_pct('filled', 'n')} >= 80 THEN 'Good' WHEN {_pct('filled', 'n')} >= 50 THEN 'Review' ELSE 'Low' END AS grade FROM s"
_heads = "MAP {" + ", ".join(f"{lit(f)}: {lit(h)}" for t in ("critical", "important", "optional") for f, h in TIERS[t].items()) + "}"
_shown = lambda c: f"coalesce(nullif(array_to_string(list_transform({c}, lambda f: {_heads}[f]), ', '), ''), '—')"


def scored(spark, sf) -> DataFrame:
    return qa.score(merge.rollup(batch(spark, sf), "idx", FIELDS))


@query("qa_scores", f"SELECT idx, fill, status, tech_any, service_any, coalesce(array_to_string(cm, ','), '') AS critical, coalesce(array_to_string(im, ','), '') AS important, coalesce(array_to_string(om, ','), '') AS optional FROM ({SCORED})")
def _(spark, sf):
    return scored(spark, sf).select("idx", "fill", "status", "tech_any", "service_any", *[F.array_join(f"{t}_missing", ",").alias(t) for t in ("critical", "important", "optional")])


@query("qa_status_distribution", f"SELECT status, count(*) AS practices FROM ({SCORED}) GROUP BY status")
def _(spark, sf):
    return qa.status_counts(scored(spark, sf))


@query("low_data_threshold", f"SELECT round(max(low_threshold), 6) AS low_threshold, count(*) FILTER (low) AS low FROM ({FLAGGED})")
def _(spark, sf):
    return qa.flagged(scored(spark, sf)).agg(F.round(F.max("low_threshold"), 6).alias("low_threshold"), F.count_if("low").alias("low"))


@query("qa_flags", f"SELECT idx, coalesce(nullif(concat_ws(' | ', CASE WHEN low THEN 'LOW DATA' END, CASE WHEN status = 'NOT SCRAPED' THEN 'NOT SCRAPED' END, CASE WHEN {sql_missing('website')} THEN 'NO WEBSITE' END), ''), '—') AS flags FROM ({FLAGGED})")
def _(spark, sf):
    return qa.flagged(scored(spark, sf)).select("idx", "flags")


@query("qa_issues", f"""WITH f AS ({FLAGGED}), x AS (SELECT idx, pos, chr(39) || n || chr(39) || ' (' || reason || ')' AS told FROM ({NAMED}) WHERE reason IS NOT NULL AND reason <> 'Empty / Not Found'),
 b AS (SELECT idx, count(*) AS bad, array_to_string(list_slice(list(told ORDER BY pos), 1, 3), '; ') AS bad_names FROM x GROUP BY idx)
SELECT idx, status, fill || '%' AS fill, coalesce(nullif(concat_ws(' | ', CASE WHEN low THEN 'LOW DATA' END, CASE WHEN status = 'NOT SCRAPED' THEN 'NOT SCRAPED' END, CASE WHEN {sql_missing('website')} THEN 'NO WEBSITE' END, CASE WHEN bad > 0 THEN 'BAD NAMES' END), ''), '—') AS flags,
 {_shown('cm')} AS critical, {_shown('im')} AS important, {_shown('list_slice(om, 1, 4)')} AS optional, CASE WHEN tech_any THEN '✓' ELSE '✗ None' END AS tech, CASE WHEN service_any THEN '✓' ELSE '✗ None' END AS services, coalesce(bad_names, '—') AS bad_names
FROM f LEFT JOIN b USING (idx) WHERE status <> 'PASS' OR low OR bad > 0""")
def _(spark, sf):
    return qa.issues(qa.flagged(scored(spark, sf)), batch(spark, sf))


@query("qa_bad_names", BADNAMES)
def _(spark, sf):
    return qa.bad_names(batch(spark, sf), "idx")


@query("field_fill_rates", f"SELECT * EXCLUDE (place) FROM ({RATES})")
def _(spark, sf):
    return qa.field_stats(merge.rollup(batch(spark, sf), "idx", FIELDS))


@query("missing_data", f"SELECT field, tier, filled, n, rate, filled_site, n_site, rate_site, CASE WHEN gap > 0 THEN gap || ' practices have website but field is empty' ELSE '—' END AS gap FROM ({RATES}) WHERE tier <> 'info'")
def _(spark, sf):
    return qa.missing_data(qa.field_stats(merge.rollup(batch(spark, sf), "idx", FIELDS)))


@query("lowest_fields", f"SELECT field, rate FROM ({RATES}) WHERE tier <> 'info' ORDER BY filled / n, CASE field WHEN 'invisalign' THEN -1 ELSE 0 END + place LIMIT 6")
def _(spark, sf):
    return qa.lowest(qa.field_stats(merge.rollup(batch(spark, sf), "idx", FIELDS)))


def _cell_sql(c: str, gone: str) -> str:
    return f"CASE WHEN {sql_missing(c)} THEN '{gone}' WHEN try_cast({c} AS DOUBLE) >= 1 THEN CAST(CAST(floor(try_cast({c} AS DOUBLE)) AS BIGINT) AS VARCHAR) WHEN try_cast({c} AS DOUBLE) IS NOT NULL OR length(trim({c})) > 20 THEN '✓' ELSE trim({c}) END AS {c}"


@query("qa_cells", f"WITH r AS ({ROLLUP}) SELECT idx, {_cell_sql('email', '✗')}, {_cell_sql('invisalign', '–')}, {_cell_sql('google_rating', '✗')}, {_cell_sql('facebook_url', '✗')}, {_cell_sql('dental_plan', '–')} FROM r")
def _(spark, sf):
    tiers = {"email": "critical", "invisalign": "service", "google_rating": "critical", "facebook_url": "important", "dental_plan": "service"}
    return merge.rollup(batch(spark, sf), "idx", FIELDS).select("idx", *[qa.cell(F.col(c), t).alias(c) for c, t in tiers.items()])


# ---- rows of doctors, ranking, sets ------------------------------------------------------------------


@query("doctor_rows_with_fallback", f"WITH b AS ({BATCH}), r AS (SELECT idx, list(doctor_name ORDER BY pos) FILTER (doctor_name LIKE 'Dr.%') AS ds, arg_min(doctor_name, pos) AS given FROM b GROUP BY idx) SELECT idx, unnest(CASE WHEN len(ds) > 0 THEN ds ELSE [CASE WHEN regexp_matches(given, '^Dr\\.? +[A-Z]') OR regexp_matches(upper(given), '[ ,](?:DDS|DMD|MD|D\\.D\\.S\\.|D\\.M\\.D\\.)\\.?$') THEN given ELSE 'Not Found' END] END) AS doctor_name, 'Not Found' AS specialty FROM r")
def _(spark, sf):
    one = F.struct(F.col("pos"), F.struct(F.col("doctor_name").alias("name"), F.lit(None).cast("string").alias("specialty"), F.lit(None).cast("array<string>").alias("associations")).alias("d"))
    rows = batch(spark, sf).groupBy("idx").agg(F.transform(F.sort_array(F.collect_list(F.when(F.col("doctor_name").startswith("Dr."), one))), lambda x: x["d"]).alias("doctors"), F.min_by("doctor_name", "pos").alias("doctor_name"))
    return sinks.doctor_rows(rows).select("idx", "doctor_name", "specialty")


@query("rendered_cells", f"WITH b AS ({BATCH}) SELECT pos, coalesce(nullif(trim(facebook_url), ''), 'Not Found') AS facebook_url, coalesce(nullif(trim(google_rating), ''), 'Not Found') AS google_rating FROM b")
def _(spark, sf):
    return batch(spark, sf).select("pos", render("facebook_url").alias("facebook_url"), render("google_rating").alias("google_rating"))


@query("argmax_with_ties", "SELECT l_orderkey, arg_min(l_linenumber, {'q': -l_quantity, 'n': l_linenumber}) AS line, max(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey")
def _(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max_by("l_linenumber", F.struct(F.col("l_quantity"), -F.col("l_linenumber"))).alias("line"), F.max("l_quantity").alias("quantity"))


@query("per_group_topk", "SELECT l_suppkey, l_orderkey, l_linenumber, rn FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 8")
def _(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return load(spark, sf, "lineitem").withColumn("rn", F.row_number().over(w)).filter("rn <= 8").select("l_suppkey", "l_orderkey", "l_linenumber", "rn")


@query("exact_dedupe", f"WITH b AS ({BATCH}) SELECT idx, min(pos) AS pos FROM b GROUP BY idx, lower(trim(doctor_name))")
def _(spark, sf):
    return entity.exact(batch(spark, sf), ["idx"], "doctor_name").select("idx", "pos")


PLAIN = r"array_to_string(list_transform(list_filter(string_split(regexp_replace(regexp_replace(lower(coalesce(doctor_name, '')), '\b(dr|d[.]?d[.]?s|d[.]?m[.]?d|m[.]?d|rdh|ph[.]?d|dpm|do|nmd|fagd|magd|ficoi|facd|ficd|aacd|abgd|fellow)\b', '', 'g'), '[,.-]', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: CASE WHEN length(w) > 3 AND w[-1] = w[-2] THEN w[:-2] ELSE w END), ' ')"


@query("name_forms", f"WITH b AS ({BATCH}) SELECT pos, {PLAIN} AS plain, regexp_matches(doctor_name, '^Dr\\.? +[A-Z]') OR regexp_matches(upper(doctor_name), '[ ,](?:DDS|DMD|MD|D\\.D\\.S\\.|D\\.M\\.D\\.)\\.?$') AS titled, len(list_filter(string_split(doctor_name, ' '), lambda w: w <> '')) + CASE WHEN regexp_matches(doctor_name, '^[Dd][Rr]\\.? ') THEN 4 ELSE 0 END + CASE WHEN regexp_matches(doctor_name, ' [A-Z][.]( |$)') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(lower(doctor_name), ', *(dds|dmd|md|ms|fagd|magd|ficoi|facd|ficd|aacd)') THEN 3 ELSE 0 END AS score FROM b")
def _(spark, sf):
    return batch(spark, sf).select("pos", names.normalised("doctor_name").alias("plain"), names.looks_titled("doctor_name").alias("titled"), names.completeness("doctor_name").cast("long").alias("score"))


@query("name_overlap", "SELECT p_partkey, len(list_intersect(list_filter(string_split(lower(p_name), ' '), lambda w: w <> ''), ['red', 'small', 'widget', 'bolt', 'office'])) AS score FROM part")
def _(spark, sf):
    return load(spark, sf, "part").select("p_partkey", names.overlap("p_name", F.lit("The Red small Dental WIDGET bolt office, LLC of Family")).cast("long").alias("score"))


@query("compact_numbers", "SELECT o_orderkey, CASE WHEN x >= 1000000 THEN format('{:.1f}', round_even(x / 1000000, 1)) || 'M' WHEN x >= 1000 THEN format('{:.1f}', round_even(x / 1000, 1)) || 'K' ELSE CAST(CAST(floor(x) AS BIGINT) AS VARCHAR) END AS shown FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS DOUBLE) * CASE WHEN o_orderkey % 3 = 0 THEN 10 WHEN o_orderkey % 3 = 1 THEN 1 ELSE 0.001 END AS x FROM (SELECT o_orderkey, floor(o_totalprice) - floor(o_totalprice) % 50 AS o_totalprice FROM orders))")
def _(spark, sf):
    base = F.floor("o_totalprice") - F.floor("o_totalprice") % 50
    x = base.cast("double") * F.when(F.col("o_orderkey") % 3 == 0, 10).when(F.col("o_orderkey") % 3 == 1, 1).otherwise(0.001)
    return load(spark, sf, "orders").select("o_orderkey", formats.compact(x).alias("shown"))


@query("slug_addresses", "SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) || ' N Main St' AS address, 'TX' AS state, 'New Braunfels' AS city, CAST(s_suppkey AS VARCHAR) AS number FROM supplier")
def _(spark, sf):
    url = F.concat(F.lit("https://x.com/offices/tx/new-braunfels/"), F.col("s_suppkey").cast("string"), F.lit("-n-main-st/"))
    parts = urls.place_parts(url)
    return load(spark, sf, "supplier").select("s_suppkey", urls.slug_address(parts["slug"]).alias("address"), parts["state"].alias("state"), parts["city"].alias("city"), parts["number"].alias("number"))


@query("cache_folders", "SELECT s_suppkey, lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s_suppkey AS VARCHAR))) AS INT), '0') || '_Supplier_' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS folder, lower(replace(s_name, '#', '-')) AS low FROM supplier")
def _(spark, sf):
    return load(spark, sf, "supplier").select("s_suppkey", urls.folder_slug("s_name", F.col("s_suppkey")).alias("folder"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("low"))


@query("lookup_strings", f"WITH b AS ({BATCH}) SELECT pos, trim(regexp_replace(concat_ws(' ', nullif(trim(practice_name), ''), city), ' +', ' ', 'g')) AS lookup FROM b")
def _(spark, sf):
    return batch(spark, sf).select("pos", formats.lookup_text("practice_name", "city").alias("lookup"))


@query("registry_match_cascade", """
WITH p AS (SELECT s_suppkey AS idx, s_name AS practice_name, CAST(s_suppkey % 20 AS VARCHAR) || ' Oak Street' AS street, s_nationkey AS c FROM supplier),
 n AS (SELECT c_custkey AS number, c_nationkey AS c, CAST(c_custkey % 40 AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN ' Oak Ave' ELSE ' Elm Ave' END AS street, CASE WHEN c_custkey % 50 = 0 THEN 'Supplier#' || lpad(CAST(c_custkey % 100 AS VARCHAR), 9, '0') || ' LLC' ELSE '' END AS org FROM customer),
 j AS (SELECT idx, number, CASE WHEN contains(lower(org), lower(practice_name)) THEN 1 WHEN split_part(p.street, ' ', 1) = split_part(n.street, ' ', 1) THEN 3 ELSE 4 END AS level FROM p JOIN n USING (c)),
 w AS (SELECT *, min(level) OVER (PARTITION BY idx) AS best, count(*) OVER (PARTITION BY idx) AS k FROM j)
SELECT idx, CAST(number AS VARCHAR) AS number, CASE best WHEN 1 THEN 'organisation' WHEN 3 THEN 'number' ELSE 'city' END AS match FROM w WHERE level = best AND (best < 4 OR k <= 15)""")
def _(spark, sf):
    places = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("idx"), F.col("s_name").alias("practice_name"), F.concat((F.col("s_suppkey") % 20).cast("string"), F.lit(" Oak Street")).alias("street"), F.col("s_nationkey").cast("string").alias("city"), F.lit("TX").alias("state"))
    people = load(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("number"), F.col("c_name").alias("person"), F.col("c_nationkey").cast("string").alias("city"), F.lit("tx").alias("state"), F.concat((F.col("c_custkey") % 40).cast("string"), F.when(F.col("c_custkey") % 2 == 0, " Oak Ave").otherwise(" Elm Ave")).alias("street"), F.when(F.col("c_custkey") % 50 == 0, F.concat(F.lit("Supplier#"), F.lpad((F.col("c_custkey") % 100).cast("string"), 9, "0"), F.lit(" LLC"))).otherwise("").alias("organisation"))
    return match.match_people(places, people).select("idx", "number", "match")


@query("event_props_json", "SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    k = signals.json_find("props", "k", ("$.k",)).cast("long")
    return load(spark, sf, "events").groupBy("event_type").agg(F.sum(k).alias("total"), F.count(F.lit(1)).alias("n"))


@query("set_operations", f"WITH b AS ({BATCH}), x AS (SELECT idx, list(DISTINCT lower(doctor_name)) AS a FROM b WHERE pos % 2 = 0 GROUP BY idx), y AS (SELECT idx, list(DISTINCT lower(doctor_name)) AS c FROM b WHERE pos % 2 = 1 GROUP BY idx) SELECT idx, len(list_distinct(list_concat(coalesce(a, []), coalesce(c, [])))) AS n_union, len(list_filter(coalesce(c, []), lambda n: NOT list_contains(coalesce(a, []), n))) AS n_new FROM x FULL JOIN y USING (idx)")
def _(spark, sf):
    b = batch(spark, sf)
    own = lambda k: F.collect_list(F.when(F.col("pos") % 2 == k, F.col("doctor_name")))
    rows = b.groupBy("idx").agg(F.array_distinct(own(0)).alias("a"), F.array_distinct(own(1)).alias("c"))
    return rows.select("idx", F.size(match.union_names(F.col("a"), F.col("c"))).cast("long").alias("n_union"), F.size(match.new_names(F.col("a"), F.col("c"))).cast("long").alias("n_new"))


@query("daily_events", "SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def _(spark, sf):
    from ..streaming.snapshots import windowed_mentions

    return windowed_mentions(load(spark, sf, "events")).withColumn("total", F.round("total", 4))


# ---- extractors, on markup made of the driver's keys --------------------------------------------------

MARKUP = """
SELECT o_orderkey AS k, CASE o_orderkey % 6
  WHEN 0 THEN '{"ratingValue":"4.' || CAST(o_orderkey % 10 AS STRING) || '","reviewCount":"1,' || CAST(100 + o_orderkey % 900 AS STRING) || '"}'
  WHEN 1 THEN '<span aria-label="4.' || CAST(o_orderkey % 10 AS STRING) || ' stars, ' || CAST(o_orderkey AS STRING) || ' reviews">'
  WHEN 2 THEN '<b>3.' || CAST(o_orderkey % 10 AS STRING) || ' (' || CAST(o_orderkey AS STRING) || ')</b>'
  WHEN 3 THEN 'an 1.1 hour visit, ' || CAST(o_orderkey % 50 AS STRING) || ' reviews; all in all 4.6 in many years: ' || CAST(60 + o_orderkey AS STRING) || ' reviews'
  WHEN 4 THEN '"follower_count": 0, ' || CAST(o_orderkey % 90 + 1 AS STRING) || '.5K followers <a href="https://www.instagram.com/p/x"></a><a href="https://www.instagram.com/smile' || CAST(o_orderkey AS STRING) || '"></a>'
  ELSE 'We have ' || CAST(o_orderkey % 40 AS STRING) || ' locations and ' || CAST(o_orderkey % 9 + 1 AS STRING) || ' dental hygienists' END AS html
FROM orders"""


def markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MARKUP.replace("{", "{{").replace("}", "}}").replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))


@query("rating_cascade", "SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN 4 + (o_orderkey % 10) / 10.0 WHEN 1 THEN 4 + (o_orderkey % 10) / 10.0 WHEN 2 THEN 3 + (o_orderkey % 10) / 10.0 WHEN 3 THEN 4.6 END::DOUBLE AS rating, CAST(CASE o_orderkey % 6 WHEN 0 THEN 1100 + o_orderkey % 900 WHEN 1 THEN o_orderkey WHEN 2 THEN o_orderkey WHEN 3 THEN 60 + o_orderkey END AS BIGINT) AS reviews, CASE o_orderkey % 6 WHEN 0 THEN 'jsonld' WHEN 1 THEN 'label' WHEN 2 THEN 'brackets' WHEN 3 THEN 'nearest' END AS method FROM orders")
def _(spark, sf):
    return markup(spark, sf).select("k", signals.rating("html").alias("r")).select("k", "r.rating", "r.reviews", "r.method")


#: What followers, profiles and hygienists are read from: the answer beside each text is told by the rules it is made for.
TOLD = [
    ('"fan_count": 0, <n>.5K followers', "(<n> * 1000 + 500)"), ('"like_count": <n>', "<n>"), ('"page_likers":{"count": <n>}', "<n>"), ('"likers": {"count":<n>} "followers_count":1', "1"),
    ('"profile_plus_follower_count":<n>', "<n>"), ('"connected_users_count" : <n>', "<n>"), ('"social_context":{"text":"<n> people follow"}', "<n>"), ("<n> likes", "<n>"), ('"follower_count": <n>', "NULL"),
]
PROFILES = [
    ('<a href="https://www.instagram.com/explore/x"></a><a href="https://www.instagram.com/smile<n>"></a>', "'https://www.instagram.com/smile' || <n>"), ("https://www.instagram.com/2008/fbml https://instagram.com/x<n>/", "'https://instagram.com/x' || <n>"),
    ("https://www.instagram.com/wix.com http://instagram.com/a.<n>?b=1", "'http://instagram.com/a.' || <n>"), ("https://instagram.com/reels/", "NULL"), ("instagram.com/<n>", "NULL"),
]
COMPANIES = [("heartland-dental", "false"), ("oak-dental-<n>", "true"), ("Aspen-Dental-Management/about", "false"), ("comfort-dental-", "false"), ("comfort-dental-of-<n>", "true")]
HYGIENISTS = [
    ("<n> RDH on staff", "<n>"), ("<n> dental hygienist", "<n>"), ("Hygienists on our team: <n>", "<n>"), ("<n> licensed dental hygiene professionals", "<n>"), ("Jane M. Smith, Registered Dental Hygienist and Bo Ray RDH", "2"),
    ("Dawn, RDH; Dawn, RDH; Eve RDHAP", "2"), ("our gentle dental hygienist", "NULL"), ("two hygienists", "NULL"),
]


def _cases(pairs: list, k: str, n: str, sql: bool) -> str:
    """One of the pairs a row, by a column: the answers for SQL, the texts for Spark."""
    texts = [f"{lit(t).replace('<n>', chr(39) + ' || CAST(' + n + ' AS STRING) || ' + chr(39))}" for t, _ in pairs]
    return f"CASE {k} % {len(pairs)} " + " ".join(f"WHEN {i} THEN {a.replace('<n>', n) if sql else t}" for i, ((_, a), t) in enumerate(zip(pairs, texts))) + " END"


@query("social_signals", f"SELECT o_orderkey AS k, CAST({_cases(TOLD, 'o_orderkey', '(o_orderkey % 900 + 1)', True)} AS BIGINT) AS followers, {_cases(PROFILES, 'o_orderkey', 'o_orderkey', True)} AS profile, {_cases(COMPANIES, 'o_orderkey', 'o_orderkey', True)} AS company FROM orders")
def _(spark, sf):
    rows = load(spark, sf, "orders").selectExpr("o_orderkey AS k", f"{_cases(TOLD, 'o_orderkey', '(o_orderkey % 900 + 1)', False)} AS told", f"{_cases(PROFILES, 'o_orderkey', 'o_orderkey', False)} AS links", f"{_cases(COMPANIES, 'o_orderkey', 'o_orderkey', False)} AS company")
    return rows.select("k", signals.facebook_followers("told").alias("followers"), urls.first_profile("links", "instagram").alias("profile"), urls.is_profile(F.concat(F.lit("https://www.linkedin.com/company/"), "company"), "linkedin").alias("company"))


@query("site_counts", f"SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 5 AND o_orderkey % 40 BETWEEN 1 AND 25 THEN CAST(o_orderkey % 40 AS VARCHAR) ELSE '1' END AS locations, CAST({_cases(HYGIENISTS, 'o_orderkey', '(o_orderkey % 9 + 1)', True)} AS BIGINT) AS hygienists FROM orders")
def _(spark, sf):
    told = load(spark, sf, "orders").selectExpr("o_orderkey AS k", f"{_cases(HYGIENISTS, 'o_orderkey', '(o_orderkey % 9 + 1)', False)} AS told")
    return markup(spark, sf).join(told, "k").select("k", text.locations("html").alias("locations"), signals.hygienists("told").alias("hygienists"))


#: Markup of testimonials, and how many each policy counts in it.
REVIEWS = [
    ('<div class="client-say">A <n></div><div class="client-say">A <n></div><div class="Success_Story">B</div>', ("2", "NULL", "1")), ('<li class="patient story">A</li><p class="review">B</p>', ("1", "NULL", "2")),
    ('<span data-type="5 Star">A</span><span data-start="patients">B</span><span data-x="y">C</span>', ("2", "NULL", "NULL")), ('<p id="feedback-<n>">A</p><b itemprop="Review">B</b>', ("NULL", "NULL", "2")),
    ('<blockquote>A <n></blockquote><blockquote>B</blockquote><blockquote>B</blockquote>', ("2", "2", "2")), ('<blockquote>A</blockquote><section class="x quote">B</section>', ("1", "1", "1")),
    ('<div class="birdeye">A</div><div class="carousel-item">B</div>', ("2", "NULL", "1")), ('<p>nothing</p><div class="testimonials"> </div>', ("NULL", "NULL", "NULL")),
]


@query("testimonial_counts", "SELECT o_orderkey AS k, " + ", ".join(f"CAST({_cases([(h, a[i]) for h, a in REVIEWS], 'o_orderkey', 'o_orderkey', True)} AS INT) AS {p}" for i, p in enumerate(("scrape", "reprocess", "refresh"))) + " FROM orders WHERE o_orderkey % 10 = 1")
def _(spark, sf):
    """Made-up markup for every order of a key that ends in 1, counted by each policy."""
    from ..functions.html import parse_pages

    pages = load(spark, sf, "orders").filter("o_orderkey % 10 = 1").selectExpr("o_orderkey AS k", f"{_cases([(h, '') for h, _ in REVIEWS], 'o_orderkey', 'o_orderkey', False)} AS html", "'https://x.co/' AS url")
    said_ = parse_pages(pages, keep=["k"]).select("k", *[features.page_testimonials(p).alias(p) for p in ("scrape", "reprocess", "refresh")])
    out = said_.select("k")
    for p in ("scrape", "reprocess", "refresh"):
        out = out.join(features.count_testimonials(said_, ["k"], p).withColumnRenamed("testimonials", p), "k", "left")
    return out


#: Sentences that name a field, and what is told of it.
SENTENCES = [
    ("Dr. <n> specializes in dental implants and orthodontics.", "'Dental Implants And Orthodontics'"), ("She earned a certificate in conscious sedation; he has expertise in lasers", "'Conscious Sedation'"), ("expertise in gardening. Training in veneers while travelling", "'Veneers'"),
    ("areas of interest: root canals", "'Root Canals'"), ("board-certified in pediatric dentistry", "'Pediatric Dentistry'"), ("specialist in implants at the university", "NULL"), ("specializing in patient care", "NULL"), ("specialty is crowns & bridges, and is loved", "'Crowns & Bridges'"),
    ("nothing to tell, case <n>", "NULL"),
]


@query("field_phrases", f"SELECT o_orderkey AS k, {_cases(SENTENCES, 'o_orderkey', 'o_orderkey', True)} AS field FROM orders")
def _(spark, sf):
    told = load(spark, sf, "orders").selectExpr("o_orderkey AS k", f"{_cases(SENTENCES, 'o_orderkey', 'o_orderkey', False)} AS told")
    return told.select("k", features.specialty_phrase(F.col("told")).alias("field"))


@query("place_pick", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'b' ELSE 'a' END AS place, CASE WHEN s_suppkey % 3 = 0 THEN 4.5 WHEN s_suppkey % 3 = 1 THEN NULL ELSE 4.1 END::DOUBLE AS rating FROM supplier")
def _(spark, sf):
    own = lambda name, address, rating: F.struct(F.lit(name).alias("place_id"), address.alias("formatted_address"), rating.cast("double").alias("rating"))
    k = F.col("s_suppkey") % 3
    rows = load(spark, sf, "supplier").select("s_suppkey", F.array(own("a", F.when(k == 2, "1 Oak St, Waco, TX").otherwise("9 Far Rd, Reno, NV"), F.when(k != 1, 4.1)), own("b", F.when(k == 0, "2 Elm St, WACO, TX").otherwise("8 Far Rd, Reno, NV"), F.lit(4.5))).alias("c"))
    return rows.select("s_suppkey", signals.place_pick("c", F.lit("Waco"), F.lit("TX")).alias("p")).select("s_suppkey", F.col("p.place_id").alias("place"), "p.rating")


@query("hidden_emails", "SELECT c_custkey, 'u' || c_custkey || '@site.org' AS email FROM customer")
def _(spark, sf):
    plain = F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@site.org"))
    key = (F.col("c_custkey") % 200 + 20).cast("int")
    byte = lambda n: F.lpad(F.lower(F.hex(n.cast("long"))), 2, "0")
    code = F.concat(byte(key), F.array_join(F.transform(F.split(plain, ""), lambda ch: byte(F.ascii(ch).bitwiseXOR(key))), ""))
    return load(spark, sf, "customer").select("c_custkey", text.decode_hidden_email(code).alias("email"))


@query("status_runs", "SELECT o_orderstatus, min(o_orderkey) AS run, count(*) AS rows FROM (SELECT o_orderstatus, o_orderkey, o_orderkey - row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS gap FROM orders) GROUP BY o_orderstatus, gap")
def _(spark, sf):
    return merge.runs(load(spark, sf, "orders").select("o_orderstatus", "o_orderkey"), "o_orderstatus", "o_orderkey").groupBy("o_orderstatus", "run").agg(F.count(F.lit(1)).alias("rows"))


@query("link_scores", f"""WITH b AS (SELECT pos, {PLAIN} AS plain, CAST(floor(pos / 9) AS BIGINT) % 4 + 1 AS k FROM ({BATCH})),
 l AS (SELECT pos, string_split(plain, ' ')[-1] AS last, list_filter(string_split(plain, ' '), lambda w: w <> '') AS words, ['/team/weber-anna', '/doctors/maria-de-la-cruz', '/john-smith/carter', '/profile/1'][k] AS href, ['dr. weber', 'meet dr. cruz', 'single carter', 'anna weber, dds'][k] AS txt FROM b)
SELECT pos, CASE WHEN last <> '' AND contains(href, last) THEN 10 ELSE 0 END + CASE WHEN last <> '' AND contains(txt, last) THEN 8 ELSE 0 END + CASE WHEN len(words) >= 2 AND len(list_filter(words, lambda w: NOT contains(href, w))) = 0 THEN 15 ELSE 0 END
 + CASE WHEN regexp_matches(href, 'bio|profile|doctor|team|provider|dentist|meet|about|dr-|/dr/|staff') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(txt, '\\b(dr|dds|dmd)\\b') THEN 2 ELSE 0 END AS score FROM l""")
def _(spark, sf):
    """Every row of the batch with one of four links."""
    link = (F.floor(F.col("pos") / 9) % 4).cast("int")
    of = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), link + 1)
    return batch(spark, sf).select("pos", names.link_score("doctor_name", of("/team/weber-anna", "/doctors/maria-de-la-cruz", "/john-smith/carter", "/profile/1"), of("Dr. Weber", "meet Dr. Cruz", "Single Carter", "Anna Weber, DDS")).alias("score"))


@query("listing_cards", "WITH c AS (SELECT p_partkey % 40 AS idx, p_partkey // 40 AS pos, p_name AS title FROM part WHERE p_partkey // 40 <= 8), s AS (SELECT *, len(list_intersect(list_distinct(string_split(title, ' ')), ['red', 'small', 'bolt'])) AS score FROM c) SELECT idx, arg_min(title, {'s': -score, 'p': pos}) AS title, max(score) AS score FROM s WHERE score > 0 GROUP BY idx")
def _(spark, sf):
    cards = load(spark, sf, "part").select((F.col("p_partkey") % 40).alias("idx"), F.floor(F.col("p_partkey") / 40).alias("pos"), F.col("p_name").alias("title"))
    places = cards.select("idx").distinct().withColumn("practice_name", F.lit("The Red small bolt of"))
    return match.match_cards(places, cards).select("idx", "title", F.col("score").cast("long").alias("score"))


# ---- operators on made-up texts, one CASE branch a text; the SQL side knows the answers alone ------------

SAID = """
SELECT c_custkey AS k, CASE c_custkey % 8
  WHEN 0 THEN 'A proud member of the ADA and of the Academy of General Dentistry. We specialize in smiles.'
  WHEN 1 THEN 'adaptive care, no codes: adagio. A family practice for all ages, with general dentistry'
  WHEN 2 THEN 'She graduated from UCLA; AzDA and AAO. An orthodontist who offers root canal therapy and dental implants'
  WHEN 3 THEN 'UCLA fans welcome. Expertise in laser work while we care. Gold Plus provider: Smithson'
  WHEN 4 THEN 'Certified in oral surgery, board certified. 3 convenient offices. Platinum is what Weberling has'
  WHEN 5 THEN 'We have two locations. Bronze Plus only, ' || repeat('x', 700) || ' Weberling. Diamond'
  WHEN 6 THEN 'Call (210) 555-01' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || '; 4.' || CAST(c_custkey % 10 AS STRING) || ' stars. Veneers, root canal. choose your location'
  ELSE '' END AS said
FROM customer"""


def said(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SAID.replace("FROM customer", "FROM {customer}"), customer=load(spark, sf_dir, "customer"))


@query("membership_codes", "SELECT c_custkey AS k, CASE c_custkey % 8 WHEN 0 THEN 'ADA, AGD' WHEN 2 THEN 'AAO, AzDA, UCLA' ELSE '' END AS codes FROM customer")
def _(spark, sf):
    return said(spark, sf).select("k", F.array_join(features.associations(F.col("said")), ", ").alias("codes"))


@query("specialty_labels", "SELECT c_custkey AS k, CASE c_custkey % 8 WHEN 0 THEN 'General Dentistry' WHEN 1 THEN 'Family Dentistry / General Dentistry' WHEN 2 THEN 'Implants / Orthodontics / Endodontics' WHEN 3 THEN 'Laser Work' WHEN 4 THEN 'Oral Surgery, Board Certified' ELSE 'Not Found' END AS specialty FROM customer")
def _(spark, sf):
    return said(spark, sf).select("k", features.specialty(F.col("said")).alias("specialty"))


@query("provider_tiers", "SELECT c_custkey AS k, CASE c_custkey % 8 WHEN 3 THEN 'Gold Plus (verify name match)' WHEN 4 THEN 'Platinum' WHEN 5 THEN 'Diamond' END AS tier FROM customer")
def _(spark, sf):
    return said(spark, sf).select("k", signals.tier("said", F.lit("Dr. Ann Weberling")).alias("tier"))


@query("place_counts", "SELECT c_custkey AS k, CASE c_custkey % 8 WHEN 4 THEN '3' WHEN 5 THEN '2' WHEN 6 THEN 'Multiple' ELSE '1' END AS places FROM customer")
def _(spark, sf):
    return said(spark, sf).select("k", text.locations("said").alias("places"))


@query("text_dumps", "SELECT c_custkey AS k, CASE WHEN c_custkey % 8 = 6 THEN '(210) 555-01' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') END AS phone, CAST(CASE WHEN c_custkey % 8 = 6 THEN 4 + (c_custkey % 10) / 10.0 END AS DOUBLE) AS rating, CASE c_custkey % 8 WHEN 2 THEN 'Dental implants, Root canal' WHEN 4 THEN 'Oral surgery' WHEN 6 THEN 'Root canal, Veneers' END AS services FROM customer")
def _(spark, sf):
    return said(spark, sf).select("k", people.dump_fields("said").alias("d")).select("k", "d.phone", "d.rating", "d.services")


@query("person_checks", """SELECT c_custkey AS k, [true, false, false, true, false, false, true, false][c_custkey % 8 + 1] AS person, [true, false, false, false, false, false, true, false][c_custkey % 8 + 1] AS found,
 [NULL, 'Business term(s): Dental, Care', 'All uppercase', NULL, 'Contains digits', 'Single word — no first + last name', NULL, 'Empty / Not Found'][c_custkey % 8 + 1] AS reason FROM customer""")
def _(spark, sf):
    given = F.element_at(F.array(*[F.lit(n) for n in ("Dr. Anna Li, DDS", "Bright Dental Care Membership", "JOHN SMITH", "Anna Carey", "May 4 Smith", "Dentistry", "John Smith III", "")]), (F.col("c_custkey") % 8 + 1).cast("int"))
    return load(spark, sf, "customer").select(F.col("c_custkey").alias("k"), given.alias("n")).select("k", names.is_person("n").alias("person"), names.is_found_name("n").alias("found"), names.bad_reason("n").alias("reason"))


@query("staff_links", f"""
WITH h AS (SELECT page_id, {HOST} AS host, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages), x AS (SELECT page_id, host, l, unnest(range(1, len(l) + 1)) AS i FROM h),
 l AS (SELECT host, page_id * 1000 + i AS pos, ['', '/meet-the', '/events', '/offices', '/tag'][(page_id + i) % 5 + 1] || l[i] AS url, ['', 'Our Team', 'Meet Dr. Li', 'welcome'][(page_id * 7 + i) % 4 + 1] AS txt FROM x),
 u AS (SELECT host, regexp_replace(url, '#.*$', '') AS url, min(pos) AS pos FROM l WHERE (regexp_matches(lower(txt), 'our dentist|our doctor|meet the team|meet our team|meet the doctor|our team|our provider|our staff|the team|about the doctor|our doctors|about us|about our team|our hygienist|meet your dentist|meet our dentist|our location|our physicians|our practitioners|our providers|dental team|dental staff|clinical team|meet our doctors|meet the dentist|meet dr|our associates|our specialists') OR regexp_matches(lower(url), 'doctor|dentist|team|provider|staff|meet-the|about-us|about_us|who-we-are|our-doctor|our-dentist|hygienist|hygiene-team|about|physician|practitioner|clinician|associate|dental-team|our-team|meet-dr|our-provider|/location/|/locations/|/office/|/offices/|/our-location|/our-office|/find-us|/visit-us')) AND NOT regexp_matches(url, '(?i)/(?:news|blog|blogs|article|articles|post|posts|press-release|press|media|updates|announcements|events|resources|newsletter|podcast|dental-tips|dental-blog|health-tips|patient-education|dental-care-tips|case-stud)(?:/|$)') GROUP BY ALL)
SELECT host, url, rank FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY pos, url) AS rank FROM u) WHERE rank <= 12""")
def _(spark, sf):
    """Every link of every page, some with a made-up text or begin, in order of place."""
    links = load(spark, sf, "pages").select("page_id", urls.domain_key("url").alias("host"), F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("i", "href"))
    i, page = F.col("i") + 1, F.col("page_id")
    of = lambda k, *values: F.element_at(F.array(*[F.lit(v) for v in values]), (k + 1).cast("int"))
    rows = links.select("host", (page * 1000 + i).alias("pos"), F.concat(of((page + i) % 5, "", "/meet-the", "/events", "/offices", "/tag"), "href").alias("href"), of((page * 7 + i) % 4, "", "Our Team", "Meet Dr. Li", "welcome").alias("text"))
    return frontier.staff_links(rows, ["host"], pos="pos")


@query("fallback_cascade", f"""WITH b AS (SELECT pos, website, doctor_name, email, try_cast(invisalign AS INT) AS invisalign FROM ({BATCH})), p AS (SELECT *, (NOT {sql_missing('website', 'bypass')} AND {sql_missing('doctor_name', 'bypass')} AND {sql_missing('email', 'bypass')}) OR ({sql_missing('doctor_name', 'bypass')} AND {sql_missing('email', 'bypass')} AND coalesce(invisalign, 0) = 0) AS poor FROM b)
SELECT pos, CASE WHEN poor AND {sql_missing('doctor_name', 'bypass')} THEN CASE WHEN pos % 2 = 0 THEN 'Dr. B' ELSE 'Dr. C' END WHEN poor THEN doctor_name ELSE doctor_name END AS doctor_name, CASE WHEN poor THEN 'c@x.org' ELSE email END AS email, CASE WHEN poor THEN 2 ELSE 0 END AS filled_from FROM p""")
def _(spark, sf):
    from .pipelines import cascade

    first = batch(spark, sf).select("pos", "website", "doctor_name", "email", F.col("invisalign").try_cast("int").alias("invisalign"))
    second = first.select("pos", F.when(F.col("pos") % 2 == 0, "Dr. B").alias("doctor_name"))
    third = first.select("pos", F.lit("Dr. C").alias("doctor_name"), F.lit("c@x.org").alias("email"))
    return cascade(first, second, third, key="pos").select("pos", "doctor_name", "email", "filled_from")


# ---- what SQL can't express: parser, clusters (tested against brute force) ----------------------------


@query("parsed_pages")
def _(spark, sf):
    from ..functions.html import parse_pages

    pages = load(spark, sf, "pages")
    return parse_pages(pages, keep=["page_id", "url"]).select("page_id", "title", F.length("text").alias("n_text"), F.length("body_text").alias("n_body"), F.length("aug_text").alias("n_aug"), F.size("links").alias("n_links"), F.size("headings").alias("n_headings"))


@query("best_first_pages")
def _(spark, sf):
    """Every host's site from its first page on: its links resolved, the ten best pages in the order of a crawl."""
    pages = load(spark, sf, "pages").select(urls.domain_key("url").alias("host"), "url", F.explode(F.regexp_extract_all("html", F.lit('href="([^"#?]+)"'), F.lit(1))).alias("href"))
    links = pages.select("host", F.col("url").alias("page"), F.when(F.startswith("href", F.lit("/")), F.concat(F.rtrim(urls.homepage("url"), F.lit("/")), "href")).otherwise(F.col("href")).alias("href"))
    starts = pages.groupBy("host").agg(F.min("url").alias("url"))
    return frontier.best_first(starts, links, ["host"])


@query("person_dedupe")
def _(spark, sf):
    return entity.person(batch(spark, sf).select("idx", "pos", F.col("doctor_name").alias("name")), "idx")


LONGEST = f"w AS (SELECT *, list_distinct(string_split({PLAIN}, ' ')) AS words FROM b), kept AS (SELECT * FROM w AS own WHERE NOT EXISTS (SELECT 1 FROM w AS other WHERE other.idx IS NOT DISTINCT FROM own.idx AND list_has_all(other.words, own.words) AND (len(other.words) > len(own.words) OR (len(other.words) = len(own.words) AND (other.pos < own.pos OR (other.pos = own.pos AND other.doctor_name < own.doctor_name))))))"


@query("subset_dedupe", f"WITH b AS ({BATCH}), {LONGEST} SELECT idx, string_agg(doctor_name, ', ' ORDER BY -len(words), pos) AS names FROM kept GROUP BY idx")
def _(spark, sf):
    rows = entity.longest(batch(spark, sf).select("idx", "pos", "doctor_name"), ["idx"], "doctor_name")
    names = F.transform(F.sort_array(F.collect_list(F.struct(-F.col("n_words"), "pos", "doctor_name"))), lambda x: x["doctor_name"])
    return rows.groupBy("idx").agg(F.array_join(names, ", ").alias("names"))


@query("city_longest_names", f"WITH b AS (SELECT DISTINCT city AS idx, client_id AS pos, name AS doctor_name FROM clients WHERE name IS NOT NULL AND client_id IS NOT NULL), {LONGEST} SELECT idx AS city, pos AS client_id, doctor_name AS name, CAST(len(words) AS INT) AS n_words FROM kept")
def _(spark, sf):
    """Clients of a city whose name isn't told in full by a longer one there; a city may hold a third of all."""
    rows = load(spark, sf, "clients").filter("name IS NOT NULL AND client_id IS NOT NULL").select("city", "client_id", "name").distinct()
    return entity.longest(rows, ["city"], order="client_id")


NEWEST = "valid_at DESC NULLS LAST, seq DESC NULLS LAST, change_id DESC NULLS LAST, op DESC NULLS LAST, source DESC NULLS LAST, segment DESC NULLS LAST, city DESC NULLS LAST, balance DESC NULLS LAST"


@query("client_upserts", f"SELECT client_id, change_id, seq, op, valid_at, source, segment, city, balance FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY {NEWEST}) AS rn FROM client_changes) WHERE rn = 1")
def _(spark, sf):
    """Changes upserted by client, newest first so that late ones must not win; the table as of the last version."""
    from ..sources import versions
    from ..staging import workplace

    rows = load(spark, sf, "client_changes").select("client_id", "change_id", "seq", "op", "valid_at", "source", "segment", "city", "balance")
    path = workplace(spark, "clients")
    order = ["valid_at", "seq", "change_id", "op", "source", "segment", "city", "balance"]
    for batch_of in ("valid_at >= '2024-03-01'", "valid_at < '2024-03-01'", "valid_at IS NULL"):
        versions.upsert(rows.filter(batch_of), path, ["client_id"], order, batch=batch_of, parts=16)
    return versions.table(spark, path)


@query("practice_extraction")
def _(spark, sf):
    from .pipelines import extract

    pages = load(spark, sf, "pages").select(urls.domain_key("url").alias("host"), "url", "html", F.col("page_id").alias("page_ord"))
    out = extract(pages, ["host"])
    return out.select("host", *[c for c in out.columns if c not in ("host", "doctors")], F.size("doctors").alias("n_doctors"))


MADE_PAGES = """
SELECT k, 1 AS page_ord, 'https://smile.co/' AS url, '<html><body><nav><a href="/services/implants">Implants</a></nav><p>Dental implant and veneer. ' || repeat('implant ', CAST(k % 8 AS INT)) || CASE WHEN k % 2 = 0 THEN 'We use CEREC.' ELSE 'Laser therapy.' END
 || '</p><a href="mailto:' || CASE WHEN k % 3 = 0 THEN 'noreply@x.org' ELSE 'front' || CAST(k AS STRING) || '@smile.co' END || '">m</a><p>Call (210) 555-01' || lpad(CAST(k % 100 AS STRING), 2, '0') || '</p><a href="https://facebook.com/smile' || CAST(k AS STRING)
 || '">f</a><div class="testimonial">Great ' || CAST(k % 2 AS STRING) || '</div><div class="testimonial">Great ' || CAST(k % 2 AS STRING) || '</div><div class="review">Loved it</div></body></html>' AS html FROM (SELECT c_custkey AS k FROM customer)
UNION ALL SELECT k, 2, 'https://smile.co/team', '<html><body><section><h2>Dr. Jane Li, DDS</h2><p>An orthodontist. ADA member.</p></section>' || CASE WHEN k % 2 = 0 THEN '<h2>Dr. Bob Ray</h2><p>nothing</p>' ELSE '' END || '<h2>Our Office</h2><div class="team-member">Anna Lee, RDH our hygienist of many years</div></body></html>' FROM (SELECT c_custkey AS k FROM customer)
UNION ALL SELECT k, 5000000, 'https://smile.co/#top', '<p>implant implant implant laser</p>' FROM (SELECT c_custkey AS k FROM customer)"""


@query("made_extraction", """
WITH c AS (SELECT c_custkey AS k, 1 + c_custkey % 8 AS n FROM customer)
SELECT k, greatest(least(n, 5) + least(n + 1, 5), 3 + least(n + 1, 3)) AS implants, 2::BIGINT AS veneers, k % 2 = 0 AS cerec, true AS lasers, CASE WHEN k % 3 > 0 THEN 'front' || k || '@smile.co' END AS email, '(210) 555-01' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') AS phone,
 'https://facebook.com/smile' || k AS facebook_url, 2 AS testimonials, 1::BIGINT AS hygienists, '1' AS locations_count, CASE WHEN k % 2 = 0 THEN 'Jane Li: Orthodontics (ADA) | Bob Ray:  ()' ELSE 'Jane Li: Orthodontics (ADA)' END AS doctors FROM c""")
def _(spark, sf):
    """Three stored pages a customer, one of them the first again under a fragment (its counts don't come twice, its flags do)."""
    from .pipelines import extract

    pages = spark.sql(MADE_PAGES.replace("FROM customer", "FROM {customer}"), customer=load(spark, sf, "customer"))
    shown = F.array_join(F.transform("doctors", lambda d: F.concat(d["name"], F.lit(": "), F.coalesce(d["specialty"], F.lit("")), F.lit(" ("), F.array_join(d["associations"], ", "), F.lit(")"))), " | ")
    return extract(pages, ["k"]).select("k", "implants", "veneers", "cerec", "lasers", "email", "phone", "facebook_url", "testimonials", "hygienists", "locations_count", shown.alias("doctors"))


@query("batch_dedup")
def _(spark, sf):
    from .pipelines import dedup_doctors

    return dedup_doctors(batch(spark, sf))
