"""What is read, matched and filled from stored answers: sitemaps, provider pages, registries, places, dumps, fallbacks."""

import json

from pyspark.sql import functions as F

from sitegrain.functions import people, signals
from sitegrain.functions.html import parse_pages
from sitegrain.operators import frontier, match
from sitegrain.plans import pipelines
from sitegrain.sources import listings, sinks


def test_names_are_extended_to_the_left(spark):
    t = "Our Dentist Ayesha Noor Raza Waseer, DDS and Meet Owner Bo Ray, DMD; bo ray, dmd. Family Care Team, DDS"
    assert spark.createDataFrame([(t,)], "t string").select(people.extended_names("t")).first()[0] == ["Ayesha Noor Raza Waseer", "Bo Ray"]


def test_dump_of_a_site(spark):
    t = "Welcome to Bright.\nDr. Jane A. Smith, DDS\nDr Bob Ray Owner\nDr. Jane A. Smith\nCall (210) 555-0100 rated 4.4 stars. Root canal, veneers and All-on-4.\n12 Oak Hill Blvd, Suite 3, Waco TX 76701"
    row = spark.createDataFrame([(t,), ("nothing",)], "t string").select(people.dump_fields("t").alias("d")).collect()
    d = row[0].d
    assert d.doctors == ["Dr. Jane A. Smith", "Dr. Bob Ray"] and d.phone == "(210) 555-0100" and d.rating == 4.4 and d.services == "Root canal, Veneers, All-on-4" and d.address.startswith("12 Oak Hill Blvd")
    assert tuple(row[1].d) == ([], None, None, None, None)


def test_sitemaps_of_sitemaps(spark):
    loc = lambda kind, *urls: "".join(f"<{kind}><loc> {u} </loc></{kind}>" for u in urls)
    maps = spark.createDataFrame([
        ("https://x.com/sitemap.xml", "<sitemapindex>" + loc("sitemap", "https://x.com/posts.xml", "https://x.com/pages.xml", "https://x.com/sitemap.xml") + "</sitemapindex>"),
        ("https://x.com/pages.xml", "<urlset>" + loc("url", "https://x.com/a", "https://y.com/b", "https://x.com/members/c", "https://x.com/d.pdf") + "</urlset>"),
        ("https://x.com/posts.xml", "<sitemapindex>" + loc("sitemap", "https://x.com/deep.xml") + "</sitemapindex>"), ("https://x.com/deep.xml", loc("url", "https://www.x.com/e", "https://x.com/a")),
    ], "url string, xml string")
    roots = spark.createDataFrame([("x.com", "https://x.com/sitemap.xml"), ("z.com", "https://z.com/sitemap.xml")], "host string, url string")
    got = sorted((r.host, r.url) for r in frontier.sitemap_pages(maps, roots).collect())
    assert got == [("x.com", "https://www.x.com/e"), ("x.com", "https://x.com/a")]
    assert frontier.sitemap_pages(maps, roots, depth=1).count() == 1
    assert maps.filter("url LIKE '%/sitemap.xml'").select(frontier.sitemap_children(F.col("xml"))).first()[0][0] == "https://x.com/pages.xml"


def test_provider_pages_and_staff_links(spark):
    links = spark.createDataFrame([(1, "https://c.com/o", "https://c.com/providers/jane?x=1"), (1, "https://c.com/o", "https://c.com/providers/bob/"), (1, "https://c.com/o", "https://c.com/providers/jane"), (1, "https://c.com/o", "https://other.com/providers/x"), (1, "https://c.com/o", "https://c.com/team")], "k int, page_url string, href string")
    pages = spark.createDataFrame([("https://c.com/providers/jane/", "About  Dr. Jane Smith of Waco"), ("https://c.com/providers/bob", "Dr. Bob Ray")], "url string, text string")
    assert sorted(r.name for r in frontier.provider_names(links, pages, ["k"]).collect()) == ["Bob Ray", "Jane Smith"]
    assert [r.name for r in frontier.provider_names(links, pages, ["k"], 1).collect()] == ["Bob Ray"]
    rows = links.withColumn("text", F.lit("")).unionByName(links.limit(1).withColumn("href", F.lit("https://c.com/blog/our-team")).withColumn("text", F.lit("")))
    assert [(r.url, r["rank"]) for r in frontier.staff_links(rows, ["k"], 2).orderBy("rank").collect()] == [("https://c.com/providers/bob/", 1), ("https://c.com/providers/jane", 2)]


def test_emails_by_path(spark):
    raw = spark.createDataFrame([(1, "https://x.com", "<p>home@x.org"), (1, "https://x.com/about", "<p>your.name@x.org, about@x.org"), (1, "https://x.com/contact-us", "<p>none <a href='/cdn-cgi/l/email-protection#5a2d32351a2d323f283f74343f2e'>m</a>"), (2, "https://y.com/team", "<p>a@y.org"), (3, "https://z.com/", "<p>noreply@z.org")], "k int, url string, html string")
    parsed = parse_pages(raw, keep=["k", "url", "html"])
    assert {r.k: r.email for r in frontier.email_by_paths(parsed, ["k"]).collect()} == {1: "who@where.net"}


def test_calls_are_made_once(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, "x"), (4, "b", "x")], "k int, s string, t string")
    got = {r.k: r.answer for r in match.call_once(rows, ["s", "t"], lambda values: [f"{s}-{t}" for s, t in values]).collect()}
    assert got == {1: "a-None", 2: "a-None", 3: "None-x", 4: "b-x"}
    asked = spark.sparkContext.accumulator(0)
    match.call_once(rows, ["s"], lambda values: [asked.add(1) or "y" for _ in values]).collect()
    assert asked.value == 3
    assert [r.answer for r in match.call_once(rows, ["s"], None).collect()] == [None] * 4


def test_calls_are_remembered_and_fail_open(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, "x"), (4, "b", "x"), (5, "bad", "x")], "k int, s string, t string")
    count, memo = spark.sparkContext.accumulator(0), f"file://{tmp_path}/memo"

    def ask(values):
        if any(s == "bad" for s, _ in values):
            raise ValueError("no answer")
        count.add(len(values))
        return [f"{s}-{t}" for s, t in values]

    want = {1: "a-None", 2: "a-None", 3: "None-x", 4: "b-x", 5: "none"}
    assert {r.k: r.answer for r in match.call_once(rows, ["s", "t"], ask, memo=memo, default="none").collect()} == want
    assert count.value == 3
    more = rows.unionByName(spark.createDataFrame([(6, "c", None)], rows.schema))
    assert {r.k: r.answer for r in match.call_once(more, ["s", "t"], ask, memo=memo, default="none").collect()} == {**want, 6: "c-None"}
    assert count.value == 4  # only what isn't remembered was asked, what raised again
    assert {r.k: r.answer for r in match.call_once(rows, ["s", "t"], ask).collect()} == {**want, 5: None}


def test_fallbacks_fill_what_wasn_t_reached(spark):
    cols = "idx int, website string, doctor_name string, email string, phone string, implants int"
    first = spark.createDataFrame([(1, "w", "Dr. A", "a@x", None, 3), (2, "w", "Not Found", "N/A", "1", 0), (3, "", None, None, None, 0)], cols)
    second = spark.createDataFrame([(1, None, None, None, "9", 0), (2, None, "Dr. B", "none", "2", 0)], cols)
    third = spark.createDataFrame([(2, None, "Dr. C", "c@x", None, 7), (3, None, None, None, None, 0)], cols)
    got = {r.idx: (r.doctor_name, r.email, r.phone, r.implants, r.filled_from) for r in pipelines.cascade(first, second, third).collect()}
    assert got == {1: ("Dr. A", "a@x", None, 3, 0), 2: ("Dr. B", "c@x", "1", 7, 2), 3: (None, None, None, None, 0)}


def test_registry_and_places_files(spark, tmp_path):
    npi = {"number": "1", "basic": {"first_name": "JANE", "last_name": "SMITH", "credential": "D.D.S.", "status": "A"}, "addresses": [{"address_purpose": "MAILING", "address_1": "PO 1", "city": "X", "state": "TX"}, {"address_purpose": "LOCATION", "address_1": "12 Oak St", "city": "Waco", "state": "TX", "organization_name": "Bright"}], "taxonomies": [{"desc": "Dentist"}]}
    (tmp_path / "npi.json").write_text("\n".join(json.dumps(x) for x in (npi, {**npi, "number": "2", "basic": {**npi["basic"], "status": "D"}})))
    got = match.npi_people(listings.read_npi(spark, f"file://{tmp_path}/npi.json")).collect()
    assert [(r.number, r.person, r.credential, r.street, r.organisation, r.taxonomy) for r in got] == [("1", "Jane Smith", "DDS", "12 Oak St", "Bright", "Dentist")]
    (tmp_path / "places.json").write_text(json.dumps({"idx": 1, "candidates": [{"place_id": "a", "formatted_address": "1 A St, Reno, NV"}, {"place_id": "b", "formatted_address": "2 B St, Waco, TX", "rating": 4.5, "user_ratings_total": 9}]}))
    rows = listings.read_places(spark, f"file://{tmp_path}/places.json")
    assert rows.select(signals.place_text_pick("candidates", F.lit("waco"), F.lit("ZZ"))["place_id"]).first()[0] == "b"
    assert rows.select(signals.place_text_pick("candidates", F.lit("Dallas"), F.lit("ZZ"))).first()[0] is None
    df = spark.createDataFrame([("12 Oak Hill Street", "99 OAK Road"), ("1 A St", "1 A St")], "a string, b string")
    assert [r[0] for r in df.select(match.street_tokens_match(F.col("a"), F.col("b"))).collect()] == [False, False]
    assert df.select(match.street_tokens_match(F.lit("12 Maple Street"), F.lit("9 MAPLE ave"))).first()[0]
    assert spark.createDataFrame([('<span aria-label="4.8 stars, 210 reviews">',), ("rated 4.9 out of 5, based on 57 reviews",)], "h string").select(signals.search_rating("h")["method"]).collect() == [("label",), (None,)]


def test_texts_and_fills_of_persons(spark):
    who = spark.createDataFrame([(1, "Jane Smith"), (1, "Bob Ray")], "k int, name string")
    texts = spark.createDataFrame([(1, 1, "smith"), (1, 2, "Here Dr. SMITH tells of her work in general"), (1, 3, "Another page where Dr. Smith is named too")], "k int, page_ord int, text string")
    assert [(r.name, r.text[:4]) for r in match.text_of_person(who, texts, ["k"]).collect()] == [("Jane Smith", "Here")]
    batch = spark.createDataFrame([(1, "Jane Smith", "Not Found", "ADA"), (1, "Bob Ray", "n/a", "-")], "idx int, doctor_name string, specialty string, associations string")
    found = spark.createDataFrame([(1, "Jane Smith", "Ortho", "AGD"), (1, "Bob Ray", "none", "AAO")], "idx int, doctor_name string, specialty string, associations string")
    assert {(r.doctor_name, r.specialty, r.associations) for r in pipelines.fill_specialty(batch, found).collect()} == {("Jane Smith", "Ortho", "ADA"), ("Bob Ray", "n/a", "AAO")}
    a = "array<string>"
    df = spark.createDataFrame([(["A", "B"], ["b", "C"]), (["A"] * 5, ["C"])], f"h {a}, f {a}")
    assert [r[0] for r in df.select(pipelines.supplement(F.col("h"), F.col("f"))).collect()] == [["A", "B", "C"], ["A"] * 5]


def test_sinks_write_and_replace(spark, tmp_path):
    out = f"file://{tmp_path}"
    pages = spark.createDataFrame([(1, "homepage", "u", "old", "t1", 1), (1, "homepage", "u", "new", "t2", 1), (2, "homepage", "v", "x", "t1", 1)], "practice_id int, page_type string, url string, html string, saved_at string, page_ord int")
    latest = sinks.latest_pages(pages)
    assert sorted((r.practice_id, r.html) for r in latest.collect()) == [(1, "new"), (2, "x")]
    sinks.write_pages(latest, f"{out}/pages")
    sinks.write_pages(latest.filter("practice_id = 1").withColumn("html", F.lit("newer")), f"{out}/pages")
    assert sorted((r.practice_id, r.html) for r in spark.read.parquet(f"{out}/pages").collect()) == [(1, "newer"), (2, "x")]
    rows = spark.createDataFrame([(1, "P", "D", "C", "S", "w", "blocked"), (2, "Q", "D", "C", "S", "w", "")], "idx int, practice_name string, doctor_name string, city string, state string, website string, skip_reason string")
    sinks.write_skipped(rows, f"{out}/skipped")
    assert [(r.idx, r.skip_reason) for r in spark.read.option("header", True).csv(f"{out}/skipped").collect()] == [("1", "blocked")]
    sinks.write_results(spark.createDataFrame([(1, {"a": "b"})], "practice_id int, result map<string,string>"), f"{out}/results")
    assert spark.read.json(f"{out}/results").first().result.a == "b"
    chain = sinks.chain_rows(rows)
    assert len(chain.columns) == 17 and chain.first().phone is None
