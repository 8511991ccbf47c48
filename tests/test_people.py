import json

from pyspark.sql import functions as F

from sitegrain.functions import people, structured
from sitegrain.functions.html import parse_pages
from sitegrain.operators import merge
from sitegrain.plans import pipelines


def test_names_in_text(spark):
    t = "Meet Dr. Jane A. Smith and Bob Ray, DDS. dr. jane a. smith again. Dr. Family Care. Ann Lee, DMD"
    df = spark.createDataFrame([(t,)], "t string")
    assert df.select(people.names_in("t")).first()[0] == ["Jane A. Smith", "Bob Ray", "Ann Lee"]
    assert df.select(people.names_in("t", 1)).first()[0] == ["Jane A. Smith"]


def test_headings(spark):
    h = "array<struct<level:int,text:string,after:string>>"
    df = spark.createDataFrame([([(2, "Interview with Dr. Bad Title", ""), (2, "Dr. Jane A. Smith, DDS", ""), (3, "Dr. Bob Ray", "")], "Jane Smith")], f"h {h}, n string")
    row = df.select(people.names_in_headings("h").alias("names"), people.fuller_name("n", "h").alias("full")).first()
    assert row.names == ["Jane A. Smith", "Bob Ray"] and row.full == "Jane A. Smith"
    said = {"Interview with Dr. Jane Li": True, "How we care": False, "A Candid Conversation  with Dr. X": True, "Behind the Mask": True, "Ask the Dr. today": True, "Featuring Dr. Li": True, "Q&A with us": True, "Rewritten byways": False, None: False}
    rows = spark.createDataFrame(list(enumerate(said)), "k int, t string").orderBy("k")
    assert [r[0] for r in rows.select(people.is_article("t")).collect()] == list(said.values())


def test_structured_data(spark):
    ld = ["not json", json.dumps({"@graph": [{"@type": "Dentist", "telephone": "555", "address": {"streetAddress": "1 A St", "addressLocality": "Waco"}, "aggregateRating": {"ratingValue": "4.9", "reviewCount": "1,024"}, "employee": [{"name": "Jane Smith"}, "Bob Ray", {"firstName": "Ann", "lastName": "Lee"}]}]})]
    df = spark.createDataFrame([(1, ld), (2, None)], "k int, jsonld array<string>")
    got = {r.k: r for r in structured.organisations(df, ["k"]).collect()}
    assert (got[1].phone, got[1].street, got[1].city, got[1].rating, got[1].reviews, got[1].people) == ("555", "1 A St", "Waco", 4.9, 1024, ["Jane Smith", "Bob Ray", "Ann Lee"])
    assert got[2].phone is None and got[2].people == []
    state = json.dumps({"props": {"pageProps": {"office": {"phone": "777", "address": {"line1": "2 B St", "city": "Reno"}, "providers": [{"fullName": "Cy Doe"}]}}}})
    df = spark.createDataFrame([(1, state), (2, "{bad"), (3, None)], "k int, state string")
    got = {r.k: r for r in structured.page_states(df, ["k"]).collect()}
    assert (got[1].phone, got[1].street, got[1].city, got[1].people) == ("777", "2 B St", "Reno", ["Cy Doe"]) and got[2].people == [] and got[3].phone is None
    assert {r.k: r.value for r in structured.find_key(df, "state", "city", ["k"]).collect()} == {1: "Reno", 2: None, 3: None}
    assert structured.state_text('{"a":["X",{"b":"Y"}]}') == "x y"


def test_chain_locations(spark):
    raw = spark.createDataFrame([(1, "https://c.com/offices/tx/waco/12-oak-st/", "<p>Call (210) 555-0100. Dr. Jane Smith</p>"), (2, "https://c.com/offices/nv/reno/9-elm-ave/", "<p>none</p>")], "idx int, url string, html string")
    states = spark.createDataFrame([(1, "{}"), (2, json.dumps({"providers": [{"name": "Cy Doe"}], "phone": "777"}))], "idx int, state string")
    got = {r.idx: r for r in pipelines.chain_locations(parse_pages(raw), states).collect()}
    assert (got[1].phone, got[1].street, got[1].city, got[1].state, got[1].people) == ("(210) 555-0100", "12 Oak St", "Waco", "TX", ["Jane Smith"])
    assert (got[2].phone, got[2].street, got[2].people) == ("777", "9 Elm Ave", ["Cy Doe"])


def test_runs(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, "a")], "pos int, v string")
    assert [(r.pos, r.run) for r in merge.runs(rows, "v").orderBy("pos").collect()] == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4)]
