import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitegrain.functions import formats, html, missing, names, signals, text, urls
from sitegrain.operators import entity


def one(spark, *cols, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    row = df.select(*cols).first()
    return row[0] if len(cols) == 1 else tuple(row)


def many(spark, values, make, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in df.select(make(F.col("v")).alias("x"), "k").orderBy("k").select("x").collect()]


def test_missing_policies_against_python(spark):
    values = [None, "", " ", "Not Found", "not found", "N/A", "n/a", "None", "ERROR", "error", "0", "0.0", "-", "Blocked", "blocked", "See Website", "X", "no", "false", "nan"]
    for policy, (mode, tokens) in missing.POLICIES.items():
        def model(v):
            if v is None:
                return True
            return {"lower": v.strip(" ").lower() in tokens, "either": v.strip(" ") in tokens or v.strip(" ").lower() in tokens, "exact": v in tokens}[mode]

        assert many(spark, values, lambda c: missing.is_missing(c, policy)) == [model(v) for v in values], policy
    assert many(spark, ["3.0", "x", "-2.7", None, "7"], missing.whole_number) == [3, None, -2, None, 7]


@settings(max_examples=40, deadline=None)
@given(st.text("ab-", max_size=30), st.text("ab", min_size=1, max_size=3), st.integers(1, 4))
def test_count_keyword_is_pythons_count(spark, t, w, cap):
    assert one(spark, text.count_keyword("t", w), t=t) == t.count(w)
    assert one(spark, text.count_keyword("t", w, cap), t=t) == min(cap, t.count(w))


def test_visible_text(spark):
    page = "<html><style>p{}</style><NAV>menu</NAV><!-- no --><p>Hello\n <b>World</b></p><script>var x='</p>';</script><noscript>n</noscript><footer>f</footer>"
    assert one(spark, text.visible_text("h"), text.visible_text("h", body=True), h=page) == ("menu hello world f", "hello world")
    assert one(spark, text.visible_text("h"), h=None) == ""


def test_emails(spark):
    values = ["write to NOREPLY@x.com or joe@site.org", "no mail", None, "a@example.com", "a@my.example.com", "your.name@site.org demo1@x.org joe@x.org"]
    assert many(spark, values, lambda c: text.first_email(c, "first")) == [None, None, None, None, "a@my.example.com", "your.name@site.org"]
    assert many(spark, values, lambda c: text.first_email(c, "any")) == ["joe@site.org", None, None, None, "a@my.example.com", "joe@x.org"]
    assert many(spark, values, lambda c: text.first_email(c, "plain")) == ["NOREPLY@x.com", None, None, "a@example.com", "a@my.example.com", "your.name@site.org"]
    a = "array<string>"
    ranked = spark.createDataFrame([(["zz"], ["noreply@x.org", "ok@x.org"], "in@text.org", []), ([], [], "noreply@x.org in@text.org", ["test@a.org", "foot@x.org"])], f"h {a}, m {a}, t string, b {a}")
    assert [r[0] for r in ranked.select(text.email_by_priority(F.col("h"), F.col("m"), F.col("t"), F.col("b"))).collect()] == ["ok@x.org", "foot@x.org"]
    key = 0x5A
    hidden = f"{key:02x}" + "".join(f"{ord(ch) ^ key:02x}" for ch in "who@where.net")
    assert many(spark, [hidden, "zz", "5a", None], text.decode_hidden_email) == ["who@where.net", None, None, None]


def test_contact_and_pages(spark):
    assert many(spark, ["call (210) 555-0100 now", "x", None], text.first_phone) == ["(210) 555-0100", None, None]
    assert many(spark, ["at 12 North Main Street, ok", "x"], text.first_street) == ["12 North Main Street", None]
    assert many(spark, ["We have 3 convenient locations", "our four offices", "at multiple locations", "12 Oak Street, Waco, TX 76701 and 21 Elm Street, Waco, TX 76702", "one office", "99 locations", "1 location", "find us at all offices"], text.locations) == ["3", "4", "Multiple", "2", "1", "1", "1", "Multiple"]
    linked = spark.createDataFrame([([("https://x.com/our-offices/", "go")],), ([("https://x.com/team", " Locations ")],), ([("https://x.com/team", "x")],)], "l array<struct<href:string,text:string>>")
    assert [r[0] for r in linked.select(text.locations(F.lit("x"), F.col("l"))).collect()] == ["Multiple", "Multiple", "1"]
    assert many(spark, ["Just a moment...", "<p>fine</p>", None], text.is_challenge) == [True, False, False]
    assert many(spark, ['<body><div id="root"></div></body>', '<div id="root">' + "text " * 90 + "</div>"], text.is_script_shell) == [True, False]
    assert many(spark, ["You must log in to continue."], lambda c: text.is_login_wall(c, "facebook")) == [True]


def test_urls(spark):
    given_ = ["https://WWW2.Site.com:8080/a?b#c", "site.com", "http://x.org/p/", ""]
    assert many(spark, given_, urls.domain_key) == ["site.com:8080", "site.com", "x.org", ""]
    assert many(spark, given_[:3], urls.homepage) == ["https://www2.site.com:8080/", "https://site.com/", "http://x.org/"]
    assert many(spark, ["https://facebook.com/Smiles", "https://facebook.com/2008/", "https://facebook.com/2008/fbml", "https://facebook.com/plugins/like", "https://facebook.com/events/", "https://facebook.com/events-hall", "https://facebook.com", "https://x.com/a", None], lambda c: urls.is_profile(c, "facebook")) == [True, False, False, False, False, True, False, False, False]
    assert many(spark, ["https://www.linkedin.com/company/acme", "https://linkedin.com/company/heartland-dental", "https://linkedin.com/company/Heartland-Dental-/about", "https://linkedin.com/in/acme"], lambda c: urls.is_profile(c, "linkedin")) == [True, False, False, True]
    assert many(spark, ['<a href="https://instagram.com/explore/1"></a><a href="https://instagram.com/wix.com"></a><a href="https://instagram.com/smile.co/?x=1"></a>', "none"], lambda c: urls.first_profile(c, "instagram")) == ["https://instagram.com/smile.co", None]
    assert many(spark, ["https://www.tiktok.com/@smile.co?x=1"], urls.username) == ["smile.co"]
    assert many(spark, ["https://x.com/blog/a", "https://x.com/events/x", "https://x.com/press-release/x", "https://x.com/dental-tips/x", "https://x.com/NEWS", "https://x.com/author/jane", "https://x.com/newsroom/a", "https://x.com/team", None], urls.is_content) == [True, True, True, True, True, False, False, False, False]
    assert many(spark, ["https://www.yelp.com/biz/x", "https://vitals.com/a", "https://x.org/doctors-locations/a", "https://x.com", None], urls.is_portal) == [True, True, True, False, False]
    assert many(spark, ["hallfamilydent.com/a", "https://www.dent.co", "https://xdental.com/"], urls.variants) == [
        ["https://hallfamilydent.com/a", "https://www.hallfamilydent.com/a", "http://hallfamilydent.com/a", "http://www.hallfamilydent.com/a", "https://hallfamilydental.com/a", "https://www.hallfamilydental.com/a"],
        ["https://www.dent.co", "https://dent.co/", "http://dent.co/", "http://www.dent.co/", "https://dental.co/", "https://www.dental.co/"],
        ["https://xdental.com/", "https://www.xdental.com/", "http://xdental.com/", "http://www.xdental.com/"],
    ]
    assert many(spark, ["100-n-main-st-ste-4"], urls.slug_address) == ["100 N Main St Ste 4"]
    assert many(spark, ["https://www.facebook.com/x"], urls.mobile) == ["https://m.facebook.com/x"]
    assert many(spark, ["Dr. O'Neil & Sons Family Dentistry of X"], urls.folder_slug) == ["Dr_O_Neil_Sons_Family_Dentistr"]


def test_formats(spark):
    assert many(spark, [1234, 1250, 999, 2_500_000, 12_345], formats.compact, "long") == ["1.2K", "1.2K", "999", "2.5M", "12.3K"]
    assert many(spark, ["12.3K", "1,234", "2M", "x"], formats.from_compact) == [12300, 1234, 2_000_000, None]
    assert many(spark, ["o'brien mc-donald x", "ANNA"], formats.title) == ["O'Brien Mc-Donald X", "Anna"]
    assert many(spark, ["Bright Smiles, LLC", "A B DDS", "Plain"], formats.without_suffix) == ["Bright Smiles", "A B", "Plain"]
    assert one(spark, formats.percent(F.lit(1), F.lit(8)), formats.percent(F.lit(3), F.lit(8)), formats.percent(F.lit(0), F.lit(0))) == (12, 38, 0)


def test_names(spark):
    given_ = ["Dr. Jane A. Smith, DDS", "jane a smith", None, "Robertss Ann-Lee D.D.S.", "Ann O'Neill Ph.D.", "Doo Woo"]
    assert many(spark, given_, names.normalised) == ["jane a smith", "jane a smith", "", "roberts ann lee", "ann o'neil", "doo woo"] == [entity.normalise(n) for n in given_]
    given_ = ["Dr. Jane A. Smith, DDS", "jane  smith PLLC", None, "Smile Inc.", "DR Ann Lee MS, PhD"]
    assert many(spark, given_, names.person_form) == ["jane a smith", "jane smith", "", "smile", "ann lee"] == [entity.person_form(n) for n in given_]
    assert many(spark, ["Dr. Jane A. Smith, DDS", "Jane Smith", "dr jane smith", "Jane Smith DDS", "J. Smith"], names.completeness) == [14, 2, 7, 3, 2]
    assert many(spark, ["Jane Smith", "Meet The Team", "Family Care", "JOHN SMITH III", "John Smith III", "Jane Periodontics", "", "Dr. Anna May, DDS", "Anna Membership", "A. Lee", "Rockville General"], names.is_person) == [True, False, True, False, True, False, False, False, False, True, False]
    assert many(spark, ["Jane Smith", "Family Care", "Room 1 Two", "A. Lee", "Dr. Anna Li, DDS"], names.is_found_name) == [True, False, False, False, True]
    bad = {
        "": "Empty / Not Found", "Not Found": "Empty / Not Found", None: "Empty / Not Found", "a@b.co": "URL or email in name field", "Smiles.com": "URL or email in name field", "Room 12": "Contains digits", "JOHN SMITH": "All uppercase",
        "JO LI": None, "Cher": "Single word — no first + last name", "J. Smith": "Single word — no first + last name", "ab cd ef gh ij kl": "Too long (6 words) — possibly a practice/office name", "Bright Dental Care": "Business term(s): Dental, Care",
        "Jane Smith": None, "Dr. Smith": None, "Anna Carey": None, "Maria Officer": None, "not found": "Empty / Not Found",
    }
    assert dict(zip(bad, many(spark, list(bad), names.bad_reason))) == bad
    assert many(spark, ["Austin Smiles", "Jane Doe"], lambda c: names.in_host(c, F.lit("austinfamily.com"))) == [True, False]
    assert one(spark, names.link_score("n", "h", "t"), n="Dr. Jane Smith", h="/team/jane-smith", t="Dr. Smith") == 38
    assert len(one(spark, names.bio_addresses("h", "n"), h="https://x.com/", n="Jane Smith")) == 10


@pytest.mark.parametrize(
    "page,want",
    [
        ('{"aggregateRating":{"ratingValue":"4.7","reviewCount":"1,203"}}', (4.7, 1203, "jsonld")),
        ('<span aria-label="4.8 stars, 210 reviews">', (4.8, 210, "label")),
        ("<b>4.6 (88)</b>", (4.6, 88, "brackets")),
        ("rated 4.9 out of 5, based on 57 reviews", (4.9, 57, "rated")),
        ("a 3.1 thing. 12 reviews there. Overall 4.4 from many: 950 reviews", (4.4, 950, "nearest")),
    ],
)
def test_rating_cascade(spark, page, want):
    assert tuple(one(spark, signals.rating("h"), h=page)) == want


def test_signals(spark):
    assert one(spark, signals.rating("h"), h="nothing") is None
    assert one(spark, signals.facebook_followers("h"), h='{"fan_count": 0} 12.5K people follow this') == 12500
    told = ['"like_count": 7', '"page_likers":{"count": 31}', '"likers":{"count":5}', '"profile_plus_follower_count":6', '"connected_users_count":8', '"social_context":{"text":"12 people follow"}', "1,234 likes", "nothing", None]
    assert many(spark, told, signals.facebook_followers) == [7, 31, 5, 6, 8, 12, 1234, None, None]
    assert tuple(one(spark, signals.instagram_counts("h"), h='"media_count":12,"follower_count":"340"')) == (12, 340)
    assert tuple(one(spark, signals.tiktok_counts("h"), h='"videoCount":7,"followerCount":99')) == (7, 99)
    assert tuple(one(spark, signals.profile_api_counts("h"), h='{"data":{"user":{"media_count":0,"follower_count":5}}}')) == (0, 5)
    assert one(spark, signals.tier("t", "n"), t="x" * 900 + " Gold " + "Smithson " + "x" * 900 + "Diamond", n="Jane Smithson") == "Gold"
    assert one(spark, signals.tier("t", "n"), t="silver only", n="Jane Smithson") == "Silver (verify name match)"
    assert one(spark, signals.tier("t", "n"), t="Gold " + "x" * 900 + " Gold Plus by Smithson; Bronze Plus", n="Jane Smithson") == "Gold Plus"
    assert one(spark, signals.tier("t", "n"), t="Gold " + "x" * 900 + " gold and Smithson", n="Jane Smithson") == "Gold"
    assert one(spark, signals.tier("t", "n"), t="nothing", n="Jane Smithson") is None
    assert many(spark, ["2 RDH on staff", "1 dental hygienist", "Hygienists on staff: 4", "3 licensed dental hygiene specialists", "Jane M. Smith, Registered Dental Hygienist", "Anna Lee, RDH and Bo Ray, RDH; Anna Lee, RDH", "Anna, RDH", "our gentle dental hygienist", None], signals.hygienists) == [2, 1, 4, 3, 1, 2, 1, None, None]
    assert one(spark, signals.json_find("j", "phone", ("$.a.phone",)), j='{"b":{"phone":"555"}}') == "555"
    c = "array<struct<formatted_address:string,rating:double>>"
    row = spark.createDataFrame([([("1 A St, Dallas, TX", None), ("2 B St, Austin, TX", 4.5)],)], f"c {c}")
    assert row.select(signals.place_pick("c", F.lit("austin"), F.lit("ZZ"))["rating"]).first()[0] == 4.5


def test_html_parser():
    page = """<title>T</title><meta name="description" content="Desc"><script type="application/ld+json">{"a":["LD"]}</script><body><header>Top</header>
    <h2>Dr. Ann Lee, DDS</h2><p>one <b>two<p>three <div class="menu-bar">m</div><div class="testimonial" data-x="1">so good</div><blockquote>nice</blockquote>
    <a href="/team/ann">Ann</a><a href="mailto:a@b.co?x">w</a><a data-cfemail="00">h</a><img alt="pic"><br>tail &amp; end"""
    r = html.parse(page, "https://h.com/x/y")
    assert r["title"] == "T" and "var" not in r["text"] and r["text"].endswith("tail & end") and "top" not in r["body_text"]
    assert all(w in r["aug_text"] for w in ("desc", "ld", "pic", "team", "ann", "x y"))
    assert r["headings"][0]["text"] == "Dr. Ann Lee, DDS" and r["headings"][0]["after"].startswith("one two three")
    assert r["links"][0] == {"href": "https://h.com/team/ann", "text": "Ann", "same_host": True, "pre": r["links"][0]["pre"]}
    assert r["mailtos"] == ["a@b.co"] and r["hidden"] == ["00"] and r["quotes"] == ["nice"] and r["reviews"][0]["text"] == "so good"


@settings(max_examples=200, deadline=None)
@given(st.text("<>/ab=\"'&; dpivscr!-\n", max_size=80))
def test_parser_never_fails(markup):
    assert set(html.parse(markup, "https://x.com/")) >= {"text", "links"}


def test_deep_find_and_fold():
    assert html.deep_find({"a": [{"b": 0}, {"c": {"b": 5}}]}, "b") == 5
    deep = {"b": 1}
    for _ in range(20):
        deep = {"x": deep}
    assert html.deep_find(deep, "b") is None
    assert html.ascii_fold("José Ñandú") == "Jose Nandu" and unicodedata.is_normalized("NFC", "é")
