"""Element intervals against a plain walk through random trees; staff, hygienists and evidence on made-up pages."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sitegrain.functions import tree
from sitegrain.functions.html import parse, parse_pages
from sitegrain.functions.people import is_hint
from sitegrain.plans import pipelines

TAGS = ["div", "section", "li", "span", "h2", "h3", "h5", "b", "em"]
TEXTS = ["Dr. Ann Lee", "Bob Ray, DDS", "Ann Lee", "Our Office", "general dentist", "hikes", "a long line about implants " * 3, "x"]


class Plain:
    def __init__(self, tag, up=None):
        self.tag, self.up, self.kids, self.words = tag, up, [], []

    def all(self):
        for k in self.kids:
            if isinstance(k, Plain):
                yield k
                yield from k.all()

    def text(self):
        return " ".join(t for t in (k.text() if isinstance(k, Plain) else k for k in self.kids) if t)

    def ups(self):
        while self.up is not None:
            self = self.up
            yield self

    def following(self):
        own = self.up.kids
        return own[own.index(self) + 1 :]


def grow(rng, depth=0, tag="body", up=None):
    node = Plain(tag, up)
    for _ in range(rng.randint(1, 4)):
        if depth < 5 and rng.random() < 0.7:
            node.kids.append(grow(rng, depth + 1, rng.choice(TAGS), node))
        else:
            node.kids.append(rng.choice(TEXTS).strip())
    return node


def html_of(node):
    return f"<{node.tag}>" + " ".join(html_of(k) if isinstance(k, Plain) else k for k in node.kids) + f"</{node.tag}>"


def doctor(n):
    return n.tag in ("h2", "h3", "h5") and re.search(r"\b(Dr\.?|DDS|DMD|Doctor)\b", n.text(), re.I)


def walk(h, least=31):
    for a in h.ups():
        if a.tag not in ("div", "section", "li"):
            continue
        if any(doctor(n) and n is not h for n in a.all()):
            break
        if len(a.text()) >= least:
            return a.text()
    parts = [h.text()]
    for s in h.following():
        if isinstance(s, Plain) and doctor(s):
            break
        parts.append(s.text() if isinstance(s, Plain) else s)
    return " ".join(p for p in parts if p)


@pytest.mark.parametrize("seed", range(3))
def test_random_trees(spark, seed):
    rng = random.Random(seed)
    roots = [grow(rng) for _ in range(25)]
    plain = [[n for n in r.all()] for r in roots]
    pages = spark.createDataFrame([(k, html_of(r), "https://x.co/") for k, r in enumerate(roots)], "k int, html string, url string")
    t = tree.tree()
    every = F.transform("elements", lambda e: F.struct(e["tag"].alias("tag"), tree.said(t, e).alias("said"), tree.own_text(t, e).alias("own"), F.transform(tree.siblings(t, e), lambda s: tree.said(t, s)).alias("after"), F.transform(tree.ancestors(t, e), lambda a: a["tag"]).alias("up")))
    rows = parse_pages(pages).select("k", "text", "elements", "links").select("k", every.alias("all")).collect()
    assert len(rows) == 25
    for r in rows:
        told = [x for x in r["all"] if x.tag != "body"]
        assert [x.tag for x in told] == [n.tag for n in plain[r.k]]
        for x, n in zip(told, plain[r.k]):
            assert x.said == n.text()
            assert list(x.after) == [s.text() for s in n.following() if isinstance(s, Plain)]
            assert list(x.up) == [a.tag for a in n.ups() if a.tag in ("div", "section", "li")]
            assert x.own == walk(n)


TEAM = """<html><body><div class="row"><div class="team-card"><h3>Dr. Ann Leeson, DDS</h3><p>Orthodontist</p><p>Ann is an AGD fellow who has straightened teeth in town for twenty years.</p><a href="/dr-leeson">Learn more</a></div>
<div class="team-card"><h3>Bob Rayner, DMD</h3><a href="/x">first</a><a href="/team/bob">profile</a></div></div>
<h2>Interview with Dr. Cy Twombly</h2>
<div class="card"><h4>Jane M. Smith</h4><p>Registered Dental Hygienist</p></div><div class="card"><h4>Ted Poe</h4><p>He works with our many hygienists and every dental hygienist of the region, day after day after day, gladly.</p></div><span>Dawn, RDH</span></body></html>"""


def parsed(spark, *pages):
    return parse_pages(spark.createDataFrame([(1, n, u, h) for n, (u, h) in enumerate(pages, 1)], "k int, page_ord int, url string, html string"))


def test_people_of_a_page(spark):
    row = parsed(spark, ("https://h.co/team", TEAM)).select(pipelines.page_people().alias("p"), tree.hygienist_names(tree.tree()).alias("h"), tree.anonymous_hygienists(tree.tree()).alias("a")).first()
    ann, bob = row.p
    assert (ann.name, ann.hint, ann.link) == ("Ann Leeson", "Orthodontist", "https://h.co/dr-leeson") and "AGD fellow" in ann.own and "Bob" not in ann.own
    assert (bob.name, bob.hint, bob.link) == ("Bob Rayner", None, "https://h.co/team/bob") and bob.own.startswith("Bob Rayner, DMD") and "Leeson" not in bob.own
    assert sorted(row.h) == ["dawn", "jane m. smith"]
    assert set(row.a) == {"jane m. smith", "registered dental hygienist", "dawn, rdh", "ted poe", "he works with our many hygienists and every dental hygienist"}


def test_hints(spark):
    said = {"Orthodontist": True, "General & family dentistry": True, "About Us Our Dentists John": False, "John Doe, DDS": False, "home of implants": False, "homely implants": True, "hikes a lot": False, "dent": False, "x" * 80 + " dentistry": True, "x" * 90 + " dentistry": False, None: False}
    df = spark.createDataFrame(list(enumerate(said)), "k int, t string")
    assert [r[0] for r in df.orderBy("k").select(is_hint("t")).collect()] == list(said.values())


def test_evidence_in_order_of_trust(spark):
    """Card, page by its address, linked page, heading elsewhere, whole site, hint: each is taken where those before say nothing."""
    filler = "words about nothing in particular, " * 5
    pages = [
        ("https://h.co/team", f"<div><h3>Dr. Ann Leeson</h3><p>Implants are hers: dental implant care</p><p>{filler}</p></div><div><h3>Dr. Bob Rayner</h3><p>{filler}</p></div><div><h3>Dr. Cy Moss</h3><a href='/third'>more about</a><p>{filler}</p></div><div><h3>Dr. Di Pennel</h3><p>{filler}</p></div><div><h3>Dr. Ed Quill</h3><p>Pediatric care, certified</p></div>"),
        ("https://h.co/dr-leeson", f"<div><h1>Dr. Ann Leeson</h1><p>root canal therapy, ADA. {filler}</p></div>"),
        ("https://h.co/dr-rayner", f"<div><p>Rayner does root canal therapy. {filler}</p></div><p>{filler}</p><p>{filler}</p>"),
        ("https://h.co/third", f"<div><p>Moss is an orthodontist. {filler}</p></div><p>{filler}</p><p>{filler}</p>"),
        ("https://h.co/fourth", f"<section><h2>Dr. Pennel, DDS</h2><p>oral surgery, and {filler}</p></section><section><h2>Dr. Else, DDS</h2><p>laser dentistry {filler}</p></section>"),
        ("https://h.co/blog/rayner", "<p>Rayner talks of laser dentistry and IAOMT</p>"),
    ]
    rows = parsed(spark, *pages)
    got = {r.name: (r.specialty, r.associations) for r in pipelines.doctors(rows, ["k"]).collect()}
    assert got == {"Ann Leeson": ("Implants", ["ADA"]), "Bob Rayner": ("Endodontics", []), "Cy Moss": ("Orthodontics", []), "Di Pennel": ("Oral Surgery", []), "Ed Quill": ("Pediatric care, certified", [])}
    sources = {(r.name, r.source) for r in pipelines.evidence(pipelines.staff(rows, ["k"]), rows, ["k"]).collect()}
    assert {("Ann Leeson", 1), ("Ann Leeson", 2), ("Bob Rayner", 2), ("Cy Moss", 3), ("Di Pennel", 4), ("Ed Quill", 6)} <= sources and not any(s == 5 for _, s in sources)
    alone = parsed(spark, ("https://g.co/", f"<h2>Dr. Solo Vane, DDS</h2><p>{filler}</p>"), ("https://g.co/about-it", "<p>We do root canal therapy</p>"))
    assert [(r.name, r.specialty) for r in pipelines.doctors(alone, ["k"]).collect()] == [("Solo Vane", "Endodontics")]


def test_offsets_are_those_of_the_text():
    row = parse("<div>a<p> b <b>c</b></p><title>t</title><p></p></div>tail", "https://x.co/")
    told = {(e["tag"], row["text"][e["start"] : e["stop"]]) for e in row["elements"]}
    assert row["text"] == "a b c tail" and {("div", "a b c"), ("p", "b c"), ("b", "c"), ("p", "")} <= told
