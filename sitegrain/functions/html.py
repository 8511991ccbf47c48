"""One parse a page: everything later stages need of the markup, as one row.

The parser is the standard library's, with rules of our own for trees: void
elements have no content, a ``p`` ends at the next block element, an end tag
closes up to its element, and what is never closed ends with the page. It runs
in Arrow batches; markup isn't carried past it.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..rules import REVIEW_DATA_MARKS, REVIEW_MARKS

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table ul".split())
SILENT = frozenset(("script", "style", "noscript"))
CHROME = frozenset(("nav", "header", "footer"))
CHROME_CLASS = re.compile(r"(?:^|[-_ ])(?:menu|nav|navbar|sidebar|breadcrumb|footer|header)(?:$|[-_ ])")
#: What may mark a testimonial under any policy: a class or id, a data attribute's value, an item property. ``rules`` has the policies' own.
REVIEW_MARK = re.compile("|".join(REVIEW_MARKS), re.I)
REVIEW_DATA = re.compile("|".join((*REVIEW_MARKS, *REVIEW_DATA_MARKS)), re.I)
REVIEW_CHARS = 200
CARD_CLASS = re.compile(r"team|staff|member|provider|doctor|bio|person|profile")
ATTRIBUTES = ("title", "aria-label", "alt", "placeholder", "data-title", "data-label")
META = ("description", "keywords", "og:title", "og:description", "twitter:title", "twitter:description")
CONTACT_CLASS = re.compile(r"contact|footer|info")
EMAIL = re.compile(r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}")
HIDDEN = re.compile(r"(?:data-cfemail=\"|/email-protection#)([0-9a-fA-F]+)")

SCHEMA = (
    "title string, text string, body_text string, aug_text string, headings array<struct<level:int,text:string,after:string>>, links array<struct<href:string,text:string,same_host:boolean,pre:int>>,"
    " mailtos array<string>, hidden array<string>, jsonld array<string>, reviews array<struct<tag:string,cls:string,id:string,data:string,item:string,text:string>>, quotes array<string>, cards array<string>, contacts array<string>,"
    " elements array<struct<pre:int,last:int,depth:int,tag:string,cls:string,start:int,stop:int>>"
)
SPACE = re.compile(r"\s+")


def squeeze(text: str) -> str:
    return SPACE.sub(" ", text).strip()


class Node:
    __slots__ = ("tag", "attrs", "parts", "chrome", "pre", "first")

    def __init__(self, tag: str, attrs: dict, chrome: bool, pre: int = 0, first: int = 0):
        self.tag, self.attrs, self.parts, self.chrome, self.pre, self.first = tag, attrs, [], chrome, pre, first


class Page(HTMLParser):
    """Collects texts per open element; an element's text goes to its parent when it closes.

    Elements are numbered in the order they open; a closed one is told with the
    number of the last element inside it and with its parts of the page's text,
    so that what lies in what is a comparison of numbers.
    """

    def __init__(self, url: str = ""):
        super().__init__(convert_charrefs=True)
        self.url, self.stack, self.opened, self.elements = url, [Node("", {}, False)], 0, []
        self.silent, self.script = 0, None
        self.text, self.body, self.extra = [], [], []
        self.title, self.headings, self.links, self.mailtos, self.hidden = [], [], [], [], []
        self.jsonld, self.reviews, self.quotes, self.cards, self.contacts = [], [], [], [], []

    def handle_starttag(self, tag, attrs):
        own = {k: v or "" for k, v in attrs}
        if tag in SILENT:
            self.silent += 1
            if tag == "script":
                self.script = [] if "ld+json" in own.get("type", "") else None
            return
        if tag in BLOCK:
            k = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i].tag == "p"), 0)
            if k and all(n.tag not in BLOCK or n.tag == "p" for n in self.stack[k:]):
                self.close(k)
        if tag == "meta" and (own.get("name") or own.get("property", "")).lower() in META:
            self.extra.append(own.get("content", ""))
        self.extra += [own[a] for a in ATTRIBUTES if own.get(a)]
        if own.get("data-cfemail"):
            self.hidden.append(own["data-cfemail"])
        if tag not in VOID:
            chrome = self.stack[-1].chrome or tag in CHROME or bool(CHROME_CLASS.search(own.get("class", "").lower()))
            self.opened += 1
            self.stack.append(Node(tag, own, chrome, self.opened, len(self.text)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
            if tag == "script" and self.script is not None:
                self.jsonld.append("".join(self.script))
                self.script = None
            return
        k = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i].tag == tag), 0)
        if k:
            self.close(k)

    def handle_data(self, data):
        if self.script is not None:
            self.script.append(data)
        if self.silent or not data.strip():
            return
        for part in (squeeze(data),):
            self.stack[-1].parts.append(part)
            if self.stack[-1].tag != "title":
                self.text.append(part)
                if not self.stack[-1].chrome:
                    self.body.append(part)
            if self.headings and len(self.headings[-1][2]) < 400 and not any(n.tag in ("h1", "h2", "h3", "h4", "h5") for n in self.stack):
                self.headings[-1][2] += " " + part

    def close(self, k: int) -> None:
        while len(self.stack) > k:
            node = self.stack.pop()
            text = " ".join(node.parts)
            self.stack[-1].parts += node.parts
            self.elements.append((node.pre, self.opened, len(self.stack), node.tag, node.attrs.get("class", "").lower(), node.first, len(self.text)))
            self.done(node, text)

    def done(self, node: Node, text: str) -> None:
        tag, attrs = node.tag, node.attrs
        if tag == "title":
            self.title.append(text)
        if tag in ("h1", "h2", "h3", "h4", "h5"):
            self.headings.append([int(tag[1]), text, ""])
        if tag == "a" and attrs.get("href"):
            href = attrs["href"].strip()
            if href.lower().startswith("mailto:"):
                self.mailtos.append(href[7:].split("?")[0])
            else:
                self.hidden += HIDDEN.findall(href)
                try:
                    full = urljoin(self.url, href)
                    same = urlsplit(full).netloc.lower() == urlsplit(self.url).netloc.lower()
                except ValueError:
                    full, same = href, False
                if not href.lower().startswith(("javascript:", "tel:")):
                    self.links.append((full, text, same, node.pre))
                    if same:
                        self.extra += [w for w in re.split(r"[^A-Za-z]+", urlsplit(full).path) if w]
        if text:
            cls, ident, data, item = attrs.get("class", ""), attrs.get("id", ""), "\n".join(v for a, v in attrs.items() if a.startswith("data-")), attrs.get("itemprop", "")
            if REVIEW_MARK.search(cls) or REVIEW_MARK.search(ident) or REVIEW_DATA.search(data) or "review" in item.lower():
                self.reviews.append((tag, cls.lower(), ident.lower(), data.lower(), item.lower(), text[:REVIEW_CHARS]))
            if tag == "blockquote":
                self.quotes.append(text)
            if tag in ("div", "section", "footer") and CONTACT_CLASS.search(attrs.get("class", "").lower()) and (found := EMAIL.search(text)):
                self.contacts.append(found.group())
            if 20 <= len(text) <= 700 and CARD_CLASS.search(attrs.get("class", "").lower()):
                self.cards.append(text)


def json_strings(value) -> Iterator[str]:
    """Every string in a JSON tree, in order."""
    if isinstance(value, str):
        yield value
    elif isinstance(value, dict):
        for v in value.values():
            yield from json_strings(v)
    elif isinstance(value, list):
        for v in value:
            yield from json_strings(v)


def deep_find(value, key: str, depth: int = 12):
    """The first truthy value under a key, depth first; None beyond the depth."""
    if depth < 0:
        return None
    if isinstance(value, dict):
        if value.get(key):
            return value[key]
        value = list(value.values())
    if isinstance(value, list):
        for v in value:
            found = deep_find(v, key, depth - 1)
            if found:
                return found
    return None


def ascii_fold(text: str) -> str:
    """Letters without their marks; other characters beyond ASCII go."""
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def parse(html: str | None, url: str | None = "") -> dict:
    """The row of a page; never raises on markup."""
    page = Page(url or "")
    try:
        page.feed(html or "")
        page.close_all()
    except (AssertionError, ValueError):
        pass
    for block in page.jsonld:
        try:
            page.extra += list(json_strings(json.loads(block)))
        except (ValueError, RecursionError):
            continue
    page.extra += [w for w in re.split(r"[^A-Za-z]+", urlsplit(url or "").path) if w] if url else []
    text, at, ends = " ".join(page.text), [0], [0]
    for part in page.text:  # where parts begin and end in the text
        ends.append(at[-1] + len(part))
        at.append(ends[-1] + 1)
    elements = [(pre, last, depth, tag, cls, at[a] if b > a else min(at[a], len(text)), ends[b] if b > a else min(at[a], len(text))) for pre, last, depth, tag, cls, a, b in sorted(page.elements)]
    return {
        "title": " ".join(page.title) or None, "text": text, "body_text": " ".join(page.body).lower(), "aug_text": squeeze(" ".join([text, *page.extra])).lower(),
        "headings": [{"level": a, "text": b, "after": c.strip()} for a, b, c in page.headings], "links": [dict(zip(("href", "text", "same_host", "pre"), x)) for x in page.links],
        "mailtos": page.mailtos, "hidden": page.hidden, "jsonld": page.jsonld, "reviews": [dict(zip(("tag", "cls", "id", "data", "item", "text"), x)) for x in page.reviews], "quotes": page.quotes, "cards": page.cards, "contacts": page.contacts,
        "elements": [dict(zip(("pre", "last", "depth", "tag", "cls", "start", "stop"), x)) for x in elements],
    }


def _close_all(self) -> None:
    HTMLParser.close(self)
    Page.close(self, 1)


Page.close_all = _close_all


#: Markup parsed together, in bytes: a page's elements, links and texts as Python objects take many times its own.
PORTION = 1 << 20


def portions(batch: pa.RecordBatch, column: int, most: int = PORTION) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` bytes of a text column; a longer text is a part of its own. No rows: one empty part."""
    first, held = 0, 0
    for k, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if k > first and held + (n or 0) > most:
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += n or 0
    yield batch.slice(first)


def parse_pages(pages: DataFrame, html_col: str = "html", url_col: str = "url", keep: list[str] | None = None) -> DataFrame:
    """The pages' other columns with the parsed ones; each page is parsed once, markup ends here."""
    keep = [c for c in pages.columns if c != html_col] if keep is None else keep
    schema = pages.select(*keep).schema
    for field in pages.sparkSession.createDataFrame([], SCHEMA).schema:
        schema = schema.add(field)
    names = [f.name for f in schema][len(keep) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            for part in portions(batch, len(keep)):
                rows = [parse(h, u) for h, u in zip(part.column(len(keep)).to_pylist(), part.column(len(keep) + 1).to_pylist())]
                own = [pa.array([r[n] for r in rows], kinds.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *own], names=[*keep, *names])

    return pages.select(*keep, F.col(html_col).alias("__sg_html"), F.col(url_col).alias("__sg_url")).mapInArrow(run, schema)
