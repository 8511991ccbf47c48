"""Structured data in pages: organisations in JSON-LD, page state of unknown shape.

Searches of unbounded depth run in Arrow batches; they read JSON text columns
and return plain columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html import deep_find, json_strings

ORG = "phone string, street string, city string, state string, zip string, rating double, reviews long, people array<string>"
PEOPLE_KEYS = ("employee", "employees", "staff", "founder", "member", "members")
PROVIDER_KEYS = ("providers", "doctors", "dentists", "clinicians", "teamMembers", "staff")
NAME_KEYS = ("name", "fullName", "displayName", "title")


def _number(value, kind):
    try:
        return kind(float(str(value).replace(",", "")))
    except (TypeError, ValueError):
        return None


def _text(value) -> str | None:
    return value.strip() or None if isinstance(value, str) else None


def objects(value, depth: int = 12) -> Iterator[dict]:
    """Every JSON object, outermost first."""
    if depth < 0:
        return
    if isinstance(value, dict):
        yield value
        value = list(value.values())
    if isinstance(value, list):
        for v in value:
            yield from objects(v, depth - 1)


def person_names(value) -> list[str]:
    """Names in a list of people, given as texts or objects."""
    out = []
    for v in value if isinstance(value, list) else [value]:
        if isinstance(v, dict):
            parts = [_text(v.get("firstName")), _text(v.get("lastName"))]
            v = next((_text(v.get(k)) for k in NAME_KEYS if _text(v.get(k))), None) or " ".join(p for p in parts if p)
        if _text(v) and v.strip() not in out:
            out.append(v.strip())
    return out


def organisation(blocks: list[str]) -> dict:
    """Phone, address, rating and people of JSON-LD blocks; the first block that has a value wins."""
    out: dict = {"people": []}
    for text in blocks:
        try:
            tree = json.loads(text)
        except (ValueError, RecursionError):
            continue
        for node in objects(tree):
            address = node.get("address") if isinstance(node.get("address"), dict) else {}
            rating = node.get("aggregateRating") if isinstance(node.get("aggregateRating"), dict) else {}
            found = {"phone": _text(node.get("telephone")), "street": _text(address.get("streetAddress")), "city": _text(address.get("addressLocality")), "state": _text(address.get("addressRegion")), "zip": _text(address.get("postalCode")), "rating": _number(rating.get("ratingValue"), float), "reviews": _number(rating.get("reviewCount", rating.get("ratingCount")), int)}
            for k, v in found.items():
                if v is not None:
                    out.setdefault(k, v)
            for k in PEOPLE_KEYS:
                if node.get(k):
                    out["people"] += [n for n in person_names(node[k]) if n not in out["people"]]
    return out


def page_state(text: str | None) -> dict:
    """The same out of a page's embedded state: provider lists wherever they are, address, phone, rating."""
    try:
        tree = json.loads(text or "")
    except (ValueError, RecursionError):
        return {"people": []}
    people: list[str] = []
    for key in PROVIDER_KEYS:
        found = deep_find(tree, key)
        if isinstance(found, list):
            people += [n for n in person_names(found) if n not in people]
    address = deep_find(tree, "address")
    address = address if isinstance(address, dict) else {}
    get = lambda *ks: next((_text(address.get(k)) for k in ks if _text(address.get(k))), None)
    return {"people": people, "phone": _text(deep_find(tree, "phone")) or _text(deep_find(tree, "telephone")), "street": get("street", "streetAddress", "address1", "line1"), "city": get("city", "addressLocality"), "state": get("state", "addressRegion"), "zip": get("zip", "postalCode"), "rating": _number(deep_find(tree, "ratingValue") or deep_find(tree, "rating"), float), "reviews": _number(deep_find(tree, "reviewCount") or deep_find(tree, "ratingCount"), int)}


def _apply(rows: DataFrame, column: str, make, keep: list[str]) -> DataFrame:
    schema = rows.select(*keep).schema
    for field in rows.sparkSession.createDataFrame([], ORG).schema:
        schema = schema.add(field)
    names = [f.name for f in schema][len(keep) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            found = [make(v) for v in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *[pa.array([r.get(n) for r in found], kinds.field(n).type) for n in names]], names=[*keep, *names])

    return rows.select(*keep, F.col(column).alias("__sg_json")).mapInArrow(run, schema)


def organisations(pages: DataFrame, keep: list[str], column: str = "jsonld") -> DataFrame:
    """Parsed pages' JSON-LD as columns (blocks: an array of texts)."""
    return _apply(pages, column, lambda blocks: organisation(blocks or []), keep)


def page_states(pages: DataFrame, keep: list[str], column: str = "state") -> DataFrame:
    """Pages' embedded state (a JSON text) as columns."""
    return _apply(pages, column, page_state, keep)


def find_key(rows: DataFrame, column: str, key: str, keep: list[str], depth: int = 12) -> DataFrame:
    """``value``: the first truthy value of a key at any place of a JSON text, as JSON; null if there is none."""
    schema = rows.select(*keep).schema.add("value", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(len(keep)).to_pylist():
                try:
                    found = deep_find(json.loads(text or ""), key, depth)
                except (ValueError, RecursionError):
                    found = None
                out.append(None if found is None else found if isinstance(found, str) else json.dumps(found))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(out, pa.string())], names=[*keep, "value"])

    return rows.select(*keep, F.col(column).alias("__sg_json")).mapInArrow(run, schema)


def state_text(text: str | None) -> str:
    """All strings of a state, for counting words in it."""
    try:
        return " ".join(json_strings(json.loads(text or ""))).lower()
    except (ValueError, RecursionError):
        return ""
