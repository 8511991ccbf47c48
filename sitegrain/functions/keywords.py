"""Many words in one pass: an automaton finds all of them while it reads a text once.

Counting word by word reads a text as often as there are words. Here a text
passes once through an automaton of all words (goto and failure links), which
tells every place where one ends; the places of a word that don't overlap,
from left to right, are counted, so counts are those of ``text.count_keyword``
and the time doesn't depend on the number of words. It runs in Arrow batches
beside the parser; what comes back is short: the words that occur.

A null text has no words. Words are compared as they are written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

HITS = "array<struct<w:int,n:int>>"


class Matcher:
    """Counts of the words of a list in a text: word number and count."""

    def __init__(self, words: list[str]):
        import ahocorasick

        self.automaton, self.length, self.same = ahocorasick.Automaton(), [len(w) for w in words], {}
        for k, w in enumerate(words):
            if w:  # equal words share a node
                self.same.setdefault(w, []).append(k)
                self.automaton.add_word(w, self.same[w][0])
        self.twins = {own[0]: own[1:] for own in self.same.values() if len(own) > 1}
        if self.same:
            self.automaton.make_automaton()

    def counts(self, text: str) -> dict[int, int]:
        found: dict[int, int] = {}
        if not self.same or not text:
            return found
        free: dict[int, int] = {}  # where a word may begin again
        length = self.length
        for end, k in self.automaton.iter(text):
            if end - length[k] + 1 >= free.get(k, 0):
                free[k] = end + 1
                found[k] = found.get(k, 0) + 1
        for k, others in self.twins.items():
            if k in found:
                found.update(dict.fromkeys(others, found[k]))
        return found


_made: dict[tuple[str, ...], Matcher] = {}


def matcher(words: tuple[str, ...]) -> Matcher:
    """This worker's automaton of a list of words."""
    if words not in _made:
        _made[words] = Matcher(list(words))
    return _made[words]


def hits(text: Column | str, words: list[str]) -> Column:
    """The words that occur in a text, by their number, each with its count without overlaps.

    A function of one batch, not of an iterator: Spark runs all such functions
    of a row in one Python worker, but gives every iterator one of its own.
    """
    own = tuple(words)

    @F.arrow_udf(HITS)
    def found(batch: pa.Array) -> pa.Array:
        count = matcher(own).counts
        rows = [count(t) if t else {} for t in batch.to_pylist()]
        at = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        word, n = [w for r in rows for w in r], [v for r in rows for v in r.values()]
        return pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(word, pa.int32()), pa.array(n, pa.int32())], names=["w", "n"]))

    return found(F.col(text) if isinstance(text, str) else text)


def listed(pack: dict[str, list[str]]) -> tuple[list[str], dict[str, tuple[int, int]]]:
    """All words of a rule pack in a row, and which of them each category has (from, up to)."""
    words, spans = [], {}
    for c, own in pack.items():
        spans[c] = (len(words), len(words) + len(own))
        words += own
    return words, spans


def of_category(found: Column, span: tuple[int, int]) -> Column:
    return F.filter(found, lambda x: (x["w"] >= span[0]) & (x["w"] < span[1]))


def capped_sum(found: Column, span: tuple[int, int], cap: int | None) -> Column:
    """Sum over a category's words of their counts, each at most ``cap``."""
    n = (lambda x: F.least(x["n"], F.lit(cap))) if cap is not None else (lambda x: x["n"])
    return F.aggregate(of_category(found, span), F.lit(0).cast("long"), lambda a, x: a + n(x))
