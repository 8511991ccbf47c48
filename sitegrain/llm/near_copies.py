"""Near copies by shingle sets: documents whose five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash fingerprints of five-word shingles, linked as in ``simhash``, propose
pairs; so do MinHash bands, for what 64 bits can't see at a similarity of 0.8;
the shingle sets themselves decide. A pair of similarity s shares a band with chance ``1 - (1 - s**DEPTH)**BANDS``: 0.9999
at 0.8, more above. Equal sets are one node from the start. A bucket of up to
``ALL`` nodes proposes all its pairs; a larger one first its pairs with
``LEADERS`` of them, then all pairs that these links leave in different
components: such a bucket is cut into parts of ``PART_ROWS``, every two parts
are a task of their own, and only links that join two components leave it. The
work still grows with the square of a bucket whose rows are neither copies of
its leaders nor of each other; what a task holds doesn't.

Edge cases: texts without words (null included) are copies of each other;
texts of under five words are one shingle; letters are compared as in
``simhash``; rows that repeat a doc_id are one document; rows without a
doc_id carry links like others, and are never dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Workspace, raw, shuffle_partitions
from .simhash import SEED, TASK_ROWS, components, links, one_row_each, simhash

WORDS, SHARE = 5, (4, 5)
BANDS, DEPTH = 30, 6
ALL, LEADERS = 32, 4
#: Rows of a large bucket that make a part; a task compares two parts.
PART_ROWS = 2048
#: Agreeing MinHash values below which a pair isn't looked at: more than five standard deviations below 0.8.
AGREE = 0.64
#: Shingles hashed at once; pairs told at once.
CHUNK, AT_ONCE = 1 << 10, 1 << 16

_rng = np.random.default_rng(SEED)
TIMES = _rng.integers(0, 1 << 63, (BANDS * DEPTH, 1), np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _rng.integers(0, 1 << 63, (BANDS * DEPTH, 1), np.uint64)


def shingles(data: bytes, words: int = WORDS) -> np.ndarray:
    """The hashes of a text's distinct word shingles, sorted."""
    own = data.lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    line = b" ".join(own)
    ends = (np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    n, reach, digest = max(1, len(own) - words + 1), min(words, len(own)) - 1, xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n], ends[reach:])), np.uint64, n))


def minhash(own: np.ndarray) -> np.ndarray:
    """The smallest value of every hash function over a set."""
    low = np.full(BANDS * DEPTH, ~np.uint64(0))
    for k in range(0, len(own), CHUNK):
        np.minimum(low, (own[k : k + CHUNK] * TIMES + PLUS).min(1), out=low)
    return low


def name_of(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes(), SEED)


def signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, node`` (a hash of the shingle set), band keys, 16 bits of every MinHash value and the SimHash fingerprint ``fp``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, sketches, fps = [], [], [], []
            for x in batch.column(1):
                own = shingles(x.as_py())
                fps.append(simhash(x.as_py(), WORDS))
                low = minhash(own)
                nodes.append(name_of(own))
                bands = [xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(low.reshape(BANDS, DEPTH))] if len(own) else []
                keys.append(np.array(bands, np.uint64).view(np.int64))
                sketches.append((low >> np.uint64(40)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), signed(nodes), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), signed(fps)], names=["doc_id", "node", "keys", "sketch", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw("text"))
    return rows.mapInArrow(run, "doc_id long, node long, keys array<long>, sketch binary, fp long")


def _told(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(a), AT_ONCE):
        yield pa.RecordBatch.from_arrays([pa.array(a[k : k + AT_ONCE]), pa.array(b[k : k + AT_ONCE])], names=["a", "b"])


def _buckets(batches: Iterator[pa.RecordBatch]):
    """Columns sorted by key, then node (smaller first), and the begin and size of every bucket of two or more."""
    held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not held:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    columns = [np.concatenate(x) for x in zip(*held)]
    order = np.lexsort((columns[1], columns[0]))
    columns = [c[order] for c in columns]
    begin = np.flatnonzero(np.append(True, np.diff(columns[0]) != 0))
    size = np.diff(np.append(begin, len(order)))
    return columns, begin[size > 1], size[size > 1]


def first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of small buckets (key, node)."""
    columns, begin, size = _buckets(batches)
    for m in np.unique(size).tolist():
        i, j = np.triu_indices(m, 1)
        some = max(1, AT_ONCE // len(i))
        at = begin[size == m]
        for k in range(0, len(at), some):
            yield from _told(columns[1][at[k : k + some, None] + i].ravel(), columns[1][at[k : k + some, None] + j].ravel())


def simhash_pairs(nodes: DataFrame, work: Workspace) -> DataFrame:
    """Pairs of sets whose fingerprints are linked: those that span the links of different fingerprints, and every set with the smallest of its fingerprint."""
    first = work.write(nodes.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints")
    met = links(first.select(F.col("fp").alias("node"), "fp"), first.count(), work)
    x, y = (first.select(F.col("fp").alias(c), F.col("first").alias(f"__{c}")) for c in ("a", "b"))
    pairs = met.join(x, "a").join(y, "b").select("__a", "__b").union(nodes.join(first, "fp").filter("node != first").select("first", "node"))
    return pairs.toDF("a", "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def leader_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of every row of large buckets with ``LEADERS`` of its bucket: the nodes of smallest hashes, found by aggregation."""
    leaders = rows.groupBy("key").agg(F.array_distinct(F.array(*[F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(LEADERS)])).alias("leaders"))
    pairs = rows.join(leaders, "key").select("node", F.explode("leaders").alias("leader")).filter("node != leader")
    return pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))


def open_links(node: np.ndarray, part: np.ndarray, own_sets: list[bytes]) -> tuple[list[int], list[int]]:
    """Links between rows of a bucket that are still in different components, one for every two components that meet."""
    sets = [np.frombuffer(x, np.uint64) for x in own_sets]
    n = np.array([len(x) for x in sets])
    place = np.cumsum(n) - n
    told, own = np.unique(np.concatenate(sets), return_inverse=True)
    _, label, many = np.unique(part, return_inverse=True, return_counts=True)
    a, b = [], []
    for k in np.flatnonzero(label != many.argmax()).tolist():  # pairs inside the largest need no look
        mark = np.zeros(len(told), np.int64)
        mark[own[place[k] : place[k] + n[k]]] = 1
        shared = np.add.reduceat(mark[own], place)
        near = (shared * SHARE[1] >= (n + n[k] - shared) * SHARE[0]) & (label != label[k])
        while near.any():
            x = int(near.argmax())
            a.append(min(node[k], node[x])), b.append(max(node[k], node[x]))
            label[label == label[x]] = label[k]
            near &= label != label[k]
    return a, b


def other_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``open_links`` of buckets cut into pairs of parts; rows come sorted by bucket and parts, and a task holds one pair of parts (key, low, high, node, component, set)."""
    at, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] != at and held:
                node, part, own = zip(*held)
                yield from _told(*[np.array(x, np.int64) for x in open_links(np.array(node), np.array(part), own)])
                held = []
            at = row[:3]
            held.append(row[3:])
    if held:
        node, part, own = zip(*held)
        yield from _told(*[np.array(x, np.int64) for x in open_links(np.array(node), np.array(part), own)])


def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in (2, 3))
        yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(1) >= AGREE)) if batch.num_rows else batch.select(["a", "b"])


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets have the Jaccard similarity asked for, in whole numbers."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared * SHARE[1] >= (len(x) + len(y) - shared) * SHARE[0]


def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [alike(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) for x, y in zip(batch.column(2), batch.column(3))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def sets(docs: DataFrame) -> DataFrame:
    """``node, own``: the shingle sets of some documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([signed([name_of(x) for x in own]), pa.array([x.tobytes() for x in own], pa.binary())], names=["node", "own"])

    return docs.select(raw("text")).mapInArrow(run, "node long, own binary")


def _both(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    x = table.select(F.col("node").alias("a"), F.col(value).alias("x"))
    y = table.select(F.col("node").alias("b"), F.col(value).alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")


def sets_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``node, own`` of some nodes, from the texts of their documents."""
    ids = work.write(nodes.join(wanted, "node", "left_semi").select(F.col("doc_id").alias("__sg_id")).distinct(), f"{name}_ids")
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = docs.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("__sg_id"), "left_semi")
    if not ids.filter("__sg_id IS NULL").isEmpty():  # sets that only rows without a doc_id have
        texts = texts.unionByName(docs.filter("doc_id IS NULL"))
    # rows that repeat a doc_id may give a set more than once
    own = work.write(sets(texts), f"{name}_sets").join(wanted, "node", "left_semi").groupBy("node").agg(F.min("own").alias("own"))
    return work.write(own, f"{name}_own")


def linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, work: Workspace) -> DataFrame:
    """Of proposed pairs those that are near copies."""
    some = work.write(_both(pairs.distinct(), nodes, "sketch").mapInArrow(likely, "a long, b long"), "likely")
    wanted = some.select(F.col("a").alias("node")).union(some.select("b")).distinct()
    out = work.write(_both(some, sets_of(wanted, nodes, docs, work, "first"), "own").mapInArrow(decided, "a long, b long"), "links")
    work.drop("first_sets"), work.drop("first_own")
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of the smallest doc_id of every component of near copies; rows without a doc_id stay."""
    spark = docs.sparkSession
    work = Workspace(spark, "near_copies")
    prints = work.write(signatures(docs), "prints")
    nodes = work.write(prints.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.min("fp").alias("fp")), "nodes")
    parts = max(shuffle_partitions(spark), -(-nodes.count() * BANDS // TASK_ROWS))
    rows = nodes.select(F.explode("keys").alias("key"), "node")
    large = work.write(rows.groupBy("key").count().filter(F.col("count") > ALL), "large")
    few = large.limit(BROADCAST_ROWS + 1).count()
    of_large = F.broadcast(large.select("key")) if few <= BROADCAST_ROWS else large.select("key")
    pairs = rows.join(of_large, "key", "left_anti").repartition(parts, "key").mapInArrow(first_pairs, "a long, b long")
    if few:
        pairs = pairs.union(leader_pairs(rows.join(of_large, "key", "left_semi")))
    found = linked(pairs.union(simhash_pairs(nodes, work)), nodes, docs, work)
    # a doc_id on rows of different texts links their sets
    by_id = prints.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z").select("doc_id", "a")
    found = found.union(prints.join(by_id, "doc_id").filter("a != node").select("a", F.col("node").alias("b")).distinct())
    comps = work.write(components(found, work), "components")
    if few:
        told = rows.join(of_large, "key", "left_semi").join(comps, "node", "left").select("key", "node", F.coalesce("component_id", "node").alias("component_id"))
        open_ = told.groupBy("key").agg(F.min("component_id").alias("x"), F.max("component_id").alias("y")).filter("x != y").select("key")
        told = work.write(told.join(open_, "key", "left_semi"), "open")
        own = sets_of(told.select("node").distinct(), nodes, docs, work, "more")
        # every two parts of a bucket are compared by one task, whatever its size
        cut = told.join(large.select("key", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("cuts")), "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        cut = cut.select("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "node", "component_id")
        spread = cut.join(own, "node").select("key", "low", "high", "node", "component_id", "own").repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
        more = work.write(spread.mapInArrow(other_links, "a long, b long").distinct(), "more")
        work.drop("more_sets"), work.drop("more_own")
        if more.limit(1).count():
            again = Workspace(spark, "near_copies")
            comps = again.write(components(found.union(more), again), "components")
    kept = prints.join(comps, "node", "left").groupBy(F.coalesce("component_id", "node").alias("c")).agg(F.min("doc_id").alias("__sg_id")).select("__sg_id").filter("__sg_id IS NOT NULL").distinct()
    return one_row_each(docs, work.write(kept, "kept"))
