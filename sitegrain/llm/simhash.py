"""SimHash near-duplicates: 64-bit fingerprints, all links within a Hamming radius, connected components.

Candidates come from exact blocking: the bits are cut into ``m`` blocks; two
fingerprints within ``radius`` agree on at least ``m - radius`` blocks, so
rows meet under every choice of that many blocks. More documents take more
blocks and so longer keys: the candidates per row stay bounded, no link is
lost at any size. Inside a bucket, fingerprints are compared bit-sliced: 64 of
them side by side, bit plane by bit plane, with carry-save counters of the
distance, and a block is abandoned once all its lanes exceed the radius.

Copies never multiply: equal fingerprints are one node from the start, and a
bucket emits a spanning forest of its links (fewer links than rows), not all
its pairs.

Edge cases: a text without words (null included) has fingerprint zero and is
linked like any other; rows that repeat a doc_id are separate rows of one
document id; rows with a null doc_id link like others, but name no component:
theirs is the smallest doc_id they reach, null if there is none; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Workspace, raw, read_table, shuffle_partitions

BITS, RADIUS, WORDS, SEED = 64, 4, 4, 42
#: Expected fingerprints in a bucket at most; beyond, keys get longer.
BUCKET = 512
#: Rows of a comparison task; pairs of a row and a block compared at once.
TASK_ROWS, AT_ONCE = 2_000_000, 1 << 17
#: Rows whose buckets are compared together; rows of a bucket that one task may hold.
TOGETHER, LARGE = 1 << 17, 1 << 16
#: Shingles of a text counted at once.
CHUNK = 1 << 16


def simhash(data: bytes, words: int = WORDS) -> int:
    """Majority of the hash bits of a text's word shingles, repeats included; ASCII letters lowered."""
    own = data.lower().split()
    if not own:
        return 0
    line = b" ".join(own)
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    ends = (np.cumsum(sizes + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    n = max(1, len(own) - words + 1)
    reach = min(words, len(own)) - 1
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, CHUNK):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[k : min(n, k + CHUNK)], ends[k + reach : k + reach + CHUNK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of every whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(x.as_py(), words) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), raw(text_col)).mapInArrow(run, "doc_id long, fp long")


def blocking(n: int, radius: int = RADIUS, bucket: int = BUCKET) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """Blocks (first bit, width) and the choices of blocks that form keys, for n distinct fingerprints."""
    for m in range(radius + 1, 2 * radius + 5):
        edges = [BITS * k // m for k in range(m + 1)]
        blocks = [(a, b - a) for a, b in zip(edges, edges[1:])]
        choices = list(combinations(range(m), m - radius))
        if n / 2 ** min(sum(blocks[k][1] for k in c) for c in choices) <= bucket:
            break
    return blocks, choices


def planes_of(fp: np.ndarray) -> np.ndarray:
    """Bit planes: word ``[b, k]`` holds bit b of the fingerprints 64k to 64k+63."""
    padded = np.zeros(-(-len(fp) // 64) * 64, np.uint64)
    padded[: len(fp)] = fp
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # row a fingerprint
    return np.ascontiguousarray(np.packbits(bits.T.reshape(BITS, -1, 64), axis=2, bitorder="little").reshape(BITS, -1, 8)).view(np.uint64)[:, :, 0]


def within(planes: np.ndarray, fp: np.ndarray, block: np.ndarray, lanes: np.ndarray, order: list[int], radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of a fingerprint and a block of 64: the lanes within the radius.

    ``lanes`` marks the lanes that count. Returns the positions of pairs with
    any such lane and their lanes. The distance is kept in vertical counters,
    added to by carry-save; lanes leave as they exceed the radius, pairs as
    all their lanes have.
    """
    alive, lanes = np.arange(len(fp)), lanes.copy()
    digits = [np.zeros(len(fp), np.uint64) for _ in range(radius.bit_length())]
    for k, b in enumerate(order):
        carry = planes[b][block] ^ (np.uint64(0) - ((fp >> np.uint64(b)) & np.uint64(1)))
        for j, digit in enumerate(digits):
            digits[j], carry = digit ^ carry, digit & carry
        lanes &= ~carry  # the counter ran over
        if k >= radius and (k % 8 == 7 or k == len(order) - 1):
            more, same = np.zeros_like(lanes), ~np.zeros_like(lanes)
            for j in reversed(range(len(digits))):  # counter > radius, from the highest digit
                if radius >> j & 1:
                    same &= digits[j]
                else:
                    more |= same & digits[j]
                    same &= ~digits[j]
            lanes &= ~more
            keep = np.flatnonzero(lanes)
            if len(keep) < 0.9 * len(lanes):
                alive, lanes, fp, block = alive[keep], lanes[keep], fp[keep], block[keep]
                digits = [d[keep] for d in digits]
                if not len(keep):
                    break
    keep = np.flatnonzero(lanes)
    return alive[keep], lanes[keep]


def forest(bounds: np.ndarray, fp: np.ndarray, order: list[int], radius: int = RADIUS) -> np.ndarray:
    """Links (row, row) that span the components inside each bucket; rows are sorted by bucket, ``bounds`` has each row's bucket end."""
    n = len(fp)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    planes, links = planes_of(fp), []
    rows = np.flatnonzero(bounds - np.arange(n) > 1)
    first, last = (rows + 1) >> 6, (bounds[rows] - 1) >> 6
    reach = np.cumsum(last - first + 1)
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    low, total = 0, int(reach[-1]) if len(rows) else 0
    for at in range(0, total, AT_ONCE):
        pair = np.arange(at, min(total, at + AT_ONCE))
        r = np.searchsorted(reach, pair, "right")
        row = rows[r]
        block = first[r] + pair - (reach[r] - (last[r] - first[r] + 1))
        base = block << 6
        lower = np.clip(row + 1 - base, 0, 63).astype(np.uint64)
        upper = np.clip(bounds[row] - base, 1, 64)
        lanes = (every << lower) & (every >> (64 - upper).astype(np.uint64))
        hit, lanes = within(planes, fp[row], block, lanes, order, radius)
        for k in range(0, len(hit), 1 << 14):
            bits = np.unpackbits(np.ascontiguousarray(lanes[k : k + (1 << 14)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            p, lane = np.nonzero(bits)
            a = row[hit[k : k + (1 << 14)][p]]
            b = (block[hit[k : k + (1 << 14)][p]] << 6) + lane
            while True:  # shorten paths, then only links between different components are left
                up = parent[parent]
                if (up == parent).all():
                    break
                parent[:] = up
            apart = parent[a] != parent[b]
            for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                i, j = root(x), root(y)
                if i != j:
                    parent[max(i, j)] = min(i, j)
                    links.append((x, y))
    return np.array(links, np.int64).reshape(-1, 2)


def links(nodes: DataFrame, n: int, work: Workspace, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links that span the components among distinct fingerprints (``node`` long, ``fp`` long); n: their number.

    A task streams over sorted rows and holds the buckets of ``TOGETHER`` rows.
    A bucket of more than ``LARGE`` rows (a family of fingerprints that share
    its bits) is compared in a second step, part by part over many tasks; what
    that takes grows with the square of the bucket, but no task holds more
    than about ``LARGE`` rows.
    """
    blocks, choices = blocking(n, radius)
    keys = []
    for c in choices:
        key = F.lit(0).cast("long")
        for k in c:
            first, width = blocks[k]
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1)))
        keys.append(key)
    spark = nodes.sparkSession
    parts = max(shuffle_partitions(spark), -(-n * len(choices) // TASK_ROWS))
    rows = nodes.select("node", "fp", F.posexplode(F.array(*keys)).alias("choice", "key"))
    # bits of the key agree, so the others are compared first, and alone
    orders = []
    for c in choices:
        inside = {b for k in c for b in range(blocks[k][0], sum(blocks[k]))}
        orders.append([b for b in range(BITS) if b not in inside])

    def run(limit: int | None):
        """Over rows sorted by bucket: whole buckets are compared together; one of more than ``limit`` rows is only told: its choice, its key, its size."""

        def compared(keys: list[np.ndarray], node: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            begin = np.flatnonzero(_begins(keys))
            size = np.diff(np.append(begin, len(node)))
            if limit is not None and (size > limit).any():
                big = begin[size > limit]
                yield pa.RecordBatch.from_arrays([pa.array(keys[0][big].astype(np.int64)), pa.array(keys[1][big]), pa.array(size[size > limit])], names=["a", "b", "n"])
            fits = (size > 1) & (size <= (limit or size.max()))
            keep = np.repeat(fits, size)
            choice = keys[0][keep]
            node, fp, ends = node[keep], fp[keep], np.repeat(np.cumsum(size[fits]), size[fits])
            for c in np.unique(choice):
                low, high = np.searchsorted(choice, [c, c + 1])
                found = forest(ends[low:high] - low, fp[low:high].view(np.uint64), orders[c], radius) + low
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]]), pa.nulls(len(found), pa.int64())], names=["a", "b", "n"])

        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows_held, over = [], 0, None  # over: a bucket that is too large, its rows so far
            for batch in batches:
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                if over is not None:
                    n = int(np.searchsorted((columns[0] != over[0]) | (columns[1] != over[1]), True))
                    over[2] += n
                    if n == batch.num_rows:
                        continue
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in over], names=["a", "b", "n"])
                    over, columns = None, [c[n:] for c in columns]
                held.append(columns)
                rows_held += len(columns[0])
                if rows_held < TOGETHER:
                    continue
                columns = [np.concatenate(x) for x in zip(*held)]
                last = int(np.flatnonzero(_begins(columns[:2] + columns[4:]))[-1])  # the last bucket may go on
                if last:
                    yield from compared([c[:last] for c in columns[:2] + columns[4:]], columns[2][:last], columns[3][:last])
                    columns = [c[last:] for c in columns]
                held, rows_held = [columns], len(columns[0])
                if limit is not None and rows_held > limit:
                    over, held, rows_held = [int(columns[0][0]), int(columns[1][0]), rows_held], [], 0
            if over is not None:
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in over], names=["a", "b", "n"])
            if held and rows_held:
                columns = [np.concatenate(x) for x in zip(*held)]
                yield from compared(columns[:2] + columns[4:], columns[2], columns[3])

        return go

    def told(rows: DataFrame, by: list[str], limit: int | None) -> DataFrame:
        return rows.repartition(parts, *by).sortWithinPartitions(*by).select("choice", "key", "node", "fp", *by[2:]).mapInArrow(run(limit), "a long, b long, n long")

    found = work.write(told(rows, ["choice", "key"], LARGE), "found")
    small = found.filter("n IS NULL").select("a", "b")
    large = found.filter("n IS NOT NULL").select(F.col("a").cast("int").alias("choice"), F.col("b").alias("key"), F.ceil(F.col("n") * 2 / LARGE).cast("int").alias("cuts"))
    many = large.limit(BROADCAST_ROWS + 1).count()
    if not many:
        return small.filter("a != b")
    # large buckets: cut into parts of half a task's rows; every two parts are a task
    spread = rows.join(F.broadcast(large) if many <= BROADCAST_ROWS else large, ["choice", "key"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).filter("own != other")
    spread = spread.select("choice", "key", "node", "fp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return small.unionByName(told(spread, ["choice", "key", "low", "high"], None).select("a", "b")).filter("a != b")


def _begins(keys: list[np.ndarray]) -> np.ndarray:
    """Where a bucket begins among sorted rows."""
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``node, component_id`` (the smallest node) of every node with a link: large-star and small-star rounds until nothing changes."""

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = work.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges0")
    seen, k = state(edges), 0
    while seen[0]:
        # large star: every larger neighbour is linked to the smallest neighbour
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        # small star: every smaller neighbour, and the node itself, to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        k += 1
        after = work.write(small, f"edges{k}")
        now = state(after)
        work.drop(f"edges{k - 1}")
        edges = after
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """``doc_id, fp, component_id``: every document's fingerprint and the smallest doc_id it is linked to, over any number of links."""
    work = Workspace(docs.sparkSession, "simhash")
    prints = work.write(fingerprints(docs, id_col, text_col, words), "prints")
    nodes = work.write(prints.groupBy("fp").agg(F.min("doc_id").alias("low")).select(F.col("fp").alias("node"), "fp", "low"), "nodes")
    # a doc_id on rows of different texts links their fingerprints
    by_id = prints.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a != z").select("doc_id", "a")
    twice = prints.join(by_id, "doc_id").filter("a != fp").select("a", F.col("fp").alias("b")).distinct()
    comps = components(links(nodes.select("node", "fp"), nodes.count(), work, radius).union(twice), work)
    parts = nodes.join(comps, "node", "left").select("fp", "low", F.coalesce("component_id", "node").alias("part"))
    told = parts.join(parts.groupBy("part").agg(F.min("low").alias("component_id")), "part").select("fp", "component_id")
    return prints.join(told, "fp", "left").select("doc_id", "fp", "component_id")


def query(spark, sf_dir):
    """op6: fingerprint and component of every document."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_row_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of every kept doc_id (``__sg_id``, distinct), of rows that repeat it that of the smallest hash; rows without a doc_id stay."""
    few = kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = docs.join(F.broadcast(kept) if few else kept, F.col("doc_id") == F.col("__sg_id"), "left_semi")
    twice = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__sg_id")).count().filter("count > 1").select("__sg_id")
    many = twice.limit(BROADCAST_ROWS + 1).count()
    if many:
        twice = F.broadcast(twice) if many <= BROADCAST_ROWS else twice
        every = [F.col(f"`{c}`") for c in docs.columns]
        again = rows.join(twice, F.col("doc_id") == F.col("__sg_id"), "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*every), F.xxhash64(F.to_json(F.struct(*every)))).alias("__sg_row"))
        rows = rows.join(twice, F.col("doc_id") == F.col("__sg_id"), "left_anti").unionByName(again.select("__sg_row.*"))
    return rows.unionByName(docs.filter("doc_id IS NULL"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every doc_id that is the smallest of its component; rows without a doc_id stay."""
    kept = near_duplicates(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("__sg_id")).distinct()
    return one_row_each(docs, kept)
