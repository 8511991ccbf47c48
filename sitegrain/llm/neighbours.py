"""Approximate nearest neighbours by inner product, over randomly rotated one-bit codes.

Index: centroids from a bounded sample (``SAMPLE`` rows) part the vectors into
lists; every vector's residual is rotated at random and stored as packed sign
bits with two scalars, its length and its inner product with its own code.
Search: a query's rotated coordinates are cut into a few bit planes, so that
its inner product with a code is a sum of pop-counts; the scalars turn that
into an estimate with an error bound, and only vectors whose upper bound
reaches the best lower bounds are compared exactly, in double precision.

Lists are cut into blocks of bounded size, and the queries that a block has to
answer into chunks: a task holds one block and one chunk, however popular a
list or a vector is. A query first searches its nearest list; its twentieth
score there, its floor, rules out every list whose own bound (centroid and
radius) stays below, and the second search tells only what reaches it. No
list is dropped without that bound. (Blocks of a quarter of the size, with a
first search in one of them, tell far more: the floor is then that of few
vectors, and each block has its own twenty above it.)

Edge cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, nor do rows without a vec_id;
of rows that repeat a vec_id all are candidates and the smallest vector asks;
no row with the query's vec_id is its neighbour; ties go to the smaller
vec_id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Workspace, read_table

SAMPLE, LIST_ROWS, LISTS = 8192, 4096, 1024
#: Rows of a block; queries of a task; queries compared with a block at once.
BLOCK, CHUNK, AT_ONCE = 8192, 4096, 64
#: Bit planes of a query; standard errors that the bound takes.
PLANES, SIGMAS = 7, 3.0
SEED = 8


def usable(vec: Column, d: int) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) == d) & fine & F.exists(vec, lambda x: x != 0)


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def centroids_of(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from spread rows; empty lists keep their place."""
    rng = np.random.default_rng(SEED)
    own = sample[rng.permutation(len(sample))[:k]].copy()
    for _ in range(rounds):
        near = nearest(sample, own)
        n = np.bincount(near, minlength=len(own))
        total = np.zeros_like(own)
        np.add.at(total, near, sample)
        own[n > 0] = total[n > 0] / n[n > 0, None]
    return own


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1) - 2 * x @ centroids.T).argmin(1)


def pack(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as words of 64 bits."""
    rows, d = signs.shape
    wide = np.zeros((rows, -(-d // 64) * 64), bool)
    wide[:, :d] = signs
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def encode(x: np.ndarray, centroid: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, residual lengths and inner products of residual directions with their codes."""
    residual = x - centroid
    length = np.sqrt((residual**2).sum(1))
    turned = residual @ turn.T / np.where(length > 0, length, 1)[:, None]
    return pack(turned > 0), length, np.abs(turned).sum(1) / np.sqrt(x.shape[1])


def estimate(query: np.ndarray, centre_score: float | np.ndarray, codes: np.ndarray, length: np.ndarray, factor: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries by vectors) and error bounds, from packed bits."""
    d = turn.shape[0]
    turned = query @ turn.T
    low = turned.min(1, keepdims=True)
    step = np.maximum((turned.max(1, keepdims=True) - low) / ((1 << PLANES) - 1), 1e-300)
    level = np.rint((turned - low) / step).astype(np.uint8)
    total = np.zeros((len(query), len(codes)), np.int32)
    for j in range(PLANES):
        plane = pack((level >> j & 1).astype(bool))
        for w in range(codes.shape[1]):
            total += np.bitwise_count(plane[:, w, None] & codes[None, :, w]).astype(np.int32) << j
    ones = np.bitwise_count(codes).sum(1)
    bits = (2 * (low * ones + step * total) - turned.sum(1, keepdims=True)) / np.sqrt(d)
    f = np.where(length > 0, np.maximum(factor, 1e-9), 1.0)
    size = np.sqrt((query**2).sum(1, keepdims=True))
    spread = SIGMAS * size * np.sqrt(np.maximum(0, 1 - f * f) / (f * f) / max(1, d - 1)) + SIGMAS * step * 0.3 / f
    return centre_score + length * bits / f, length * spread


def inner(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of columns i of a and j of b, summed in order of the components: the same double on every machine."""
    total = np.zeros(len(i))
    for x, y in zip(a, b):
        total += x[i] * y[j]
    return total


def search_block(query_ids, queries, floor, ids, vectors, codes, length, factor, centroid, turn, k: int) -> Iterator[tuple]:
    """``(query id, vector id, score)`` of each query's best k in the block; floor: scores below can't matter."""
    down = np.ascontiguousarray(vectors.T)
    for at in range(0, len(queries), AT_ONCE):
        q, own = queries[at : at + AT_ONCE], query_ids[at : at + AT_ONCE]
        guess, bound = estimate(q, (q @ centroid)[:, None], codes, length, factor, turn)
        self_ = own[:, None] == ids[None, :]
        least = np.where(self_, -np.inf, guess - bound)
        cut = floor[at : at + AT_ONCE]
        if len(ids) > k:
            cut = np.maximum(cut, -np.partition(-least, k - 1, axis=1)[:, k - 1])
        # a hair of slack: the floor is exact, the sums round
        r, c = np.nonzero((guess + bound >= (cut - 1e-9 * np.abs(np.where(np.isfinite(cut), cut, 0)))[:, None]) & ~self_)
        score, across = np.empty(len(r)), np.ascontiguousarray(q.T)
        for s in range(0, len(r), 1 << 18):
            score[s : s + (1 << 18)] = inner(across, r[s : s + (1 << 18)], down, c[s : s + (1 << 18)])
        reach = score >= floor[at : at + AT_ONCE][r]  # what an earlier search has outdone needn't be told
        r, c, score = r[reach], c[reach], score[reach]
        order = np.lexsort((ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r, "left") < k
        yield own[r[keep]], ids[c[keep]], score[keep]


def matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest of every row that ``is_query`` marks, against all rows."""
    spark = vectors.sparkSession
    work = Workspace(spark, "neighbours")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = vectors.filter(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).count().collect()  # a row a vector length
    d = max(((r["count"], r["d"]) for r in sizes if r["d"] > 0), default=(0, 0))[1]
    if not d:
        return empty
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vec_col), d)).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), is_query.alias("asks"))
    n = rows.count()
    if not n:
        return empty
    unit = F.shiftrightunsigned(F.xxhash64("id", F.lit(SEED)), 11) / float(1 << 53)
    taken = rows.filter(unit < SAMPLE / n).orderBy("id", "vec").limit(2 * SAMPLE).select("vec").collect()  # about SAMPLE vectors
    sample = np.array([r.vec for r in taken]).reshape(-1, d)
    lists = max(1, min(LISTS, n // LIST_ROWS, len(sample)))
    centroids = centroids_of(sample, lists) if len(sample) else np.zeros((1, d))
    turn = rotation(d)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), d)
            near = nearest(x, centroids)
            codes, length, factor = encode(x, centroids[near], turn)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(near, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(factor)], names=["id", "vec", "asks", "list", "code", "length", "factor"])

    indexed = work.write(rows.mapInArrow(index, "id long, vec array<double>, asks boolean, list int, code binary, length double, factor double"), "index")
    per = {r.list: (r.n, r.radius) for r in indexed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("radius")).collect()}  # a row a list
    cuts = np.array([-(-per.get(i, (0, 0))[0] // BLOCK) for i in range(lists)])
    first = np.cumsum(cuts) - cuts  # a list's blocks are numbered in a row
    radius = np.array([per.get(i, (0, 0.0))[1] for i in range(lists)])
    of_list = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("list") + 1)
    spread = F.pmod(F.xxhash64("id", F.lit("block")), F.greatest(of_list(cuts), F.lit(1))).cast("int")
    blocked = indexed.select("id", "vec", "code", "length", "factor", "list", (of_list(first) + spread).alias("block"))
    owner = np.repeat(np.arange(lists), cuts)

    def bounds(x: np.ndarray) -> np.ndarray:
        top = x @ centroids.T + np.sqrt((x**2).sum(1, keepdims=True)) * radius
        return np.where(cuts > 0, top, -np.inf)

    def route(home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, floor = matrix(batch.column(1), d), batch.column(2).to_numpy(zero_copy_only=False)
                best = np.where(cuts > 0, x @ centroids.T, -np.inf).argmax(1)
                wanted = np.arange(lists)[None, :] == best[:, None]
                if not home:
                    wanted = (bounds(x) >= (floor - 1e-9 * np.abs(np.where(np.isfinite(floor), floor, 0)))[:, None]) & ~wanted & (cuts > 0)
                blocks = [[int(b) for i in np.flatnonzero(row) for b in range(first[i], first[i] + cuts[i])] for row in wanted]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.list_(pa.int32()))], names=["id", "vec", "floor", "blocks"])

        return run

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if left.num_rows and right.num_rows:
            codes = np.frombuffer(b"".join(right.column("code").to_pylist()), "<u8").reshape(right.num_rows, -1)
            arrays = [right.column(c).to_numpy() for c in ("id", "length", "factor")]
            for part in search_block(left.column("id").to_numpy(), matrix(left.column("vec"), d), left.column("floor").to_numpy(), arrays[0], matrix(right.column("vec"), d), codes, arrays[1], arrays[2], centroids[owner[key[0].as_py()]], turn, k):
                for o, p in zip(out, part):
                    o.append(p)
        return pa.table({"query_id": np.concatenate(out[0]).astype(np.int64), "vec_id": np.concatenate(out[1]).astype(np.int64), "score": np.concatenate(out[2]).astype(np.float64)})

    def search(queries: DataFrame, home: bool) -> DataFrame:
        name = "home" if home else "others"
        routed = work.write(queries.mapInArrow(route(home), "id long, vec array<double>, floor double, blocks array<int>"), f"{name}_routed")
        # a block that many queries reach is compared chunk by chunk
        need = work.write(routed.select(F.explode("blocks").alias("block")).groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")), f"{name}_need")
        need = F.broadcast(need) if need.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else need
        asked = routed.select("id", "vec", "floor", F.explode("blocks").alias("block")).join(need, "block").withColumn("chunk", F.pmod(F.xxhash64("id", F.lit("chunk")), F.col("chunks")).cast("int"))
        held = blocked.select("id", "vec", "code", "length", "factor", "block").join(need, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        pairs = asked.select("id", "vec", "floor", "block", "chunk").groupBy("block", "chunk").cogroup(held.drop("chunks").groupBy("block", "chunk"))
        return pairs.applyInArrow(compare, "query_id long, vec_id long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    queries = indexed.filter("asks").groupBy("id").agg(F.min("vec").alias("vec"))
    found = work.write(search(queries.withColumn("floor", F.lit(float("-inf"))), True), "near")
    if lists > 1:
        floor = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        asked = queries.join(floor, "id", "left").select("id", "vec", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
        found = found.unionByName(search(asked, False))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


FINE = "embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) = (SELECT len(embedding) FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1) AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
ORACLE = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {FINE}),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20"""


def query(spark, sf_dir):
    """op8: the 20 nearest vectors of every vector whose id is divisible by 20."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
