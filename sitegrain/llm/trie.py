"""Prefix trie of conversations, its totals gathered by leaf peeling.

Every distinct sequence of first turns is a node. A node's name is its depth
and the exclusive or of 128-bit hashes of its turns and their places, so names
are running aggregates of a conversation's turns and a parent's name is a
child's without its last turn. Only these hashes travel; texts are read once
and never shuffled (equal names are taken for equal turns; a chance of about
2**-128 a pair).

Totals of subtrees are gathered by messages: a node waits for as many messages
as it has children; complete nodes send their totals to their parents, message
by message added up before they are dealt, until the root is complete. Nodes
in a row that have the same members (a node of smallest member c and n members
and its only child of as many) are one segment, so the rounds are as many as
the branchings above each other, not as the turns. Each round is a written
table, and only what still waits goes through the next.

Edge cases: rows without a conv_id belong to no conversation; null roles and
texts are empty ones; turns of one place are taken in the order of their
hashes, repeated rows are turns of their own; a conversation without turns is
a member of the root and ends there; an empty table has no node. Other columns
are ignored. A very long conversation is dealt over tasks by ranges of its turns;
the digest of very many conversations that end at one node is taken in one
stream, as SHA-256 has to be, over parts that are joined beforehand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, bucket_of, read_table, running, shuffle_partitions
from .mixing import size_of

NODE = ["depth", "p1", "p2"]
#: Ids joined to one part of what is digested.
PART = 1 << 16


def hashed(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, d1, d2, words, row`` of conversations' rows: hashes of role and text, words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.filter("conv_id is not null").select("conv_id", "turn", digest.alias("d"), size_of("text").alias("words"))
    return rows.select("conv_id", "turn", F.xxhash64(F.lit(1), "d").alias("d1"), F.xxhash64(F.lit(2), "d").alias("d2"), "words", F.monotonically_increasing_id().alias("row"))


def placed(turns: DataFrame, work: Workspace) -> DataFrame:
    """Adds to ``hashed`` rows their place in the conversation, from 1."""
    return running(turns, ["conv_id"], ["turn", "d1", "d2", "row"], work, "turns", place=(F.sum, F.lit(1).cast("long")))


def borrowed(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: their first h turns (crc32 of the id mod ``most``) are those of the conversation at ``id - id % every``.

    ``turns`` has places. Gives turns ``conv_id, depth, d1, d2, words, size`` and all conversations with their sizes.
    """
    own = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    base = own.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    plan = own.withColumns({"h": bucket_of("conv_id", most), "base": F.col("conv_id") - F.col("conv_id") % every}).join(base, "base", "left")
    plan = plan.withColumn("m", F.least("h", F.coalesce("there", F.lit(0)))).withColumn("size", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    first = turns.filter(F.col("place") < most).select(F.col("conv_id").alias("base"), "place", "d1", "d2", "words")
    first = plan.filter("m > 0").select("conv_id", "base", "m", "size").join(first, "base").filter("place <= m")
    rest = turns.join(plan.select("conv_id", "h", "m", "size"), "conv_id").filter("place > h")
    same = ["d1", "d2", "words", "size"]
    made = first.select("conv_id", F.col("place").alias("depth"), *same).unionByName(rest.select("conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("depth"), *same))
    return made, plan.select("conv_id", "size")


def digests(ends: DataFrame, by: list[str]) -> DataFrame:
    """SHA-256 of each node's ids, ascending, as decimals with commas between: parts are joined in ranges, then digested in order."""
    types = ", ".join(f"{c} long" for c in by)
    parts_n = shuffle_partitions(ends.sparkSession)

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in node], pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=[*by, "first", "ids"])

        for batch in batches:
            columns = batch.to_pydict()
            for conv, *own in zip(columns["conv_id"], *[columns[c] for c in by]):
                if own != node or len(ids) >= PART:
                    if ids:
                        yield part()
                    node, ids = own, []
                ids.append(conv)
        if ids:
            yield part()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []

        def told() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.string())], names=[*by, "ends_sha256"])

        for batch in batches:
            columns = batch.to_pydict()
            for ids, *own in zip(columns["ids"], *[columns[c] for c in by]):
                if own == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = own, hashlib.sha256(ids.encode())
            if len(out) >= PART:
                yield told()
        if node is not None:
            out.append((*node, state.hexdigest()))
        if out:
            yield told()

    parts = ends.select(*by, "conv_id").repartitionByRange(parts_n, *by, "conv_id").sortWithinPartitions(*by, "conv_id").mapInArrow(join_ids, f"{types}, first long, ids string")
    return parts.repartition(parts_n, *by).sortWithinPartitions(*by, "first").mapInArrow(digest, f"{types}, ends_sha256 string")


def peel(segments: DataFrame, work: Workspace) -> DataFrame:
    """``conv_id, n_convs, n_leaves, below`` of every segment: leaves of its subtree and what its children's subtrees save.

    ``segments``: ``conv_id, n_convs, up_conv, up_n`` (its parent, null at the root), ``own`` (what it saves itself), ``remaining`` (its children).
    """
    state = work.write(segments.withColumns({"n_leaves": F.when(F.col("remaining") == 0, 1).otherwise(0).cast("long"), "below": F.lit(0).cast("long")}), "waiting0")
    step = 0
    while True:
        work.write(state.filter("remaining = 0"), f"complete/round={step}")
        waits = state.filter("remaining > 0")
        if waits.isEmpty():
            break
        sent = state.filter("remaining = 0 and up_conv is not null").groupBy(F.col("up_conv").alias("to_conv"), F.col("up_n").alias("to_n"))
        sent = sent.agg(F.count(F.lit(1)).alias("got"), F.sum("n_leaves").alias("l"), F.sum(F.col("own") + F.col("below")).alias("s"))
        told = waits.join(sent, (F.col("conv_id") == F.col("to_conv")) & (F.col("n_convs") == F.col("to_n")), "left")
        more = {"remaining": ("remaining", "got", -1), "n_leaves": ("n_leaves", "l", 1), "below": ("below", "s", 1)}
        step += 1
        state = work.write(told.select(*["conv_id", "n_convs", "up_conv", "up_n", "own"], *[(F.col(a) + sign * F.coalesce(b, F.lit(0))).alias(c) for c, (a, b, sign) in more.items()]), f"waiting{step}")
        work.drop(f"waiting{step - 1}")
    return work.spark.read.schema(state.schema).parquet(f"{work.path}/complete").select("conv_id", "n_convs", "n_leaves", "below")


def trie(turns: DataFrame, sizes: DataFrame, work: Workspace) -> DataFrame:
    """All nodes of the trie of turns ``conv_id, depth, d1, d2, words, size`` (depth from 1, without gaps) and conversations ``conv_id, size``.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    hashes = {f"g{i}": F.xxhash64("depth", f"d{i}") for i in (1, 2)}
    named = running(turns.withColumns(hashes), ["conv_id"], ["depth"], work, "rebuilt", p1=(F.bit_xor, F.col("g1")), p2=(F.bit_xor, F.col("g2")))
    named = work.write(named.select("conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("g1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("g2")).alias("q2"), "words", (F.col("depth") == F.col("size")).alias("last")), "named")
    zero = F.lit(0).cast("long")
    nodes = named.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.min("q1").alias("q1"), F.min("q2").alias("q2"))
    root = sizes.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in NODE], "n_convs", "conv_id", zero.alias("words"), zero.alias("q1"), zero.alias("q2"))
    nodes = work.write(nodes.unionByName(root), "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("up_conv"), F.col("n_convs").alias("up_n"))
    # the root's children are met by its one row, the others' by name (AQE splits a parent of very many children)
    low = nodes.filter("depth <= 1").join(F.broadcast(parents.filter("depth = 1")), ["depth", "q1", "q2"], "left")
    high = nodes.filter("depth > 1").join(parents.filter("depth > 1"), ["depth", "q1", "q2"])
    full = low.unionByName(high).drop("q1", "q2").join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    full = running(full, ["conv_id", "n_convs"], ["depth"], work, "segments", upto=(F.sum, (F.col("n_convs") - 1) * F.col("words")))
    full = work.write(full, "linked")
    segments = full.groupBy("conv_id", "n_convs").agg(F.min_by(F.struct("up_conv", "up_n"), "depth").alias("up"), F.max("upto").alias("own"), F.max_by("n_children", "depth").alias("remaining"))
    done = peel(segments.select("conv_id", "n_convs", "up.up_conv", "up.up_n", "own", "remaining"), work)
    own = segments.select("conv_id", "n_convs", "own")
    ends = digests(named.filter("last").select(*NODE, "conv_id").unionByName(sizes.filter("size = 0").select(*[zero.alias(c) for c in NODE], "conv_id")), NODE)
    told = full.join(done.join(own, ["conv_id", "n_convs"]), ["conv_id", "n_convs"]).join(ends, NODE, "left")
    saved = F.col("own") - F.col("upto") + (F.col("n_convs") - 1) * F.col("words") + F.col("below")
    nothing = hashlib.sha256(b"").hexdigest()
    return told.select("conv_id", "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def query(spark, sf_dir):
    """op13: the trie of all conversations, each rebuilt with the beginning of the first of its twenty."""
    work = Workspace(spark, "op13")
    turns = work.write(placed(work.write(hashed(read_table(spark, sf_dir, "conversations")), "hashed"), work), "placed")
    made, sizes = borrowed(turns)
    return trie(made, work.write(sizes, "sizes"), work)


ORACLE = r"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(str_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
m AS (SELECT c.conv_id, c.h, count(o.place) AS m FROM c LEFT JOIN o ON o.conv_id = c.base AND o.place <= c.h GROUP BY ALL),
t AS (
  SELECT c.conv_id, o.place AS depth, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.place <= c.h
  UNION ALL
  SELECT m.conv_id, o.place - m.h + m.m, o.role, o.text FROM m JOIN o ON o.conv_id = m.conv_id AND o.place > m.h),
p AS (
  SELECT conv_id, depth, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS way,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM t
  UNION ALL
  SELECT conv_id, 0, [], 0, conv_id NOT IN (SELECT conv_id FROM t) FROM c),
n AS (
  SELECT way, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM p GROUP BY way),
k AS (SELECT way[:depth - 1] AS way, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
b AS (SELECT n.way, n.n_convs, n.words, coalesce(k.n_children, 0) AS n_children, unnest(range(n.depth + 1)) AS upto FROM n LEFT JOIN k ON n.way = k.way),
s AS (SELECT way[:upto] AS way, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved FROM b GROUP BY 1)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, u.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s ON n.way = s.way LEFT JOIN k ON n.way = k.way LEFT JOIN n AS u ON n.depth > 0 AND u.way = n.way[:n.depth - 1]
"""
