import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from sitegrain.llm import trie as T
from sitegrain.llm.common import Workspace

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0))] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (c % 20 if c >= 0 else -((-c) % 20)), [])
        out[c] = base[:h] + v[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    found = set()
    for way, own in members.items():
        children = [w for w in members if len(w) == len(way) + 1 and w[:-1] == way]
        below = [w for w in members if w[: len(way)] == way]
        leaves = sum(not any(len(x) == len(w) + 1 and x[:-1] == w for x in members) for w in below)
        saved = sum((len(members[w]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", w[-1][1])) for w in below if w)
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(way))))
        found.add((min(own), len(way), min(members[way[:-1]]) if way else None, len(own), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return found


def made(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(0, 70):
        if conv in (20, 33):
            continue
        for turn in range(rng.randint(0, 5)):
            rows.append((conv, None if turn == 0 and rng.random() < 0.3 else turn, rng.choice(["user", "assistant", None]), rng.choice(["a b", "a b ", "x", "", None, "c d e\n f"])))
    rows += [(-7, 1, "user", "a b"), (-40, 1, "u", "v"), (-40, 2, "u", "w"), (None, 1, "user", "lost"), (68, 9, "user", "same"), (68, 9, "user", "same"), (999, 1, "ab", "c"), (998, 1, "a", "bc")]
    rows += [(conv, turn, "user", f"copied {turn}") for conv in range(200, 290) for turn in range(4)]  # very many that end at one node
    rows += [(conv, turn, "user", f"long {turn if turn < 40 + conv else -conv}") for conv in (1001, 1003) for turn in range(60)]
    return rows


def collected(df):
    rows = [tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_query(spark, tmp_path, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("depth", "size", "place", "words", "range", "own", "p1"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    df.repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    assert collected(T.query(spark, str(tmp_path))) == brute(rows)


def test_sql(spark, tmp_path):
    rows = [r for r in made(3) if r[0] not in (1001, 1003)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    names = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    assert set(con.sql(f"SELECT {names} FROM ({T.ORACLE})").fetchall()) == brute(rows)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert T.query(spark, str(tmp_path)).collect() == []


def test_a_long_conversation_is_dealt_over_ranges(spark):
    """Three thousand shared turns are one segment; members leave one by one, a branching each."""
    convs = {c: 3000 - 700 * c for c in range(4)}
    rows = [(c, d, "u", f"turn {d}") for c, n in convs.items() for d in range(1, n + 1)]
    work = Workspace(spark, "test")
    turns = T.placed(work.write(T.hashed(spark.createDataFrame(rows, SCHEMA)), "hashed"), work)
    sizes = spark.createDataFrame(list(convs.items()), "conv_id long, size long")
    turns = turns.select("conv_id", F.col("place").alias("depth"), "d1", "d2", "words").join(sizes, "conv_id")
    found = T.trie(turns, sizes, work).orderBy("depth").collect()
    assert [r.depth for r in found] == list(range(3001)) and {r.n_leaves for r in found} == {1}
    for r in found:
        assert r.n_convs == sum(n >= r.depth for n in convs.values()) and r.n_children == (r.depth < 3000)
        assert r.saved_tokens == sum(2 * (sum(n >= d for n in convs.values()) - 1) for d in range(max(r.depth, 1), 3001))
    assert work.spark.read.parquet(f"{work.path}/complete").select("round").distinct().count() == 4


def test_digests_join_parts_in_order(spark, monkeypatch):
    ids = list(range(-50, 700))
    df = spark.createDataFrame([(i % 2, i) for i in ids], "n long, conv_id long").repartition(3)
    found = {r.n: r.ends_sha256 for r in T.digests(df, ["n"]).collect()}
    assert found == {n: hashlib.sha256(",".join(str(i) for i in ids if i % 2 == n).encode()).hexdigest() for n in (0, 1)}
