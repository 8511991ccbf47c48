import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from sitegrain.llm import near_copies as nc

from .docs import rows, save


def brute_set(text):
    own = (text or "").encode().lower().split()
    return frozenset(b" ".join(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else frozenset()


def brute_kept(data):
    """The smallest doc_id of every component."""
    data = [(i if i is not None else 10**9 + k, t) for k, (i, t) in enumerate(data)]  # rows without an id link, and all stay
    parent = {i: i for i, _ in data}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    own = [(i, brute_set(t)) for i, t in data]
    for k, (i, a) in enumerate(own):
        for j, b in own[k + 1 :]:
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted({root(i) for i in parent if i < 10**9})


def edited(rng, n, edits):
    """A text of n words and a copy with some words replaced."""
    own = [f"w{rng.randint(0, 9999)}" for _ in range(n)]
    copy = list(own)
    for k in rng.sample(range(n), edits):
        copy[k] = f"new{rng.randint(0, 9999)}"
    return " ".join(own), " ".join(copy)


def planted():
    rng, out = random.Random(3), []
    for k in range(160):  # 400 words: similarities of about 0.76 to 0.98
        for side, text in enumerate(edited(rng, 400, 1 + k % 11)):
            out.append((100_000 + 2 * k + side, text, "en", "a", None))
    hot = [f"h{i}" for i in range(300)]
    for k in range(90):  # a cluster above the size of which all pairs are proposed
        own = list(hot)
        own[rng.randrange(300)] = f"x{k}"
        out.append((200_000 + k, " ".join(own), "en", "hot", None))
    return out + [(i, t, *r) for i, t, *r in rows()]


def test_stage_finds_planted_copies(spark, tmp_path):
    data = planted()
    docs = spark.read.parquet(save(spark, tmp_path, data) + "/documents.parquet")
    two = cp.drop_near_copies(spark, docs, str(tmp_path))
    assert two.columns == docs.columns
    got = [r.doc_id for r in two.collect()]
    assert sorted(i for i in got if i is not None) == brute_kept([(i, t) for i, t, *_ in data])
    assert got.count(None) == sum(i is None for i, *_ in data)
    near = [(a, b) for a, b in zip(data[:320:2], data[1:320:2]) if 0.8 <= len(brute_set(a[1]) & brute_set(b[1])) / len(brute_set(a[1]) | brute_set(b[1])) <= 0.95]
    assert len(near) > 80


def test_large_buckets_link_what_leaders_leave():
    rng = random.Random(1)
    base = [frozenset(rng.sample(range(10_000), 60)) for _ in range(6)]
    own = [sorted(set(rng.sample(sorted(base[k % 6]), 57)) | {20_000 + k}) for k in range(48)]
    part = [0 if k % 6 == 0 else k for k in range(48)]
    zero = pa.array([0] * 48)
    batch = pa.RecordBatch.from_arrays([pa.array([7] * 48), zero, zero, pa.array(range(48)), pa.array(part), pa.array([np.array(x, np.uint64).tobytes() for x in own])], names=["key", "low", "high", "node", "component_id", "own"])
    links = [(a, b) for x in nc.other_links(iter([batch.slice(0, 20), batch.slice(20)])) for a, b in zip(*(c.to_pylist() for c in x.columns))]
    near = {(a, b) for a in range(48) for b in range(a + 1, 48) if 5 * len(set(own[a]) & set(own[b])) >= 4 * len(set(own[a]) | set(own[b]))}
    assert set(links) <= near

    def groups(pairs):
        label = list(part)
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return {frozenset(k for k in range(48) if label[k] == x) for x in label}

    assert groups(links) == groups(near) and len(links) == len(set(part)) - len(groups(near))
    first = {(a, b) for x in nc.first_pairs(iter([batch.select(["key", "node"])])) for a, b in zip(*(c.to_pylist() for c in x.columns))}
    assert first == {(a, b) for a in range(48) for b in range(a + 1, 48)}


def test_leaders_meet_every_row(spark):
    rows_ = spark.createDataFrame([(k, n) for k in (1, 2) for n in range(k, 100, k)], "key long, node long").repartition(5)
    pairs = [(r.a, r.b) for r in nc.leader_pairs(rows_).collect()]
    assert all(a < b for a, b in pairs)
    met = {n: {a + b - n for a, b in pairs if n in (a, b)} for n in range(1, 100)}
    assert all(len(others) >= 3 for others in met.values()) and len(pairs) <= 2 * nc.LEADERS * 100


@pytest.mark.parametrize("part_rows", [5, 2048])
def test_a_hot_bucket_goes_through_many_tasks(spark, tmp_path, monkeypatch, part_rows):
    """Three hundred sets share a band key with each other, most of them neither copies of its leaders nor of each other: the links are those of all pairs."""
    monkeypatch.setattr(nc, "PART_ROWS", part_rows)
    plain = nc.signatures
    hot = lambda docs: plain(docs).withColumn("keys", F.concat(F.array(F.lit(77).cast("long")), F.slice("keys", 1, 1)))
    monkeypatch.setattr(nc, "signatures", hot)
    rng = random.Random(part_rows)
    texts = []
    for k in range(60):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(70)]
        texts += [" ".join([*words[: 70 - 2 * j], *(f"e{k}.{j}.{x}" for x in range(2 * j))]) for j in range(5)]
    docs = spark.read.parquet(save(spark, tmp_path, [(i, t, "en", "a", None) for i, t in enumerate(texts)]) + "/documents.parquet")
    assert sorted(r.doc_id for r in nc.keep_one(docs).collect()) == brute_kept(list(enumerate(texts)))


def test_one_row_of_a_repeated_id(spark, tmp_path):
    data = rows() + [(900, "a row repeated as it is, many times over", "en", "hot", None)] * 30 + [(None, "no id", None, None, None)] * 2
    docs = spark.read.parquet(save(spark, tmp_path, data) + "/documents.parquet")
    got = Counter(r.doc_id for r in nc.keep_one(docs).collect())
    assert got.pop(None) == 4
    assert got[900] == got[505] == 1 and set(got.values()) == {1}


def test_rows_without_an_id_carry_links(spark, tmp_path):
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words[k : k + 80]) for k in (0, 6, 12)]  # neighbours share 70 of 82 shingles, the ends 64 of 88
    docs = spark.read.parquet(save(spark, tmp_path, [(7, texts[0], "en", "a", None), (None, texts[1], "en", "a", None), (9, texts[2], "en", "a", None), (11, "alone", "en", "a", None)]) + "/documents.parquet")
    assert sorted(str(r.doc_id) for r in nc.keep_one(docs).collect()) == ["11", "7", "None"]


def test_simhash_proposes_pairs(spark, tmp_path, monkeypatch):
    """Linked fingerprints are looked at without any band key; the sets still decide."""
    plain = nc.signatures
    monkeypatch.setattr(nc, "signatures", lambda docs: plain(docs).withColumn("keys", F.array(F.monotonically_increasing_id())))
    rng = random.Random(5)
    pairs = [edited(rng, 900, 1) for _ in range(12)]
    pairs = [(a, b) for a, b in pairs if (nc.simhash(a.encode(), 5) ^ nc.simhash(b.encode(), 5)).bit_count() <= 4]
    assert len(pairs) > 6
    texts = [t for pair in pairs for t in pair] + ["a b c d e", "v w x y z"]
    docs = spark.read.parquet(save(spark, tmp_path, [(i, t, "en", "a", None) for i, t in enumerate(texts)]) + "/documents.parquet")
    assert sorted(r.doc_id for r in nc.keep_one(docs).collect()) == brute_kept(list(enumerate(texts)))
