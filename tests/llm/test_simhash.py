import random

import numpy as np
import pytest
import xxhash

from sitegrain.llm import simhash as s

from .docs import rows, save


def brute_print(text):
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    shingles = [b" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))]
    ones = [sum(xxhash.xxh64_intdigest(x, 42) >> b & 1 for x in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(prints):
    """prints: (doc_id, fingerprint)."""
    parent = {i: i for i, _ in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(prints):
        for j, b in prints[k + 1 :]:
            if (a ^ b).bit_count() <= 4:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def varied():
    rng = random.Random(5)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randint(0, 400)) for _ in range(400)) for _ in range(8)]
    out = []
    for i in range(160):
        own = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 6, 30])):
            own[rng.randrange(len(own))] = f"w{rng.randint(0, 999)}"
        out.append((10_000 + 7 * i, " ".join(own), "en", "a", None))
    return rows() + out


def test_query_against_all_pairs(spark, tmp_path):
    data = varied()
    got = s.query(spark, save(spark, tmp_path, data)).collect()
    assert sorted(str((r.doc_id, r.fingerprint)) for r in got) == sorted(str((i, f"{brute_print(t):016x}")) for i, t, *_ in data)
    want = brute_components([(i, brute_print(t)) for i, t, *_ in data if i is not None])
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == set(want.items())
    assert len(set(want.values())) < len(want) - 40
    assert s.query(spark, save(spark, tmp_path / "none", [])).collect() == []


@pytest.mark.parametrize("n,bits", [(300, 64), (5000, 64), (700, 9)])
def test_forest_spans_all_links(n, bits):
    rng = np.random.default_rng(n)
    fp = rng.integers(0, 1 << min(bits, 63), n, dtype=np.uint64)
    for _ in range(n // 3):
        i, j = rng.integers(0, n, 2)
        fp[j] = fp[i]
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            fp[j] ^= np.uint64(1) << np.uint64(b)
    found = s.forest(np.full(n, n), fp, list(range(64)))
    prints = [(k, int(x)) for k, x in enumerate(fp)]
    assert all((prints[a][1] ^ prints[b][1]).bit_count() <= 4 for a, b in found.tolist())
    want = brute_components(prints)
    assert len(found) == n - len(set(want.values()))
    parent = list(range(n))
    for _ in range(n):
        before = list(parent)
        for a, b in found.tolist():
            parent[a] = parent[b] = min(parent[a], parent[b])
        if parent == before:
            break
    assert parent == [want[i] for i in range(n)]


@pytest.mark.parametrize("n", [10, 10**6, 10**8, 5 * 10**10])
def test_blocking_misses_no_pair(n):
    blocks, choices = s.blocking(n)
    rng = random.Random(n)
    for _ in range(500):
        diff = {rng.randrange(64) for _ in range(4)}
        hit = {k for k, (a, w) in enumerate(blocks) if any(a <= b < a + w for b in diff)}
        assert any(not hit & set(c) for c in choices)
    assert sum(w for _, w in blocks) == 64


def test_long_chains_are_one_component(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 999)], "a long, b long")
    got = {r.node: r.component_id for r in s.components(edges, s.Workspace(spark, "t")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000: 999, 1001: 999}


def test_keep_one(spark, tmp_path):
    data = varied() + [(None, "no id", None, None, None)]
    docs = spark.read.parquet(save(spark, tmp_path, data) + "/documents.parquet")
    kept = s.keep_one(docs)
    assert kept.columns == docs.columns
    want = brute_components([(i, brute_print(t)) for i, t, *_ in varied() if i is not None])
    assert {r.doc_id for r in kept.collect()} == set(want.values()) | {None}


def test_keep_one_row_of_a_repeated_id(spark, tmp_path):
    data = rows() + [(900, "a row repeated as it is, many times over", "en", "hot", None)] * 30 + [(None, "no id", None, None, None)] * 2
    docs = spark.read.parquet(save(spark, tmp_path, data) + "/documents.parquet")
    got = [r.doc_id for r in s.keep_one(docs).collect()]
    assert got.count(None) == 4 and got.count(900) == got.count(505) == 1
    assert len(got) - 4 == len(set(got) - {None})


def test_ids_with_different_texts_link_whole_components(spark, tmp_path):
    a, b, c = ("one text of some words " * 9, "quite another story told here " * 9, "third thing, unlike the others " * 9)
    prints = [brute_print(x) for x in (a, b, c)]
    assert min((prints[0] ^ prints[1]).bit_count(), (prints[0] ^ prints[2]).bit_count(), (prints[1] ^ prints[2]).bit_count()) > 4
    data = [(i, t, "en", "a", None) for i, t in [(3, a), (4, b), (7, a), (7, b), (9, c), (None, c)]]
    got = s.query(spark, save(spark, tmp_path, data)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(3, 3), (4, 3), (7, 3), (7, 3), (9, 9)]
    assert [r.component_id for r in got if r.doc_id is None] == [9]


def test_rows_without_an_id_carry_links(spark, monkeypatch):
    def flipped(fp, *bits):
        for b in bits:
            fp ^= 1 << b
        return fp

    chain = [(5, 0), (None, flipped(0, 1, 2, 3, 4)), (3, flipped(0, 1, 2, 3, 4, 5, 6, 7, 8)), (None, flipped(0, *range(20, 40)))]
    prints = spark.createDataFrame(chain, "doc_id long, fp long")
    monkeypatch.setattr(s, "fingerprints", lambda *_: prints)
    got = [(r.doc_id, r.fp, r.component_id) for r in s.near_duplicates(prints).collect()]
    assert sorted(got, key=str) == sorted([(i, fp, 3 if k < 3 else None) for k, (i, fp) in enumerate(chain)], key=str)


@pytest.mark.parametrize("n,large", [(3000, 300), (50_000, 9_000)])
def test_hot_buckets_are_parted(spark, monkeypatch, n, large):
    """A family of fingerprints that share most bits: one bucket holds all of them, no task may."""
    monkeypatch.setattr(s, "LARGE", large)
    monkeypatch.setattr(s, "TOGETHER", large + large // 2)
    rng = np.random.default_rng(n)
    fp = np.unique(np.concatenate([rng.integers(0, 1 << 20, n, dtype=np.uint64) << np.uint64(40), rng.integers(0, 1 << 62, 50, dtype=np.uint64)]))
    nodes = spark.createDataFrame([(int(x), int(x)) for x in fp.view(np.int64)], "node long, fp long").repartition(4)
    work = s.Workspace(spark, "t")
    got = s.links(nodes, len(fp), work)
    found = spark.read.parquet(f"{work.path}/found").filter("n IS NOT NULL").collect()
    assert found and all(r.n > large for r in found)
    links = [(r.a, r.b) for r in got.collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in links)
    own = {int(x): k for k, x in enumerate(fp.view(np.int64))}
    whole = s.forest(np.full(len(fp), len(fp)), fp, list(range(64)))

    def parts(pairs):
        parent = list(range(len(fp)))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for a, b in pairs:
            parent[root(a)] = root(b)
        label = {}
        return [label.setdefault(root(k), k) for k in range(len(fp))]

    assert parts([(own[a], own[b]) for a, b in links]) == parts(whole.tolist())
