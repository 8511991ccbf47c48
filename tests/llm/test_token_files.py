"""Token files: encoder, Huffman files, flat files and packing, against the library and brute force."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitegrain.llm import huffman, packing, separators, tokens
from sitegrain.llm.common import Workspace

from .docs import rows, save

E = tokens.encoder(tokens.default_path())


def library(text, special=True):
    enc = tokens.encoder(tokens.default_path(), special)
    return enc.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab'sdlrevmt0123. ,<|endoftext>ÀéÖ×÷ßÿøΣς²½ ́\x1c\x85​漢İ\n\t…😀_-", max_size=40))
def test_encoder_equals_library(text):
    assert np.frombuffer(E.ids(text.encode()), E.dtype).tolist() == library(text)


def ordered(data):
    return sorted(((i, t or "") for i, t, *_ in data), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))


def in_order(got):
    """Rows of documents in ascending doc_id order (null first), one after the other without gaps; rows of one id in any order."""
    got = sorted(got, key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    return got


def test_huffman_query(spark, tmp_path):
    got = in_order(huffman.query(spark, save(spark, tmp_path)).collect())
    want = []
    for i, t in ordered(rows()):
        ids = [*library(t), tokens.END]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got)
    assert huffman.query(spark, save(spark, tmp_path / "none", [])).collect() == []


def test_files_are_small_and_many(spark, tmp_path, monkeypatch):
    """Blocks of some hundred ids, two a file; a doc_id that most rows repeat is spread over the partitions."""
    monkeypatch.setattr(huffman, "BLOCK_IDS", 300)
    monkeypatch.setattr(huffman, "FILE_BLOCKS", 2)
    data = [(7, f"the same id {i} again and again", "en", "hot", None) for i in range(400)] + rows()
    docs = spark.read.parquet(save(spark, tmp_path, data) + "/documents.parquet")
    path = huffman.write_files(docs, Workspace(spark, "t"), tokens.default_path())
    files = [r for r in spark.read.format("binaryFile").load(f"{path}/blocks").select("path", "content").collect() if r.content]
    per = [list(huffman.blocks_of(bytes(r.content))) for r in files]
    assert len(files) > 8 and all(1 <= len(blocks) <= 2 for blocks in per)
    assert all(n < 300 or len(keys) == 1 or sum(sizes[:-1]) < 300 for blocks in per for keys, sizes, _, _, _, n in blocks)
    got = in_order(huffman.read_files(spark, path).collect())
    assert sorted(str((r.doc_id, np.frombuffer(r.ids, "<u4").tolist())) for r in got) == sorted(str((i, [*library(t), tokens.END])) for i, t in ordered(data))
    parts = {r.path.split("part-")[1].split("-")[0] for r, blocks in zip(files, per) for keys, *_ in blocks if set(keys) == {7}}
    assert len(parts) > 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=300), st.integers(0, 2**31))
def test_code_lengths_are_prefix_free_and_optimal(counts, seed):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts)
    n = int((counts > 0).sum())
    assert (lengths[counts == 0] == 0).all()
    if n > 1:
        assert sum(2.0 ** -int(x) for x in lengths if x) == 1 and lengths.max() <= huffman.LIMIT
        import heapq

        heap, cost = sorted(int(c) for c in counts if c), 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost += a + b
            heapq.heappush(heap, a + b)
        if lengths.max() < huffman.LIMIT:
            assert cost == int((counts * lengths).sum())
    if n:
        rng = np.random.default_rng(seed)
        ids = rng.choice(np.flatnonzero(counts), 3000)
        payload, marks = huffman.encode(ids, huffman.canonical_codes(lengths), lengths)
        per = np.minimum(huffman.EVERY, len(ids) - huffman.EVERY * np.arange(len(marks)))
        assert (huffman.decode(payload, marks, per, huffman.decoding_table(lengths)) == ids).all()


def test_length_limit_holds():
    lengths = huffman.code_lengths(np.array([2**k for k in range(40)]))
    assert lengths.max() == huffman.LIMIT and sum(2.0 ** -int(x) for x in lengths) == 1


def test_packing_query(spark, tmp_path):
    got = packing.query(spark, save(spark, tmp_path)).collect()
    docs = {}
    for i, t in ordered(rows()):
        docs.setdefault(i, []).append(np.array([*library(t), tokens.END], "<u4"))
    total = sum(len(x) for v in docs.values() for x in v)
    assert sum(r.length for r in got) == total
    for i, own in docs.items():
        for ids in own:
            pieces = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i and r.doc_tokens == len(ids))
            assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1].tolist()]
            assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in pieces) and sum(p[1] for p in pieces) == len(ids)
    assert sum(r.length for r in got if r.doc_id is None) == 1 + len(library("no id here")) + 1
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        n = sum(r.length for r in own)
        assert n <= 4096 and len({r.step_group for r in own}) == 1
        padding += 0 if n & (n - 1) == 0 else 4096 - n
    assert padding < 4096
    assert packing.query(spark, save(spark, tmp_path / "none", [])).collect() == []


def test_ends_are_packed_in_rounds(spark, tmp_path, monkeypatch):
    """300 partitions of a few words each, the ends of 7 in a task: three rounds, one padded window."""
    monkeypatch.setattr(packing, "FAN", 7)
    texts = {i: " ".join(f"word{i} {k}" for k in range(1 + i % 40)) for i in range(900)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(300)
    out = packing.pack(docs, tokens.default_path())
    got = out.collect()
    whole = {i: np.array([*library(t), tokens.END], "<u4") for i, t in texts.items()}
    back = {}
    for r in sorted(got, key=lambda r: r.start):
        back.setdefault(r.doc_id, []).append(np.frombuffer(r.ids, "<u4"))
    assert all((np.concatenate(back[i]) == whole[i]).all() for i in whole) and back.keys() == whole.keys()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    sizes = [sum(r.length for r in own) for own in by.values()]
    assert all(sorted(r.offset for r in own) == [0, *np.cumsum([r.length for r in sorted(own, key=lambda r: r.offset)])[:-1].tolist()] for own in by.values())
    assert all(n in packing.TIERS for n in sorted(sizes)[1:]) and len({s >> packing.ROUND_SHIFT for s in by}) >= 3
    assert sorted(map(str, got)) == sorted(map(str, out.collect()))


def test_groups_are_balanced():
    rng = random.Random(3)
    packer, dealer = packing.Packer(), packing.Dealer(0, False)
    for i in range(3000):
        n = rng.choice([20, 300, 900, 3000])
        for w in packer.add(packing.Piece(i, n, 0, np.zeros(n, "<u2"))):
            dealer.take(w, sum(len(p.ids) for p in w))
    for w in packer.pack(last=True):
        dealer.take(w, sum(len(p.ids) for p in w))
    out = [r for b in dealer.flush(last=True) for r in b.to_pylist()]
    cost = {}
    for r in out:
        if r["window"] == 4096:
            cost.setdefault(r["step_group"], []).append(r["length"] ** 2)
    full = [sum(v) for v in cost.values()][: packing.ROUND]
    assert max(full) < 1.5 * min(full)


def test_separators_query(spark, tmp_path):
    got = separators.query(spark, save(spark, tmp_path)).collect()
    want = sorted(str((i, len(library(t, special=False)) + 1)) for i, t in ordered(rows()))
    assert sorted(str((r.doc_id, r.n_tokens)) for r in got) == want
    got.sort(key=lambda r: r.ordinal)
    assert [r.ordinal for r in got] == list(range(len(want)))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert separators.query(spark, save(spark, tmp_path / "none", [])).collect() == []


def test_flat_files_are_small(spark, tmp_path, monkeypatch):
    """A task writes many files, each of some bytes or one document; none of their rows is broadcast."""
    monkeypatch.setattr(separators, "FILE_BYTES", 400)
    data = [(i, f"document {i} " * (1 + i % 30), "en", "a", None) for i in range(300)] + [(900, "long " * 3000, "en", "a", None)] + rows()
    sf = save(spark, tmp_path / "t", data)
    docs = spark.read.parquet(f"{sf}/documents.parquet").coalesce(1)
    path = f"file://{tmp_path}/flat"
    separators.write_flat(docs, path, tokens.default_path())
    held = {k: {r.name: r.length for r in spark.read.format("binaryFile").load(f"{path}/kind={k}").filter("length > 0").selectExpr("element_at(split(path, '/'), -1) AS name", "length").collect()} for k in ("ids", "docs")}
    longest = 2 * max(len(library(t, special=False)) + 1 for _, t in ordered(data))
    assert held["ids"].keys() == held["docs"].keys() and len(held["ids"]) > 20
    assert max(held["ids"].values()) < 400 + longest and sorted(held["ids"].values())[-5] < 3000
    made = separators.query(spark, sf)
    got = sorted(made.collect(), key=lambda r: r.ordinal)
    assert sorted(str((r.doc_id, r.n_tokens)) for r in got) == sorted(str((i, len(library(t, special=False)) + 1)) for i, t in ordered(data))
    assert [r.ordinal for r in got] == list(range(len(data))) and [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    top = made._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert top.rstrip().endswith("SortMerge")


@pytest.mark.parametrize("seed", range(3))
def test_scan_stitches_across_files(spark, tmp_path, seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 6, 2000).astype("<u2")
    if seed == 2:
        ids[300:1500] = 1  # files without an end
    cuts = [0, *sorted(rng.integers(0, 2000, 9).tolist()), 2000]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (tmp_path / f"f{k:02}.bin").write_bytes(ids[a:b].tobytes())
    rows_ = separators.scan(spark, f"file://{tmp_path}", end=5, block=[7, 64, 5000][seed]).collect()  # documents run across blocks, files and ranges
    got = sorted((r.ordinal, r.start, r.n_tokens, r.ended) for r in rows_)
    per = {}
    for r in sorted(rows_, key=lambda r: r.ordinal):
        assert r.nth == per.setdefault(r.file, 0)
        per[r.file] += 1
    ends = (np.flatnonzero(ids == 5) + 1).tolist()
    marks = [0, *ends] + ([2000] if ends[-1] < 2000 else [])
    assert got == [(k, a, b - a, b in ends) for k, (a, b) in enumerate(zip(marks, marks[1:]))]
    assert separators.ends_of(ids, 5).tolist() == ends


def test_files_are_readable_alone(spark, tmp_path):
    docs = spark.read.parquet(save(spark, tmp_path) + "/documents.parquet")
    path = huffman.write_files(docs, Workspace(spark, "t"), tokens.default_path())
    back = {(r.doc_id, r.n_tokens): np.frombuffer(r.ids, "<u4").tolist() for r in huffman.read_files(spark, path).collect()}
    for i, t in ordered(rows()):
        ids = [*library(t), tokens.END]
        assert back[i, len(ids)] == ids
