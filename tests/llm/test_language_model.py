import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitegrain.llm import language_model as L
from sitegrain.llm.common import Workspace

from .docs import SCHEMA, rows, save


def fold(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w] + [None]


def expected(data):
    """doc_id, text -> counts and base scores from the definition."""
    counts = Counter(t for i, text in data if fold(i) != 1 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in data:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((i, fold(i) == 1, len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def plain_score(model, rare, text):
    """The model's log10 probability, token by token, from its parameters and counts."""
    vocab, p = model.vocab, model.scorer.p
    place = {w: k for k, w in enumerate(vocab.top, 1)}
    units, shares = [], []
    for t in tokens(text):
        if t is None:
            units.append(0)
            shares.append(1.0)
            continue
        word = t.encode()
        if place.get(word, 1 << 20) <= L.OWN:
            units.append(place[word])
            shares.append(1.0)
            continue
        k = L.class_of(word)
        c = int(vocab.counts[place[word]]) if word in place else rare.get(word, 0)
        units.append(1 + L.OWN + k)
        shares.append((c + 0.5) / (vocab.class_tokens[k] + 0.5 * (vocab.class_words[k] + 1)))
    total, last, earlier = 0.0, 0, 0
    for u, share in zip(units, shares):
        context = p.scale[0].astype(float) * p.inner[last] + p.scale[1].astype(float) * p.inner[earlier]
        scores = p.outer[:, : L.WIDTH].astype(float) @ context + p.outer[:, L.WIDTH]
        total += math.log10(share) + (scores[u] - np.log(np.exp(scores - scores.max()).sum()) - scores.max()) / math.log(10)
        last, earlier = u, last
    return total


def test_query_against_the_definition(spark, tmp_path):
    data = rows(n=150)
    found = L.query(spark, save(spark, tmp_path, data)).collect()
    want = expected([(r[0], r[1]) for r in data])
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5])
    found.sort(key=lambda r: (*key(r), r.base_score))
    want.sort(key=lambda r: (*key(r), r[5]))
    assert [tuple(r)[:5] for r in found] == [r[:5] for r in want]
    for r, w in zip(found, want):
        assert r.base_score == pytest.approx(w[5], rel=1e-9, abs=1e-6) and r.score < 0


@pytest.fixture
def small_top(monkeypatch):
    monkeypatch.setattr(L, "TOP", 1000)


def corpus(seed, n=400):
    """Two made-up tongues; words follow words of their own tongue."""
    rng = np.random.default_rng(seed)
    tongues = [[f"{a}{i}{'xyzw'[i % 4]}" for i in range(1500)] for a in ("mo", "ku")]
    out = []
    for i in range(n):
        words = tongues[i % 2]
        out.append((i, " ".join(words[int(k)] for k in np.minimum(rng.zipf(1.3, 60), 1500) - 1), "en", "a", None))
    return out


def test_scores_are_the_model_s(spark, small_top):
    """Scores of whole texts equal those of a plain walk through the parameters; held-out texts gain over single words."""
    data = corpus(1, 4000)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    model = L.fit(df, F.col("doc_id") % 5 != 1, Workspace(spark, "test"))
    rare = {bytes(r.word): r.c for r in model.rare.collect()}
    assert len(model.vocab.top) <= 1000 and rare and not set(rare) & set(model.vocab.top)
    found = {r.doc_id: r for r in L.score(model).collect()}
    assert len(found) == len(data)
    for i, text, *_ in data[:25]:
        assert found[i].score == pytest.approx(plain_score(model, rare, text), rel=1e-5)
    held = [r for r in found.values() if not r.learn]
    assert len(held) == 800 and sum(r.score for r in held) / sum(r.n_tokens for r in held) > sum(r.base_score for r in held) / sum(r.n_tokens for r in held) + 0.05


def test_probabilities_sum_to_one(spark, small_top):
    model = L.fit(spark.createDataFrame(corpus(2, 60), SCHEMA), F.lit(True), Workspace(spark, "test"))
    vocab, rng = model.vocab, np.random.default_rng(0)
    for _ in range(20):
        last, earlier = rng.integers(0, L.UNITS, 2)
        units = np.arange(L.UNITS)
        assert np.exp(model.scorer.units(units, np.full(L.UNITS, last), np.full(L.UNITS, earlier))).sum() == pytest.approx(1, abs=1e-4)
    # shares of a unit: its words' counts plus a half each, and a half for one unknown word
    counts = Counter()
    for r in model.rare.collect():
        counts[L.class_of(bytes(r.word))] += r.c + 0.5
    for w, c in zip(vocab.top[L.OWN :], vocab.counts[1 + L.OWN :]):
        counts[L.class_of(w)] += c + 0.5
    for k in range(L.CLASSES):
        assert counts[k] + 0.5 == pytest.approx(vocab.class_tokens[k] + 0.5 * (vocab.class_words[k] + 1))


def test_steps_follow_the_contrastive_gradient():
    """A step's gradients against differences of the loss, with its noise units held."""
    rng = np.random.default_rng(4)
    frequency = rng.dirichlet(np.ones(L.UNITS))
    units = rng.integers(0, L.UNITS, 12).astype(np.uint16)
    counts = np.array([1, 0, 1, 1, 1, 0, 1, 1, 1, 1], np.float32)
    start = L.Parameters.first(frequency)
    start.flat += rng.normal(0, 0.3, start.flat.shape).astype(np.float32)
    noise = np.minimum(np.searchsorted(np.cumsum(frequency), np.random.default_rng((L.SEED, 7)).random(L.NOISE)), L.UNITS - 1)

    def loss(flat):
        p, total = L.Parameters(flat), 0.0
        for j, c in enumerate(counts):
            if c:
                context = p.scale[0] * p.inner[units[j + 1]] + p.scale[1] * p.inner[units[j]]
                delta = lambda u: p.outer[u, : L.WIDTH] @ context + p.outer[u, L.WIDTH] - np.log(L.NOISE * frequency[u])  # noqa: B023, E731
                total += np.log1p(np.exp(-delta(units[j + 2]))) + sum(np.log1p(np.exp(delta(u))) for u in noise)
        return total / counts.sum()

    seen = {}
    trainer = L.Trainer(L.Parameters(start.flat.copy()), frequency, 7)
    trainer.move = lambda name, gradient, rate=0: seen.setdefault(name, gradient)
    trainer.step(units, counts)
    flat = np.concatenate([seen[n].ravel() for n in ("inner", "outer", "scale")])
    for k in rng.choice(np.flatnonzero(np.abs(flat) > 1e-4), 60, replace=False):
        up, down = start.flat.astype(np.float64), start.flat.astype(np.float64)
        up[k] += 1e-5
        down[k] -= 1e-5
        assert -(loss(up) - loss(down)) / 2e-5 == pytest.approx(flat[k], rel=2e-2, abs=1e-5)


def test_averages_weigh_tokens(spark):
    df = spark.createDataFrame([(k, float(w), np.full(3, w * v, np.float64).tobytes()) for k in range(L.SLICES) for w, v in ((1, 2.0), (3, 6.0), (4, 1.0))], "slice int, weight double, sums binary").repartition(7)
    found = {r.slice: np.frombuffer(r.sums) / r.weight for r in L.added_up(df).collect()}
    assert len(found) == L.SLICES and all((v == (2 + 18 + 4) / 8).all() for v in found.values())


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b", "en", "a", None), (2, None, None, None, None)], SCHEMA)
    found = {r.doc_id: r for r in L.score(L.fit(df, F.lit(False), Workspace(spark, "test"))).collect()}
    assert (found[1].n_tokens, found[1].n_known, found[1].train_tokens, found[1].base_score) == (3, 0, 0, pytest.approx(0, abs=1e-6))
    assert (found[2].n_tokens, found[2].n_known) == (1, 0) and found[1].score < found[2].score < 0
    assert L.score(L.fit(df.limit(0), F.lit(True), Workspace(spark, "test"))).collect() == []
