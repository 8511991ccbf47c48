"""op10 against plain re-computations: found lexicons, the label model, the linear classifier, scores."""

import math
import re

import numpy as np

from sitegrain.llm import toxicity as tox

from .docs import frame
from .test_classifiers import texts


def labelled(spark):
    data = texts(400)
    labels = [(i, int(i % 5 == 0)) for i, *_ in data]
    return data, spark.createDataFrame(labels, "doc_id long, toxic int")


def ratio(t, c, rate):
    part = lambda k, share: k * math.log(k / ((t + c) * share)) if k else 0.0
    return 2 * (part(t, rate) + part(c, 1 - rate))


def test_lexicons_against_counts(spark):
    data, _ = labelled(spark)
    rows = [(int(i % 5 == 0), t) for i, t, *_ in data]
    sample = spark.createDataFrame(rows, "toxic int, text string")
    n1 = sum(y for y, _ in rows)
    held = {}
    for y, t in rows:
        words = set(re.findall(r"[^\W\d_]{3,}", t.lower()))
        longest = max(((len(w), w) for w in words), default=None)
        for w in words:
            held[w, longest] = max(held.get((w, longest), 0), y)
    t, c = {}, {}
    for (w, _), y in held.items():
        t[w], c[w] = t.get(w, 0) + y, c.get(w, 0) + 1 - y
    rate = n1 / len(rows)
    best = {w: ratio(t[w], c[w], rate) for w in t if t[w] >= tox.SUPPORT}
    best = {w: r for w, r in best.items() if r >= tox.CHANCE and t[w] > 2 * (t[w] + c[w]) * rate}
    want = [frozenset(w for w, r in best.items() if (r >= 3 * tox.CHANCE) is x) for x in (True, False)]
    assert tox.find_lexicons(sample, n1, len(rows) - n1) == [v for v in want if v] and any(want)


def plain_label_model(votes, rounds=60):
    """The same expectation-maximisation, row by row, without pooling."""
    n, m = votes.shape
    p = 1 / (1 + np.exp(-3.0 * votes[:, -1]))
    weights = np.ones(m)
    for k in range(rounds):
        rates = []
        for c, q in enumerate((1 - p, p)):
            own = np.array([[(q[votes[:, j] == v].sum() + 0.5 * a) / (q.sum() + 1.0) for j in range(m)] for v, a in zip((-1, 0, 1), (0.3, 1.4, 0.3))])
            own[:, -1] = tox.HELD[c]
            rates.append(own)
        prior = min(max(p.mean(), 1e-4), 1 - 1e-4)
        if k in (5, 20, 40):
            residual = votes - np.outer(1 - p, rates[0][2] - rates[0][0]) - np.outer(p, rates[1][2] - rates[1][0])
            cov = residual.T @ residual / n
            sd = np.sqrt(np.diag(cov)) + 1e-9
            rho = np.abs(cov / np.outer(sd, sd))
            rho[rho < 0.05] = 0
            weights = 1 / np.maximum(rho[:, :-1].sum(1), 1)
            weights[-1] = 1.0
        z = np.log(prior / (1 - prior)) + sum(weights[j] * np.log(rates[1][votes[:, j] + 1, j] / rates[0][votes[:, j] + 1, j]) for j in range(m))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return p


def test_label_model_against_a_plain_one():
    rng = np.random.default_rng(4)
    y = rng.random(600) < 0.3
    votes = np.column_stack([np.where(rng.random(600) < np.where(y, a, b), 1, np.where(rng.random(600) < 0.1, -1, 0)) for a, b in ((0.8, 0.05), (0.6, 0.1), (0.5, 0.02))] + [np.where(y, 1, -1)])
    votes = np.column_stack([votes[:, :1], votes])  # one voter twice
    assert np.allclose(tox.label_model(votes)[0], plain_label_model(votes), atol=1e-8)


def test_classifier_is_at_its_minimum():
    rng = np.random.default_rng(5)
    x, y = rng.integers(-1, 2, (500, 6)).astype(float), rng.random(500)
    w, b = tox.logistic(x, y)
    e = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(x.T @ e + 0.5 * w).max() < 1e-5 and abs(e.sum()) < 1e-3


def test_scores_against_dense_sums(spark):
    data, labels = labelled(spark)
    docs = frame(spark, [*data, (None, "you idiot", None, None, None), (900, None, None, None, None), (901, "", None, None, None)])
    model = tox.fit(docs, labels)
    words = tox.given_words()
    for r in tox.score(docs, model, ["doc_id", "text"]).collect():
        votes, hits = tox.evidence(r.text or "", words, model["found"], model["stems"])
        own = set(re.findall(r"[^\W\d_]+", (r.text or "").lower()))
        assert votes[: len(words["sets"])] == [int(bool(own & v)) for v in words["sets"]]
        x = np.array([*votes, *[float(w in hits) for w in model["lexicon"]]])
        want = 1 / (1 + math.exp(-min(30.0, max(-30.0, float(x @ model["w"]) + model["b"]))))
        assert abs(r.toxicity - want) < 1e-9 and 0 <= r.toxicity <= 1
