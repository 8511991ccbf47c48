import numpy as np
import pytest
from pyspark.sql import functions as F

from sitegrain.llm import neighbours as nn


def brute(ids, x, k=20):
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = x @ q
            own = [(-a, j) for a, j in zip(s, ids) if j != i]
            out[i] = sorted(own)[:k]
    return out


def table(spark, path, rows, kind="array<float>"):
    spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int, score string, id string").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.mark.parametrize("kind", ["random", "clustered", "copies"])
def test_recall_against_brute_force(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(nn, "LIST_ROWS", 200)
    monkeypatch.setattr(nn, "BLOCK", 150)
    monkeypatch.setattr(nn, "CHUNK", 7)  # a block's queries come in many chunks
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    if kind == "clustered":
        x = x * 0.1 + rng.standard_normal((8, 24))[rng.integers(0, 8, 1500)].astype(np.float32)
    if kind == "copies":
        x[300:900] = x[300]
    rows = [(i, v.tolist(), 0, "x", "y") for i, v in enumerate(x)]
    rows += [(5000, None, 0, "x", "y"), (5020, [0.0] * 24, 0, "x", "y"), (5040, [float("nan")] * 24, 0, "x", "y"), (5060, [1.0, None] * 12, 0, "x", "y"), (5080, [1.0], 0, "x", "y"), (None, [9.0] * 24, 0, "x", "y"), (5100, [float("inf")] * 24, 0, "x", "y"), (5120, [], 0, "x", "y")]
    got = nn.query(spark, table(spark, tmp_path, rows)).collect()
    want = brute(list(range(1500)), x.astype(np.float64))
    by = {}
    for r in sorted(got, key=lambda r: r.rank):
        by.setdefault(r.query_id, []).append(r)
    assert by.keys() == want.keys()
    hits = 0
    for i, own in by.items():
        assert [r.rank for r in own] == list(range(1, 21))
        assert all(abs(r.score - float(x[r.vec_id].astype(np.float64) @ x[i].astype(np.float64))) < 1e-9 for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & {j for _, j in want[i]})
    assert hits >= 0.98 * 20 * len(want)


def test_few_rows(spark, tmp_path):
    got = nn.query(spark, table(spark, tmp_path, [(0, [1.0, 2.0], 0, "", ""), (3, [1.0, 2.0], 0, "", ""), (3, [1.0, 2.0], 0, "", ""), (40, [3.0, 0.0], 0, "", "")], "array<double>")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 3, 5.0), (0, 2, 3, 5.0), (0, 3, 40, 3.0), (40, 1, 0, 3.0), (40, 2, 3, 3.0), (40, 3, 3, 3.0)]
    assert nn.query(spark, table(spark, tmp_path / "none", [])).collect() == []
    assert nn.query(spark, table(spark, tmp_path / "bad", [(0, None, 0, "", ""), (20, [0.0], 0, "", "")])).collect() == []


def test_estimates_lie_within_bounds():
    rng = np.random.default_rng(2)
    for d in (3, 64, 100):
        x, q = rng.standard_normal((2000, d)), rng.standard_normal((30, d))
        turn = nn.rotation(d)
        c = x.mean(0)
        guess, bound = nn.estimate(q, (q @ c)[:, None], *nn.encode(x, c, turn), turn)
        assert (np.abs(guess - q @ x.T) <= bound).mean() > 0.98
