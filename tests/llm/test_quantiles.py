import math
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sitegrain.llm import quantiles as Q
from sitegrain.llm.common import Workspace


def exact_of(xs):
    return Q.exact(np.zeros(len(xs), np.int64), np.asarray(xs, np.int64), np.ones(len(xs), np.int64))


def bounds_hold(p, xs):
    xs = np.sort(xs)
    below, upto = np.searchsorted(xs, p.x), np.searchsorted(xs, p.x, side="right")
    return (p.lo <= upto).all() and (p.hi >= below).all() and p.x[0] == xs[0] and p.x[-1] == xs[-1] and p.rows[0] == len(xs)


@pytest.mark.parametrize("spread", [5, 1000, 10**12])
def test_trees_stay_within_their_budget(spread):
    rng = np.random.default_rng(spread)
    size, leaves = 40, 37
    data = [rng.integers(0, spread, rng.integers(1, 400)) for _ in range(leaves)]
    p = exact_of(data[0])
    for d in data[1:]:
        p = Q.beside(p, exact_of(d))
    p = Q.prune(p, size)
    p, key = Q.tree(p, np.zeros(leaves, np.int64), size)
    xs = np.sort(np.concatenate(data))
    assert list(key) == [0] and bounds_hold(p, xs)
    assert min(Q.LEAST, len(np.unique(xs))) <= len(p.x) <= size + 1
    target = np.arange(1, len(xs) + 1)
    answers = p.x[Q.pick(p, np.zeros(len(target), np.int64), target)]
    error = np.maximum(np.searchsorted(xs, answers) + 1 - target, target - np.searchsorted(xs, answers, side="right"))
    heights = 1 + math.ceil(math.log2(leaves))
    assert error.max() <= heights / (2 * size) * len(xs) + heights + leaves / 2
    assert (np.diff(answers) >= 0).all()
    q = Q.unpack(Q.pack(p))
    assert (q.x == p.x).all() and (q.lo == p.lo).all() and (q.hi == p.hi).all()


def test_heavy_values_leave_room_for_others():
    xs = np.concatenate([np.full(1_000_000, 7), np.arange(100, 400)])
    p = Q.prune(exact_of(xs), 40)
    assert Q.LEAST <= len(p.x) <= 41 and bounds_hold(p, xs)


def tables(rows, names, types_, step):
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types_)], names=names)
    return [batch.slice(k, step) for k in range(0, batch.num_rows, step)]


def gathered(batches):
    return [r for b in batches for r in b.to_pylist()]


@pytest.mark.parametrize("leaf", [4, 50])
def test_tasks_in_short_leaves(monkeypatch, leaf):
    """Leaves, rounds and ends as tasks run them, with runs that go on over many leaves."""
    monkeypatch.setattr(Q, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    rows = [(str(rng.choice([1, 2, 2, 2, 2, 3, int(rng.integers(4, 60))])), int(rng.integers(0, 4)), int(rng.integers(0, 500)), int(rng.integers(1, 4))) for _ in range(3000)]
    size = 60
    packed, single = [], []
    for task in range(5):
        own = sorted(rows[task::5])
        monkeypatch.setattr(Q, "TaskContext", types.SimpleNamespace(get=lambda t=task: types.SimpleNamespace(partitionId=lambda: t)))
        for r in gathered(Q.leaves(["k"], size)(tables(own, ["k", "part", "x", "w"], [pa.string(), pa.int32(), pa.int64(), pa.int64()], 7))):
            (single if r["packed"] is None else packed).append(r)
    assert packed and single
    packed = sorted([(r["k"], r["part"], 0, r["packed"]) for r in packed], key=lambda r: r[:3])
    merged = gathered(Q.merge(["k"], size)(tables(packed, ["k", "part", "node", "packed"], [pa.string(), pa.int32(), pa.int32(), pa.binary()], 3)))
    last = [(r["k"], r["part"], r["x"], r["w"], None) for r in single] + [(r["k"], r["part"], None, None, r["packed"]) for r in merged]
    last.sort(key=lambda r: (r[0], r[1], -1 if r[2] is None else r[2]))
    found = gathered(Q.finish(["k"], size, 1)(tables(last, ["k", "part", "x", "w", "packed"], [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()], 5)))
    told = {(r["k"], r["part"]): r for r in found}
    assert len(told) == len(found) == len({(k, p) for k, p, _, _ in rows} | {(k, -1) for k, *_ in rows})
    for (k, part), r in told.items():
        xs = np.sort(np.concatenate([np.full(w, x) for kk, p, x, w in rows if kk == k and part in (p, -1)]))
        p = Q.unpack([r["summary"]])
        assert r["n"] == len(xs) and r["points"] == len(p.x) <= size + 1 and bounds_hold(p, xs)


@pytest.mark.parametrize("leaf", [3, 40, 10_000])
def test_running_counts_over_ranges(monkeypatch, leaf):
    monkeypatch.setattr(Q, "LEAF", leaf)
    rng = np.random.default_rng(5)
    rows = {}
    for _ in range(900):
        at = (str(rng.choice([1, 2, 2, 2, 3])), int(rng.integers(0, 200)), int(rng.integers(0, 3)))
        rows[at] = rows.get(at, 0) + int(rng.integers(1, 3))
    asked = []
    for k in "123":
        for part in (-1, 0, 1, 2):
            xs = sorted(x for (kk, x, p), w in rows.items() if kk == k and part in (p, -1) for _ in range(w))
            asked += [(k, xs[int(rng.integers(0, len(xs)))], part, 0, i, -(-i * len(xs) // 20), xs) for i in range(1, 20)]
    both = sorted([(*at, w, None, None) for at, w in rows.items()] + [a[:6] for a in asked], key=lambda r: r[:2])
    cuts = [0, 100, 101, 400, len(both)]
    cuts = [next((j for j in range(c, len(both)) if c in (0, len(both)) or both[j][:2] != both[j - 1][:2]), len(both)) for c in cuts]
    told = []
    for task, (a, b) in enumerate(zip(cuts, cuts[1:])):
        monkeypatch.setattr(Q, "TaskContext", types.SimpleNamespace(get=lambda t=task: types.SimpleNamespace(partitionId=lambda: t)))
        told += gathered(Q.counted(["k"])(tables(both[a:b], ["k", "x", "part", "w", "i", "target"], [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()], 11)))
    totals = {(r["range"], r["k"], r["part"]): r["upto"] for r in told if r["kind"] == 3}
    assert len(totals) == sum(r["kind"] == 3 for r in told)
    before = {at: sum(n for (r, k, p), n in totals.items() if (k, p) == at[1:] and r < at[0]) for at in totals}
    for k, x, part, _, i, target, xs in asked:
        own = [r for r in told if (r["k"], r["part"]) == (k, part)]
        closed = [r for r in own if r["kind"] == 0 and r["i"] == i]
        below, upto = np.searchsorted(xs, x), np.searchsorted(xs, x, side="right")
        if closed:
            assert len(closed) == 1 and (closed[0]["x"], closed[0]["below"], closed[0]["upto"]) == (xs[target - 1], below, upto)
            continue
        (mark,) = [r for r in own if r["kind"] == 1 and r["i"] == i]
        base = before[mark["range"], k, part]
        assert (mark["below"] + base, mark["upto"] + base) == (below, upto)
        (hit,) = [r["x"] for r in own if r["kind"] == 2 and r["below"] + before[r["range"], k, part] < target <= r["upto"] + before[r["range"], k, part]]
        assert hit == xs[target - 1]


def brute(clicks, lines, items):
    value = {}
    for i, client, v in clicks:
        value[i if i is not None else object()] = (client, v)
    rows = [("value", None if c is None else str(c), i if isinstance(i, int) else None, v) for i, (c, v) in value.items()]
    rows += [("price", b, vendor, p) for item, vendor in lines for it, b, p in items if item is not None and it == item]
    groups = {}
    for stream, grp, i, money in rows:
        if grp is None or money is None or not math.isfinite(money) or abs(money) >= 9e16:
            continue
        batch = zlib.crc32(b"" if i is None else str(i).encode()) % 16
        x = math.floor(100 * money + 0.5) + 1000 * batch
        for part in (batch, -1):
            groups.setdefault((stream, grp, part), []).append(x)
    return {k: sorted(v) for k, v in groups.items() if len(v) >= 20}


def test_query(spark, tmp_path):
    rng = np.random.default_rng(3)
    clicks = [(i, None if i % 50 == 0 else int(rng.choice([7, 7, 8, int(rng.integers(0, 40))])), None if i % 41 == 0 else float(np.round(rng.normal(50, 30), 2))) for i in range(2500)]
    clicks += [clicks[5], clicks[6], (None, 7, 1.0), (None, 7, 1.0), (9000, 7, float("nan")), (9001, 7, float("inf")), (9002, 7, 1e300), (9003, -4, -0.005)]
    items = [(i, None if i == 3 else f"B{i % 3}", None if i == 4 else float(np.round(rng.gamma(2, 50), 2))) for i in range(60)]
    lines = [(None if j % 97 == 0 else int(rng.choice([1, 1, int(rng.integers(0, 70))])), None if j % 53 == 0 else int(rng.choice([2, 2, int(rng.integers(0, 30))]))) for j in range(3000)]
    spark.createDataFrame(clicks, "click_id long, client_id long, value double").selectExpr("*", "'clash' AS part", "'clash' AS w").repartition(5).write.parquet(f"{tmp_path}/clicks.parquet")
    spark.createDataFrame(lines, "item_id long, vendor_id long").selectExpr("*", "'clash' AS price", "'clash' AS grp").repartition(3).write.parquet(f"{tmp_path}/sale_lines.parquet")
    spark.createDataFrame(items, "item_id long, brand string, price double").write.parquet(f"{tmp_path}/items.parquet")
    found = {}
    for r in Q.query(spark, str(tmp_path)).collect():
        found.setdefault((r.stream, r.grp, r.batch), {})[r.i] = r
    want = brute(clicks, lines, items)
    assert found.keys() == want.keys() and len(want) > 20
    for at, xs in want.items():
        n, distinct, last = len(xs), len(set(xs)), None
        assert sorted(found[at]) == list(range(1, 20))
        for i, r in sorted(found[at].items()):
            target = -(-i * n // 20)
            below, upto = int(np.searchsorted(xs, r.answer)), int(np.searchsorted(xs, r.answer, side="right"))
            assert (r.n, r.target, r.exact_x, r.n_below, r.n_upto) == (n, target, xs[target - 1], below, upto)
            assert r.rank_error == max(0, below + 1 - target, target - upto) and r.within and min(20, distinct) <= r.points <= min(n, 2000)
            assert xs[0] <= r.answer <= xs[-1] and (last is None or last <= r.answer)
            last = r.answer


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "click_id long, client_id long, value double").write.parquet(f"{tmp_path}/clicks.parquet")
    spark.createDataFrame([], "item_id long, vendor_id long").write.parquet(f"{tmp_path}/sale_lines.parquet")
    spark.createDataFrame([], "item_id long, brand string, price double").write.parquet(f"{tmp_path}/items.parquet")
    assert Q.query(spark, str(tmp_path)).collect() == []


def test_summaries_of_any_rows(spark):
    """The operator itself: other keys, many tasks, a budget of its own."""
    rng = np.random.default_rng(9)
    rows = [(int(rng.choice([1, 1, 1, 2])), bool(rng.integers(0, 2)), int(rng.integers(0, 3)), int(x)) for x in rng.integers(0, 10**6, 20_000)]
    df = spark.createDataFrame(rows, "a int, b boolean, part int, x long").selectExpr("*", "1L AS w").repartition(20)
    df = Workspace(spark, "test").write(df, "rows")
    told = Q.summarise(df, ["a", "b"], Workspace(spark, "test"), parts=3, error=0.05).collect()
    assert len(told) == 2 * 2 * 4
    for r in told:
        xs = np.array([x for a, b, part, x in rows if (a, b) == (r.a, r.b) and r.part in (part, -1)])
        p = Q.unpack([r.summary])
        assert r.n == len(xs) and bounds_hold(p, xs) and len(p.x) < len(xs)
        target = np.arange(1, len(xs) + 1)
        answers, xs = p.x[Q.pick(p, np.zeros(len(xs), np.int64), target)], np.sort(xs)
        assert np.maximum(np.searchsorted(xs, answers) + 1 - target, target - np.searchsorted(xs, answers, side="right")).max() <= 0.0625 * len(xs)
