"""Mergeable quantile summaries: rank intervals combined and pruned in a balanced tree of sensors.

A summary of n rows is a list of points, its rows' values in order, each with
two bounds: ``lo`` rows at least are at most the point, ``hi`` rows at most are
below it. Every task is a sensor: what it holds of a group becomes a leaf with
exact bounds. Two summaries combine into one whose points are both's, with
bounds added to those of the neighbouring points of the other; this loses
nothing. A summary of more than ``size + 1`` points is pruned to those nearest
to evenly spaced ranks, which costs an error of ``1 / (2 * size)`` of its
rows. A tree of a given height prunes once a height, so ``size`` follows from
the error budget and the number of heights: the budget is split evenly.

How the tree lies over Spark: rows of a group that are ``FEW`` or less in a
task go on as they are and form one more leaf at the end; other leaves are
packed rows, at most ``size + 1`` points, that meet ``FAN`` to a task in rounds
until one a group and part is left. The last task of a group makes the leaf of
single rows, the summaries of its parts and from these alone, in pairs, the
whole. No task gets more of a group than ``FAN`` packed rows or a few rows of
every other task, and nothing reaches the driver but the number of tasks.

``ranked`` holds answers against all rows: one sort by range, running counts
in each range, and short tables of counts for groups that run on into other
ranges.

Edge cases: rows lacking a group, or with a value that is null, not finite or
beyond a long, take no part; a null part is a part like ``-2``; equal values
are one point; groups of one row are summaries of one point; an empty table
gives an empty result; columns that aren't named are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, bucket_of, read_table, shuffle_partitions

#: Error budget of a whole summary, as a share of its rows (a fifth of what is promised stays for rounding).
ERROR = 0.008
#: Points that any summary keeps at least, if it has as many.
LEAST = 20
#: Packed leaves a task combines; rows of a group in a task up to which they aren't packed; rows a leaf takes in.
FAN, FEW, LEAF = 16, 3, 1 << 16
#: Heights of the tree inside a task: a leaf of LEAF rows to 256 of them (a deeper one adds a share of the slack).
INSIDE = 8
WHOLE = -1


class Points:
    """Summaries of many groups in one: ``at`` tells where each group's points begin; groups are numbered from 0."""

    def __init__(self, at: np.ndarray, x: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.at, self.x, self.lo, self.hi = at, x, lo, hi

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    @property
    def rows(self) -> np.ndarray:
        """Rows of each group: the last point's lower bound."""
        return self.lo[self.at[1:] - 1]

    def keep(self, index: np.ndarray) -> Points:
        """The points of these (rising) indexes; every group keeps some."""
        return Points(np.searchsorted(index, self.at), self.x[index], self.lo[index], self.hi[index])


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted columns change, 0 first, their length last."""
    n = len(columns[0])
    changed = np.zeros(n, bool)
    changed[:1] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(changed), n)


def exact(group: np.ndarray, x: np.ndarray, w: np.ndarray) -> Points:
    """Leaves: of values with numbers of rows, by group (dense, rising); values may repeat in any order."""
    order = np.lexsort((x, group))
    group, x, w = group[order], x[order], w[order]
    cut = starts(group, x)
    w, group, x = np.add.reduceat(w, cut[:-1]) if len(w) else w, group[cut[:-1]], x[cut[:-1]]
    at = starts(group)
    run = np.cumsum(w)
    lo = run - np.repeat((run - w)[at[:-1]], np.diff(at))
    return Points(at, x, lo, lo - w)


def combine(p: Points, parent: np.ndarray, side: np.ndarray) -> Points:
    """Pairs of groups become one: group i goes to ``parent[i]`` (dense, rising) as its left (0) or right (1) half."""
    per = p.counts
    group, half = np.repeat(parent, per), np.repeat(side, per)
    order = np.lexsort((p.x, group))
    group, half, x, lo, hi = group[order], half[order], p.x[order], p.lo[order], p.hi[order]
    cut = starts(group, x)
    row = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    group, x = group[cut[:-1]], x[cut[:-1]]
    at = starts(group)
    first, last = np.repeat(at[:-1], np.diff(at)), np.repeat(at[1:], np.diff(at))
    n = np.zeros((2, len(at) - 1), np.int64)
    n[side, parent] = p.rows
    sums = [np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)]
    place = np.arange(len(x))
    for h in (0, 1):
        own = half == h
        mark = np.full(len(x), -1)
        mark[row[own]] = np.flatnonzero(own)  # the place of this half's point, where it has one
        before = np.maximum.accumulate(np.where(mark >= 0, place, -1))
        sums[0] += np.where(before >= first, lo[mark[before]], 0)
        after = np.minimum.accumulate(np.where(mark >= 0, place, len(x))[::-1])[::-1]
        sums[1] += np.where(after < last, hi[mark[np.minimum(after, len(x) - 1)]], n[h][group])
    return Points(at, x, *sums)


def pick(p: Points, group: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The point of a group whose bounds allow the least error at a rank (from 1), for rising groups; rises with the rank."""
    sums = p.lo + p.hi + 1
    wide = int(sums.max(initial=0)) + 2
    if wide * max(len(p.at), 1) >= 1 << 62:
        return np.concatenate([pick(Points(np.array([0, b - a]), p.x[a:b], p.lo[a:b], p.hi[a:b]), np.zeros(int((group == g).sum()), np.int64), target[group == g]) + a for g, (a, b) in enumerate(zip(p.at[:-1], p.at[1:])) if (group == g).any()])
    number = np.repeat(np.arange(len(p.at) - 1), p.counts)
    right = np.searchsorted(number * wide + sums, group * wide + np.minimum(2 * target, wide - 1))
    right = np.clip(right, p.at[group], p.at[group + 1] - 1)
    left = np.maximum(right - 1, p.at[group])
    worst = [np.maximum(np.maximum(p.hi[k] + 1 - target, target - p.lo[k]), 0) for k in (left, right)]
    return np.where(worst[0] <= worst[1], left, right)


def prune(p: Points, size: int) -> Points:
    """Groups of more than ``size + 1`` points keep those nearest to evenly spaced ranks, their ends among them.

    Free places (a heavy value is nearest to many ranks) go to points at even distances among the rest.
    """
    large = np.flatnonzero(p.counts > size + 1)
    if not len(large):
        return p
    keep = np.ones(len(p.x), bool)
    n = p.rows[large]
    ranks = 1 + np.round(np.arange(size + 1) * ((n - 1) / size)[:, None]).astype(np.int64)
    found = pick(p, np.repeat(large, size + 1), ranks.ravel()).reshape(len(large), size + 1)
    for g, near in zip(large, found):
        a, b = p.at[g], p.at[g + 1]
        keep[a:b] = False
        keep[near] = keep[a] = keep[b - 1] = True
        free = size + 1 - int(keep[a:b].sum())
        if free > 0:
            rest = a + np.flatnonzero(~keep[a:b])
            keep[rest[np.linspace(0, len(rest) - 1, min(free, len(rest))).astype(np.int64)]] = True
    return p.keep(np.flatnonzero(keep))


def tree(p: Points, key: np.ndarray, size: int) -> tuple[Points, np.ndarray]:
    """All groups of a key (rising, dense or not) in pairs, height by height, pruned at each; one group a key is left, with the keys."""
    while len(key) > 1 and (key[1:] == key[:-1]).any():
        cut = starts(key)
        place = np.arange(len(key)) - np.repeat(cut[:-1], np.diff(cut))
        top = starts(key, place >> 1)
        parent = np.repeat(np.arange(len(top) - 1), np.diff(top))
        p, key = prune(combine(p, parent, place & 1), size), key[top[:-1]]
    return p, key


def pack(p: Points) -> list[bytes]:
    """Each group's points: columns of differences, compressed from nine points on."""
    out = []
    for a, b in zip(p.at[:-1].tolist(), p.at[1:].tolist()):
        data = np.diff(np.stack([p.x[a:b], p.lo[a:b], p.hi[a:b]]), prepend=0, axis=1).astype("<i8").tobytes()
        out.append(b"\1" + zlib.compress(data, 1) if b - a > 8 else b"\0" + data)
    return out


def unpack(packed: list[bytes]) -> Points:
    parts = [np.cumsum(np.frombuffer(zlib.decompress(d[1:]) if d[0] else d[1:], "<i8").reshape(3, -1), axis=1) for d in packed]
    at = np.cumsum([0] + [c.shape[1] for c in parts], dtype=np.int64)
    return Points(at, *(np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), np.int64)))


def beside(p: Points, q: Points) -> Points:
    """The groups of both, the second's after the first's."""
    return Points(np.concatenate([p.at, p.at[-1] + q.at[1:]]), *(np.concatenate([getattr(p, c), getattr(q, c)]) for c in ("x", "lo", "hi")))


def changes(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Where sorted columns of a table change, 0 first, its length last."""
    changed = np.zeros(table.num_rows, bool)
    changed[:1] = True
    for c in columns:
        own = table.column(c).combine_chunks()
        own = own.chunk(0) if isinstance(own, pa.ChunkedArray) else own
        changed[1:] |= pc.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(changed), table.num_rows)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str], cut: int = 0, within: str = "") -> Iterator[tuple[pa.Table, bool]]:
    """Sorted rows in tables that end where a run of equal keys ends.

    A run of more than ``cut`` rows comes in pieces, each a table of its own
    and told by True: the run may go on. Rows of equal ``within`` stay together.
    """
    held, n, least = [], 0, LEAF
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = int(changes(table, keys)[-2])
        if last:
            yield table.slice(0, last), False
            held, n, least = table.slice(last).combine_chunks().to_batches(), n - last, LEAF
        elif cut and n >= cut and (end := int(changes(table, [*keys, within])[-2]) if within else n):
            yield table.slice(0, end), True
            held, n, least = table.slice(end).combine_chunks().to_batches(), n - end, LEAF
        else:
            held, least = table.to_batches(), 2 * n
    if n:
        yield pa.Table.from_batches(held).combine_chunks(), False


def longs(table: pa.Table, column: str) -> np.ndarray:
    return pc.fill_null(table.column(column), 0).to_numpy().astype(np.int64, copy=False)


def told(table: pa.Table, rows: np.ndarray, columns: list[str], **more: pa.Array) -> pa.RecordBatch:
    """Rows of a table's columns, with columns beside them."""
    own = [table.column(c).take(pa.array(rows)).combine_chunks() for c in columns]
    own = [c.chunk(0) if isinstance(c, pa.ChunkedArray) and c.num_chunks == 1 else (pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) and c.num_chunks else c) for c in own]
    own = [pa.array([], table.schema.field(name).type) if isinstance(c, pa.ChunkedArray) else c for name, c in zip(columns, own)]
    return pa.RecordBatch.from_arrays([*own, *more.values()], names=[*columns, *more])


def leaves(keys: list[str], size: int) -> Callable:
    """A task's rows, sorted by keys, part and x: single rows of small groups, packed leaves of others."""
    by = [*keys, "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId()
        open_: list[Points | None] = []  # the summaries of the run that goes on, by height
        before: pa.Table | None = None  # a row of that run

        def add(p: Points) -> None:
            for k, own in enumerate(open_):
                if own is None:
                    open_[k] = p
                    return
                open_[k], p = None, prune(combine(beside(own, p), np.zeros(2, np.int64), np.arange(2)), size)
            open_.append(p)

        def close() -> Iterator[pa.RecordBatch]:
            if before is not None:
                rest = [p for p in open_ if p is not None]
                p = rest[0]
                for q in rest[1:]:
                    p = prune(combine(beside(p, q), np.zeros(2, np.int64), np.arange(2)), size)
                yield told(before, np.zeros(1, np.int64), by, node=pa.array([node], pa.int32()), x=pa.array([None], pa.int64()), w=pa.array([None], pa.int64()), packed=pa.array(pack(p), pa.binary()))
                open_.clear()

        for table, more in whole_runs(batches, by, LEAF):
            cut = changes(table, by)
            p = prune(exact(np.repeat(np.arange(len(cut) - 1), np.diff(cut)), longs(table, "x"), longs(table, "w")), size)
            goes_on = before is not None and table.slice(0, 1).select(by).equals(before.select(by))
            if goes_on:  # the first run belongs to the one before
                add(p.keep(np.arange(p.at[1])) if len(p.at) == 2 else Points(p.at[:2], p.x[: p.at[1]], p.lo[: p.at[1]], p.hi[: p.at[1]]))
            if more:
                if not goes_on:
                    yield from close()
                    add(p)
                before = table.slice(0, 1)
                continue
            yield from close()
            before = None
            many = np.flatnonzero(p.counts > FEW)
            many = many[many > 0] if goes_on else many
            few = p.counts <= FEW
            few[:1] &= not goes_on
            own = np.flatnonzero(np.repeat(few, p.counts))
            group = np.repeat(np.arange(len(few)), p.counts)[own]
            none = pa.nulls(len(own), pa.int32()), pa.nulls(len(own), pa.binary())
            yield told(table, cut[group], by, node=none[0], x=pa.array(p.x[own]), w=pa.array(p.lo[own] - p.hi[own]), packed=none[1])
            packed = pack(Points(np.cumsum(np.append(0, p.counts[many])), *(c[np.repeat(np.isin(np.arange(len(few)), many), p.counts)] for c in (p.x, p.lo, p.hi))))
            yield told(table, cut[many], by, node=pa.array(np.full(len(many), node), pa.int32()), x=pa.nulls(len(many), pa.int64()), w=pa.nulls(len(many), pa.int64()), packed=pa.array(packed, pa.binary()))
        yield from close()

    return run


def merge(keys: list[str], size: int) -> Callable:
    """Packed summaries of a group and node, next to each other, become one."""
    by = [*keys, "part", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in whole_runs(batches, by):
            cut = changes(table, by)
            p, _ = tree(unpack(table.column("packed").to_pylist()), np.repeat(np.arange(len(cut) - 1), np.diff(cut)), size)
            yield told(table, cut[:-1], by, packed=pa.array(pack(p), pa.binary()))

    return run


def finish(keys: list[str], size: int, least: int) -> Callable:
    """All that is left of a group: its parts' summaries, and from these the whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in whole_runs(batches, keys):
            cut, top = changes(table, [*keys, "part"]), changes(table, keys)
            group = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
            single = table.column("packed").is_null().to_numpy()
            rows = np.flatnonzero(single)
            p, parent, side = Points(np.zeros(1, np.int64), *np.zeros((3, 0), np.int64)), np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(rows):
                own = table.take(pa.array(rows))
                has = np.unique(group[rows])
                p, parent, side = prune(exact(np.searchsorted(has, group[rows]), longs(own, "x"), longs(own, "w")), size), has, np.zeros(len(has), np.int64)
            rows = np.flatnonzero(~single)
            if len(rows):
                packed = unpack(table.column("packed").take(pa.array(rows)).to_pylist())
                p, parent, side = beside(p, packed), np.append(parent, group[rows]), np.append(side, np.ones(len(rows), np.int64))
            p = prune(combine(p, parent, side), size)
            whole, _ = tree(p, np.searchsorted(top, cut[:-1], side="right") - 1, size)
            for q, at, part in ((p, cut[:-1], None), (whole, top[:-1], WHOLE)):
                n = q.rows
                full = np.flatnonzero(n >= least)
                chosen = q.keep(np.flatnonzero(np.repeat(n >= least, q.counts))) if len(full) == len(n) else Points(np.cumsum(np.append(0, q.counts[full])), *(c[np.repeat(n >= least, q.counts)] for c in (q.x, q.lo, q.hi)))
                parts = table.column("part").take(pa.array(at[full])).combine_chunks() if part is None else pa.array(np.full(len(full), part), pa.int32())
                parts = pa.concat_arrays(parts.chunks) if isinstance(parts, pa.ChunkedArray) and parts.num_chunks else parts
                if len(full):
                    yield told(table, at[full], keys, part=parts, n=pa.array(n[full]), points=pa.array(chosen.counts), summary=pa.array(pack(chosen), pa.binary()))

    return run


def fields(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)


def summarise(rows: DataFrame, keys: list[str], work: Workspace, parts: int = 16, error: float = ERROR, least: int = 1) -> DataFrame:
    """Summaries ``keys, part, n, points, summary`` of rows ``keys, part, x, w`` (w rows of value x): one a part, and one of the whole (part -1).

    ``parts`` is how many parts a group may have (a height for every doubling).
    Summaries of fewer than ``least`` rows are merged into the whole, not told.
    """
    spark, by = rows.sparkSession, fields(rows, keys)
    tasks = (rows.select(F.spark_partition_id().alias("task")).agg(F.max("task")).first()[0] or 0) + 1
    rounds = math.ceil(math.log(tasks, FAN) - 1e-9)
    heights = 1 + INSIDE + math.ceil(math.log2(FAN)) * rounds + 1 + math.ceil(math.log2(max(parts, 2)))
    size = max(math.ceil(heights / (2 * error)), LEAST)
    found = rows.select(*keys, "part", "x", "w").sortWithinPartitions(*keys, "part", "x").mapInArrow(leaves(keys, size), f"{by}, part int, node int, x long, w long, packed binary")
    found = work.write(found, "leaves")
    packed = found.filter(F.col("node").isNotNull()).select(*keys, "part", "node", "packed")
    for _ in range(rounds):
        packed = packed.withColumn("node", (F.col("node") / FAN).cast("int"))
        packed = packed.repartition(shuffle_partitions(spark), *keys, "part", "node").sortWithinPartitions(*keys, "part", "node").mapInArrow(merge(keys, size), f"{by}, part int, node int, packed binary")
    none = F.lit(None).cast("long")
    rest = found.filter(F.col("node").isNull()).select(*keys, "part", "x", "w", "packed").unionByName(packed.select(*keys, "part", none.alias("x"), none.alias("w"), "packed"))
    return rest.repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "part", "x").mapInArrow(finish(keys, size, least), f"{by}, part int, n long, points long, summary binary")


def quantiles(summaries: DataFrame, keys: list[str], q: int) -> DataFrame:
    """``keys, part, n, points, i, target, answer`` for i in 1..q-1: each summary's estimate of its row of rank ceil(i * n / q)."""
    columns = [*keys, "part", "n", "points"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            p = unpack(table.column("summary").to_pylist())
            i = np.tile(np.arange(1, q), table.num_rows)
            group = np.repeat(np.arange(table.num_rows), q - 1)
            target = -(-i * longs(table, "n")[group] // q)
            yield told(table, group, columns, i=pa.array(i, pa.int32()), target=pa.array(target), answer=pa.array(p.x[pick(p, group, target)]))

    return summaries.select(*columns, "summary").mapInArrow(run, f"{fields(summaries, columns)}, i int, target long, answer long")


def counted(keys: list[str]) -> Callable:
    """Running counts in one range of rows sorted by keys and x; rows with w = 0 ask.

    kind 0: a question of a group that lies in this range alone, answered; 1: a question of another group, 2: a
    value of such a group, 3: its number of rows here. A group is taken for one of these if it is the range's first or last,
    or too long to be held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        carry: dict[int, int] = {}  # of the run that goes on: rows so far by part
        last_key: pa.Table | None = None
        first = True

        def tell(table, rows, part, kind, i, x, below, upto):
            n = len(rows)
            return told(table, rows, keys, part=pa.array(part, pa.int32()), range=pa.array(np.full(n, here), pa.int32()), kind=pa.array(np.full(n, kind), pa.int32()), i=pa.array(i, pa.int32()) if i is not None else pa.nulls(n, pa.int32()), x=pa.array(x, pa.int64()), below=pa.array(below, pa.int64()), upto=pa.array(upto, pa.int64()))

        def work_on(table: pa.Table, more: bool, final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal carry, last_key, first
            top = changes(table, keys)
            groups = len(top) - 1
            group = np.repeat(np.arange(groups), np.diff(top))
            part, x, w = longs(table, "part"), longs(table, "x"), longs(table, "w")
            asks = w == 0
            goes_on = last_key is not None and table.slice(0, 1).select(keys).equals(last_key.select(keys))
            if last_key is not None and not goes_on:
                at = np.zeros(len(carry), np.int64)
                yield tell(last_key, at, list(carry), 3, None, at, at, list(carry.values()))
                carry = {}
            runs_on = np.zeros(groups, bool)  # groups that may go on beyond this range
            runs_on[0] = first or goes_on or more
            runs_on[-1] |= final or more
            first = False
            # rows once more as the whole: a part of their own; questions belong to one part only
            rows = np.concatenate([np.arange(len(x)), np.flatnonzero(~asks)])
            level = np.concatenate([part, np.full(len(rows) - len(x), WHOLE)])
            order = np.lexsort((x[rows], level, group[rows]))
            rows, level = rows[order], level[order]
            g, v, m = group[rows], x[rows], w[rows]
            run_at = starts(g, level)
            tie_at = starts(g, level, v)
            total = np.cumsum(m)
            base = np.repeat((total - m)[run_at[:-1]], np.diff(run_at))
            if goes_on:
                base = base - np.where(g == 0, np.array([carry.get(k, 0) for k in np.unique(level)])[np.searchsorted(np.unique(level), level)], 0)
            tie = np.repeat(np.arange(len(tie_at) - 1), np.diff(tie_at))
            below, upto = ((total - m)[tie_at[:-1]] - base[tie_at[:-1]]), (total[tie_at[1:] - 1] - base[tie_at[:-1]])
            asked = np.flatnonzero(m == 0)
            closed = asked[~runs_on[g[asked]]]
            if len(closed):
                run_of = np.repeat(np.arange(len(run_at) - 1), np.diff(run_at))
                wide = int(total[-1]) + 2
                target = longs(table, "target")[rows[closed]]
                found = np.searchsorted(run_of[tie_at[:-1]] * wide + upto, run_of[closed] * wide + target)
                yield tell(table, rows[closed], level[closed], 0, longs(table, "i")[rows[closed]], v[tie_at[found]], below[tie[closed]], upto[tie[closed]])
            others = asked[runs_on[g[asked]]]
            if len(others):
                yield tell(table, rows[others], level[others], 1, longs(table, "i")[rows[others]], v[others], below[tie[others]], upto[tie[others]])
            values = np.flatnonzero(runs_on[g[tie_at[:-1]]] & (upto > below))
            yield tell(table, rows[tie_at[values]], level[tie_at[values]], 2, None, v[tie_at[values]], below[values], upto[values])
            run_end = run_at[1:] - 1
            ends = {int(k): int(total[e] - base[e]) for k, e in zip(level[run_end], run_end) if g[e] == groups - 1 and runs_on[-1]}
            if groups > 1 and runs_on[0]:
                own = run_end[g[run_end] == 0]
                head = {**(carry if goes_on else {}), **{int(k): int(total[e] - base[e]) for k, e in zip(level[own], own)}}
                at = np.zeros(len(head), np.int64)
                yield tell(table, at, list(head), 3, None, at, at, list(head.values()))
            if runs_on[-1]:
                carry = {**(carry if goes_on and groups == 1 else {}), **ends}
                last_key = table.slice(int(top[-2]), 1)
            else:
                carry, last_key = {}, None

        held = None
        for piece in whole_runs(batches, keys, 4 * LEAF, "x"):
            if held:
                yield from work_on(*held, False)
            held = piece
        if held:
            yield from work_on(*held, True)
        if last_key is not None:
            at = np.zeros(len(carry), np.int64)
            yield tell(last_key, at, list(carry), 3, None, at, at, list(carry.values()))

    return run


def ranked(rows: DataFrame, asked: DataFrame, keys: list[str], q: int, work: Workspace) -> DataFrame:
    """``asked`` (of ``quantiles``) with ``exact_x``, the row of its rank, and ``n_below``, ``n_upto``, the rows below and up to its answer.

    ``rows`` has no two rows of equal keys, part and x.
    """
    spark = rows.sparkSession
    none = F.lit(None)
    marks = asked.select(*keys, F.col("answer").alias("x"), "part", F.lit(0).cast("long").alias("w"), "i", "target")
    both = rows.select(*keys, "x", "part", "w", none.cast("int").alias("i"), none.cast("long").alias("target")).unionByName(marks)
    both = both.repartitionByRange(shuffle_partitions(spark), *keys, "x").sortWithinPartitions(*keys, "x")
    told_ = work.write(both.mapInArrow(counted(keys), f"{fields(rows, keys)}, part int, range int, kind int, i int, x long, below long, upto long"), "ranges")
    of = [*keys, "part"]
    before = Window.partitionBy(*of).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = told_.filter("kind = 3").select("range", *of, F.coalesce(F.sum("upto").over(before), F.lit(0)).alias("before"), F.sum("upto").over(Window.partitionBy(*of)).alias("n"))
    open_ = told_.filter("kind in (1, 2)").join(totals, ["range", *of]).withColumns({"below": F.col("below") + F.col("before"), "upto": F.col("upto") + F.col("before")})
    nothing = none.cast("long")
    marked = open_.filter("kind = 1").select(*of, "i", nothing.alias("exact_x"), F.col("below").alias("n_below"), F.col("upto").alias("n_upto"))
    # ceil(i * n / q) lies above `below` and not above `upto`: a value is the row of these ranks
    low, high = F.expr(f"below * {q} div n") + 1, F.least(F.expr(f"upto * {q} div n"), F.lit(q - 1).cast("long"))
    values = open_.filter(f"kind = 2 and n >= {q}").withColumns({"low": low, "high": high}).filter("low <= high")
    values = values.select(*of, F.explode(F.sequence(F.col("low").cast("int"), F.col("high").cast("int"))).alias("i"), F.col("x").alias("exact_x"), nothing.alias("n_below"), nothing.alias("n_upto"))
    done = told_.filter("kind = 0").select(*of, "i", F.col("x").alias("exact_x"), F.col("below").alias("n_below"), F.col("upto").alias("n_upto"))
    own = [c for c in asked.columns if c not in (*of, "i")]
    sides = done.unionByName(marked).unionByName(values).unionByName(asked, allowMissingColumns=True)
    return sides.groupBy(*of, "i").agg(*[F.max(c).alias(c) for c in (*own, "exact_x", "n_below", "n_upto")]).filter(F.col("answer").isNotNull())


def cents(money: str, batch: Column) -> Column:
    """``floor(100 * money + 0.5) + 1000 * batch`` as a long; null where money is null, not finite or too large for it."""
    fits = (F.abs(F.col(money)) < 9e16) & ~F.isnan(money)
    return F.when(fits, F.floor(100 * F.when(fits, F.col(money)) + 0.5).cast("long") + 1000 * batch)


def streams(spark, sf_dir: str) -> DataFrame:
    """Rows ``stream, grp, part, x, w`` of both streams, equal ones added up.

    Rows of one click_id are one row, of the largest value of each column (rows without a click_id are rows of their own). Lines are
    added up by item before they meet the items, so a frequent item is a few rows there.
    """
    batch = bucket_of("id", 16).cast("int")
    clicks = read_table(spark, sf_dir, "clicks").select(F.col("click_id").alias("id"), "client_id", "value")
    known = clicks.filter("id is not null").groupBy("id").agg(F.max("client_id").alias("client_id"), F.max("value").alias("value"))
    value = known.unionByName(clicks.filter("id is null")).select(F.lit("value").alias("stream"), F.col("client_id").cast("string").alias("grp"), batch.alias("part"), cents("value", batch).alias("x"), F.lit(1).cast("long").alias("w"))
    lines = read_table(spark, sf_dir, "sale_lines").filter("item_id is not null").select("item_id", F.col("vendor_id").alias("id"))
    lines = lines.groupBy("item_id", batch.alias("part")).agg(F.count(F.lit(1)).alias("w"))
    items = read_table(spark, sf_dir, "items").filter("brand is not null and price is not null").select("item_id", F.col("brand").alias("grp"), "price")
    price = lines.join(items, "item_id").select(F.lit("price").alias("stream"), "grp", "part", cents("price", F.col("part")).alias("x"), "w")
    rows = value.unionByName(price).filter("grp is not null and x is not null")
    return rows.groupBy("stream", "grp", "part", "x").agg(F.sum("w").alias("w"))


def query(spark, sf_dir):
    """op12: summaries of every batch and, merged from these, of the whole, at nineteen ranks each, held against all rows."""
    work, keys, q = Workspace(spark, "op12"), ["stream", "grp"], 20
    rows = work.write(streams(spark, sf_dir), "rows")
    asked = work.write(quantiles(summarise(rows, keys, work, parts=16, least=q), keys, q), "asked")
    found = ranked(rows, asked, keys, q, work)
    error = F.greatest(F.lit(0).cast("long"), F.col("n_below") + 1 - F.col("target"), F.col("target") - F.col("n_upto"))
    told_ = found.select("stream", "grp", F.col("part").alias("batch"), "i", "n", "target", "exact_x", "points", "answer", "n_below", "n_upto", error.alias("rank_error"))
    return told_.withColumn("within", 1000 * F.col("rank_error") <= 10 * F.col("n"))
