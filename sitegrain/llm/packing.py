"""Packing documents into training windows of several lengths.

Lengths are powers of two from ``TIERS``. A document's whole windows of the
longest tier are cut off as they come; its tail goes to the shortest tier that
holds it. Tiers are packed from the longest: a tail opens a window of its
tier, the gap is filled with the largest shorter tails that fit, and what then
remains is filled by cutting one more tail, so every window is exactly full.
What is too little for a window of its tier goes down the tiers; less than the
shortest tier is left of a partition, and these ends are packed together in
rounds: the ends of ``FAN`` partitions in a task, what they leave in the next
round, until one task is left. Only the very last window is padded.

Windows of a tier are dealt into step groups of equal token counts, so that
the groups of a round have about the same attention cost (the sum of squared
piece lengths).

Edge cases: a null or empty text is its end id alone; rows that repeat a
doc_id are separate documents; an empty table gives an empty result; extra
columns are ignored; a text longer than a window is cut into many.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, raw, read_table
from .tokens import END, default_path, encoder

TIERS = (512, 1024, 2048, 4096)
#: Ids gathered before tails are packed.
POOL = 1 << 20
#: Ids in an output batch.
BATCH = 1 << 20
#: Tokens of a step group, and groups dealt at once.
GROUP, ROUND = 32 * 4096, 8
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long, step_group long, ids binary"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: Partitions whose ends one task of a round packs.
FAN = 1024
#: sequence_id and step_group: the partition in the upper part, above it the round.
SHIFT, ROUND_SHIFT = 28, 56


class Piece:
    """Part of a document: its id, its tokens, where the piece begins, the piece's ids."""

    __slots__ = ("doc", "total", "start", "ids")

    def __init__(self, doc, total, start, ids):
        self.doc, self.total, self.start, self.ids = doc, total, start, ids

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.total, self.start, self.ids[:n]), Piece(self.doc, self.total, self.start + n, self.ids[n:])


class Packer:
    """Takes documents in order, gives full windows: lists of pieces whose lengths sum to a tier."""

    def __init__(self, tiers=TIERS):
        self.tiers, self.sizes, self.tails, self.held = tiers, [], [], 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        long = self.tiers[-1]
        while len(piece.ids) >= long:
            head, piece = piece.cut(long)
            yield [head]
        if len(piece.ids):
            self.put(piece)
        if self.held >= POOL:
            yield from self.pack()

    def put(self, piece: Piece) -> None:
        k = bisect.bisect_right(self.sizes, len(piece.ids))
        self.sizes.insert(k, len(piece.ids))
        self.tails.insert(k, piece)
        self.held += len(piece.ids)

    def pop(self, k: int) -> Piece:
        self.held -= self.sizes.pop(k)
        return self.tails.pop(k)

    def pack(self, last: bool = False) -> Iterator[list[Piece]]:
        """Windows of the longest tails first; while more may come, stops short of a window's worth."""
        least = self.tiers[0] if last else self.tiers[-1]
        while self.held >= least:
            longest = self.sizes[-1]
            tier = next(t for t in self.tiers if t >= longest)
            while tier > self.held:  # the end of the partition: what is left goes down the tiers
                tier = self.tiers[self.tiers.index(tier) - 1]
            window, gap = [], tier
            while gap:
                k = bisect.bisect_right(self.sizes, gap) - 1
                if k >= 0:
                    window.append(self.pop(k))
                else:
                    head, rest = self.pop(0).cut(gap)
                    window.append(head)
                    self.put(rest)
                gap -= len(window[-1].ids)
            yield window

    def rest(self) -> list[Piece]:
        return self.tails


class Dealer:
    """Numbers windows, deals them into step groups, and makes rows."""

    def __init__(self, part: int, with_ids: bool, turn: int = 0):
        self.base, self.with_ids, self.windows, self.groups, self.waiting, self.out = (turn << ROUND_SHIFT) + (part << SHIFT), with_ids, 0, 0, {}, []

    def take(self, window: list[Piece], size: int) -> None:
        own = self.waiting.setdefault(size, [])
        rows, offset = [], 0
        for p in window:
            data = p.ids.astype("<u4").tobytes()
            rows.append([p.doc, p.start, len(p.ids), zlib.crc32(data), p.total, self.base + self.windows, offset, size, None, data if self.with_ids else None])
            offset += len(p.ids)
        self.windows += 1
        own.append((sum(len(p.ids) ** 2 for p in window), rows))
        if len(own) >= ROUND * max(1, GROUP // size):
            self.deal(size)

    def deal(self, size: int) -> None:
        own = sorted(self.waiting.pop(size, []), key=lambda x: -x[0])
        n = -(-len(own) // max(1, GROUP // size))
        for k, (_, rows) in enumerate(own):
            turn, seat = divmod(k, n)  # to and fro, the costliest first
            group = self.base + self.groups + (seat if turn % 2 == 0 else n - 1 - seat)
            for r in rows:
                r[8] = group
                self.out.append(r)
        self.groups += n

    def flush(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if last:
            for size in sorted(self.waiting):
                self.deal(size)
        if self.out and (last or len(self.out) >= 5000 or self.with_ids and sum(r[2] for r in self.out) >= BATCH):
            kinds = [pa.int64()] * 9 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*self.out), kinds)], names=NAMES)
            self.out = []


def pack(docs: DataFrame, tokenizer: str, end: int = END, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step_group`` and the ids.

    No shuffle of texts: each partition packs what it reads, in pools of a
    bounded number of ids. Only ends shorter than the shortest tier, one a
    partition, go on to the rounds; a task of a round gets at most ``FAN`` of them.
    """
    work = Workspace(docs.sparkSession, "pack")

    def packed(turn: int, pieces_of, last: bool):
        """Packs a task's pieces; what is left is padded in the last round, else told without a sequence, ``window`` naming the task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            packer, dealer = Packer(), Dealer(part, with_ids, turn)
            for batch in batches:
                for piece in pieces_of(batch):
                    for window in packer.add(piece):
                        dealer.take(window, sum(len(p.ids) for p in window))
                    yield from dealer.flush()
            for window in packer.pack(last=True):
                dealer.take(window, sum(len(p.ids) for p in window))
            rest = packer.rest()
            if rest and last:
                dealer.take(rest, TIERS[-1])
            yield from dealer.flush(last=True)
            if rest and not last:
                whole, none = (lambda v: pa.array(v, pa.int64())), pa.nulls(len(rest), pa.int64())
                yield pa.RecordBatch.from_arrays([whole([p.doc for p in rest]), whole([p.start for p in rest]), whole([len(p.ids) for p in rest]), none, whole([p.total for p in rest]), none, none, whole([part] * len(rest)), none, pa.array([p.ids.astype("<u4").tobytes() for p in rest], pa.binary())], names=NAMES)

        return run

    def texts(batch: pa.RecordBatch) -> Iterator[Piece]:
        enc = encoder(tokenizer)
        mark = np.array([end], enc.dtype).tobytes()
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.frombuffer(enc.ids(text.as_py()) + mark, enc.dtype)
            yield Piece(key, len(ids), 0, ids)

    def ends(batch: pa.RecordBatch) -> Iterator[Piece]:
        for doc, start, total, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
            yield Piece(doc, total, start, np.frombuffer(data, "<u4"))

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), raw(F.col(f"`{text_col}`")).alias("text"))
    done, turn = work.write(rows.mapInArrow(packed(0, texts, False), SCHEMA), "pieces0"), 0
    out = done.filter("sequence_id IS NOT NULL")
    while True:
        left = done.filter("sequence_id IS NULL")
        tasks = -(-((left.agg(F.max("window")).first()[0] or 0) + 1) // FAN)
        turn += 1
        # fewer than 512 ids a task of the round before, in a few rows; FAN of those tasks in a row are one task now
        own = left.select("doc_id", "start", "doc_tokens", "ids", "window", F.expr(f"cast(window div {FAN} as int)").alias("task"))
        dealt = own.repartition(1) if tasks == 1 else own.repartitionByRange(tasks, "task")
        dealt = dealt.sortWithinPartitions("task", "window", "doc_id", "start", F.crc32("ids")).drop("window", "task")
        done = work.write(dealt.mapInArrow(packed(turn, ends, tasks == 1), SCHEMA), f"pieces{turn}")
        out = out.unionByName(done.filter("sequence_id IS NOT NULL"))
        if tasks == 1:
            return out


def query(spark, sf_dir, tokenizer: str | None = None):
    """op4: every document's pieces in windows of at most 4096 ids."""
    return pack(read_table(spark, sf_dir, "documents"), tokenizer or default_path(), with_ids=False).drop("ids")
