"""A log-bilinear language model, learnt by noise-contrastive estimation from the whole corpus.

Words are spread over ``UNITS`` output units: the end of a text, the ``OWN``
most frequent words, and classes of all others by their last two bytes. A
context's vector is the sum of its ``CONTEXT`` units' vectors, each scaled by
its place; its product with a unit's vector, plus the unit's bias, is the
unit's score. Training tells a text's units from ``NOISE`` units drawn from
the units' frequencies, which needs no normalisation; every task trains on its
texts from the same parameters in numpy, the results are averaged by numbers
of tokens, and that ``ROUNDS`` times. For scoring, batched matrix products
give the normaliser of every context of two units, so a token's probability
is exact: its unit's softmax, times its share of the unit (counts plus a half;
a half is left for one unknown word a class), which sums to one over all
words.

Counts of all words come from all texts that are learnt from, added up in the
tasks before they are dealt. Frequent words (``TOP`` at most, by count) are
sent to the tasks with their counts; other words meet their counts in a join
by word, once a document and word.

Edge cases: null and empty texts are an end alone; rows that repeat an id, or
have none, are documents of their own; without a text to learn from all
counts are 0 and the model is uniform over the units; an empty table gives an
empty result; other columns are ignored. Training depends on how the texts
are dealt over tasks, counts and the base score don't.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, bucket_of, raw, read_table, shuffle_partitions

OWN, CLASSES = 767, 256
UNITS = 1 + OWN + CLASSES
#: Frequent words that tasks know with their counts, at most; the codes of other words' classes come after them.
TOP, RARE = 60_000, 65_536 - CLASSES
WIDTH, CONTEXT, NOISE = 16, 2, 16
ROUNDS, STEP, RATE = 2, 1024, 0.2
#: Different words counted in a task before they are handed on; tokens trained on at once.
HELD, BUFFER = 1 << 20, 1 << 20
#: Slices a parameter vector is averaged in.
SLICES = 16
SEED = 11
#: Logarithms are added up as whole numbers of this size, so that sums don't depend on their order.
NANO = 10**9


@dataclass
class Vocabulary:
    """Counts of the texts learnt from. ``top``: frequent words, most frequent first; ``counts``: theirs, with the end's in front."""

    top: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int
    class_tokens: np.ndarray  # of words without a unit of their own
    class_words: np.ndarray

    @property
    def units(self) -> np.ndarray:
        """Tokens of each unit."""
        own = np.zeros(1 + OWN)
        own[: len(self.counts)] = self.counts[: 1 + OWN]
        return np.concatenate([own, self.class_tokens])

    @property
    def unit_of(self) -> np.ndarray:
        """The unit of every code."""
        out = np.zeros(1 << 16, np.uint16)
        out[1 : 1 + min(OWN, len(self.top))] = np.arange(1, 1 + min(OWN, len(self.top)))
        for k, word in enumerate(self.top[OWN:], 1 + OWN):
            out[k] = 1 + OWN + class_of(word)
        out[RARE:] = 1 + OWN + np.arange(CLASSES)
        return out


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def words_of(data: bytes) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space: exactly the characters that ``bytes.split`` cuts at."""
    return data.lower().split()


def count(texts: DataFrame) -> DataFrame:
    """``word, c`` of a column of bytes; the word null stands for the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends = Counter(), 0

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])
            held.clear()
            return out

        for batch in batches:
            ends += batch.num_rows
            for data in batch.column(0).to_pylist():
                held.update(words_of(data))
                if len(held) >= HELD:
                    yield told()
        yield told()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([ends], pa.int64())], names=["word", "c"])

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """What the driver needs of all counts, all of fixed size, and the bucket of counts from which on words are in ``top``."""
    words = counts.filter("word is not null")
    levels = words.groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()  # at most some thousand, by logarithm
    least, held = 1 << 30, 0
    for level, n in levels:
        if held + n > TOP:
            break
        least, held = level, held + n
    top = sorted(((-r.c, bytes(r.word)) for r in words.filter(F.col("level") >= least).select("word", "c").collect()))
    ends = counts.filter("word is null").agg(F.sum("c")).first()[0] or 0
    class_tokens, class_words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for k, c, n in words.groupBy("class").agg(F.sum("c"), F.count(F.lit(1))).collect():
        class_tokens[k], class_words[k] = c, n
    tokens, distinct = int(class_tokens.sum()) + ends, int(class_words.sum()) + (ends > 0)
    for c, word in top[:OWN]:
        class_tokens[class_of(word)] += c
        class_words[class_of(word)] -= 1
    return Vocabulary([w for _, w in top], np.array([ends] + [-c for c, _ in top], np.int64), tokens, distinct, class_tokens, class_words), least


def coded(docs: DataFrame, vocab: Vocabulary, id_col: str, text_col: str, learn: Column) -> DataFrame:
    """``row, doc_id, learn, codes`` (16 bits a token, the end's last) and the words that aren't in ``top`` with their numbers: ``rare, times``."""
    top = vocab.top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare: list[bytes] = []

        class Codes(dict):
            def __missing__(self, word: bytes) -> int:
                rare.append(word)
                return RARE + class_of(word)

        of = Codes(zip(top, range(1, 1 + len(top)))).__getitem__
        for batch in batches:
            codes, words, times = [], [], []
            for data in batch.column(3).to_pylist():
                rare.clear()
                own = words_of(data)
                codes.append(np.array([*map(of, own), 0], np.uint16).tobytes())
                found = Counter(rare)
                words.append(list(found))
                times.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes, pa.binary()), pa.array(words, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int32()))], names=["row", "doc_id", "learn", "codes", "rare", "times"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), learn.alias("learn"), raw(F.col(f"`{text_col}`")).alias("data"))
    return rows.mapInArrow(run, "row long, doc_id long, learn boolean, codes binary, rare array<binary>, times array<int>")


class Parameters:
    """Vectors of contexts' units, vectors and biases (the last column) of outputs, scales of places: one flat vector."""

    SHAPES = ((UNITS, WIDTH), (UNITS, WIDTH + 1), (CONTEXT, WIDTH))

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        views = []
        for shape in self.SHAPES:
            n = int(np.prod(shape))
            views.append(flat[at : at + n].reshape(shape))
            at += n
        self.inner, self.outer, self.scale = views

    @classmethod
    def first(cls, frequency: np.ndarray) -> Parameters:
        """Small random vectors; biases are the units' log frequencies, so learning begins at those."""
        rng = np.random.default_rng(SEED)
        p = cls(rng.normal(0, 0.1, sum(int(np.prod(s)) for s in cls.SHAPES)).astype(np.float32))
        p.outer[:, WIDTH], p.scale[:] = np.log(frequency), 1
        return p


def scattered(index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows added up by unit: a table of all units."""
    order = np.argsort(index, kind="stable")
    index = index.take(order)
    cut = np.concatenate([[0], np.flatnonzero(index[1:] != index[:-1]) + 1])
    out = np.zeros((UNITS, rows.shape[1]), np.float32)
    out[index.take(cut)] = np.add.reduceat(rows.take(order, axis=0), cut, axis=0)
    return out


class Trainer:
    """Noise-contrastive steps over a run of units, with a step size of its own for every parameter (AdaGrad)."""

    def __init__(self, p: Parameters, frequency: np.ndarray, seed: int):
        self.p, self.tokens, self.rng = p, 0, np.random.default_rng((SEED, seed))
        self.log_noise, self.upto = np.log(NOISE * frequency).astype(np.float32), np.cumsum(frequency)
        self.squares = Parameters(np.full(p.flat.shape, 1e-2, np.float32))

    def move(self, name: str, gradient: np.ndarray, rate: float = RATE) -> None:
        squares, values = getattr(self.squares, name), getattr(self.p, name)
        squares += gradient * gradient
        values += rate * gradient / np.sqrt(squares)

    def step(self, units: np.ndarray, counts: np.ndarray) -> None:
        """``units``: CONTEXT units of context, then the targets; ``counts``: 1 for targets, 0 for padding."""
        p, n = self.p, len(counts)
        target, total = units[CONTEXT:], max(float(counts.sum()), 1.0)
        before = [p.inner.take(units[CONTEXT - k : CONTEXT - k + n], axis=0) for k in range(1, CONTEXT + 1)]
        context = np.ones((n, WIDTH + 1), np.float32)
        context[:, :WIDTH] = sum(scale * rows for scale, rows in zip(p.scale, before))
        noise = np.minimum(np.searchsorted(self.upto, self.rng.random(NOISE)), UNITS - 1)
        mine, other = p.outer.take(target, axis=0), p.outer[noise]
        # how far the model is from telling each target, and each noise unit, apart
        up = counts / (1 + np.exp(np.minimum(np.einsum("ij,ij->i", context, mine) - self.log_noise.take(target), 60)))
        down = context @ other.T - self.log_noise[noise]
        down = counts[:, None] / (1 + np.exp(np.minimum(-down, 60)))
        back = (up[:, None] * mine - down @ other)[:, :WIDTH]
        outer = scattered(target, up[:, None] * context)
        np.subtract.at(outer, noise, down.T @ context)
        scale = np.stack([np.einsum("ij,ij->j", back, rows) for rows in before]) / total
        inner = np.zeros((n + CONTEXT, WIDTH), np.float32)  # a unit is context of as many targets as there are places
        for k in range(1, CONTEXT + 1):
            inner[CONTEXT - k : CONTEXT - k + n] += p.scale[k - 1] * back
        self.move("outer", outer / total)
        self.move("inner", scattered(units, inner) / total)
        self.move("scale", scale, RATE / 4)
        self.tokens += int(counts.sum())

    def run(self, texts: list[np.ndarray]) -> None:
        """Texts' units, each with its end, in steps; every text begins after ends only."""
        pad = np.zeros(CONTEXT - 1, np.uint16)
        units = np.concatenate([np.zeros(1, np.uint16), *[x for text in texts for x in (pad, text)]])
        counts = np.concatenate([x for text in texts for x in (np.zeros(CONTEXT - 1, np.float32), np.ones(len(text), np.float32))])[CONTEXT - 1 :]
        for at in range(0, len(counts), STEP):
            self.step(units[at : at + STEP + CONTEXT], counts[at : at + STEP])


def train(table: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Parameters:
    """Every task trains on its texts, the average goes into the next round."""
    unit_of, frequency = vocab.unit_of, vocab.units + 0.5
    frequency = frequency / frequency.sum()
    p = Parameters.first(frequency)
    texts = table.filter("learn").select("codes")
    for turn in range(rounds):
        flat = p.flat.copy()

        def run(batches: Iterator[pa.RecordBatch], flat=flat, turn=turn) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(Parameters(flat.copy()), frequency, turn * 1_000_003 + TaskContext.get().partitionId())
            held, n = [], 0
            for batch in batches:
                for data in batch.column(0):
                    own = unit_of.take(np.frombuffer(data.as_buffer(), np.uint16))
                    held.append(own)
                    n += len(own)
                    if n >= BUFFER:
                        trainer.run(held)
                        held, n = [], 0
            if held:
                trainer.run(held)
            if trainer.tokens:
                parts = np.array_split(trainer.p.flat, SLICES)
                yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([float(trainer.tokens)] * SLICES, pa.float64()), pa.array([(x.astype(np.float64) * trainer.tokens).tobytes() for x in parts], pa.binary())], names=["slice", "weight", "sums"])

        told = added_up(texts.mapInArrow(run, "slice int, weight double, sums binary"))
        rows = {r.slice: np.frombuffer(r.sums) / r.weight for r in told.collect()}  # SLICES rows of fixed size
        if len(rows) == SLICES:
            p = Parameters(np.concatenate([rows[k] for k in range(SLICES)]).astype(np.float32))
    return p


def added_up(parts: DataFrame) -> DataFrame:
    """Slices' sums over all tasks, in two steps; a task holds one sum a slice, however many it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for k, weight, sums in zip(*[c.to_pylist() for c in batch.columns]):
                own = held.setdefault(k, [0.0, 0.0])
                own[0] += weight
                own[1] = own[1] + np.frombuffer(sums)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([w for w, _ in held.values()], pa.float64()), pa.array([s.tobytes() for _, s in held.values()], pa.binary())], names=["slice", "weight", "sums"])

    schema = "slice int, weight double, sums binary"
    first = parts.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(shuffle_partitions(parts.sparkSession)))).repartition("slot").select("slice", "weight", "sums").mapInArrow(run, schema)
    return first.repartition(SLICES, "slice").mapInArrow(run, schema)


def normalisers(spark, p: Parameters) -> np.ndarray:
    """Log normalisers of all contexts of two units, last unit first: batched matrix products over Spark's tasks."""
    flat = p.flat.copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Parameters(flat)
        bias = own.outer[:, WIDTH].astype(np.float64)
        earlier = own.scale[1] * own.inner
        for batch in batches:
            out = []
            for last in batch.column(0).to_pylist():
                scores = (earlier + own.scale[0] * own.inner[last]) @ own.outer[:, :WIDTH].T + bias
                most = scores.max(axis=1)
                out.append((np.log(np.exp(scores - most[:, None]).sum(axis=1)) + most).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["last", "z"])

    rows = spark.range(UNITS).repartition(min(UNITS, 16)).mapInArrow(run, "last long, z binary").collect()
    return np.stack([np.frombuffer(r.z, np.float32) for r in sorted(rows, key=lambda r: r.last)])


@dataclass
class Scorer:
    """Log probabilities (natural) of units after two units, by tables; shares of words in their units."""

    p: Parameters
    z: np.ndarray

    def __post_init__(self) -> None:
        outer = self.p.outer[:, :WIDTH].T
        self.by_last = ((self.p.scale[0] * self.p.inner) @ outer + self.p.outer[:, WIDTH]).ravel()
        self.by_earlier = ((self.p.scale[1] * self.p.inner) @ outer).ravel()
        self.flat_z = self.z.ravel()

    def units(self, units: np.ndarray, last: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        units, last, earlier = (x.astype(np.int64) for x in (units, last, earlier))
        return self.by_last.take(last * UNITS + units).astype(np.float64) + self.by_earlier.take(earlier * UNITS + units) - self.flat_z.take(last * UNITS + earlier)


def scored(table: DataFrame, vocab: Vocabulary, scorer: Scorer) -> DataFrame:
    """``row, doc_id, learn, n_tokens, known, top, model`` of coded texts: all but the counts of rare words.

    ``known``: tokens of frequent words and ends; ``top``: the sum of log10(count + 0.5) of these, and ``shares`` of those
    among them that share a unit, in billionths; ``model``: log10 probabilities of units, less log10 of the shared units' sums.
    """
    unit_of, counts = vocab.unit_of, vocab.counts
    flat, z = scorer.p.flat.copy(), scorer.z

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(Parameters(flat), z)
        logs = np.zeros(1 << 16, np.int64)
        logs[: len(counts)] = np.round(np.log10(counts + 0.5) * NANO)
        shared = unit_of > OWN
        room = np.zeros(UNITS)
        room[1 + OWN :] = np.log10(vocab.class_tokens + 0.5 * (vocab.class_words + 1))
        frequent = np.arange(1 << 16) < RARE
        frequent[0] = counts[0] > 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column(3)]
            size = np.array([len(x) for x in codes])
            at = np.concatenate([[0], np.cumsum(size)[:-1]])
            code = np.concatenate(codes)
            unit = unit_of.take(code)
            last, earlier = np.zeros_like(unit), np.zeros_like(unit)
            last[1:], earlier[2:] = unit[:-1], unit[:-2]
            last[at] = earlier[at] = 0
            earlier[at[size > 1] + 1] = 0
            log = logs.take(code)
            model = own.units(unit, last, earlier) / np.log(10) - room.take(unit)
            sums = [np.add.reduceat(x, at) for x in (frequent.take(code).astype(np.int64), log, np.where(shared.take(code), log, 0), model)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(size, pa.int64()), *map(pa.array, sums)], names=["row", "doc_id", "learn", "n_tokens", "known", "top", "shares", "model"])

    return table.select("row", "doc_id", "learn", "codes").mapInArrow(run, "row long, doc_id long, learn boolean, n_tokens long, known long, top long, shares long, model double")


@dataclass
class Model:
    vocab: Vocabulary
    rare: DataFrame  # counts of all words that aren't frequent
    table: DataFrame  # the coded texts that were read with the model
    scorer: Scorer


def fit(docs: DataFrame, learn: Column, work: Workspace, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> Model:
    """A model of the texts of rows where ``learn`` holds; codes of all rows."""
    counts = count(docs.filter(learn).select(raw(F.col(f"`{text_col}`"))))
    level = F.floor(F.log2("c") * 64).cast("int")
    counts = work.write(counts.select("word", "c", level.alias("level"), (F.crc32(F.substring("word", -2, 2)) % CLASSES).cast("int").alias("class")), "counts")
    vocab, least = vocabulary(counts)
    table = work.write(coded(docs, vocab, id_col, text_col, learn), "coded")
    p = train(table, vocab, rounds)
    return Model(vocab, counts.filter(F.col("level") < least).select("word", "c"), table, Scorer(p, normalisers(docs.sparkSession, p)))


def score(model: Model) -> DataFrame:
    """``doc_id, learn, n_tokens, n_known, train_tokens, base_score, score`` of every row that was coded with the model."""
    rare = model.table.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    rare = rare.join(model.rare, "word", "left")
    log = F.round(F.log10(F.coalesce("c", F.lit(0)) + 0.5) * NANO).cast("long")
    rare = rare.groupBy("row").agg(F.sum(F.col("times") * log).alias("logs"), F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).cast("long").alias("more"))
    rows = scored(model.table, model.vocab, model.scorer).join(rare, "row", "left").fillna(0, ["logs", "more"])
    vocab = model.vocab
    room = float(np.log10(vocab.tokens + 0.5 * (vocab.distinct + 1)))
    base = (F.col("top") + F.col("logs")) / F.lit(float(NANO)) - F.col("n_tokens") * F.lit(room)
    value = F.col("model") + (F.col("shares") + F.col("logs")) / F.lit(float(NANO))
    return rows.select("doc_id", "learn", "n_tokens", (F.col("known") + F.col("more")).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), value.alias("score"))


def query(spark, sf_dir):
    """op11: every document's log10 probability, by words alone and by the model; documents of fold 1 of 5 aren't learnt from."""
    model = fit(read_table(spark, sf_dir, "documents"), bucket_of("doc_id", 5) != 1, Workspace(spark, "op11"))
    told = score(model)
    return told.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
