"""Token ids in binary files: canonical length-limited Huffman codes of global counts.

File format (little-endian): a file is a row of blocks, each followed by the
trailer ``TRAILER``. A block stands alone:

    magic "SGH1" | documents u32 | ids u32 | checkpoints u32 | payload bytes u64
    | ids of the corpus before the block u64
    | doc ids i64 each | 1 where a doc id is null u8 each | ids per document u32 each
    | bit offsets of every 512th id u64 each | payload, codes from the high bit

Beside the blocks, ``codes`` holds the code length of every id (u8 each); the
canonical code follows from lengths alone. Blocks hold documents in ascending
doc_id order and never split one; a block's place in the corpus is in its
header, so blocks may be read and decoded independently and in any order; a
file has ``FILE_BLOCKS`` of them at most.
Spark's text writer puts the blocks into any store (the trailer is its line
separator) and its binary reader gets them back.

Edge cases: a null text is an empty document (its end id alone); rows that
repeat a doc_id are separate documents, in an order of their own; a null doc_id sorts first; an empty
table gives no block and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, raw, read_table, shuffle_partitions
from .tokens import END, default_path, encoder

MAGIC, TRAILER = b"SGH1", b"\n-end-of-block-\n"
HEAD = "<4sIIIQQ"
#: Longest code; the decoding table has 2**18 entries.
LIMIT = 18
EVERY = 512
BLOCK_IDS = 1 << 16
#: Blocks of a file: some 10 MB, so that a file is a small unit of reading however large the corpus is.
FILE_BLOCKS = 128
#: Ids decoded side by side.
AT_ONCE = 1 << 20


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge; 0 for ids that don't occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids can't have codes of at most {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(leaves))
        both = both[order]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    # from the last level down: the first 2n-2 items; each package among them stands for two items of the level before
    take, own = 2 * len(used) - 2, np.zeros(len(used) + 1, np.int64)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        own[0] += 1
        own[n] -= 1
        take = 2 * (take - n)
    lengths[used] = np.cumsum(own)[:-1]
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        n = lengths[order].astype(np.int64)
        # a code is the sum of the shares 2**-length before it
        share = np.cumsum(1 << (LIMIT - n)) - (1 << (LIMIT - n))
        codes[order] = (share >> (LIMIT - n)).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every string of LIMIT bits: the id whose code it begins with, and that code's length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    n = lengths[order].astype(np.int64)
    ids = np.zeros(1 << LIMIT, np.uint32)
    step = np.ones(1 << LIMIT, np.uint8)
    filled = np.repeat(order, 1 << (LIMIT - n))
    ids[: len(filled)] = filled
    step[: len(filled)] = np.repeat(n, 1 << (LIMIT - n))
    return ids, step


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of all ids, and the bit offset of every EVERY-th."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    starts = ends - n
    words = np.zeros((int(ends[-1]) >> 5) + 2 if len(ids) else 0, np.uint64)
    if len(ids):
        at = starts >> 5
        window = codes[ids] << (64 - (starts & 31) - n).astype(np.uint64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        words[at[first]] += np.add.reduceat(window >> np.uint64(32), first)
        words[at[first] + 1] += np.add.reduceat(window & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8 if len(ids) else 0], starts[::EVERY]


def decode(payload: bytes, offsets: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """All ids: the runs that begin at ``offsets`` are decoded side by side, an id of each at a time."""
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    out = np.empty(int(counts.sum()), np.uint32)
    place = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    at, place, counts = offsets[order].astype(np.int64), place[order], counts[order]
    ids, step = table
    for k in range(int(counts[0]) if len(counts) else 0):
        live = int(np.searchsorted(-counts, -k, "left"))  # runs longer than k
        at, place = at[:live], place[:live]
        bits = (window[at >> 3] >> (32 - LIMIT - (at & 7)).astype(np.uint32)) & ((1 << LIMIT) - 1)
        out[place + k] = ids[bits]
        at = at + step[bits]
    return out


def write_files(docs: DataFrame, work: Workspace, tokenizer: str, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Sort, tokenize and count, code, write; returns the folder with ``blocks`` and ``codes``.

    Rows of one doc_id are parted by a hash of their text and their place in
    the table, so that a doc_id which very many rows repeat isn't one task.
    (Ids take about as many bytes as texts here, so texts are sorted: sorting
    ids, written where texts are read, took a third more time.)
    """
    spark = docs.sparkSession
    width = encoder(tokenizer).dtype.itemsize
    kind = np.dtype(f"<u{width}")

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, keys, sizes, data, held, before = encoder(tokenizer), TaskContext.get().partitionId(), [], [], [], 0, 0
        last, total = np.array([end], enc.dtype).tobytes(), np.zeros(1, np.int64)

        def block() -> pa.RecordBatch:
            nonlocal total
            own = b"".join(data)
            more = np.bincount(np.frombuffer(own, kind), minlength=len(total))
            more[: len(total)] += total
            total = more
            return row(part, before, keys, sizes, held, own)

        def row(*values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()))], names=["part", "before", "keys", "sizes", "n", "ids"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                data.append(enc.ids(text.as_py()) + last)
                sizes.append(len(data[-1]) // width)
                held += sizes[-1]
                if held >= BLOCK_IDS:
                    yield block()
                    keys, sizes, data, before, held = [], [], [], before + held, 0
        if keys:
            yield block()
        # the task's counts: ids that occur, and how often
        used = np.flatnonzero(total)
        yield row(None, None, used.tolist(), total[used].tolist(), None, None)

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"), raw(text).alias("text"))
    order = ["doc_id", "tie", "row"]
    placed = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    ids = work.write(placed.mapInArrow(tokenize, "part int, before long, keys array<long>, sizes array<long>, n long, ids binary"), "ids")

    pairs = ids.filter("part IS NULL").select(F.explode(F.arrays_zip("keys", "sizes")).alias("x"))
    counts = pairs.groupBy(F.col("x.keys").alias("id")).agg(F.sum("x.sizes").alias("n")).collect()  # a row an id of the vocabulary
    ids = ids.filter("part IS NOT NULL")
    table = np.zeros(max((r.id for r in counts), default=0) + 1, np.int64)
    for r in counts:
        table[r.id] = r.n
    lengths = code_lengths(table)
    parts = {r.part: r.n for r in ids.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # a row a partition
    before, offset = {}, 0
    for p in sorted(parts):
        before[p], offset = offset, offset + parts[p]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        for batch in batches:
            out = []
            for part, start, keys, sizes, _, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                own = np.frombuffer(data, kind)
                payload, marks = encode(own, codes, lengths)
                head = struct.pack(HEAD, MAGIC, len(keys), len(own), len(marks), len(payload), before[part] + start)
                out.append(head + np.array([k or 0 for k in keys], "<i8").tobytes() + bytes([k is None for k in keys]) + np.array(sizes, "<u4").tobytes() + marks.astype("<u8").tobytes() + payload)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["block"])

    as_text = F.col("block").cast("string")  # bytes as they are; the text writer copies them
    ids.mapInArrow(code, "block binary").select(as_text).write.option("lineSep", TRAILER.decode()).option("maxRecordsPerFile", FILE_BLOCKS).text(f"{work.path}/blocks")
    held = spark.createDataFrame([(bytearray(lengths.tobytes()),)], "block binary").coalesce(1)
    held.select(as_text).write.option("lineSep", TRAILER.decode()).text(f"{work.path}/codes")
    work.drop("ids")
    return work.path


def blocks_of(content: bytes) -> Iterator[tuple]:
    """The blocks of a file: doc ids, sizes, ids before, payload, bit offsets, number of ids."""
    at = 0
    while at < len(content):
        magic, docs, n, marks, size, before = struct.unpack_from(HEAD, content, at)
        if magic != MAGIC:
            raise ValueError("not a block")
        at += struct.calcsize(HEAD)
        keys = np.frombuffer(content, "<i8", docs, at)
        null = np.frombuffer(content, np.uint8, docs, at + 8 * docs)
        sizes = np.frombuffer(content, "<u4", docs, at + 9 * docs)
        at += 13 * docs
        offsets = np.frombuffer(content, "<u8", marks, at)
        at += 8 * marks
        yield [None if x else int(k) for k, x in zip(keys, null)], sizes, before, content[at : at + size], offsets, n
        at += size + len(TRAILER)


def read_files(spark, path: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32, ids`` (little-endian u32; null unless ``with_ids``)."""
    read = spark.read.format("binaryFile")
    lengths = np.frombuffer(read.load(f"{path}/codes").filter("length > 0").select("content").first()[0], np.uint8)[: -len(TRAILER)]  # a byte an id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        for batch in batches:
            for content in batch.column(0):
                held, n = [], 0
                for block in blocks_of(content.as_py()):
                    held.append(block)
                    n += block[5]
                    if n >= AT_ONCE:
                        yield documents_of(held, table, with_ids)
                        held, n = [], 0
                if held:
                    yield documents_of(held, table, with_ids)

    return read.load(f"{path}/blocks").filter("length > 0").select("content").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def documents_of(blocks: list[tuple], table, with_ids: bool = True) -> pa.RecordBatch:
    base, offsets, counts = 0, [], []
    for _, _, _, payload, marks, n in blocks:
        offsets.append(marks.astype(np.int64) + 8 * base)
        counts.append(np.minimum(EVERY, n - EVERY * np.arange(len(marks))))
        base += len(payload)
    ids = decode(b"".join(b[3] for b in blocks), np.concatenate(offsets), np.concatenate(counts), table)
    keys = [k for b in blocks for k in b[0]]
    sizes = np.concatenate([b[1] for b in blocks]).astype(np.int64)
    starts = np.concatenate([b[2] + np.cumsum(b[1].astype(np.int64)) - b[1] for b in blocks])
    data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes) * 4
    own = [data[e - 4 * s : e] for s, e in zip(sizes.tolist(), ends.tolist())]
    out = pa.array([bytes(x) for x in own], pa.binary()) if with_ids else pa.nulls(len(own), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x) for x in own], pa.int64()), out], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def query(spark, sf_dir, tokenizer: str | None = None):
    """op3: ids of every document, written to files and read back."""
    path = write_files(read_table(spark, sf_dir, "documents"), Workspace(spark, "op3"), tokenizer or default_path())
    return read_files(spark, path, with_ids=False).drop("ids")
