"""Token counts of documents in flat token files, by a scan for the end-of-document id.

A flat token file holds ids of fixed width and nothing else: no index, no
header. Blocks of a file are searched for the end id vectorised; documents may
run across blocks and across files, so block boundaries are stitched by a
prefix scan: a row a block (its ids, its ends, the place of its last end) is
put in order by range, scanned within each range by window functions, and over
the ranges by one short row a range on the driver.

Spark's binary reader gives a file whole, of up to 2 GB; ``write_flat`` makes
files of some 2 MB (or of one document), however much a task writes.

Edge cases: files without an end id are part of a longer document; ids after
the last end are an unfinished document, told by ``ended``; empty files and
empty documents (an end id alone) are fine; a null or empty text is such a
document. For the files ``write_flat`` makes, rows that repeat a doc_id are
separate documents and a null doc_id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Workspace, raw, read_table, shuffle_partitions
from .tokens import default_path, encoder

#: Ids of a block.
BLOCK = 1 << 20
#: The public vocabulary's end-of-text id: no ordinary text has it, so it can part documents.
SEPARATOR = 49407
#: Bytes of a file that ``write_flat`` makes, up to its last document: files are read whole, so a task's memory follows them.
FILE_BYTES = 2 << 20


def ends_of(ids: np.ndarray, end: int) -> np.ndarray:
    """Positions just past every end id."""
    return np.flatnonzero(ids == end) + 1


def blocks_of(spark, path: str, end: int, dtype: str, block: int) -> DataFrame:
    """``file, block, ids, ends``: how many ids a block of a file has, and the positions just past its ends."""
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(content.as_buffer(), dtype, len(content.as_buffer()) // width)
                for k in range(0, len(data), block):
                    own = data[k : k + block]
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([k // block], pa.int64()), pa.array([len(own)], pa.int64()), pa.array([ends_of(own, end)], pa.list_(pa.int64()))], names=["file", "block", "ids", "ends"])

    files = spark.read.format("binaryFile").load(path).filter(f"length >= {width}").select("path", "content")
    return files.mapInArrow(run, "file string, block long, ids long, ends array<long>")


def prefix_scan(blocks: DataFrame, work: Workspace) -> DataFrame:
    """Adds to every block ``base`` (ids before it), ``before`` (ends before it) and ``since`` (where the last end before it stands among all ids, 0 if there is none)."""
    order = ["file", "block"]
    ranged = work.write(blocks.repartitionByRange(shuffle_partitions(work.spark), *order).withColumn("part", F.spark_partition_id()), "ranged")
    w = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({"base": F.coalesce(F.sum("ids").over(w), F.lit(0)), "before": F.coalesce(F.sum(F.size("ends")).over(w), F.lit(0)).cast("long")})
    last = F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1))
    inside = inside.withColumn("last", last).withColumn("since", F.max("last").over(w))
    totals = sorted(inside.groupBy("part").agg(F.sum("ids"), F.sum(F.size("ends")), F.max("last")).collect())  # a row a range
    rows, base, before, since = [], 0, 0, 0
    for part, ids, ends, last_end in totals:
        rows.append((part, base, before, since))
        since = base + last_end if last_end is not None else since
        base, before = base + ids, before + ends
    carried = work.spark.createDataFrame(rows, "part int, base0 long, before0 long, since0 long")
    told = inside.join(F.broadcast(carried), "part")
    return told.select("file", "block", "ids", "ends", (F.col("base") + F.col("base0")).alias("base"), (F.col("before") + F.col("before0")).alias("before"), F.coalesce(F.col("since") + F.col("base0"), F.col("since0")).alias("since"))


def scan(spark, path: str, end: int = SEPARATOR, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """``file, nth, ordinal, start, n_tokens, ended`` of every document in the files below a path, in order of their names.

    ``nth`` counts the documents that end in that file, ``ordinal`` all;
    ``start`` is the number of ids before, ``n_tokens`` includes the end id.
    """
    work = Workspace(spark, "scan")
    blocks = work.write(blocks_of(spark, path, end, dtype, block), "blocks")  # files are read once
    placed = work.write(prefix_scan(blocks, work), "placed")
    first = placed.groupBy("file").agg(F.min("before").alias("first"))
    few = first.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = placed.join(F.broadcast(first) if few else first, "file").select("file", "first", "base", "before", "since", "ends", F.posexplode("ends").alias("k", "at"))
    start = F.when(F.col("k") == 0, F.col("since")).otherwise(F.col("base") + F.element_at("ends", F.greatest("k", F.lit(1))))
    ordinal = F.col("before") + F.col("k")
    found = rows.select("file", (ordinal - F.col("first")).alias("nth"), ordinal.alias("ordinal"), start.alias("start"), (F.col("base") + F.col("at") - start).alias("n_tokens"), F.lit(True).alias("ended"))
    # ids after the last end of all are one unfinished document, of the last file
    tail = placed.agg(F.max("file").alias("file"), F.max(F.col("base") + F.col("ids")).alias("total"), F.max(F.col("before") + F.size("ends")).alias("ordinal"), F.max(F.greatest("since", F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1)))).alias("start"))
    tail = tail.filter("total > start").join(F.broadcast(first) if few else first, "file")
    return found.unionByName(tail.select("file", (F.col("ordinal") - F.col("first")).alias("nth"), "ordinal", "start", (F.col("total") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")))


def write_flat(docs: DataFrame, path: str, tokenizer: str, end: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Flat token files in ``path/kind=ids`` and, in files of the same names in ``path/kind=docs``, the doc ids in order as text.

    Spark's text writer writes them, to any store: the bytes of a file's
    documents, parted by the end id, are its one line, and the end id is the
    line separator. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, nth = encoder(tokenizer, special=False), 0
        keys, own, held = [], [], 0

        def filled() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(["ids", "docs"]), pa.array([nth, nth], pa.int64()), pa.array([mark.join(own), mark.join(keys)], pa.binary())], names=["kind", "nth", "line"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(b"" if key is None else str(key).encode())
                own.append(enc.ids(text.as_py()))
                held += len(keys[-1]) + len(own[-1]) + 2 * len(mark)
                if held >= FILE_BYTES:
                    yield filled()
                    nth, keys, own, held = nth + 1, [], [], 0
        if keys:
            yield filled()

    mark = np.array([end], encoder(tokenizer, special=False).dtype).tobytes()
    lines = docs.select(F.col(id_col).cast("long"), raw(text_col)).mapInArrow(run, "kind string, nth long, line binary").sortWithinPartitions("kind", "nth")
    lines.select("kind", F.col("line").cast("string").alias("line")).write.partitionBy("kind").option("encoding", "ISO-8859-1").option("lineSep", mark.decode("latin-1")).option("maxRecordsPerFile", 1).text(path)


def doc_ids(spark, path: str, end: int = SEPARATOR, dtype: str = "<u2") -> DataFrame:
    """``file, nth, doc_id`` of the files that ``write_flat`` put beside the token files."""
    mark = np.array([end], dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = [int(k) if k else None for k in content.split(mark)[:-1]]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(np.arange(len(keys)), pa.int64()), pa.array(keys, pa.int64())], names=["file", "nth", "doc_id"])

    files = spark.read.format("binaryFile").load(f"{path}/kind=docs").filter("length > 0").select("path", "content")
    return files.mapInArrow(run, "file string, nth long, doc_id long")


def query(spark, sf_dir, tokenizer: str | None = None):
    """op9: documents tokenized to flat files; every document's tokens (with its end) as the scan finds them."""
    tokenizer = tokenizer or default_path()
    path = f"{Workspace(spark, 'op9').path}/flat"
    docs = read_table(spark, sf_dir, "documents")
    write_flat(docs, path, tokenizer)
    if spark.read.format("binaryFile").load(path).filter("length > 0").limit(1).select("path").count() == 0:
        return spark.createDataFrame([], "doc_id long, ordinal long, start long, n_tokens long")
    dtype = encoder(tokenizer, special=False).dtype.str
    base = F.element_at(F.split("file", "/"), -1)
    found = scan(spark, f"{path}/kind=ids", dtype=dtype).withColumn("file", base)
    names = doc_ids(spark, path, dtype=dtype).withColumn("file", base)
    # both have a row a document, which the files they come from don't tell: no broadcast
    return found.join(names.hint("merge"), ["file", "nth"]).select("doc_id", "ordinal", "start", "n_tokens")
