"""Document fingerprints: a canonical exact digest, and classes of equal documents.

Two texts are the same document if they agree after Unicode normalisation
(NFKC), case folding and white-space folding. Their fingerprint is the XXH3
128-bit hash of the canonical UTF-8 bytes. A hash alone never merges
documents: inside a bucket of equal hashes the bytes themselves are compared.

Edge cases: a null text counts as empty; all texts without a visible character
share one fingerprint; rows that repeat a ``doc_id`` are separate documents,
ordered by a hash of their text; a null ``doc_id`` sorts first and names no
class (theirs is the smallest id of it, null if there is none); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Workspace, raw, read_table, shuffle_partitions

DIGEST_BITS = 128


def canonical(text: str) -> bytes:
    """NFKC, case folded, runs of white space as one space, none at the ends."""
    if text.isascii():
        return " ".join(text.lower().split()).encode()
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "replace")


def digest(data: bytes, bits: int = DIGEST_BITS) -> str:
    """Hex XXH3-128 of canonical bytes; fewer bits only to provoke collisions in tests."""
    return f"{xxhash.xxh3_128_intdigest(data) >> (128 - bits):032x}"


def likeness(a: bytes, b: bytes, bits: int = DIGEST_BITS) -> float:
    """1 if both texts are one document: equal hashes first, then equal bytes."""
    return float(digest(a, bits) == digest(b, bits) and a == b)


def spliced(text: str, other: str) -> str:
    """The text with its last half replaced by as much of the head of another."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = DIGEST_BITS) -> DataFrame:
    """``id_col, fingerprint, canon``: digest and canonical bytes of every whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            canon = [canonical(x.decode("utf-8", "replace")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([digest(x, bits) for x in canon], pa.string()), pa.array(canon, pa.binary())], names=[id_col, "fingerprint", "canon"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), raw(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string, canon binary")


def exact_classes(docs: DataFrame, prints: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = DIGEST_BITS) -> DataFrame:
    """Classes of equal documents: the columns of ``prints`` and ``class_id`` (the smallest id of the class).

    ``prints`` has ``id_col, fingerprint`` for every document, and perhaps more.
    Only documents whose digest occurs more than once have their bytes
    compared: per digest the smallest and the largest canonical text are
    aggregated map-side first, so a digest that a third of all rows share sends
    one row a task. Where they differ (a hash collision), classes are formed by
    the bytes themselves and the fingerprint gets the class's rank as a suffix.
    """
    work = Workspace(docs.sparkSession, "classes")
    # digests that occur more than once, as a table of their own: joins with it are broadcast while it is small, or may be split by AQE
    repeated = work.write(prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("class_id")).filter("n > 1").drop("n"), "repeated")
    small = repeated.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else (lambda df: df)
    ids = work.write(prints.join(hint(repeated.select("fingerprint")), "fingerprint", "left_semi").select(F.col(id_col).alias("__id")).distinct(), "ids")
    few = ids.count() <= BROADCAST_ROWS
    chosen = docs.select(id_col, text_col).join(F.broadcast(ids) if few else ids, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    whole = fingerprints(chosen, id_col, text_col, bits)
    apart = work.write(whole.groupBy("fingerprint").agg(F.min("canon").alias("low"), F.max("canon").alias("high")).filter("low != high").select("fingerprint"), "collisions")
    merged = prints.join(hint(repeated), "fingerprint", "left").select(*prints.columns, F.coalesce("class_id", id_col).alias("class_id"))
    if apart.isEmpty():
        return merged
    split = whole.join(apart, "fingerprint", "left_semi")
    classes = split.groupBy("fingerprint", "canon").agg(F.min(id_col).alias("class_id"))
    rank = classes.groupBy("fingerprint").agg(F.sort_array(F.collect_list("canon")).alias("all"))
    classes = classes.join(rank, "fingerprint").select("fingerprint", "canon", F.col("class_id").alias("__class"), F.concat(F.lit("-"), F.array_position("all", F.col("canon")).cast("string")).alias("__suffix"))
    told = split.join(classes, ["fingerprint", "canon"]).groupBy(F.col(id_col).alias("__id"), F.col("fingerprint").alias("__print")).agg(F.min("__suffix").alias("__suffix"), F.min("__class").alias("__class"))
    rows = merged.join(told, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("fingerprint") == F.col("__print")), "left")
    new = {"fingerprint": F.concat("fingerprint", F.coalesce("__suffix", F.lit(""))).alias("fingerprint"), "class_id": F.when(F.col("__suffix").isNotNull(), F.col("__class")).otherwise(F.col("class_id")).alias("class_id")}
    return rows.select(*[new.get(c, F.col(c)) for c in merged.columns])


def spliced_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = DIGEST_BITS) -> DataFrame:
    """Each document beside the one after it in id order: digests of the text, and of the text spliced with the next.

    One range shuffle of the texts. Tasks stream over their sorted rows with a
    look-ahead of one; the first and last row of each partition keep their
    text and are joined along the chain of partitions afterwards (two rows a
    partition).
    """
    spark = docs.sparkSession
    work = Workspace(spark, "splice")

    def finish(text: str, n: int, canon: bytes, after: str) -> tuple:
        edited = spliced(text, after)
        changed, then = canonical(edited), canonical(after)
        return hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), digest(changed, bits), likeness(canon, changed, bits), likeness(canon, then, bits)

    names = ["part", "doc_id", "n_chars", "fingerprint", "edited_sha256", "edited_fingerprint", "near_edited", "near_next", "first", "last", "text"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first, out = TaskContext.get().partitionId(), None, True, []
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = data.decode("utf-8", "replace")
                if held:
                    out.append((part, held[0], len(held[1]), digest(held[2], bits), *finish(held[1], len(held[1]), held[2], text), first, False, held[1].encode() if first else None))
                    first = False
                held = (key, text, canonical(text))
                if len(out) >= 2000:
                    yield batch_of(out)
                    out = []
        if held:
            out.append((part, held[0], len(held[1]), digest(held[2], bits), None, None, None, None, first, True, held[1].encode()))
        if out:
            yield batch_of(out)

    schema = "part int, doc_id long, n_chars long, fingerprint string, edited_sha256 string, edited_fingerprint string, near_edited double, near_next double, first boolean, last boolean, text binary"
    # rows of one doc_id are parted by a hash of their text and their place in the table: no id makes a task of its own
    order = ["doc_id", "tie", "row"]
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("tie"), F.monotonically_increasing_id().alias("row"), raw(F.col(f"`{text_col}`")).alias("text"))
    sorted_docs = keyed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = work.write(sorted_docs.mapInArrow(run, schema), "rows")
    chain = [r[0] for r in rows.filter("first").select("part").orderBy("part").collect()]  # one int a partition
    after = spark.createDataFrame(list(zip(chain, chain[1:] + chain[:1])), "part int, next_part int")
    heads = rows.filter("first").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    ends = rows.filter("last").join(after, "part").join(heads, "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, data, then in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = data.decode("utf-8", "replace")
                canon = canonical(text)
                out.append((key, len(text), digest(canon, bits), *finish(text, len(text), canon, then.decode("utf-8", "replace"))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds[1:8])], names=names[1:8])

    closed = ends.select("doc_id", "text", "next_text").mapInArrow(close, "doc_id long, n_chars long, fingerprint string, edited_sha256 string, edited_fingerprint string, near_edited double, near_next double")
    return rows.filter("NOT last").select(*names[1:8]).unionByName(closed)


def query(spark, sf_dir):
    """op1: every document's fingerprint, that of its splice with the next one, and its class of equal documents."""
    docs = read_table(spark, sf_dir, "documents")
    rows = Workspace(spark, "op1").write(spliced_with_next(docs), "rows")
    return exact_classes(docs, rows).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id")
