"""Mixing sources to target weights by hash-threshold histograms.

Every row has a fixed hash, of its id and text and, behind these bits, of its
place in the table, so that rows that repeat another part too. Per source, the
sizes of documents are summed by hash bucket; the threshold that meets a
source's budget lies in one boundary bucket, which alone is refined by the
next hash bits until it holds a single row. A document is taken once more than
its source's whole repeats if its hash lies below the threshold. What then
remains of the budget, less than the row at the threshold, is offered to the
next ``OFFER`` rows by hash, the largest first (or that row is taken, if that
comes closer). Nothing is sorted but buckets and offers, and a budget larger
by more than the offers takes a superset of a smaller one: thresholds nest.

Edge cases: a null or blank text has size 0 and takes 0; a null source is a
source of its own, last in order; rows that repeat an id, or id and text, are
decided one by one (the place of a row is its file and its number there, so
the table must not change between its two readings, but may be split otherwise
among tasks); rows that share all bits of the hash, which 32 bits of place make
rare, are taken alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, read_table

#: Hash bits a refinement uses, refinements at most, and the bits of the content among them (the others part equal rows).
LEVEL_BITS, LEVELS, CONTENT = 12, 5, 28
ROW = LEVEL_BITS * LEVELS - CONTENT
PLACE = "__sg_place"
#: Rows beyond the threshold that the rest of a budget is offered to.
OFFER = 32
#: Sources up to which the table of thresholds is broadcast (a row of a few numbers each).
SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text_col: str = "text") -> Column:
    """Number of words between ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], budget: float, most: float) -> list[float]:
    """Share a budget by weight; nobody gets over ``most`` times its size, the excess is shared anew among the rest."""
    targets, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = float(min(budget, most * sum(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        if total <= 0:
            break
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in full:
            targets[i] = most * sizes[i]
        left -= sum(targets[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def mix_plan(docs: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, source_col: str = "source", size_col: str = "size") -> list[tuple]:
    """``(source, its size, its target)`` by code point, null last.

    One row a source reaches the driver: like the weights themselves, which are
    given a source, this is configuration, not data.
    """
    rows = docs.groupBy(source_col).agg(F.sum(size_col).alias("s")).collect()
    rows = sorted(((r[0], int(r[1] or 0)) for r in rows), key=lambda r: (r[0] is None, (r[0] or "").encode()))
    sizes = [s for _, s in rows]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
    return [(name, s, t) for (name, s), t in zip(rows, targets)]


def placed(docs: DataFrame) -> DataFrame:
    """Adds every row's place: its file and its number there, the same however files are split among tasks.

    Only a Parquet scan can tell that; other tables are written first.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(PLACE)
    try:
        return docs.select(*[F.col(f"`{c}`") for c in docs.columns], place)
    except AnalysisException:  # no scan of Parquet files
        written = Workspace(docs.sparkSession, "mix_docs").write(docs, "docs")
        return written.select(*[F.col(f"`{c}`") for c in docs.columns], place)


def hash_of(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A placed row's hash of LEVEL_BITS * LEVELS bits; rows equal in id and text (and the few that share the content's bits) are told apart by place."""
    content = F.shiftrightunsigned(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), 64 - CONTENT)
    return F.shiftleft(content, ROW).bitwiseOR(F.shiftrightunsigned(F.col(PLACE), 64 - ROW))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SOURCES else df


def thresholds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame, int]:
    """Of placed documents: ``doc_id, source, size, h``; plans ``goal, source_size, target, whole, cut, extra`` (the hashes beyond the cut that are taken too); the number of sources.

    One pass over the texts counts words into a narrow written table; all
    histograms run on that. Hot sources cost nothing special: histograms are
    pre-aggregated map-side, to at most 4096 rows a source and task, and a
    task hands on OFFER rows a source at most.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "mix")
    slim = work.write(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size_of(text_col).alias("size"), hash_of(id_col, text_col).alias("h")), "slim")
    plan = [(name, s, t, int(t // s) if s else 0, t - (t // s) * s if s else 0.0) for name, s, t in mix_plan(slim, weights, share, most)]
    goals = spark.createDataFrame(plan, "goal string, source_size long, target double, whole int, rest double")
    same = F.col("source").eqNullSafe(F.col("goal"))
    whole_range = LEVEL_BITS * LEVELS
    # cut: per source the first hash bits below which all is taken; left: budget that remains inside the boundary bucket
    cuts, first = goals.select("goal", F.col("rest").alias("left"), F.lit(0).cast("long").alias("cut")), None
    for level in range(1, LEVELS + 1):
        fine = F.shiftrightunsigned("h", whole_range - LEVEL_BITS * level)
        inside = slim.join(_small(cuts.select("goal", "left", "cut"), len(plan)), same)
        if level > 1:
            inside = inside.filter(F.shiftrightunsigned(fine, LEVEL_BITS) == F.col("cut"))
        histogram = inside.groupBy("goal", "left", fine.alias("bucket")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("size") > 0).alias("filled"))
        if level == 1:
            histogram = first = work.write(histogram, "histogram")
        running = F.sum("s").over(Window.partitionBy("goal").orderBy("bucket"))
        # the first bucket whose running sum exceeds the budget is the boundary; without one, everything inside is taken
        over = histogram.withColumn("upto", running).filter("upto > left").groupBy("goal").agg(F.min_by(F.struct("bucket", (F.col("left") - F.col("upto") + F.col("s")).alias("left"), "n"), "bucket").alias("b"))
        top = F.shiftleft(F.col("cut") + 1, LEVEL_BITS) if level > 1 else F.lit(2**LEVEL_BITS)
        cuts = cuts.withColumnRenamed("goal", "g0").join(over, F.col("g0").eqNullSafe(F.col("goal")), "left").select(F.col("g0").alias("goal"), F.coalesce("b.left", "left").cast("double").alias("left"), F.coalesce("b.bucket", top).cast("long").alias("cut"), F.coalesce("b.n", F.lit(0)).alias("n"))
        cuts = work.write(cuts, f"cuts{level}")
        if level == LEVELS or cuts.filter("n > 1").isEmpty():
            break
    cuts = cuts.select(F.col("goal").alias("g0"), "left", F.shiftleft("cut", whole_range - LEVEL_BITS * level).alias("cut"))
    # the buckets of the first histogram from the cut on that hold enough rows to offer the rest to
    begin = F.shiftrightunsigned("cut", whole_range - LEVEL_BITS)
    counted = first.select("goal", "bucket", "filled").join(_small(cuts, len(plan)), F.col("goal").eqNullSafe(F.col("g0"))).filter(F.col("bucket") >= begin)
    upto = F.sum(F.when(F.col("bucket") > begin, F.col("filled")).otherwise(0)).over(Window.partitionBy("goal").orderBy("bucket"))
    until = counted.withColumn("upto", upto).groupBy("g0", "left", "cut").agg(F.min(F.when(F.col("upto") >= OFFER, F.col("bucket"))).alias("until"))
    near = slim.join(_small(until, len(plan)), F.col("source").eqNullSafe(F.col("g0"))).filter((F.col("h") >= F.col("cut")) & (F.col("size") > 0) & (F.col("until").isNull() | (F.shiftrightunsigned("h", whole_range - LEVEL_BITS) <= F.col("until"))))
    offers = near.withColumn("k", F.row_number().over(Window.partitionBy("g0").orderBy("h", "size"))).filter(F.col("k") <= OFFER)
    offers = offers.groupBy("g0", "left").agg(F.collect_list(F.struct("size", "h")).alias("all"), F.min_by(F.struct("size", "h"), F.struct("h", "size")).alias("next"))
    none = F.array().cast("array<bigint>")
    fill = F.aggregate(F.sort_array("all", False), F.struct(F.col("left").alias("left"), none.alias("extra")), lambda acc, x: F.when(x["size"] <= acc["left"], F.struct((acc["left"] - x["size"]).alias("left"), F.concat(acc["extra"], F.array(x["h"])).alias("extra"))).otherwise(acc))
    offers = offers.withColumn("f", fill).select(F.col("g0").alias("g1"), F.when(F.abs(F.col("next.size") - F.col("left")) < F.col("f.left"), F.array("next.h")).otherwise(F.col("f.extra")).alias("extra"))
    plans = goals.join(cuts, F.col("goal").eqNullSafe(F.col("g0"))).join(offers, F.col("goal").eqNullSafe(F.col("g1")), "left")
    return slim, work.write(plans.select("goal", "source_size", "target", "whole", "cut", F.coalesce("extra", none).alias("extra")), "plans"), len(plan)


def copies_of(h: Column, most: float, p: str = "") -> Column:
    more = (h < F.col(f"{p}cut")) | F.array_contains(f"{p}extra", h)
    return F.least(F.col(f"{p}whole") + more.cast("int"), F.lit(int(most)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, h``: how often the mix takes each document."""
    slim, plans, n = thresholds(placed(docs), id_col, text_col, source_col, weights, share, most)
    rows = slim.join(_small(plans, n), F.col("source").eqNullSafe(F.col("goal")))
    return rows.select("doc_id", "source", "size", "source_size", "target", copies_of(F.col("h"), most).alias("copies"), "h")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents as often as the mix takes them, all columns kept.

    The texts aren't shuffled: a row's hash is worked out again, and the plan
    of each source joins as a small table.
    """
    names, docs = docs.columns, placed(docs)
    _, plans, n = thresholds(docs, id_col, text_col, source_col, weights, share, most)
    plans = plans.select(*[F.col(c).alias(f"__sg_{c}") for c in ("goal", "whole", "cut", "extra")])
    rows = docs.withColumn("__sg_h", hash_of(id_col, text_col)).join(_small(plans, n), F.col(f"`{source_col}`").eqNullSafe(F.col("__sg_goal")))
    copies = copies_of(F.col("__sg_h"), most, "__sg_")
    rows = rows.withColumn("__sg_copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    return rows.select(*[F.col(f"`{c}`") for c in names])


def query(spark, sf_dir):
    """op2: the mix of all documents by the weights 3, 1, 2 to 150 % of all words."""
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
