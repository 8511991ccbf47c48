"""Reading listings, page snapshots, cached results and external records.

Everything is a Spark reader over a path, so any store will do. Order matters
to "first" rules, so readers add ``pos`` or ``page_ord``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.missing import is_missing
from ..schema import ALIASES, MANIFEST, NPI, PLACES, WIDE


def with_position(rows: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """Numbers rows from 1 by the given columns, range by range: the ranges' sizes (a row a range) are counted first, then rows are numbered within each."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = rows.repartitionByRange(ranges, *order).withColumn("__part", F.spark_partition_id())
    sizes = {r[0]: r[1] for r in parted.groupBy("__part").count().collect()}
    before, total = [], 0
    for k in range(ranges):
        before.append(total)
        total += sizes.get(k, 0)
    offset = F.element_at(F.array(*[F.lit(n) for n in before]), F.col("__part") + 1)
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return parted.withColumn(name, (offset + within).cast("long")).drop("__part")


def canonical(rows: DataFrame, aliases: dict[str, list[str]] = ALIASES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns under their own names, whatever header they came with; missing ones are null, rows without an index go; columns to ``keep`` stay."""
    have = {c.strip().lower(): c for c in rows.columns}
    cols = []
    for name, others in aliases.items():
        found = [F.col(f"`{have[a.lower()]}`").cast("string") for a in [name, *others] if a.lower() in have]
        value = F.coalesce(*found) if found else F.lit(None).cast("string")
        cols.append((value.try_cast("double").cast("int") if name == "idx" else F.trim(value)).alias(name))
    return rows.select(*cols, *keep).filter("idx IS NOT NULL")


def read_practices(spark: SparkSession, path: str, start: int = 1, end: int | None = None) -> DataFrame:
    """A practice listing (CSV with a header), in index order; rows ``start`` to ``end``."""
    rows = with_position(canonical(spark.read.option("header", True).csv(path)), "idx")
    return rows.filter(F.col("pos").between(start, end if end is not None else 2**31 - 1))


def batch_columns(texts: dict[str, Column]) -> list[Column]:
    """The wide table's columns, typed, from its cells as texts."""
    flag = lambda c: F.coalesce(F.upper(F.trim(c)).isin("X", "TRUE", "YES"), F.lit(False))
    typed = lambda c, kind: flag(c) if kind == "boolean" else c.try_cast("double").cast(kind) if kind in ("int", "double") else c
    return [typed(texts[name], kind).alias(name) for _, name, kind, _ in WIDE]


def in_file_order(rows: DataFrame, *columns) -> DataFrame:
    """Rows of a file scan with ``file`` and ``pos``: their number, from 1, over the files in order of their paths, as they stand there.

    Spark deals splits of files by size; a row's place follows from its file,
    where its split begins and its number in it. Splits are counted and added
    up before them, so positions need no global sort and rows of one split
    stay together.
    """
    placed = rows.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__seen"))
    numbered = placed.withColumn("__in", F.row_number().over(Window.partitionBy("file", "__block").orderBy("__seen")))
    splits = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block")).groupBy("file", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return numbered.join(offsets, ["file", "__block"]).withColumn("pos", F.col("__off") + F.col("__in")).drop("__block", "__seen", "__in", "__off")


def read_batch(spark: SparkSession, *paths: str) -> DataFrame:
    """Batch tables (CSV, wide headers) as typed rows, in the order of the files and of their rows."""
    raw = spark.read.option("header", True).option("recursiveFileLookup", True).csv(list(paths))
    have = {c.strip().lower(): c for c in raw.columns}
    at = {name: have.get(header.lower()) or have.get(name) for header, name, _, _ in WIDE}
    cols = batch_columns({name: F.col(f"`{c}`") if c else F.lit(None).cast("string") for name, c in at.items()})
    return in_file_order(raw, *cols).filter("idx IS NOT NULL")


def read_pages(spark: SparkSession, root: str, least: int = 200, manifest: bool = False) -> DataFrame:
    """Page snapshots ``root/NNN_name/type.html`` with ``manifest.json`` beside them.

    manifest: only what manifests name, in any length; else every ``*.html`` of
    ``least`` characters, with address and time from a manifest that has it.
    """
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").load(root)
    pages = files.select(folder.alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("content").cast("string").alias("html"))
    meta = spark.read.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").json(root)
    meta = meta.select(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.explode_outer("pages").alias("page_type", "p")).filter("page_type IS NOT NULL")
    meta = meta.select("folder", "page_type", "p.url", F.regexp_extract("p.file", r"([^/]+)$", 1).alias("file"), "p.saved_at")
    rows = pages.join(meta, ["folder", "file"], "inner" if manifest else "left")
    if not manifest:
        rows = rows.filter(F.length("html") >= least)
    kind = F.coalesce("page_type", F.regexp_replace("file", r"\.html$", ""))
    index = F.regexp_extract("folder", r"^([0-9]+)_", 1).try_cast("int")
    order = F.row_number().over(Window.partitionBy("folder").orderBy("file"))
    return rows.select(index.alias("practice_id"), kind.alias("page_type"), F.coalesce("url", F.lit("")).alias("url"), "html", "saved_at", order.alias("page_ord"))


def read_results(spark: SparkSession, root: str) -> DataFrame:
    """Cached results, a JSON file a practice; a corrupt one is left out."""
    schema = "practice map<string,string>, scraped_at string, result map<string,string>, doctors array<struct<name:string,specialty:string,associations:string>>, _corrupt string"
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", "result.json").json(root)
    folder = F.regexp_extract("_metadata.file_path", r"([0-9]+)_[^/]*/[^/]+$", 1).try_cast("int")
    return rows.select(folder.alias("practice_id"), "practice", "scraped_at", "result", "doctors", "_corrupt").filter("_corrupt IS NULL").drop("_corrupt")


def read_urls(lines: DataFrame, column: str = "value") -> DataFrame:
    """Addresses in lines of text, by white space and commas."""
    return lines.select(F.explode(F.split(F.col(column), r"[\s,]+")).alias("url")).filter(F.col("url").startswith("http"))


def read_npi(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NPI).option("multiLine", False).json(path)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLACES).json(path)


def batch_slice(rows: DataFrame, batch: int, size: int = 100, start: int | None = None, pos: str = "pos") -> DataFrame:
    """Batch b has rows (b-1)*size+1 to b*size; ``start`` is a row in it, or its place in the batch (1 to size)."""
    low, high = (batch - 1) * size + 1, batch * size
    if start is not None:
        first = start if low <= start <= high else low + start - 1 if 1 <= start <= size else None
        if first is None:
            raise ValueError(f"start {start} isn't in rows {low} to {high}")
        low = first
    return rows.filter(F.col(pos).between(low, high))


def pick_rows(rows: DataFrame, numbers: list[int], pos: str = "pos") -> DataFrame:
    """The given row numbers, once each, in order."""
    return rows.filter(F.col(pos).isin(sorted(set(numbers)))).orderBy(pos)


def blocked(rows: DataFrame, policy: str = "bypass") -> Column:
    """A site that didn't answer: a website, but neither doctor nor email."""
    return ~is_missing("website", policy) & is_missing("doctor_name", policy) & is_missing("email", policy)


def empty_result(counts: tuple[str, ...] = ("implants", "veneers", "invisalign", "whitening", "sedation"), policy: str = "bypass") -> Column:
    total = sum((F.coalesce(F.col(c).cast("string").try_cast("int"), F.lit(0)) for c in counts), F.lit(0))
    return is_missing("doctor_name", policy) & is_missing("email", policy) & (total == 0)


def needs_refresh(flags: list[str], policy: str = "refresh") -> Column:
    """Any technology unknown, no mention of aligners, no hygienists or no testimonials."""
    out = F.lit(False)
    for f in flags:
        out = out | ~F.coalesce(F.col(f), F.lit(False))
    number = lambda c: F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)) == 0
    return out | number("invisalign") | is_missing("hygienists", policy) | number("testimonials")


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: the rows whose key isn't done."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def targets(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return rows.join(wanted.select(key).distinct(), key, "left_semi")


def lacking(rows: DataFrame, *columns: str, policy: str = "patch") -> DataFrame:
    """Rows in which any of the columns is missing."""
    out = F.lit(False)
    for c in columns:
        out = out | is_missing(c, policy)
    return rows.filter(out)
