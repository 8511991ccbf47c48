"""Writing tables and snapshots. Writes overwrite whole partitions, so a repeated task leaves the same files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import render
from ..functions.names import looks_titled
from ..schema import CHAIN, SKIPPED, WIDE


def doctor_rows(results: DataFrame) -> DataFrame:
    """One row a doctor; without doctors, the listed names, else the given name if it carries a title or credential, else "Not Found"."""
    given = F.when(looks_titled("doctor_name"), F.col("doctor_name")).otherwise(F.lit("Not Found"))
    names = F.coalesce(F.nullif(F.trim("names"), F.lit("")), given) if "names" in results.columns else given
    one = F.array(F.struct(names.alias("name"), F.lit(None).cast("string").alias("specialty"), F.lit(None).cast("array<string>").alias("associations")))
    exploded = results.withColumn("__d", F.explode(F.when(F.size("doctors") > 0, F.col("doctors")).otherwise(one)))
    others = [c for c in results.columns if c not in ("doctors", "names", "doctor_name", "specialty", "associations")]
    return exploded.select(*others, F.col("__d.name").alias("doctor_name"), render("__d.specialty").alias("specialty"), render(F.array_join("__d.associations", ", ")).alias("associations"))


def rendered(rows: DataFrame) -> DataFrame:
    """The 46 columns under their headers, as text: flags as X or blank."""

    def show(name: str, kind: str) -> Column:
        if name not in rows.columns:
            return F.lit("")
        if kind == "boolean":
            return F.when(F.col(name), F.lit("X")).otherwise(F.lit(""))
        return F.coalesce(F.col(name).cast("string"), F.lit("Not Found" if kind == "string" else ""))

    return rows.select(*[show(name, kind).alias(header) for header, name, kind, _ in WIDE])


def write_batch(rows: DataFrame, path: str) -> None:
    rendered(rows).write.mode("overwrite").option("header", True).csv(path)


def write_skipped(rows: DataFrame, path: str) -> None:
    skipped(rows).write.mode("overwrite").option("header", True).csv(path)


def skipped(rows: DataFrame) -> DataFrame:
    return rows.filter(F.coalesce(F.col("skip_reason"), F.lit("")) != "").select(*SKIPPED)


def chain_rows(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in CHAIN])


def write_pages(pages: DataFrame, path: str) -> None:
    """Page snapshots by practice; practices in the batch are replaced, others stay."""
    pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("practice_id").parquet(path)


def latest_pages(pages: DataFrame) -> DataFrame:
    """One page a practice and type: the last saved."""
    others = [c for c in pages.columns if c not in ("practice_id", "page_type")]
    return pages.groupBy("practice_id", "page_type").agg(F.max_by(F.struct(*others), F.struct("saved_at", "page_ord")).alias("p")).select("practice_id", "page_type", "p.*")


def write_results(results: DataFrame, path: str) -> None:
    results.write.mode("overwrite").json(path)


def summary(rows: DataFrame, column: str) -> DataFrame:
    """The console report: rows a value."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), column)
