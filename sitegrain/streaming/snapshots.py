"""New page snapshots as they arrive, kept page by page, summed by practice.

The state is a row a practice and page: the largest of each count that any
snapshot of the page had, and its flags. Merging never reduces anything and
gives the same state for any split of the snapshots into batches, any order
and any repetition; what a practice has is summed from the state, so pages
that come in two batches count as they would in one. Neither watermark nor
state store is needed: a batch that is retried changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import parse_pages
from ..functions.urls import without_fragment
from ..operators.features import page_counts, page_flags, prepared, sum_counts
from ..rules import COUNT_POLICIES, SERVICES, TECHNOLOGY
from ..schema import PAGE

KEY = ["practice_id"]


def page_rows(pages: DataFrame, policy: str = "scrape") -> DataFrame:
    """A row a page of a batch: counts and flags."""
    return prepared(parse_pages(pages)).select(*KEY, "url", "page_ord", *page_counts(policy), *page_flags(policy))


def merged(rows: DataFrame, policy: str = "scrape") -> DataFrame:
    """One row a practice and page: the largest of each count, of each word's count, and of each flag."""
    page = without_fragment("url") if COUNT_POLICIES[policy]["page_key"] == "no_fragment" else F.col("url")
    most = [c for c in rows.columns if c[:2] in ("b_", "f_") or c in TECHNOLOGY]
    own = rows.withColumn("url", page).groupBy(*KEY, F.coalesce("url", F.col("page_ord").cast("string")).alias("__page"))
    worded = [F.flatten(F.collect_set("words")).alias("words")] if "words" in rows.columns else []
    kept = own.agg(F.min("url").alias("url"), F.min("page_ord").alias("page_ord"), *[F.max(c).alias(c) for c in most], *worded).drop("__page")
    if not worded:
        return kept
    names = F.array_distinct(F.transform("words", lambda x: F.struct(x["c"].alias("c"), x["w"].alias("w"))))
    largest = lambda k: F.array_max(F.transform(F.filter("words", lambda x: (x["c"] == k["c"]) & (x["w"] == k["w"])), lambda x: x["n"]))
    return kept.withColumn("words", F.array_sort(F.transform(names, lambda k: F.struct(k["c"].alias("c"), k["w"].alias("w"), largest(k).alias("n")))))


def practices(state: DataFrame, policy: str = "scrape") -> DataFrame:
    """Counts and flags of each practice over its pages."""
    flags = state.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in TECHNOLOGY])
    return sum_counts(state, KEY, policy, list(SERVICES)).drop("dental_plan").join(flags, KEY)


def page_features(pages: DataFrame, policy: str = "scrape") -> DataFrame:
    """Counts and flags of each practice of a table of pages."""
    return practices(merged(page_rows(pages, policy), policy), policy)


def merge_batch(table: str, policy: str = "scrape"):
    """For ``foreachBatch``: merges a batch into the state at ``table/pages`` and writes the practices to ``table/v=<batch>``; versions are numbered by batch, so a repeat overwrites itself."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = page_rows(batch, policy)
        if epoch:
            rows = spark.read.parquet(f"{table}/pages/v={epoch - 1}").unionByName(rows)
        merged(rows, policy).write.mode("overwrite").parquet(f"{table}/pages/v={epoch}")
        practices(spark.read.parquet(f"{table}/pages/v={epoch}"), policy).write.mode("overwrite").parquet(f"{table}/v={epoch}")

    return run


def start(spark: SparkSession, folder: str, table: str, checkpoint: str, policy: str = "scrape"):
    """A file stream over page snapshots; runs until what is there is done."""
    pages = spark.readStream.schema(PAGE).parquet(folder)
    return pages.writeStream.foreachBatch(merge_batch(table, policy)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_mentions(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events a type and day, streaming or not; late events count up to the watermark."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    return events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")
