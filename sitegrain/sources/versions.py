"""Tables that are upserted by key, batch by batch, and read as of any batch.

Rows lie in a fixed number of parts by a hash of their key. A batch rewrites
the parts it has keys of, in a folder of its own, and then writes a version: a
row a part that names the folder holding it now. Nothing is changed in place,
so a job that dies before its version is written leaves the table as it was;
what it wrote is never read, and the batch can be run again. A batch that a
version names already is left out, so a loop over batches resumes by running
again. One writer at a time.

Edge cases: of rows of one key the largest by the given order stays, whether it
came before or now; of equal ones the new row. Null keys are one key. A batch
without rows is a version like the one before. All batches have the columns of
the first. The driver sees a row a part, never rows of data.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a new table; a table keeps the number it was made with.
PARTS = 64
VERSION = "version long, batch string, part int, parts int, folder string"


def history(spark: SparkSession, path: str) -> DataFrame | None:
    """The finished versions, a row a part (a table without rows has one without a folder); None where there is no table."""
    try:
        return spark.read.schema(VERSION).json(f"{path}/versions/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _parts(told: DataFrame | None, version: int | None) -> list:
    """A version's rows (the last by default), at most one a part."""
    if told is None:
        return []
    at = told.agg(F.max("version")).first()[0] if version is None else version
    return told.filter(F.col("version") == at).collect()


def _read(spark: SparkSession, path: str, rows: list) -> DataFrame | None:
    folders = [f"{path}/data/{r.folder}/part={r.part}" for r in rows if r.folder is not None]
    return spark.read.parquet(*folders) if folders else None


def table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows as of a version, the last by default. A table without any rows has no columns to show and raises, as an unknown version does."""
    found = _read(spark, path, _parts(history(spark, path), version))
    if found is None:
        raise ValueError(f"no rows in version {version if version is not None else 'any'} of {path}")
    return found


def upsert(rows: DataFrame, path: str, key: list[str], order: list[str | Column], batch: str, parts: int = PARTS) -> int:
    """Merge a batch into the table below a path; the version that has it."""
    spark = rows.sparkSession
    told = history(spark, path)
    if told is not None:
        had = told.filter(F.col("batch") == batch).agg(F.min("version")).first()[0]
        if had is not None:
            return had
    last = _parts(told, None)
    parts = last[0].parts if last else parts
    version, folder = (last[0].version + 1 if last else 0), uuid.uuid4().hex
    part = F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")
    touched = {r.part for r in rows.select(part.alias("part")).distinct().collect()}  # of a fixed number of parts
    if touched:
        old = _read(spark, path, [r for r in last if r.part in touched])
        both = rows.withColumn("__new", F.lit(1))
        if old is not None:
            both = both.unionByName(old.select(*rows.columns).withColumn("__new", F.lit(0)))
        one = F.max_by(F.struct(*rows.columns), F.struct(*order, "__new")).alias("row")
        kept = both.groupBy(*[F.col(k).alias(f"__key{n}") for n, k in enumerate(key)]).agg(one).select("row.*").withColumn("part", part)
        kept.repartition("part").write.partitionBy("part").parquet(f"{path}/data/{folder}")
    now = [(version, batch, r.part, parts, r.folder) for r in last if r.folder is not None and r.part not in touched]
    now += [(version, batch, p, parts, folder) for p in sorted(touched)]
    told_now = spark.createDataFrame(now or [(version, batch, 0, parts, None)], VERSION)
    told_now.coalesce(1).write.mode("overwrite").json(f"{path}/versions/{version:09d}")  # one file, there at once when the job commits
    return version


def forget(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the last versions, and folders that none of those names; unfinished batches' too."""
    told = history(spark, path)
    if told is None:
        return
    numbers = sorted(r.version for r in told.select("version").distinct().collect())
    kept = numbers[-keep:]
    named = {r.folder for r in told.filter(F.col("version").isin(kept)).select("folder").distinct().collect()}
    jvm = spark._jvm
    place = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    files = place("data").getFileSystem(spark._jsc.hadoopConfiguration())
    for number in numbers[:-keep]:
        files.delete(place(f"versions/{number:09d}"), True)
    if files.exists(place("data")):
        for one in files.listStatus(place("data")):
            if one.getPath().getName() not in named:
                files.delete(one.getPath(), True)
