"""Helpers that the training-data operators share: tables, the shared folder, written tables.

Nothing here assumes a local disk: intermediate tables go to the folder the
cluster names in ``spark.checkpoint.dir`` and are reached by Spark readers and
writers only.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Number of rows up to which a keyed table of a few longs may be broadcast
#: (at 16 to 40 bytes a row: 40 MB at most). Callers count before they hint.
BROADCAST_ROWS = 1_000_000

_own: dict[str, str] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. A folder of our own only where that is unset and Spark runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="sitegrain-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    return f"file://{_own['dir']}"


class Workspace:
    """Written tables of one operator run, in a folder of its own below the shared folder.

    A written table cuts lineage: a lost executor costs a re-read, not a
    recomputation of everything before it. Results are read from these tables,
    so they stay until ``clear`` is called, when the results are written.
    """

    made: list[Workspace] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/sitegrain/{name}-{uuid.uuid4().hex}"
        Workspace.made.append(self)

    def write(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        df.write.option("compression", codec).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        """Delete one written table (or all), through the file system the path names."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def clear() -> None:
    """Delete what all operator runs of this process have written; call it once their results are written elsewhere."""
    while Workspace.made:
        Workspace.made.pop().drop()


def raw(col: str | Column) -> Column:
    """A string column as its UTF-8 bytes, null as empty: what Python workers get, so that bad UTF-8 can't fail a task."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def once(value: Column, make: Callable[[Column], Column]) -> Column:
    """An expression of a value that is worked out once, however often it occurs there."""
    return F.element_at(F.transform(F.array(value), make), 1)


def bucket_of(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, mod a number: the fold of a row; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def running(df: DataFrame, keys: list[str], order: list[str], work: Workspace, name: str, **what: tuple[Callable, Column]) -> DataFrame:
    """Adds running aggregates over each key's rows in an order, a row's own included: ``column=(F.sum or F.bit_xor, of what)``.

    A key's rows need not fit a task: rows are dealt by ranges of key and
    order and added up in each range; what the ranges before hold of a key, a
    row a key and range, comes on top. ``order`` should tell all rows of a key
    apart, as equal rows share a task. Needs no column named ``range``.
    """
    ranged = work.write(df.repartitionByRange(shuffle_partitions(work.spark), *keys, *order).withColumn("range", F.spark_partition_id()), name)
    inside = Window.partitionBy("range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range", *keys).agg(*[f(c).alias(n) for n, (f, c) in what.items()], F.lit(1).alias("__sg_one"))
    totals = totals.select("range", *keys, *[f(n).over(before).alias(f"__sg_{n}") for n, (f, _) in what.items()], F.sum("__sg_one").over(before).alias("__sg_on")).filter("__sg_on is not null").drop("__sg_on")
    rows = ranged.withColumns({n: f(c).over(inside) for n, (f, c) in what.items()}).join(totals, ["range", *keys], "left")
    own = {n: F.col(n).bitwiseXOR(F.coalesce(f"__sg_{n}", F.lit(0))) if f is F.bit_xor else F.col(n) + F.coalesce(f"__sg_{n}", F.lit(0)) for n, (f, _) in what.items()}
    return rows.withColumns(own).select(*df.columns, *what)
