"""Tables a pipeline writes on its way, in the folder all executors share.

A written table cuts lineage: a lost executor costs a read, not a second parse
of its pages. The folder is the one the cluster names in
``spark.checkpoint.dir``; one of our own only where that is unset and Spark
runs on one machine.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="sitegrain-staged-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    return f"file://{_own['dir']}"


def workplace(spark: SparkSession, name: str) -> str:
    """A new folder's path that all executors share; ``clear`` deletes it."""
    path = f"{shared_folder(spark)}/sitegrain-staged/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written and to be read again column by column; ``clear`` deletes them once results are written."""
    spark = df.sparkSession
    path = workplace(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear() -> None:
    while _made:
        spark, path = _made.pop()
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
