"""Sending this package to the executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


#: Rows of an Arrow batch: texts and pages may be long, so batches are short (10,000 by default).
BATCH_ROWS = 512


#: Rows of narrow tables that a task should get of expensive work.
TASK_ROWS = 2048


def spread(rows: DataFrame) -> DataFrame:
    """The rows of a stored table dealt over all cores, for work that costs far more than their bytes.

    Files are cut by bytes, at most into row groups; a million narrow rows in
    one of them would be one task. The number of tasks follows the number of
    rows, which files tell without being read, up to the shuffle's partitions.
    """
    spark = rows.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    parts = min(most, -(-rows.count() // TASK_ROWS))
    return rows.repartition(parts) if parts > 1 else rows


def ship(spark: SparkSession) -> SparkSession:
    """Give executors this package, once a Spark context: Python workers import it, wherever the driver was started.

    Also shortens Arrow batches, where they have their default length.
    """
    context = spark.sparkContext
    if not getattr(context, "_sitegrain_shipped", False):
        root = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="sitegrain-zip-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = os.path.join(folder, "sitegrain.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for at, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(at, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(target)
        context._sitegrain_shipped = True
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark
