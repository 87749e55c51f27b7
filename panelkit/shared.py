"""Tables that a job writes for itself, in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset and Spark runs in one local JVM (tests), a temporary folder is made and set for the session;
    on a cluster a missing setting is an error, because a machine-local folder would lose rows.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="panelkit-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def saved(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    # shuffle files go when the driver's collector finds their plan unused; otherwise those of all steps pile up
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def spread(df: DataFrame, least: int, uneven: float = 2.0) -> DataFrame:
    """The rows over as many tasks as run at once, ``least`` or more in each; ``df`` itself where none of its tasks holds more than ``uneven`` such shares.

    For work that is long for each row: few files or a filter may leave all rows in a few tasks.
    """
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]  # one row for each task
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, sum(rows) // least)
    return df if tasks < 2 or max(rows) <= uneven * sum(rows) / tasks else df.repartition(tasks)


def discard(table: DataFrame) -> None:
    """Delete a table made by ``saved`` that no later step reads."""
    discard_folder(table.sparkSession, table.saved_path)


def discard_folder(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def in_threads(spark: SparkSession, work, items: list, at_once: int) -> list:
    """``work`` on each item in threads, each in a scheduler pool of its own; results in the items' order."""
    def one(item):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", uuid.uuid4().hex)
        return work(item)

    if not items:
        return []
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(items)))) as pool:
        # wrapped one by one: threads of one wrapper share their properties, and so the pool that was named last
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(one), i) for i in items]]
