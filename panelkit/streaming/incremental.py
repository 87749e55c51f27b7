"""Incremental ingest of landed panel files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def deduplicated(df: DataFrame, keys=("element", "fixture"), order: str = "seq") -> DataFrame:
    """One row for each key, the first by ``order``."""
    rows = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.col(order)).alias("_r"))
    return rows.select("_r.*").select(*df.columns)


def ingest_batch(base: DataFrame | None, new: DataFrame, keys=("element", "fixture"), order: str = "seq") -> DataFrame:
    """Rows of ``new``, one for each key, whose key ``base`` lacks."""
    rows = deduplicated(new, keys, order)
    return rows if base is None else rows.join(base.select(*keys).distinct(), list(keys), "left_anti").select(*new.columns)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def same_periods(spark: SparkSession, target: str, batch: DataFrame, period: str = "GW") -> DataFrame | None:
    """The rows of ``target``, a table partitioned by period, whose period the batch has; other partitions are not read."""
    if not _exists(spark, target):
        return None
    periods = [r[0] for r in batch.select(period).distinct().collect()]  # a value a period
    base = spark.read.parquet(target)
    known, missing = [p for p in periods if p is not None], None in periods
    return base.where(F.col(period).isin(known) | (F.col(period).isNull() if missing else F.lit(False)))


def append_once(batch: DataFrame, batch_id: int, target: str, ledger: str, keys=("element", "fixture"), order: str = "kickoff", period: str = "GW") -> bool:
    """Append the batch's new rows to ``target``; false if the ledger says that the batch is already there.

    A batch whose append ended without its entry in the ledger, as after a lost driver, is held against the target
    once more and adds only what is missing. The period must follow from the keys.
    """
    spark = batch.sparkSession
    entry = f"{ledger}/batch={batch_id}"
    if _exists(spark, f"{entry}/_SUCCESS"):
        return False
    base = same_periods(spark, target, batch, period)
    rows = ingest_batch(base, batch, keys, order)
    rows.repartition(period, F.pmod(F.xxhash64(*keys), F.lit(8))).write.mode("append").partitionBy(period).parquet(target)
    spark.range(1).select(F.lit(batch_id).alias("id")).write.mode("overwrite").parquet(entry)
    return True


def stream_panel(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys=("element", "fixture"), delay: str = "30 days",
                 order: str = "kickoff", row_keys=None):
    """Start the stream: CSV files landing in ``source`` are deduplicated and appended to ``target``, partitioned by GW.

    Redelivered rows add nothing: within the delay the stream's state drops rows that agree in ``row_keys`` (by default
    ``keys``), and each batch is held against the target's rows of its periods. Of a batch's rows with the same keys the
    first by ``order`` stays, of several batches' the first batch's. All files that are there are taken, then the query
    ends (available-now trigger); started again with the same checkpoint it goes on with the files that have come since.
    """
    rows = spark.readStream.schema(schema).option("header", True).csv(source)
    rows = rows.withWatermark("kickoff", delay).dropDuplicatesWithinWatermark(list(row_keys or keys))
    append = lambda batch, i: append_once(batch, i, target, f"{checkpoint}-ledger", keys, order)
    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
