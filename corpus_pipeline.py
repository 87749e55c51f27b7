"""Corpus pipeline: quality rules, line dedup, near dedup, decontamination, packing, each over all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm.best_fit_packing import packing_stage
from panelkit.llm.decontamination import decontamination_stage
from panelkit.llm.line_dedup import line_stage
from panelkit.llm.quality_rules import quality_stage
from panelkit.llm.simhash_dedup import simhash_stage
from panelkit.shared import shared_dir

STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: Fingerprints, token ids and seed hashes have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what each returns is written to the shared folder and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
