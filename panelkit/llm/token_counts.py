"""Token counts of flat, unindexed token files by scanning for the end-of-document id.

A flat file is ids of fixed width, one after another, each document closed by the end id; nothing says where documents
lie. Blocks of a file are scanned on their own, as vectors; a prefix scan over the blocks' sums stitches the documents
that cross block boundaries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm import tokens
from panelkit.shared import saved

BLOCK_BYTES = 1 << 20
#: Blocks of a file that one task scans; groups are then scanned by their sums.
GROUP = 4096
END_ID = 50256


def token_files(docs: DataFrame, path: str, end_id: int = END_ID, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Flat token files of ``docs``, one for each input partition, as a stored table of blocks.

    Rows with ``content`` are blocks (file, block); rows with ``ordinal`` are the manifest (file, ordinal, doc_id):
    which document is the file's n-th. Blocks end where they are full, inside a document as well as between two. The
    end id's string in a text is encoded as text, so the id only ends documents. An id that ``dtype`` cannot hold raises an error.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["file", "block", "content", "ordinal", "doc_id"]

    def run(batches):
        file, block, ordinal, buffer = TaskContext.get().partitionId(), 0, 0, bytearray()
        id_type = None

        def blocks(parts):
            nonlocal block
            n = len(parts)
            out = pa.RecordBatch.from_arrays([pa.array([file] * n, pa.int64()), pa.array(range(block, block + n), pa.int64()), pa.array(parts, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, id_type)], names=names)
            block += n
            return out

        for b in batches:
            id_type = b.column("doc_id").type
            for text in b.column("text"):
                ids = tokens.ids_of(path, text.as_py(), end_id, special=False)
                if ids.max() > np.iinfo(dtype).max:
                    raise ValueError(f"id {ids.max()} does not fit into {dtype}")
                buffer += ids.astype(dtype).tobytes()
                while len(buffer) >= block_bytes:
                    yield blocks([bytes(buffer[:block_bytes])])
                    del buffer[:block_bytes]
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([file] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(range(ordinal, ordinal + n), pa.int64()), b.column("doc_id")], names=names)
            ordinal += n
        if buffer:
            yield blocks([bytes(buffer)])

    return docs.select("doc_id", "text").mapInArrow(run, f"file bigint, block bigint, content binary, ordinal bigint, doc_id {kind}")


def read_token_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of the flat files under ``path``; ``file`` is the file's path. Each file is read whole by one task (at most 2 GB)."""
    whole = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    return whole.select("file", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.length("content") - 1) / block_bytes), F.lit(0)).cast("int")),
        lambda i: F.substring("content", i * block_bytes + 1, F.lit(block_bytes)))).alias("block", "content"))


def token_counts(blocks: DataFrame, end_id: int = END_ID, dtype: str = "<u2") -> DataFrame:
    """file, ordinal, start, n_tokens, closed of each document of flat token files given as blocks (file, block, content).

    ``start`` counts ids from the file's first; ``n_tokens`` leaves out the end id. Ids after a file's last end id make
    a last document that is not ``closed``; a document without ids counts 0. Null or empty blocks hold nothing; blocks
    need whole ids, else an error is raised; an empty table gives an empty result; other columns are ignored. A block
    number must come once in a file.
    """
    kind = blocks.schema["file"].dataType.simpleString()

    def scan(batches):
        for b in batches:
            size, ends = [], []
            for c in b.column("content"):
                ids = np.frombuffer(c.as_buffer(), dtype) if c.is_valid else np.empty(0, dtype)
                size.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id))
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array(size, pa.int64()), pa.array(ends, pa.list_(pa.int64()))], names=["file", "block", "size", "ends"])

    scanned = saved(blocks.select("file", F.col("block").cast("bigint").alias("block"), "content").mapInArrow(
        scan, f"file {kind}, block bigint, size bigint, ends array<bigint>"), "block-ends")
    # the scan sees three numbers of each block, first within groups of blocks, then over the groups' sums
    sums = scanned.select("file", "block", "size", F.size("ends").alias("n"), F.get("ends", F.size("ends") - 1).alias("end"), F.floor(F.col("block") / GROUP).alias("group"))
    w = Window.partitionBy("file", "group").orderBy("block")
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    inner = sums.withColumn("base", F.coalesce(F.sum("size").over(prior), F.lit(0))).withColumn("done", F.coalesce(F.sum("n").over(prior), F.lit(0)))
    inner = inner.withColumn("after", F.col("base") + F.col("end") + 1).withColumn("open", F.max("after").over(prior))
    per_group = inner.groupBy("file", "group").agg(F.sum("size").alias("g_size"), F.sum("n").alias("g_n"), F.max("after").alias("g_after"), F.max("block").alias("g_last"))
    g = Window.partitionBy("file").orderBy("group")
    before = g.rowsBetween(Window.unboundedPreceding, -1)
    per_group = per_group.withColumn("g_base", F.coalesce(F.sum("g_size").over(before), F.lit(0))).withColumn("g_done", F.coalesce(F.sum("g_n").over(before), F.lit(0)))
    per_group = per_group.withColumn("g_open", F.coalesce(F.max(F.col("g_base") + F.col("g_after")).over(before), F.lit(0))).withColumn(
        "last", F.when(F.lead("group").over(g).isNull(), F.col("g_last"))).select(
        F.col("file").alias("g_file"), F.col("group").alias("g_group"), "g_base", "g_done", "g_open", "last")
    placed = inner.join(per_group, F.col("file").eqNullSafe(F.col("g_file")) & F.col("group").eqNullSafe(F.col("g_group"))).select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), (F.col("base") + F.col("g_base")).alias("base"), (F.col("done") + F.col("g_done")).alias("done"),
        F.coalesce(F.col("open") + F.col("g_base"), F.col("g_open")).alias("open"), F.coalesce(F.col("block") == F.col("last"), F.lit(False)).alias("last"))
    stitched = scanned.join(placed, F.col("file").eqNullSafe(F.col("_file")) & F.col("block").eqNullSafe(F.col("_block")))
    closed = F.transform("ends", lambda e, i: F.struct(
        (F.col("done") + i).alias("ordinal"),
        F.when(i == 0, F.col("open")).otherwise(F.col("base") + F.get("ends", i - 1) + 1).alias("start"),
        (F.col("base") + e).alias("stop"), F.lit(True).alias("closed")))
    tail_start = F.when(F.size("ends") > 0, F.col("base") + F.get("ends", F.size("ends") - 1) + 1).otherwise(F.col("open"))
    tail = F.when(F.col("last") & (tail_start < F.col("base") + F.col("size")), F.array(F.struct(
        (F.col("done") + F.size("ends")).alias("ordinal"), tail_start.alias("start"),
        (F.col("base") + F.col("size")).alias("stop"), F.lit(False).alias("closed")))).otherwise(F.array())
    return stitched.select("file", F.explode(F.concat(closed, tail)).alias("d")).select(
        "file", "d.ordinal", "d.start", (F.col("d.stop") - F.col("d.start")).alias("n_tokens"), "d.closed")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the documents' ids to flat files, scan the files, and name the documents by the manifest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    files = saved(token_files(docs, tokens.default_path()), "token-files", "zstd")
    counts = token_counts(files.where(F.col("content").isNotNull()))
    names = files.where(F.col("ordinal").isNotNull()).select("file", "ordinal", "doc_id")
    return names.join(counts, ["file", "ordinal"], "left").select("doc_id", "n_tokens", "start", "closed")
