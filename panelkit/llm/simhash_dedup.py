"""SimHash near-dedup by the general pigeonhole principle.

64-bit fingerprints; bits that vary together form octets, chained octets form partitions; a dynamic program gives each
partition a threshold of its own, so that the thresholds (each plus one) add up to the distance plus one and the
estimated work is least. Fingerprints within the distance then agree in some partition up to its threshold, so
probing each partition with all values in that radius and verifying the whole distance finds every link.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.components import connected
from panelkit.shared import saved

SHINGLE_WORDS, MAX_BITS = 3, 3
CHUNK = 1 << 18  # shingles that are unpacked at a time


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of the words of an UTF-8 text, A-Z lower-cased; 0 without words."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(shingle, len(words))
    hash_of = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(words) - k + 1
    for a in range(0, n, CHUNK):
        b = min(n, a + CHUNK)
        h = np.array([hash_of(flat[s:e], 42) for s, e in zip(starts[a:b].tolist(), ends[a + k - 1:b + k - 1].tolist())], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and ``fp`` of each row."""
    schema = docs.select("doc_id").withColumn("fp", F.lit(0).cast("bigint")).schema

    def run(batches):
        for b in batches:
            texts = b.column("text")
            fp = [fingerprint(None if not t.is_valid else t.as_buffer().to_pybytes(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def octets(nodes: DataFrame) -> list[list[int]]:
    """The 64 bits in 8 groups, each grown from the pair that correlates most; counts cover all fingerprints."""

    def run(batches):
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            x = _bits(b.column("fp").to_numpy(zero_copy_only=False)).astype(np.float32)
            both += x.T @ x
            n += len(x)
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(both.ravel()[at], n).astype(np.int64))], names=["at", "c"])

    rows = nodes.select("fp").mapInArrow(run, "at bigint, c bigint").groupBy("at").agg(F.sum("c").alias("c")).collect()
    got = {r["at"]: r["c"] for r in rows}  # at most 64 * 64 + 1 sums
    n = max(got.get(-1, 0), 1)
    both = np.zeros(64 * 64)
    for at, c in got.items():
        if at >= 0:
            both[at] = c / n
    both = both.reshape(64, 64)
    p = np.diag(both)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, -1)
    left, groups = set(range(64)), []
    while left:
        rest = sorted(left)
        sub = corr[np.ix_(rest, rest)]
        i, j = divmod(int(sub.argmax()), len(rest))
        group = [rest[i], rest[j]]
        while len(group) < 8:
            group.append(max((b for b in rest if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        groups.append(sorted(group))
        left -= set(group)
    return groups


def distance_shares(nodes: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """For each octet the share of pairs at distance 0..8, from its histogram over all fingerprints."""
    fields = [F.struct(F.lit(g).alias("g"), sum(
        (F.shiftleft(F.getbit("fp", F.lit(bit)).cast("int"), i) for i, bit in enumerate(bits)), F.lit(0)).alias("v"))
        for g, bits in enumerate(groups)]
    rows = nodes.select(F.explode(F.array(*fields)).alias("x")).groupBy("x.g", "x.v").count().collect()  # <= 8 * 256
    counts = np.zeros((len(groups), 256))
    for r in rows:
        counts[r["g"], r["v"]] = r["count"]
    far = np.array([[bin(u ^ v).count("1") for v in range(256)] for u in range(256)])
    return [np.bincount(far.ravel(), np.outer(c, c).ravel(), 9) / max(c.sum() ** 2, 1) for c in counts]


def allocate(n: int, groups: list[list[int]], shares: list[np.ndarray], max_bits: int = MAX_BITS, ways=(2, 3, 4)):
    """Partitions (bits, threshold) of least estimated work: probes plus candidates; partitions without a probe are left out."""
    best = None
    for m in ways:
        cut = [round(i * len(groups) / m) for i in range(m + 1)]
        parts = [sorted(sum(groups[a:b], [])) for a, b in zip(cut, cut[1:])]
        cost = []
        for bits, a, b in zip(parts, cut, cut[1:]):
            near = np.ones(1)
            for s in shares[a:b]:  # octets taken as independent
                near = np.convolve(near, s)
            radius = [1]
            for t in range(1, max_bits + 1):
                radius.append(radius[-1] * (len(bits) - t + 1) // t)
            cost.append([0.0] + [2.0 * n * sum(radius[:t + 1]) + n * n / 2 * float(near[:t + 1].sum()) for t in range(max_bits + 1)])
        # table[b]: least cost and thresholds of the partitions so far that use up b of max_bits + 1
        table = {0: (0.0, ())}
        for c in cost:
            step: dict = {}
            for used, (total, chosen) in table.items():
                for t1 in range(max_bits + 2 - used):
                    now = (total + c[t1], (*chosen, t1 - 1))
                    if used + t1 not in step or now < step[used + t1]:
                        step[used + t1] = now
            table = step
        total, chosen = table[max_bits + 1]
        if best is None or total < best[0]:
            best = (total, [(bits, t) for bits, t in zip(parts, chosen) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _probe(p: int, mask: int, flips: list[int]) -> Column:
    values = F.array(*[F.lit(x).cast("bigint") for x in flips])
    return F.transform(values, lambda x: F.struct(
        F.lit(p).alias("p"), F.col("fp").bitwiseXOR(x).bitwiseAND(F.lit(mask).cast("bigint")).alias("v")))


def links(nodes: DataFrame, parts, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs a < b of different fingerprints at most ``max_bits`` apart; a pair may come up once for each partition."""
    index, probes = [], []
    for p, (bits, radius) in enumerate(parts):
        mask = _signed(sum(1 << b for b in bits))
        flips = [_signed(sum(1 << b for b in c)) for t in range(radius + 1) for c in combinations(bits, t)]
        index.append(F.struct(F.lit(p).alias("p"), F.col("fp").bitwiseAND(F.lit(mask).cast("bigint")).alias("v")))
        probes.append(_probe(p, mask, flips))
    have = nodes.select(F.col("fp").alias("a"), F.explode(F.array(*index)).alias("k")).select("a", "k.p", "k.v")
    seek = nodes.select(F.col("fp").alias("b"), F.explode(F.concat(*probes)).alias("k")).select("b", "k.p", "k.v")
    return have.join(seek, ["p", "v"]).where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, ``fp`` (signed) and ``component_id`` (smallest doc_id reachable over links) of each row of ``docs``.

    Needs columns doc_id and text; others are ignored. Null, empty and blank texts have fingerprint 0 and link like
    any other. Repeated rows come back as often; a null doc_id is in its component but never names it unless no
    other is there (then null). An empty table gives an empty result. Copies meet as one fingerprint before any
    pairing, so a group of copies of any size costs one probe. A text of any length is hashed whole, by one task.
    """
    fps = saved(fingerprints(docs, shingle), "fingerprints")
    nodes = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    n = nodes.count()
    groups = octets(nodes)
    parts = allocate(n, groups, distance_shares(nodes, groups), max_bits)
    label = connected(links(nodes, parts, max_bits))  # of fingerprints with a link: id -> component
    named = nodes.join(label, nodes.fp == label.id, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    final = saved(named.join(smallest, "component").select("fp", "component_id"), "components")
    return fps.join(final, "fp").select("doc_id", "fp", "component_id")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return simhash_dedup(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document that names it stays.

    Null, empty and blank texts are one component, of which one document stays. Rows of one id stay together, also where
    their texts differ; a null id stays only where its component has no other. An empty table stays empty, all columns pass through.
    """
    keep = simhash_dedup(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.alias("d").join(keep.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi")
