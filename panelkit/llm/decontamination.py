"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick some of the words in a short span and ignore the others, so a span with a substituted word still
hashes alike under a mask that skips it. Hashes of benchmark items and documents are joined; around each hit the two
texts are laid side by side and the aligned words compared. For each number of words that is compared, masks are added
until every admissible pattern of unequal words leaves some mask's words equal.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed masks: 1 is a word that counts, 0 one that is ignored.
MASKS = ("111111", "1110111", "11011011", "101110011", "1100110101")
OVERLAP_WORDS = 13      # aligned words that are compared; an item with fewer words is compared whole
SIMILARITY = 0.8        # share of them that must be equal
BLOCK_WORDS = 200_000   # benchmark words that are broadcast at a time
PIECE_WORDS = 5_000     # longer benchmark items are cut into overlapping pieces
TABLE_BITS = 22
ADDED_WORDS = 6         # words that count in an added mask, fewer where fewer are equal
MAX_PATTERNS = 20_000   # patterns of unequal words that are enumerated; beyond, a run of equal words is the seed

_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_WORD = "[^!-/:-@\\[-`{-~]"  # a character that word_hashes keeps
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


class _Words(dict):
    """Word hashes met so far, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(text: str | None, seen: _Words) -> np.ndarray:
    """64-bit hashes of the words of a text, lower-cased, without ASCII punctuation."""
    words = (text or "").lower().encode().translate(None, _PUNCTUATION).split()
    return np.array([seen[w] for w in words], np.uint64)


def seeds(h: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The hash under ``mask`` of the span from each word on."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, salt + 1, np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            out += h[i:i + n] * (_MULTIPLIERS[i % len(_MULTIPLIERS)] + np.uint64(2 * (i // len(_MULTIPLIERS))))
    out ^= out >> np.uint64(29)
    return out * np.uint64(0x9E3779B97F4A7C15)


def _meets(mask: str, need: int, unequal: tuple) -> bool:
    """Whether the mask, somewhere in a passage of ``need`` words, skips all words of ``unequal``."""
    return any(all(not 0 <= p - o < len(mask) or mask[p - o] == "0" for p in unequal) for o in range(need - len(mask) + 1))


@lru_cache(maxsize=256)
def masks_for(need: int, similarity: float = SIMILARITY, masks: tuple = MASKS) -> tuple:
    """The masks that fit ``need`` compared words, and more until every admissible pattern of unequal words is met."""
    unequal = need - max(0, ceil(similarity * need - 1e-9))
    equal = need - unequal
    out = [m for m in masks if len(m) <= need and m.count("1") <= equal]
    if equal == 0:  # no word need be equal, so no seed can find it
        return tuple(out)
    run = "1" * ceil(equal / (unequal + 1))  # so many equal words are always side by side
    if comb(need, unequal) > MAX_PATTERNS:
        return (*out, run)
    missed = [x for x in combinations(range(need), unequal) if not any(_meets(m, need, x) for m in out)]
    words = min(ADDED_WORDS, equal)
    spans = sorted({"".join("1" if i - c[0] in {j - c[0] for j in c} else "0" for i in range(c[0], c[-1] + 1))
                    for c in combinations(range(need), words)}, key=lambda m: (len(m), m)) if missed else []
    while missed:
        best = max(spans, key=lambda m: sum(_meets(m, need, x) for x in missed))
        out.append(best)
        missed = [x for x in missed if not _meets(best, need, x)]
    return tuple(out)


class _Block:
    """Seeds and words of some benchmark items, given as (id, text, whether it is part of a longer item)."""

    def __init__(self, items, masks, overlap: int, similarity: float):
        seen = _Words()
        # items, words and number of words compared: all of a shorter item, but not of a shorter part
        self.items = [(i, h, overlap if part else min(overlap, len(h))) for i, h, part in ((i, word_hashes(t, seen), p) for i, t, p in items)]
        self.items = [x for x in self.items if len(x[1]) >= x[2] > 0]
        wanted = [masks_for(need, similarity, tuple(masks)) for _, _, need in self.items]
        self.masks = list(dict.fromkeys(m for w in wanted for m in w))
        salt = {m: k for k, m in enumerate(self.masks)}
        found = [(seeds(h, m, salt[m]), salt[m], n) for n, ((_, h, _), w) in enumerate(zip(self.items, wanted)) for m in w]
        self.hash = np.concatenate([np.empty(0, np.uint64), *[s for s, _, _ in found]])
        self.item = np.concatenate([np.empty(0, np.int64), *[np.full(len(s), n) for s, _, n in found]]).astype(np.int64)
        self.pos = np.concatenate([np.empty(0, np.int64), *[np.arange(len(s)) for s, _, _ in found]]).astype(np.int64)
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.item, self.pos = self.hash[order], self.item[order], self.pos[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.hash >> np.uint64(64 - TABLE_BITS)] = True

    def overlaps(self, h: np.ndarray, similarity: float) -> list[tuple]:
        """(item id, words aligned, words equal, first word in the document) of the best overlap with each item."""
        lanes = set()
        for k, m in enumerate(self.masks):
            s = seeds(h, m, k)
            at = np.flatnonzero(self.table[s >> np.uint64(64 - TABLE_BITS)])
            lo, hi = np.searchsorted(self.hash, s[at], "left"), np.searchsorted(self.hash, s[at], "right")
            for i, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                lanes.update(zip(self.item[a:b].tolist(), (i - self.pos[a:b]).tolist()))
        best: dict[int, tuple] = {}
        for item, lane in lanes:
            key, words, need = self.items[item]
            a, b = max(0, lane), min(len(h), lane + len(words))
            if b - a < need:
                continue
            same = np.concatenate([[0], np.cumsum(h[a:b] == words[a - lane:b - lane])])
            score = same[need:] - same[:-need]
            top = int(score.argmax())
            if score[top] >= similarity * need - 1e-9:
                now = (need, int(score[top]), a + top)
                if key not in best or (now[1] / now[0], -now[2]) > (best[key][1] / best[key][0], -best[key][2]):
                    best[key] = now
        return [(k, *v) for k, v in best.items()]


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, masks=MASKS, overlap: int = OVERLAP_WORDS,
                       similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, n_aligned, n_equal, doc_start of every document and benchmark item that share a passage.

    A passage is ``overlap`` aligned words (all words of a shorter item) of which ``similarity`` or more are equal;
    ``masks_for`` adds to ``masks`` so that each is found, so an item of one word meets every document with that word.
    The benchmark is the stated query set: it is read in blocks of about ``block_words`` words, each broadcast and held
    against all documents, so its size is not limited. Null and empty texts match nothing, texts of any
    length are searched whole by one task. A pair comes once, at
    its best overlap; repeated rows of an id come once. Null ids are kept as ids; other columns are ignored. Empty
    tables give an empty result.
    """
    spark = docs.sparkSession
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda w: w.rlike(_WORD))
    parts = benchmark.select("item_id", words.alias("w")).where(F.size("w") > 0)
    total = parts.agg(F.sum(F.size("w")).alias("n")).first()["n"] or 0
    # each passage of an item lies in one piece, and no piece is shorter than a passage
    parts = parts.select("item_id", (F.size("w") - overlap >= PIECE_WORDS).alias("part"), F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - overlap, F.lit(0)), F.lit(PIECE_WORDS)),
        lambda s: F.array_join(F.slice("w", s + 1, PIECE_WORDS + overlap), " "))).alias("text"))
    n_blocks = max(1, -(-total // block_words))
    parts = parts.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    doc_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = (f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, n_aligned int, n_equal int, doc_start bigint")
    found = None
    for b in range(n_blocks):
        rows = parts.where(F.col("_block") == b).select("item_id", "text", "part").collect()  # about block_words words
        block = spark.sparkContext.broadcast(_Block([(r["item_id"], r["text"], r["part"]) for r in rows], masks, overlap, similarity))

        def run(batches, block=block):
            seen, test = _Words(), block.value
            for batch in batches:
                at, out = [], []
                for i, text in enumerate(batch.column("text")):
                    hits = test.overlaps(word_hashes(text.as_py(), seen), similarity)
                    at += [i] * len(hits)
                    out += hits
                cols = list(zip(*out)) or [()] * 4
                arrow = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at, pa.int32())), pa.array(cols[0], item_arrow),
                     pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64())],
                    names=["doc_id", "item_id", "n_aligned", "n_equal", "doc_start"])
                yield arrow

        from pyspark.sql.pandas.types import to_arrow_type

        item_arrow = to_arrow_type(item_type)
        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        (F.col("n_equal") / F.col("n_aligned")).alias("r"), (-F.col("doc_start")).alias("s"), "n_aligned", "n_equal")).alias("x")).select(
        "doc_id", "item_id", "x.n_aligned", "x.n_equal", (-F.col("x.s")).alias("doc_start"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return benchmark_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that share a passage with a benchmark item go.

    Null and empty texts stay; all rows of an id go together, also those of a null id; an empty table or benchmark drops nothing;
    all columns pass through.
    """
    found = benchmark_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = found.select("doc_id").distinct()
    return docs.alias("d").join(bad.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")), "left_anti")
