"""Substring dedup of words with a compressed FM-index for each shard.

Distinct segments (see ``superwindows``) of a shard are indexed: Burrows-Wheeler transform in a wavelet matrix of
packed bits. All segments are streamed against their shard's index; backward search extends each match to the left
and stops where only the segment itself is left, and windows whose match reaches the window's length are reported
with their interval. Equal windows share an interval; all but the first in the corpus go.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import superwindows as sw
from panelkit.shared import discard, saved

WINDOW_WORDS = 20
GRAM_WORDS = 4
SHARD = 25_000     # segments to an index
CROWDED = 60_000   # an anchor with more distinct segments is counted window by window
BATCH = 1 << 18    # windows that are searched at a time

_known: dict[bytes, int] = {}


def read_words(text) -> np.ndarray:
    """64-bit hash of each word; bytes.split cuts at the six ASCII blanks that end a word."""
    import xxhash

    if len(_known) > 500_000:
        _known.clear()
    out = []
    for w in bytes(text).split():
        h = _known.get(w)
        if h is None:
            h = _known[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    return np.array(out, np.uint64)


def word_slices(text):
    """A function (starts, ends) -> words start..end of the text, joined by one space."""
    words = bytes(text).split()
    flat = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    return lambda start, end: [flat[a:b] for a, b in zip((ends - size)[start].tolist(), ends[end - 1].tolist())]


class FMIndex:
    """Backward search over strings of symbols, for patterns of up to ``depth`` symbols."""

    def __init__(self, strings: np.ndarray, sizes: np.ndarray, depth: int):
        self.alphabet, ranks = np.unique(strings, return_inverse=True)
        # 0 closes each string
        text = np.zeros(len(strings) + len(sizes), np.int64)
        ends = np.cumsum(sizes + 1) - 1
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = ranks + 1
        rank, reach, n = text.copy(), 1, len(text)
        while reach < depth:  # suffix order by doubling; deeper ties do not matter to patterns of this depth
            behind = np.zeros(n, np.int64)
            behind[:-reach] = rank[reach:] + 1
            key = rank * (n + len(self.alphabet) + 2) + behind
            order = np.argsort(key, kind="stable")
            step = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = step
            reach *= 2
        order = np.argsort(rank, kind="stable")
        bwt = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.alphabet) + 1))])
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.height = max(1, int(len(self.alphabet)).bit_length())
        for level in range(self.height - 1, -1, -1):
            bit = (bwt >> level & 1).astype(np.uint8)
            padded = np.zeros(-(-(n + 1) // 64) * 64, np.uint8)
            padded[:n] = bit
            packed = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))])
            zeros = n - int(bit.sum())
            self.levels.append((packed, ones, zeros))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])
        self.size = n

        # where each symbol's zero-th occurrence ends up below the last level
        self.floor = np.zeros(len(self.alphabet) + 1, np.int64)
        self._descend(np.arange(len(self.alphabet) + 1), self.floor)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.alphabet, words) + 1

    def _descend(self, c: np.ndarray, at: np.ndarray) -> None:
        for level, (packed, ones, zeros) in zip(range(self.height - 1, -1, -1), self.levels):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            r = ones[word] + np.bitwise_count(packed[word] & below)
            at[:] = np.where(c >> level & 1, zeros + r, at - r)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c stands before position i of the transform."""
        at = i.copy()
        self._descend(c, at)
        return at - self.floor[c]

    def search(self, text: np.ndarray, start: np.ndarray, length: int, least: int = 2):
        """(which, interval start) of the patterns text[start: start + length] that occur ``least`` times or more.

        All patterns go one symbol to the left at a time; patterns in the same state are looked up once.
        """
        alive = np.arange(len(start))
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), self.size, np.int64)
        for k in range(length - 1, -1, -1):
            c = text[start[alive] + k]
            _, one, back = np.unique(lo * len(self.before) + c, return_index=True, return_inverse=True)
            sym = c[one]
            both = self.rank(np.concatenate([sym, sym]), np.concatenate([lo[one], hi[one]]))
            new_lo, new_hi = self.before[sym] + both[:len(sym)], self.before[sym] + both[len(sym):]
            lo, hi = new_lo[back], new_hi[back]
            still = hi - lo >= least
            alive, lo, hi = alive[still], lo[still], hi[still]
            if not len(alive):
                break
        return alive, lo


def later_windows(words: np.ndarray, sizes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) pairs: the windows that stand earlier in the corpus in another segment; ``first`` has (doc, key, start) rows."""
    index = FMIndex(words, sizes, window)
    text = index.symbols(words)
    base = np.cumsum(sizes) - sizes
    counts = sizes - window + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at, start = [], []
    for a in range(0, len(owner), BATCH):  # stream the segments against the index
        hit, lo = index.search(text, base[owner[a:a + BATCH]] + offset[a:a + BATCH], window)
        at.append(hit + a)
        start.append(lo)
    at, start = np.concatenate(at), np.concatenate(start)
    seg, j = owner[at], offset[at]
    order = np.lexsort((first[seg, 2] + j, first[seg, 1], first[seg, 0], start))
    later = np.concatenate([[False], start[order][1:] == start[order][:-1]]) if len(order) else np.empty(0, bool)
    return seg[order[later]], j[order[later]]


def substring_dedup(docs: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS, shard: int = SHARD,
                    crowded: int = CROWDED) -> DataFrame:
    """Remove each word that a window of ``window`` words covers which also starts earlier in ``docs``.

    Earlier is a smaller doc_id (null is smallest), or an earlier start in the same row. Returns per row: doc_id
    (bigint), n_words, n_removed, kept_sha256. Rows with one doc_id and one text count as one text and come back alike;
    rows with one doc_id and different texts are ordered by the hash of their text. Null texts have no words, texts
    shorter than the window keep all; an empty table gives an empty result; columns besides doc_id and text are ignored.
    A text of any length is held by one task; in a text of short period, equal neighbouring segments travel as one.
    """
    texts = sw.keyed(docs)
    found = sw.repeated_segments(texts, read_words, word_slices, window, gram)
    distinct = sw.distinct_segments(found, with_first=True)
    few, many = sw.crowds(distinct, crowded)
    least = F.lit(-(1 << 63)).cast("bigint")

    def work(table):
        words = read_words(b" ".join(sw.texts_of(table.column("seg").combine_chunks())))
        sizes = sw.count_of(table.column("at").to_numpy()) + window - 1
        first = np.stack([table.column(c).to_numpy() for c in ("f_id", "f_key", "f_start")], axis=1)
        return later_windows(words, sizes, first, window)

    flags = sw.by_shard(few.select("gram", "digest", "at", "seg", F.coalesce("first.doc_id", least).alias("f_id"), F.col(
        "first.key").alias("f_key"), F.shiftright("first.at", 20).alias("f_start")), work, shard)
    single = sw.single_windows(many, word_slices, window).join(many.select("gram", "digest", "first"), ["gram", "digest"]).select(
        "gram", "digest", "j", "w", F.struct("first.doc_id", "first.key", (F.shiftright("first.at", 20) + F.col("j")).alias("start")).alias("place"))
    lead = single.groupBy("w").agg(F.min("place").alias("lead"))
    later = single.join(lead, "w").where(~F.col("place").eqNullSafe(F.col("lead")))
    flags = saved(flags.union(later.groupBy("gram", "digest").agg(F.collect_list("j").alias("gone"))), "window-flags")
    verdict = saved(distinct.select("gram", "digest", "n", "first").join(flags, ["gram", "digest"], "left").where(
        (F.col("n") > 1) | F.col("gone").isNotNull()).select("gram", "digest", "first", "gone"), "verdict")
    discard(distinct)
    is_first = F.struct("doc_id", "key", "at").eqNullSafe(F.col("first"))
    hits = found.select("doc_id", "key", "at", "reps", "gram", "digest").join(verdict, ["gram", "digest"])
    # of equal segments that follow one another only the first can be the first in the corpus; the others go whole
    whole = F.lit(None).cast("array<int>")
    part = lambda at, reps, gone: F.struct(at.alias("at"), reps.cast("int").alias("reps"), gone.alias("gone"))
    one, rest = F.lit(1), part(F.col("at") + F.shiftleft(F.shiftright("at", 10).bitwiseAND(1023), 20), F.col("reps") - 1, whole)
    pieces = F.when(is_first, F.array_compact(F.array(F.when(F.col("gone").isNotNull(), part(F.col("at"), one, F.col("gone"))), F.when(F.col("reps") > 1, rest)))).otherwise(
        F.array(part(F.col("at"), F.col("reps"), whole)))
    hits = hits.select("doc_id", "key", F.explode(pieces).alias("x")).select("doc_id", "key", "x.at", "x.reps", "x.gone")
    return sw.finished(texts, hits, cut_words(window), {"n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"})


def cut_words(window: int):
    def finish(text, start, count):
        words = bytes(text).split()
        gone = sw.covered(start, count, len(words), window)
        kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
        return len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()

    return finish


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
