"""Suffix-array dedup of bytes by a column-wise construction over many strings.

The strings (segments of equal-content anchors, see ``superwindows``) lie side by side at their anchors. Each round
inserts one symbol in front of every string's suffix and updates the suffix order, the column of the Burrows-Wheeler
transform and the common prefixes from those of the round before. Only the state of one round is held; symbols,
order, transform and prefixes pass through files that are read and written in sequence. Neighbours in the order whose
common prefix reaches the window hold the same bytes.
"""

from __future__ import annotations

import hashlib
import tempfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import superwindows as sw
from panelkit.shared import discard, saved

WINDOW_BYTES = 200
GRAM_BYTES = 32
SHARD = 25_000     # strings that are built together
CROWDED = 40_000   # an anchor with more distinct strings is counted window by window


def read_bytes(text) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def byte_slices(text):
    text = bytes(text)
    return lambda start, end: [text[a:b] for a, b in zip(start.tolist(), end.tolist())]


def _range_minima(prefix: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """min(prefix[i + 1 .. j]) for each pair i < j."""
    size = j - i
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(i), prefix.dtype)
    table, step = prefix, 1
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[i[at] + 1], table[j[at] - step + 1])
        table = np.minimum(table[:-step], table[step:])
        step *= 2
    return out


def column_rounds(columns: Path, n: int, rounds: int, folder: Path, limit: int):
    """Insert one symbol for each of n strings a round, last column first; yields (round, order, common prefixes).

    ``columns`` holds the symbols (uint16, 0: none) by round. ``order`` lists the strings by the suffix that starts at
    the round's column, ``prefixes`` has what each shares with the one before it, up to ``limit``.
    """
    # opened once and written over in place: a file cut to nothing and written anew is flushed to the disk when it is closed
    with open(columns, "rb") as symbols, open(folder / "old", "w+b", 0) as old, open(folder / "new", "w+b", 0) as new:
        column = np.fromfile(symbols, np.uint16, n)  # the symbols in front of the empty suffixes
        for state in (np.arange(n, dtype=np.int32), np.zeros(n, np.int16), column):
            state.tofile(old)
        for r in range(rounds):
            old.seek(0)
            new.seek(0)
            order, prefix, bwt = (np.fromfile(old, t, n) for t in (np.int32, np.int16, np.uint16))
            put = np.argsort(bwt, kind="stable")  # symbol by symbol, each in the order of the suffixes behind it
            symbol = bwt[put]
            shared = np.zeros(n, np.int16)
            at = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] > 0)) + 1
            if len(at):
                shared[at] = np.minimum(_range_minima(prefix, put[at - 1], put[at]) + 1, limit)
            order = order[put]
            column = np.fromfile(symbols, np.uint16, n) if r + 1 < rounds else np.zeros(n, np.uint16)
            for state in (order, shared, column[order]):
                state.tofile(new)
            yield r, order, shared
            old, new = new, old


def repeated_windows(flat: np.ndarray, at: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, window) pairs: the windows whose symbols another string has, too.

    ``flat`` has the strings one after another, ``at`` their packed places; they are laid side by side at their anchors.
    """
    n, span = len(at), window - gram + 1
    count, shift = sw.count_of(at), sw.shift_of(at)
    size = count + window - 1
    base = np.cumsum(size) - size
    rounds = window + span - 1  # columns -(span - 1) .. window - 1 from the anchor on
    string, place = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    with tempfile.TemporaryDirectory() as name:
        folder = Path(name)
        part = max(1, (1 << 22) // max(n, 1))
        with open(folder / "columns", "wb") as f:  # from the last column to the first
            for top in range(window - 1, -span, -part):
                x = np.arange(top, max(top - part, -span), -1)[:, None] + shift[None, :]
                there = (x >= 0) & (x < size[None, :])
                block = np.zeros(x.shape, np.uint16)
                block[there] = flat[(x + base[None, :])[there]].astype(np.uint16) + 1
                block.tofile(f)
        for r, order, shared in column_rounds(folder / "columns", n, rounds, folder, window):
            x = window - 1 - r
            if x > 0:
                continue
            full = shared >= window
            full[:-1] |= full[1:]
            i = order[full].astype(np.int64)
            j = x + shift[i]
            good = (j >= 0) & (j < count[i])
            string.append(i[good])
            place.append(j[good])
    return np.concatenate(string), np.concatenate(place)


def suffix_dedup(docs: DataFrame, window: int = WINDOW_BYTES, gram: int = GRAM_BYTES, shard: int = SHARD,
                 crowded: int = CROWDED) -> DataFrame:
    """Remove each byte that a ``window``-byte string covers which also starts anywhere else in ``docs``.

    Returns per row: doc_id (bigint), n_bytes, n_removed, n_spans, kept_sha256. Every row is a text of its own, so a
    repeated row or a copy under another id loses all bytes that its windows cover; texts are judged on the input and
    matches never cross rows. Null texts count as empty, texts shorter than the window keep all bytes. A null doc_id
    is an id like others; an empty table gives an empty result; columns besides doc_id and text are ignored. A text of any
    length is held by one task; in a text of short period, equal neighbouring segments travel as one.
    """
    texts = sw.keyed(docs)
    found = sw.repeated_segments(texts, read_bytes, byte_slices, window, gram)
    distinct = sw.distinct_segments(found, with_first=False)
    few, many = sw.crowds(distinct, crowded)

    def work(table):
        flat = np.frombuffer(b"".join(sw.texts_of(table.column("seg").combine_chunks())), np.uint8)
        segment, j = repeated_windows(flat, table.column("at").to_numpy(), window, gram)
        alone = table.column("n").to_numpy()[segment] == 1  # a string that occurs twice goes whole
        return segment[alone], j[alone]

    flags = sw.by_shard(few.select("gram", "digest", "at", "n", "seg"), work, shard)
    single = sw.single_windows(many, byte_slices, window)
    twice = single.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    flags = saved(flags.union(single.join(twice, "w").groupBy("gram", "digest").agg(F.collect_list("j").alias("gone"))), "window-flags")
    verdict = saved(distinct.select("gram", "digest", "n").join(flags, ["gram", "digest"], "left").where(
        (F.col("n") > 1) | F.col("gone").isNotNull()).select("gram", "digest", F.when(F.col("n") == 1, F.col("gone")).alias("gone")), "verdict")
    discard(distinct)
    hits = found.select("doc_id", "key", "at", "reps", "gram", "digest").join(verdict, ["gram", "digest"])
    return sw.finished(texts, hits, cut_bytes(window), {
        "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"})


def cut_bytes(window: int):
    def finish(text, start, count):
        gone = sw.covered(start, count, len(text), window)
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        return len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()

    return finish


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
