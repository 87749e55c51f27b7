"""Windows of k symbols, dealt out by content so that equal windows meet.

Every window has an anchor: its gram of w symbols with the smallest hash (the leftmost of equal ones). Neighbouring
windows mostly share their anchor, so a run of them travels as one segment; equal windows have equal anchors at equal
offsets, so they meet under the anchor's hash, laid side by side at the anchor. Segments whose anchor occurs once in
the corpus hold no repeated window and are never moved; equal segments are counted before they are moved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.shared import discard, saved

CHUNK = 1 << 19          # windows that are cut at a time; positions inside a chunk take 20 bits
_LOW = np.uint64((1 << 20) - 1)
PIECE = 1 << 14          # segments that are cut out of a text at a time


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` symbols (a power of two) from each position on, by doubling."""
    h, size, factor = symbols.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:] if len(h) > size else h[:0]
        size, factor = 2 * size, (factor * factor + 2 * size) % (1 << 64) | 1
    return _mixed(h)


def _repeats(symbols: np.ndarray, start, count, shift, anchor, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(first of each run of neighbouring equal segments, length of the run): in a text of short period they follow one another."""
    same = (count[1:] == count[:-1]) & (shift[1:] == shift[:-1]) & (anchor[1:] == anchor[:-1])
    pairs = np.flatnonzero(same)
    for c in np.unique(count[pairs]).tolist():  # the next segment starts ``c`` symbols on
        differs = np.concatenate([[0], np.cumsum(symbols[c:] != symbols[:-c])])
        at = pairs[count[pairs] == c]
        same[at] = differs[start[at] + c + window - 1] == differs[start[at]]
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    return first, np.diff(np.append(first, len(start)))


def segment_runs(symbols: np.ndarray, window: int, gram: int):
    """(start, count, shift, anchor hash, repeats) arrays of each chunk: runs of ``count`` windows from ``start`` on with the
    anchor ``shift`` symbols after the start; ``repeats`` equal segments, each ``count`` symbols after the one before, are one."""
    span, n = window - gram + 1, len(symbols) - window + 1
    for base in range(0, max(n, 0), CHUNK):
        m = min(CHUNK, n - base)
        g = gram_hashes(symbols[base:base + m + window - 1], gram)
        low = (g & ~_LOW) | np.arange(len(g), dtype=np.uint64)
        size = 1
        while 2 * size <= span:
            low, size = np.minimum(low[:-size], low[size:]), 2 * size
        if size < span:
            low = np.minimum(low[:size - span], low[span - size:])
        start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        at = (low[start] & _LOW).astype(np.int64)
        count, shift, anchor = np.diff(np.append(start, m)), at - start, g[at].view(np.int64)
        first, repeats = _repeats(symbols[base:base + m + window - 1], start, count, shift, anchor, window)
        yield start[first] + base, count[first], shift[first], anchor[first], repeats


def segments(symbols: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """The arrays of ``segment_runs`` over all chunks."""
    return tuple(np.concatenate(x) for x in zip(*[(np.empty(0, np.int64),) * 5, *segment_runs(symbols, window, gram)]))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id (bigint), key and the text as bytes; a null text as an empty one.

    A row is told by doc_id and key; key is 0 where a doc_id comes once, else the hash of the row's text.
    """
    # texts travel to Python in batches of this many rows, several of which are held at a time
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # stored, so that its size is known when the joins with it are planned
    many = saved(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("m_id"), F.lit(True).alias("many")), "repeated-ids")
    return docs.join(many, same("doc_id", "m_id"), "left").select(
        "doc_id", F.when(F.col("many"), F.xxhash64("text")).otherwise(F.lit(0).cast("bigint")).alias("key"), F.col("text").cast("binary").alias("text"))


def texts_of(column) -> list[memoryview]:
    """The bytes of an Arrow binary column without nulls."""
    if column.type == pa.large_binary():
        column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[a:b] for a, b in zip(at, at[1:])]


def same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


# Where a segment lies: start, count and shift in one number that sorts by start; both counts are below 1024.

def _packed(start, count, shift):
    return start << 20 | count << 10 | shift


def start_of(at):
    return at >> 20


def count_of(at):
    return at >> 10 & 1023


def shift_of(at):
    return at & 1023


def repeated_segments(docs: DataFrame, read, slices, window: int, gram: int) -> DataFrame:
    """Stored table of all segments whose anchor occurs more than once.

    ``docs`` is ``keyed``; ``read(text)`` makes an array of symbols, ``slices(text)`` a function (starts, ends) -> the bytes
    of symbol ranges. Columns: doc_id, key, at (packed place), reps (how many equal segments follow one another from there
    on), gram (anchor hash), digest (64-bit hash of the bytes; read together with gram) and seg (the bytes).
    """
    if not 0 < gram <= window < 1024:
        raise ValueError("windows must have fewer than 1024 symbols and hold a gram")

    def cut(batches):
        for b in batches:
            row, parts = [], []
            for i, t in enumerate(texts_of(b.column("text"))):
                for start, count, shift, g, reps in segment_runs(read(t), window, gram):
                    row.append(np.full(len(start), i, np.int32))
                    parts.append((_packed(start, count, shift), g, reps))
                if parts and (i + 1 == b.num_rows or sum(map(len, row)) > 1 << 18):
                    rows = pa.array(np.concatenate(row))
                    at, g, reps = (np.concatenate(x) for x in zip(*parts))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(rows), b.column("key").take(rows), pa.array(at), pa.array(g), pa.array(reps.astype(np.int32))],
                        names=["doc_id", "key", "at", "gram", "reps"])
                    row, parts = [], []

    anchors = saved(docs.mapInArrow(cut, "doc_id bigint, key bigint, at bigint, gram bigint, reps int"), "anchors")
    # stored, so that the join below sees two plain tables and can split a gram that very many segments have
    again = saved(anchors.groupBy("gram").agg(F.sum("reps").alias("n")).where("n > 1").select("gram"), "grams")
    wanted = saved(anchors.join(again, "gram").groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("at", "gram", "reps")).alias("want")).toDF("w_id", "w_key", "want"), "wanted")
    discard(anchors)
    discard(again)

    def fetch(batches):
        import xxhash

        names = ["doc_id", "key", "at", "reps", "gram", "digest", "seg"]
        for b in batches:
            want = b.column("want")
            rows, offsets = want.flatten(), (want.offsets.to_numpy() - want.offsets[0].as_py()).tolist()
            at = rows.field("at").to_numpy()
            begin = start_of(at)
            end = begin + count_of(at) + window - 1
            owner = np.repeat(np.arange(b.num_rows, dtype=np.int32), np.diff(offsets))
            held, weight, first = [], 0, 0
            for i, t in enumerate(texts_of(b.column("text"))):
                cut_out = slices(t)
                # segments take several times the text's room, so batches go by bytes, within a text as well
                for a in range(offsets[i], offsets[i + 1], PIECE):
                    z = min(a + PIECE, offsets[i + 1])
                    held += (more := cut_out(begin[a:z], end[a:z]))
                    weight += sum(map(len, more))
                    if weight > 1 << 23 or z == len(at):
                        row, part = pa.array(owner[first:z]), rows.slice(first, z - first)
                        digest = np.fromiter(map(xxhash.xxh3_64_intdigest, held), np.uint64, len(held)).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [b.column("doc_id").take(row), b.column("key").take(row), part.field("at"), part.field("reps"), part.field("gram"),
                             pa.array(digest), pa.array(held, pa.binary())], names=names)
                        held, weight, first = [], 0, z

    found = docs.join(wanted, same("doc_id", "w_id") & (F.col("key") == F.col("w_key"))).select("doc_id", "key", "text", "want")
    out = saved(found.mapInArrow(fetch, "doc_id bigint, key bigint, at bigint, reps int, gram bigint, digest bigint, seg binary"), "segments", "zstd")
    discard(wanted)
    return out


def distinct_segments(found: DataFrame, with_first: bool) -> DataFrame:
    """Stored table of distinct segments: gram, digest, n (how often it occurs), at (of any), seg, and first (its first place)."""
    first = [F.min(F.struct("doc_id", "key", "at")).alias("first")] if with_first else []
    return saved(found.groupBy("gram", "digest").agg(
        F.sum("reps").alias("n"), F.first("at").alias("at"), F.first("seg").alias("seg"), *first), "distinct-segments", "zstd")


def crowds(distinct: DataFrame, crowded: int) -> tuple[DataFrame, DataFrame]:
    """The distinct segments of anchors with up to ``crowded`` of them, and of anchors with more."""
    hot = saved(distinct.groupBy("gram").agg(F.count("*").alias("d")).where(F.col("d") > crowded).select("gram"), "crowded")
    return distinct.join(hot, "gram", "left_anti"), distinct.join(hot, "gram", "left_semi")


def by_shard(rows: DataFrame, work, shard: int) -> DataFrame:
    """gram, digest, gone of ``rows``: ``work`` gets tables of whole anchors, about ``shard`` rows or one anchor, streamed by anchor."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(x.num_rows for x in held) >= shard:
                table = pa.Table.from_batches(held).combine_chunks()
                g = table.column("gram").to_numpy()
                cut = int(np.searchsorted(g, g[-1]))  # the last anchor may go on
                if cut:
                    yield from marked(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield from marked(pa.Table.from_batches(held).combine_chunks())

    def marked(table):
        _, group, size = np.unique(table.column("gram").to_numpy(), return_inverse=True, return_counts=True)
        table = table.take(pa.array(np.flatnonzero(size[group] > 1)))  # a lone segment differs from nothing
        if not table.num_rows:
            return
        segment, window = work(table.combine_chunks())
        order = np.lexsort((window, segment))
        segment, window = segment[order], window[order]
        at, first = np.unique(segment, return_index=True)
        if len(at):
            offsets = pa.array(np.append(first, len(segment)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [table.column(c).combine_chunks().take(pa.array(at)) for c in ("gram", "digest")]
                + [pa.ListArray.from_arrays(offsets, pa.array(window.astype(np.int32)))], names=["gram", "digest", "gone"])

    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "gram bigint, digest bigint, gone array<int>")


def single_windows(rows: DataFrame, slices, window: int) -> DataFrame:
    """The windows of segments, each on its own: gram, digest, j (window of the segment), w (128-bit digest of the window)."""

    def run(batches):
        import xxhash

        for b in batches:
            count = count_of(b.column("at").to_numpy())
            segs = texts_of(b.column("seg"))
            for a in range(0, len(segs), 200):
                n = count[a:a + 200]
                row = pa.array(np.repeat(np.arange(a, a + len(n), dtype=np.int32), n))
                ws = [xxhash.xxh3_128_digest(x) for s, m in zip(segs[a:a + 200], n.tolist()) for x in slices(s)(np.arange(m), np.arange(m) + window)]
                j = np.concatenate([np.arange(m, dtype=np.int32) for m in n])
                yield pa.RecordBatch.from_arrays(
                    [b.column("gram").take(row), b.column("digest").take(row), pa.array(j), pa.array(ws, pa.binary())], names=["gram", "digest", "j", "w"])

    return rows.select("gram", "digest", "seg", "at").mapInArrow(run, "gram bigint, digest bigint, j int, w binary")


def covered(start: np.ndarray, count: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n symbols a window covers; runs of ``count`` windows begin at ``start``."""
    edge = np.bincount(start, minlength=n + 1) - np.bincount(np.minimum(n, start + count + window - 1), minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def finished(docs: DataFrame, hits: DataFrame, finish, results: dict[str, str]) -> DataFrame:
    """doc_id and ``results`` (name: type) of ``finish(text, starts, counts)`` for every row of ``docs``.

    ``hits`` has doc_id, key, at, reps (equal segments from there on) and gone (which windows of the segment; null: all of all).
    """
    per = hits.groupBy("doc_id", "key").agg(F.collect_list(F.struct("at", "reps", "gone")).alias("hits")).toDF("h_id", "h_key", "hits")
    rows = docs.join(per, same("doc_id", "h_id") & (F.col("key") == F.col("h_key")), "left").select(
        "doc_id", "text", F.coalesce("hits", F.array().cast("array<struct<at:bigint,reps:int,gone:array<int>>>")).alias("hits"))
    kinds = {"bigint": pa.int64(), "string": pa.string()}

    def run(batches):
        for b in batches:
            h = b.column("hits")
            marks, bound = h.flatten(), (h.offsets.to_numpy() - h.offsets[0].as_py()).tolist()
            at, reps, lists = marks.field("at").to_numpy(), marks.field("reps").to_numpy(), marks.field("gone")
            whole = lists.is_null().to_numpy(zero_copy_only=False)
            js = lists.flatten().to_numpy()
            size = np.where(whole, 0, lists.value_lengths().fill_null(0).to_numpy())
            ends = np.cumsum(size)
            out = []
            for i, t in enumerate(texts_of(b.column("text"))):
                s = slice(bound[i], bound[i + 1])
                w, a, m = whole[s], at[s], size[s]
                single = np.repeat(start_of(a), m) + js[ends[s][0] - m[0]:ends[s][-1]] if len(a) else a
                out.append(finish(t, np.concatenate([start_of(a)[w], single]), np.concatenate([(count_of(a) * reps[s])[w], np.ones(len(single), np.int64)])))
            cols = list(zip(*out)) or [()] * len(results)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, kinds[k]) for c, k in zip(cols, results.values())]], names=["doc_id", *results])

    return rows.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{c} {k}" for c, k in results.items()))
