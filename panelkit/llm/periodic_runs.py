"""Periodic run detection: a suffix automaton of each text's words, its last occurrences kept by link-cut access.

The automaton's suffix links form a tree in which the path from a prefix's state to the root holds all its suffixes. Each
appended word recolours that path with its own number, so a segment of one colour holds the suffixes whose last end
was that word. If the segment's longest suffix, of L words, ended d words ago and d <= L, the text ends in a square of
period d; the L + d words are its whole extent to the left, and it is a run once the next word breaks the period.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A run has at least so many words and periods.
SHORTEST, EXPONENT = 6, 4
GRAM = 3
#: Rounds in which stretches are narrowed; fewer rounds leave longer stretches, not other runs.
ROUNDS = 6
#: A worker hands on its rows when their texts reach so many bytes.
BATCH_BYTES = 8_000_000


class Automaton:
    """Suffix automaton of a sequence of whole numbers >= 0. State 1 is the root, 0 is none.

    A state's first transition lies in two lists, further ones in a dict, as most states have one: about 250 bytes a word.
    """

    def __init__(self, word: list[int]):
        self.length, self.link = [0, 0], [0, 0]
        self._symbol, self._to, self._more = [-1, -1], [0, 0], {}
        self.prefix = []  # the state of each prefix
        last = 1
        for c in word:
            last = self._append(last, c)
            self.prefix.append(last)

    def _next(self, p: int, c: int) -> int:
        if self._symbol[p] == c:
            return self._to[p]
        more = self._more.get(p)
        return more.get(c, 0) if more else 0

    def _set(self, p: int, c: int, q: int) -> None:
        if self._symbol[p] in (c, -1):
            self._symbol[p], self._to[p] = c, q
        else:
            self._more.setdefault(p, {})[c] = q

    def _state(self, length: int, symbol: int, to: int) -> int:
        self.length.append(length)
        self.link.append(1)
        self._symbol.append(symbol)
        self._to.append(to)
        return len(self.length) - 1

    def _append(self, p: int, c: int) -> int:
        length, link = self.length, self.link
        new = self._state(length[p] + 1, -1, 0)
        while p and not (q := self._next(p, c)):
            self._set(p, c, new)
            p = link[p]
        if not p:
            return new
        if length[q] == length[p] + 1:
            link[new] = q
            return new
        clone = self._state(length[p] + 1, self._symbol[q], self._to[q])
        if q in self._more:
            self._more[clone] = dict(self._more[q])
        link[clone], link[q], link[new] = link[q], clone, clone
        while p and self._next(p, c) == q:
            self._set(p, c, clone)
            p = link[p]
        return new


class LastEnds:
    """The suffix-link tree cut into paths of one colour each; a path is a splay tree ordered by depth.

    The colour is kept at the splay tree's root, whose ``up`` leads to the state above the path.
    """

    def __init__(self, link: list[int]):
        self.up, n = list(link), len(link)
        self.left, self.right, self.colour = [0] * n, [0] * n, [-1] * n

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            y = up[x]
            if left[y] == x:
                below = True
            elif right[y] == x:
                below = False
            else:
                return
            z = up[y]
            if left[z] != y and right[z] != y:  # y is the root: one rotation
                if below:
                    left[y] = b = right[x]
                    right[x] = y
                else:
                    right[y] = b = left[x]
                    left[x] = y
                up[b], up[y], up[x] = y, x, z
                self.colour[x] = self.colour[y]
                up[0] = 0
                return
            g, under = up[z], left[z] == y
            if under == below:
                if below:
                    left[z], left[y] = b, a = right[y], right[x]
                    right[y], right[x] = z, y
                else:
                    right[z], right[y] = b, a = left[y], left[x]
                    left[y], left[x] = z, y
                up[b], up[a], up[z], up[y] = z, y, y, x
            else:
                if below:
                    left[y], right[z] = b, a = right[x], left[x]
                    right[x], left[x] = y, z
                else:
                    right[y], left[z] = b, a = left[x], right[x]
                    left[x], right[x] = y, z
                up[b], up[a], up[z], up[y] = y, z, x, x
            up[x] = g
            up[0] = 0
            if left[g] == z and g:
                left[g] = x
            elif right[g] == z and g:
                right[g] = x
            else:
                self.colour[x] = self.colour[z]
                return

    def access(self, v: int, colour: int):
        """Recolour the path from ``v`` to the root; gives (deepest state, colour so far) of each segment, from below."""
        x, under, out = v, 0, []
        while x:
            self._splay(x)
            out.append((x, self.colour[x]))
            if rest := self.right[x]:  # what hangs below the segment keeps its colour
                self.colour[rest] = self.colour[x]
            self.right[x] = under
            under, x = x, self.up[x]
        self._splay(v)
        self.colour[v] = colour
        return out


def runs(word: list[int], shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the maximal stretches of at least ``shortest`` words and ``exponent`` periods.

    ``exponent`` is 2 or more. At a run's last word its longest suffix seen before ended one smallest period ago: an end
    in between, or a shorter period, would give the run a smaller period.
    """
    tree = Automaton(word)
    ends, length, n, out = LastEnds(tree.link), tree.length, len(word), []
    for i, state in enumerate(tree.prefix):
        for x, last in ends.access(state, i):
            d = i - last
            if last >= 0 and length[x] + d >= max(shortest, exponent * d) and (i + 1 == n or word[i + 1] != word[i + 1 - d]):
                out.append((i + 1 - d - length[x], length[x] + d, d))
    return out


def _codes(values: np.ndarray) -> tuple[np.ndarray, int]:
    found, at = np.unique(values, return_inverse=True)
    return at, len(found)


def stretches(codes: np.ndarray, shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[tuple[int, int]]:
    """(start, end) of stretches such that each run lies in one of them.

    Of a run's three-word grams each starts in it at least ``least`` times: exponent - 1 times for a period of two words
    or more, and at all but two words for a period of one. So grams that are rarer within their stretch part it.
    """
    n, least = len(codes), min(max(shortest, exponent) - GRAM + 1, exponent - 1)
    if n < max(shortest, exponent):
        return []
    if least < 2:
        return [(0, n)]
    gram, size = codes[:n - GRAM + 1].astype(np.int64), int(codes.max()) + 1
    for k in range(1, GRAM):
        if size > 2**20:
            gram, size = _codes(gram)
        wide = int(codes.max()) + 1
        gram, size = gram * wide + codes[k:n - GRAM + 1 + k], size * wide
    gram, size = _codes(gram)
    at, part = np.arange(len(gram)), np.zeros(len(gram), np.int64)
    for _ in range(ROUNDS):
        key, m = (gram, size) if not part.any() else _codes(part * size + gram)
        often = np.bincount(key, minlength=m)[key] >= least
        if often.all():
            break
        at, gram = at[often], gram[often]
        if not len(at):
            return []
        part = np.cumsum(np.diff(at, prepend=at[0]) > 1)
    cuts = np.flatnonzero(np.diff(at) > 1)
    first, last = at[np.concatenate([[0], cuts + 1])], at[np.concatenate([cuts, [len(at) - 1]])]
    return [(a, b + GRAM) for a, b in zip(first.tolist(), last.tolist()) if b + GRAM - a >= max(shortest, exponent)]


def text_runs(words: list[bytes], shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """The runs of a text's words by start, then period."""
    if len(words) < max(shortest, exponent):
        return []
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    out = []
    for a, b in stretches(codes, shortest, exponent):
        out += [(a + s, m, q) for s, m, q in runs(codes[a:b].tolist(), shortest, exponent)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words outside of runs and the first period of each run, joined by one space."""
    if not found:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for s, m, q in found:
        gone[s + q] += 1
        gone[s + m] -= 1
    drop = (np.cumsum(gone[:-1]) > 0).tolist()
    return b" ".join([w for w, d in zip(words, drop) if not d])


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST, exponent: int = EXPONENT, rewrite=None) -> DataFrame:
    """doc_id, n_words, runs (start word, length, period; by start, then period) and collapsed text of each row.

    Words are split at ASCII blanks. ``rewrite`` (doc_id, words as UTF-8 bytes) -> words may change them before the
    search. A word is left out of the collapsed text if a run has it after the run's first period.

    Null and empty texts have no words, no runs and an empty collapsed text. Each row is judged by itself: repeated rows
    and null ids come back as often as they come in, other columns are ignored, an empty table gives an empty one. Texts of
    any length are taken whole, by one task a row; the automaton is built only over stretches in which every gram
    recurs often enough for a run (``stretches``), with about 400 bytes a word, so a text of one long run
    of ten million words needs 4 GB.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            first, n_words, all_runs, kept, held = 0, [], [], [], 0
            for i in range(batch.num_rows):
                words = (texts[i].as_py() or b"").split()
                if rewrite is not None:
                    words = rewrite(ids[i].as_py(), words)
                found = text_runs(words, shortest, exponent)
                n_words.append(len(words))
                all_runs.append([{"start": s, "length": m, "period": q} for s, m, q in found])
                kept.append(collapsed(words, found))
                held += len(kept[-1])
                if held > BATCH_BYTES or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(first, i + 1 - first), pa.array(n_words, pa.int64()), pa.array(all_runs, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                        names=["doc_id", "n_words", "runs", "collapsed"])
                    first, n_words, all_runs, kept, held = i + 1, [], [], [], 0

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def repeated_tail(doc_id, words: list[bytes]) -> list[bytes]:
    """The contract's words: in a tenth of the ids (by crc32) the tail repeats its first words; a null id has no number and keeps its words."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its runs' number, the longest, and digests of all runs and of the collapsed text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(docs, rewrite=repeated_tail)
    # the greatest of (length, -start, -period)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return found.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(length * 1000 / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
