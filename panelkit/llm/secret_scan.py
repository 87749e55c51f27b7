"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regex is turned into a Boolean query over trigrams that every match must contain. The index holds the
postings of those trigrams over the whole table; postings are intersected by document, and only candidates are
verified with the regex. Rules without mandatory trigrams scan all texts.
"""

from __future__ import annotations

from re import _constants as ops
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.shared import saved

#: kind, head, value, smallest length of the value: a match is the regex head followed by value; matches with a shorter
#: value are dropped after matching. Where a run of one character class carries the length, the regex asks for it
#: itself, which drops the same matches. ``(?i:`` covers ASCII letters only.
RULES = (
    ("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?", "[A-Za-z0-9+/_.=-]+", 8),
    ("access", "", "AKIA[A-Z0-9]{12,}", 0),
    ("hex", "", "[0-9a-f]{32,}", 0),
    ("private_key", "", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0),
    ("github", "", "gh[pousr]_[A-Za-z0-9]{36,}", 0),
    ("slack", "", "xox[abprs]-[A-Za-z0-9-]{10,}", 0),
    ("jwt", "", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0),
    ("bearer", "(?i:bearer)\\x20+", "[A-Za-z0-9._~+/=-]{20,}", 0),
)
BASE_KINDS = ("assign", "access", "hex")
MAX_STRINGS = 64  # strings of a regex that the trigram query follows exactly


# --- regex -> Boolean trigram query. A query is True, ("tri", t), ("and", ...) or ("or", ...).

def _parts(query, kind: str) -> tuple:
    return query[1:] if query[0] == kind else (query,)


def _and(*qs):
    qs = list(dict.fromkeys(p for q in qs if q is not True for p in _parts(q, "and")))
    return True if not qs else qs[0] if len(qs) == 1 else ("and", *qs)


def _or(*qs):
    if True in qs or not qs:
        return True
    qs = list(dict.fromkeys(p for q in qs for p in _parts(q, "or")))
    sets = [set(_parts(q, "and")) for q in qs]
    # a way that asks for more than another one adds nothing
    qs = [q for q, s in zip(qs, sets) if not any(t < s for t in sets)]
    return qs[0] if len(qs) == 1 else ("or", *qs)


def _strings(found: frozenset) -> object:
    """The query of a set of strings, one of which must occur."""
    return _or(*[_and(*[("tri", s[i:i + 3]) for i in range(len(s) - 2)]) for s in sorted(found)]) if found else True


class _Info:
    """What a regex matches: all its strings if they are few (else None), how matches begin and end, and its query."""

    def __init__(self, exact=None, first=frozenset([""]), last=frozenset([""]), query=True):
        self.exact, self.first, self.last, self.query = exact, first, last, query


def _ends(strings, keep) -> frozenset:
    return frozenset(keep(s) for s in strings)


def _loosen(a: _Info) -> _Info:
    if a.exact is None:
        return a
    return _Info(None, _ends(a.exact, lambda s: s[:2]), _ends(a.exact, lambda s: s[-2:]), _and(a.query, _strings(a.exact)))


def _join(a: _Info, b: _Info) -> _Info:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MAX_STRINGS:
        return _Info(frozenset(x + y for x in a.exact for y in b.exact), query=_and(a.query, b.query))
    tail = a.exact if a.exact is not None else a.last
    head = b.exact if b.exact is not None else b.first
    # trigrams over the seam, where both sides are known
    seam = _strings(frozenset(x[-2:] + y[:2] for x in tail for y in head)) if len(tail) * len(head) <= MAX_STRINGS else True
    left, right = _loosen(a), _loosen(b)
    first = frozenset(x + y for x in a.exact for y in head) if a.exact is not None and len(a.exact) * len(head) <= MAX_STRINGS else left.first
    last = frozenset(x + y for x in tail for y in b.exact) if b.exact is not None and len(tail) * len(b.exact) <= MAX_STRINGS else right.last
    return _Info(None, _ends(first, lambda s: s[:2]), _ends(last, lambda s: s[-2:]), _and(left.query, right.query, seam))


def _set_of(items) -> frozenset | None:
    out = set()
    for op, arg in items:
        if op is ops.LITERAL:
            out.add(chr(arg).lower())
        elif op is ops.RANGE and arg[1] - arg[0] < MAX_STRINGS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return frozenset(out) if len(out) <= 8 else None


def _walk(parsed) -> _Info:
    out = _Info(exact=frozenset([""]))
    for op, arg in parsed:
        if op is ops.LITERAL:
            one = _Info(exact=frozenset([chr(arg).lower()]))
        elif op is ops.IN and (chars := _set_of(arg)):
            one = _Info(exact=chars)
        elif op is ops.SUBPATTERN:
            one = _walk(arg[-1])
        elif op is ops.BRANCH:
            ways = [_walk(x) for x in arg[1]]
            if all(w.exact is not None for w in ways) and sum(len(w.exact) for w in ways) <= MAX_STRINGS:
                one = _Info(exact=frozenset().union(*[w.exact for w in ways]), query=_or(*[w.query for w in ways]))
            else:
                ways = [_loosen(w) for w in ways]
                one = _Info(None, frozenset().union(*[w.first for w in ways]), frozenset().union(*[w.last for w in ways]), _or(*[w.query for w in ways]))
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
            low, high, sub = arg
            inner = _walk(sub)
            if (low, high) == (0, 1) and inner.exact is not None:
                one = _Info(exact=inner.exact | {""})
            elif low == 0:
                one = _Info()
            else:
                once = _loosen(inner)
                one = _Info(None, once.first, once.last, once.query)
        elif op is ops.AT:
            one = _Info(exact=frozenset([""]))
        else:
            one = _Info()
        out = _join(out, one)
    return out


def trigram_query(regex: str):
    """Boolean query over lower-case trigrams that holds for every text with a match; True if there is none."""
    return _loosen(_walk(_parser.parse(regex))).query


def _trigrams(query) -> set:
    return set() if query is True else {query[1]} if query[0] == "tri" else set().union(*map(_trigrams, query[1:]))


def _holds(query, present: Column) -> Column:
    """The query over the array of a document's postings."""
    if query is True:
        return F.lit(True)
    if query[0] == "tri":
        return F.array_contains(present, query[1])
    parts = [_holds(q, present) for q in query[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = (out & p) if query[0] == "and" else (out | p)
    return out


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Index rows (trigram, key): which texts (by hash) hold which of the trigrams, letters in either case."""
    rows = docs.where(F.col("text").isNotNull()).select(F.lower("text").alias("_low"), F.xxhash64("text").alias("_key"))
    held = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    # an outer generator, as Spark puts a filter on the array's size, and with it a second search, below an inner one
    return rows.select("_key", held.alias("_held")).select(F.explode_outer("_held").alias("trigram"), "_key").where(F.col("trigram").isNotNull())


def _found(kind: str, head: str, value: str, least: int) -> Column:
    """Spans (start, stop, kind) of a rule in ``text``: its leftmost matches, placed by the texts between them."""
    regex = F.lit(f"({head})({value})")
    gaps = F.split("text", regex, -1)
    heads, values = (F.regexp_extract_all("text", regex, F.lit(g)) for g in (1, 2))
    rows = F.filter(F.arrays_zip(gaps.alias("gap"), heads.alias("head"), values.alias("value")), lambda r: r["value"].isNotNull())
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,kind:string>>").alias("out"))

    def step(a, r):
        start = a["at"] + F.length(r["gap"])
        stop = start + F.length(r["head"]) + F.length(r["value"])
        span = F.struct(start.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"))
        return F.struct(stop.alias("at"), F.when(F.length(r["value"]) >= least, F.array_append(a["out"], span)).otherwise(a["out"]).alias("out"))

    return F.aggregate(rows, zero, step, lambda a: a["out"])


def secret_scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` plus ``spans``: array of (start, stop, kind) in code points, by start, then in the order of ``rules``.

    Null and empty texts have no spans. Postings and candidates are kept by the text's hash, so repeated rows and
    ids do not matter; a hash that two texts share only adds a candidate. An empty table gives an empty result; a
    column named ``spans`` is replaced, others pass through. A text of any length is searched whole, by one task.
    """
    queries = {kind: trigram_query(head + value) for kind, head, value, _ in rules}
    needed = sorted(set().union(*[_trigrams(q) for q in queries.values()]))
    none = F.array().cast("array<struct<start:int,stop:int,kind:string>>")
    out = docs.select(F.struct("*").alias("row"), "text", F.xxhash64("text").alias("_key"))
    if needed:
        index = saved(postings(docs, needed), "postings")
        met = index.groupBy("_key").agg(F.collect_set("trigram").alias("_tri"))  # at most len(needed) to a text
        candidates = met.select("_key", F.array_compact(F.array(*[
            F.when(_holds(q, F.col("_tri")), F.lit(kind)) for kind, q in queries.items() if q is not True])).alias("_rules"))
        out = out.join(candidates.where(F.size("_rules") > 0), "_key", "left")
    else:
        out = out.withColumn("_rules", F.lit(None).cast("array<string>"))
    order = F.array(*[F.lit(r[0]) for r in rules])
    cols = []
    for i, (kind, head, value, least) in enumerate(rules):
        verify = F.col("text").rlike(head + value)
        if queries[kind] is not True:
            verify = F.when(F.array_contains("_rules", kind), verify)
        out = out.withColumn(f"_s{i}", F.when(F.coalesce(verify, F.lit(False)), _found(kind, head, value, least)).otherwise(none))
        cols.append(f"_s{i}")
    spans = F.transform(F.array_sort(F.transform(F.concat(*cols), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["start"], s["stop"], s["kind"]))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "spans"], spans.alias("spans"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[_count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
