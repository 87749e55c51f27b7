"""Quality rules: a threshold table compiled into one Spark projection, without user functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BREAK = "[ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es werden aus er hat dass sie nach "
    "de la le et les des en un une du que est pour qui dans par plus pas au sur ne se ce il avec son elle "
    "el y los las del por con para una su al lo como más o pero sus le ya"
).split()

#: rule name, metric, smallest allowed value, largest allowed value (None: open).
RULES = (
    ("word_length", "mean_word_chars", 1.5, 20.0),
    ("symbols", "symbols_per_word", None, 0.1),
    ("exclamations", "exclamations_per_word", None, 0.3),
    ("stop_words", "stop_word_share", 0.02, None),
    ("dup_lines", "dup_line_share", None, 0.5),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def measure(docs: DataFrame) -> DataFrame:
    """``row`` (a row of ``docs``) and the struct ``_q`` with the base counts and ratios of its ``text``, read whole.

    Repeated windows are told apart by the 64-bit hash of their three words, within one text only.
    """
    raw = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(F.struct("*").alias("row"), "text").withColumn("_t", F.struct(
        F.filter(F.split(raw, WORD_BREAK), lambda w: w != "").alias("w"),
        F.filter(F.split(raw, "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"),
        F.length(_without(raw, SYMBOLS)).alias("plain"),
        F.length(F.replace(raw, F.lit("!"), F.lit(""))).alias("calm"),
        F.length(raw).alias("chars"),
    ))
    w = F.col("_t.w")
    windows = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
    )
    out = out.withColumn("_s", F.sort_array(windows))
    s = F.col("_s")
    again = F.filter(
        s, lambda x, k: F.coalesce((k > 0) & (F.get(s, k - 1)["h"] == x["h"]), F.lit(False))
        | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
    out = out.withColumn("_p", F.sort_array(F.transform(again, lambda x: x["i"])))
    # each repeated window covers three words, less what the one before it covers
    covered = F.aggregate(
        F.col("_p"), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"])
    n_lines = F.size("_t.lines")
    n = F.size(w).cast("bigint")
    out = out.withColumn("_b", F.struct(
        n.alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.col("_t.chars") - F.col("_t.plain")).cast("bigint").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("_t.lines"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        (F.col("_t.chars") - F.col("_t.calm")).cast("bigint").alias("n_exclamations"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        n_lines.cast("bigint").alias("n_lines"),
    ))
    b = F.col("_b")
    ratio = lambda a, c: F.try_divide(b[a].cast("double"), b[c].cast("double"))
    q = F.struct(
        *[b[c].alias(c) for c in (*_BASE, "n_exclamations", "n_stop_words", "n_lines")],
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbols_per_word"),
        ratio("n_exclamations", "n_words").alias("exclamations_per_word"),
        ratio("n_stop_words", "n_words").alias("stop_word_share"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_share"),
    )
    # a generator ends the projection: a filter on a measure would otherwise be pushed below it and written out in
    # full at every level, which the optimizer does not finish; the row passes it by
    return out.select("row", F.explode(F.array(q)).alias("_q"))


def failed_rules(q: Column, rules=RULES) -> Column:
    """The names of the rules in the threshold table that the measures ``q`` break; an undefined ratio breaks none."""
    broken = []
    for name, metric, low, high in rules:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (q[metric] < F.lit(low))
        if high is not None:
            bad = bad | (q[metric] > F.lit(high))
        broken.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)))
    return F.array_compact(F.array(*broken))


def quality_rules(docs: DataFrame, rules=RULES) -> DataFrame:
    """``row`` (struct of the row of ``docs``), ``measures``, ``base_failed``, ``failed`` (rule names) and ``kept``.

    ``docs`` needs a column ``text``; other columns, of whatever name, stay inside ``row``. A null text counts as no
    words and fails the base rule; rows that repeat are judged alike; an empty table gives an empty result. A text of any
    length is measured whole, by one task, with some 100 bytes a word.
    """
    q = F.col("measures")
    out = measure(docs).select("row", F.col("_q").alias("measures"))
    out = out.withColumn("base_failed", (q["n_words"] < MIN_WORDS) | (
        q["n_repeat_words"] * 100 > q["n_words"] * MAX_REPEAT_PERCENT))
    out = out.withColumn("failed", failed_rules(q, rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select(
        "row.doc_id", *[F.col(f"measures.{c}").alias(c) for c in _BASE], "base_failed", "kept",
        F.concat_ws(",", "failed").alias("failed_rules"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that a rule rejects go.

    Null and empty texts go, repeated rows are judged alike, null ids are ids like others; an empty table stays empty, all
    columns pass through.
    """
    return quality_rules(docs).where("kept").select("row.*")


_STOP_SQL = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
OP1_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
win AS (
  SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS tri
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d)),
rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY rid),
ln AS (
  SELECT rid, count(*) AS n_lines, count(DISTINCT line) AS n_distinct
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (coalesce(n_lines, 0) - coalesce(n_distinct, 0))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         (length(t) - length(replace(t, '!', ''))) AS n_excl, coalesce(n_lines, 0) AS n_lines,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP_SQL}))) AS n_stop
  FROM d LEFT JOIN cov USING (rid) LEFT JOIN ln USING (rid)),
j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         concat_ws(',',
           CASE WHEN n_words > 0 AND (word_chars::DOUBLE / n_words < 1.5 OR word_chars::DOUBLE / n_words > 20.0) THEN 'word_length' END,
           CASE WHEN n_words > 0 AND n_symbols::DOUBLE / n_words > 0.1 THEN 'symbols' END,
           CASE WHEN n_words > 0 AND n_excl::DOUBLE / n_words > 0.3 THEN 'exclamations' END,
           CASE WHEN n_words > 0 AND n_stop::DOUBLE / n_words < 0.02 THEN 'stop_words' END,
           CASE WHEN n_lines > 0 AND n_dup_lines::DOUBLE / n_lines > 0.5 THEN 'dup_lines' END) AS failed_rules
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM j
"""
