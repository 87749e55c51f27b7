"""URL filters: rules first, then words of the host and path scored by naive Bayes.

Host names run words together ("tionsh"); a unigram Viterbi, with word counts over the text of all pages, splits them.
A multinomial naive Bayes over host words and path tokens, trained on the urls that a rule decides, judges the others.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.shared import saved

#: verdict, host and path prefix; the longest rule that fits wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
MAX_WORD = 20  # letters of a word
SMOOTHING = 1.0


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty without ``://``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))
    host = F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(has, _ascii_lower(host)).otherwise(""), F.when(has, path).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n: letters-only words of up to MAX_WORD letters in the visible text of all pages, lower-cased."""
    visible = F.regexp_replace("html", "(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    return pages.where(F.col("html").isNotNull()).select(F.explode(F.split(F.lower(visible), "[^a-z]+")).alias("word")).where(
        F.length("word").between(1, MAX_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def _segment(label: str, known, total: int) -> list[str]:
    """The most probable split of a label under the unigram model; unknown strings cost more for each letter."""
    n = len(label)
    score = {(w["at"], w["size"]): math.log(w["n"] / total) for w in known}
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - MAX_WORD), end):
            p = score.get((start, end - start))
            if p is None:
                p = -math.log(total) - (end - start) * math.log(10)
            if best[start] + p > best[end]:
                best[end], back[end] = best[start] + p, start
    words, end = [], n
    while end:
        words.append(label[back[end]:end])
        end = back[end]
    return words[::-1]


def segmented(labels: DataFrame, words: DataFrame) -> DataFrame:
    """label, parts: each different label, of any length, with the words that it splits into; empty ones are left out."""
    total = max(words.agg(F.sum("n")).first()[0] or 1, 1)
    pieces = labels.where(F.length("label") > 0).select("label", F.posexplode(F.sequence(F.lit(1), F.length("label"))).alias("_", "start")).select(
        "label", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("label") - F.col("start") + 1))).alias("size"))
    pieces = pieces.withColumn("word", F.expr("substring(label, start, size)"))
    known = pieces.join(words, "word").groupBy("label").agg(
        F.collect_list(F.struct((F.col("start") - 1).alias("at"), "size", "n")).alias("known"))

    @F.pandas_udf("array<string>")
    def split(label: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_segment(x, [] if k is None else list(k), total) for x, k in zip(label, found)])

    return labels.where(F.length("label") > 0).join(known, "label", "left").select("label", split("label", "known").alias("parts"))


def _tokens(urls: DataFrame, words: DataFrame) -> DataFrame:
    """host, path, tokens: the host's words and the path's tokens (numbers alike) of each different url."""
    hosts = urls.select("host").distinct()
    labels = hosts.select("host", F.explode(F.filter(F.split("host", "[^a-z]+"), lambda x: x != "")).alias("label"))
    parts = segmented(labels.select("label").distinct(), words)
    by_host = labels.join(parts, "label").groupBy("host").agg(F.flatten(F.collect_list("parts")).alias("parts"))
    path = F.filter(F.split(F.regexp_replace(F.lower("path"), "[0-9]+", "#"), "[^\\p{L}#]+"), lambda x: x != "")
    return urls.join(by_host, "host", "left").select("host", "path", F.concat(
        F.transform(F.coalesce("parts", F.array().cast("array<string>")), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(path, lambda x: F.concat(F.lit("path:"), x))).alias("tokens"))


def url_filter(pages: DataFrame, rules=RULES, smoothing: float = SMOOTHING) -> DataFrame:
    """``pages`` plus host, path, rule and verdict (these columns are replaced if present).

    Needs page_id, url and html; a null url or one without ``://`` has an empty host and path and is judged by the
    class shares alone; null html counts no words; repeated rows are trained on and judged as often as they come; ties
    and an empty training set give ``allow``; an empty table gives an empty result. Every decided url trains the model.
    Urls of any length are taken whole.
    """
    host, path = url_parts(F.col("url"))
    out = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    rule, decided = rule_of(F.col("host"), F.col("path"), rules)
    out = out.withColumn("rule", rule).withColumn("_by_rule", decided)
    urls = saved(out.groupBy("host", "path", "_by_rule").agg(F.count("*").alias("n")), "urls")
    words = saved(word_counts(pages), "page-words")
    tokens = saved(_tokens(urls.select("host", "path"), words), "url-tokens").join(urls, ["host", "path"])
    train = tokens.where(F.col("_by_rule").isNotNull())
    of = lambda v: F.sum(F.when(F.col("_by_rule") == v, F.col("n")).otherwise(0))
    model = saved(train.select("_by_rule", "n", F.explode("tokens").alias("token")).groupBy("token").agg(
        of("allow").alias("a"), of("block").alias("b")), "url-model")
    size = model.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("v")).first()
    share = train.agg(of("allow").alias("a"), of("block").alias("b")).first()
    v = size["v"] + 1
    a_total, b_total = (size["a"] or 0) + smoothing * v, (size["b"] or 0) + smoothing * v
    prior = math.log(((share["a"] or 0) + 1) / ((share["b"] or 0) + 1))
    weight = F.log((F.coalesce("a", F.lit(0)) + smoothing) / F.lit(a_total)) - F.log((F.coalesce("b", F.lit(0)) + smoothing) / F.lit(b_total))
    score = tokens.where(F.col("_by_rule").isNull()).select("host", "path", F.explode("tokens").alias("token")).join(
        model, "token", "left").groupBy("host", "path").agg(F.sum(weight).alias("w"))
    judged = tokens.where(F.col("_by_rule").isNull()).join(score, ["host", "path"], "left").select(
        "host", "path", F.when(F.round(F.coalesce("w", F.lit(0.0)) + prior, 9) >= 0, "allow").otherwise("block").alias("_scored"))
    return out.join(judged, ["host", "path"], "left").select(
        *[F.col("row")[c].alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")],
        "host", "path", "rule", F.coalesce("_by_rule", "_scored").alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
