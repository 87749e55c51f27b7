"""Line dedup with a log-template tree, in DataFrame functions only.

Lines go down a tree of fixed depth: number of tokens, then the leading tokens (tokens with a digit count as variable);
a line of fewer tokens than the depth has as many leading tokens as it has.
In each leaf a token is constant at its position if a share of the leaf's lines carry it there; all other tokens are
variable fields, and the line with its fields generalised is its template. A line has a template for each of a few
shares, from all of the leaf's lines down to none (the line itself), as a leaf can hold several templates. Templates
that enough documents carry recur; their lines are dropped. Near copies, texts that share most lines, count once.
A field without a digit among the leading tokens parts the tree: its lines recur only value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.shared import saved

FIELD = "<*>"
MIN_DOCS = 8          # documents that must carry a template before it recurs
DEPTH = 3             # leading tokens on a path of the tree
MIN_CONSTANT = 0.5    # share of a template's tokens that must be constant
COPY_SHARE = 0.5      # a text that shares more of its lines and of its characters with min_docs texts is a near copy
MIN_SHARES = (1.0, 3 / 4, 1 / 2, 1 / 4, 1 / 8, 1 / 16, 1 / 32, 0.0)  # of a leaf's lines that carry a constant token


def _masked(line: Column) -> Column:
    """The line's tokens joined by one space, tokens with a digit made a field."""
    flat = F.trim(F.regexp_replace(line, "[ \\t-\\r]+", " "))
    return F.when(line.rlike("[0-9]"), F.regexp_replace(flat, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)).otherwise(flat)


def _lines(docs: DataFrame) -> DataFrame:
    """One row for each line with a token: hash of its text, position, hash of the masked line and of its leaf,
    length; and the text's length and number of lines that are not empty."""
    texts = docs.where(F.col("text").isNotNull()).select("text", F.xxhash64("text").alias("_key"), F.length("text").alias("_chars"))
    split = F.split("text", "\n")
    # one for each text, below the generator, and the masked line by one of its own, so that the filter does not repeat it
    texts = texts.withColumn("_rows", F.size(F.array_remove(split, "")))
    rows = texts.select("_key", "_chars", "_rows", F.posexplode(split).alias("_pos", "_raw")).select(
        "_key", "_chars", "_rows", "_pos", F.length("_raw").alias("_len"), F.explode(F.array(_masked(F.col("_raw")))).alias("_line"))
    return rows.withColumn("_n", F.size(F.split("_line", " "))).where(F.col("_line") != "").select(
        "_key", "_chars", "_rows", "_pos", "_len", F.xxhash64("_line").alias("_h"),
        F.xxhash64("_n", F.substring_index("_line", " ", DEPTH)).alias("_leaf"))


def _line_tokens(docs: DataFrame, lines: DataFrame, min_docs: int) -> DataFrame:
    """_leaf, _h, c (different texts that carry the line) and _toks of the masked lines in leaves that may hold a recurring one."""
    # a text and its exact copies count once; the first of them carries the line
    per_line = lines.groupBy("_leaf", "_h", "_key").agg(F.min("_pos").alias("_pos")).groupBy("_leaf", "_h").agg(
        F.count("*").alias("c"), F.min(F.struct("_key", "_pos")).alias("at"))
    per_line = saved(per_line, "line-counts")
    # a leaf that fewer than min_docs lines reach can hold no recurring template
    leaves = per_line.groupBy("_leaf").agg(F.sum("c").alias("leaf_c")).where(F.col("leaf_c") >= min_docs).select("_leaf")
    carried = per_line.join(leaves, "_leaf").select("_leaf", "_h", "c", "at._key", "at._pos")
    wanted = carried.groupBy("_key").agg(F.collect_list(F.struct("_pos", "_leaf", "_h", "c")).alias("want"))
    texts = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("_key"), "text")
    rows = texts.join(wanted, "_key").select(F.explode(F.transform(
        "want", lambda x: F.struct(x["_leaf"].alias("_leaf"), x["_h"].alias("_h"), x["c"].alias("c"), F.get(
            F.split("text", "\n"), x["_pos"]).alias("_raw")))).alias("r")).select("r.*")
    rows = rows.groupBy("_leaf", "_h").agg(F.max("c").alias("c"), F.max("_raw").alias("_raw"))  # copies carry it too
    return saved(rows.select("_leaf", "_h", "c", F.split(_masked(F.col("_raw")), " ").alias("_toks")), "line-tokens")


def line_templates(docs: DataFrame, lines: DataFrame, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT,
                   min_shares: tuple = MIN_SHARES) -> DataFrame:
    """_h, c, order ``_o`` (of md5) and hash ``_t`` of each template of the masked lines, for templates that ``min_docs`` texts may carry."""
    rows = _line_tokens(docs, lines, min_docs)
    tokens = rows.select("_leaf", "_h", "c", F.posexplode("_toks").alias("_pos", "_tok"))
    leaf = rows.groupBy("_leaf").agg(F.sum("c").alias("leaf_c"))
    least = min(x for x in min_shares if x > 0)
    common = tokens.where(F.col("_tok") != FIELD).groupBy("_leaf", "_pos", "_tok").agg(F.sum("c").alias("w")).join(leaf, "_leaf").where(
        F.col("w") >= F.col("leaf_c") * least).select("_leaf", "_pos", "_tok", (F.col("w") / F.col("leaf_c")).alias("_share"))
    marked = tokens.join(common, ["_leaf", "_pos", "_tok"], "left").select(
        "_leaf", "_h", "c", "_pos", "_tok", F.coalesce("_share", F.lit(0.0)).alias("_share"))
    marked = marked.groupBy("_leaf", "_h").agg(
        F.max("c").alias("c"), F.array_sort(F.collect_list(F.struct("_pos", "_tok", "_share"))).alias("t"))
    at = lambda least: F.transform("t", lambda x: F.when(x["_share"] >= least, x["_tok"]).otherwise(F.lit(FIELD)))
    whole = lambda t: F.size(F.filter(t, lambda x: x != FIELD)) >= F.size(t) * min_constant
    order = F.substring(F.md5(F.array_join(F.transform("t", lambda x: x["_tok"]), " ")), 1, 16)
    template = marked.select("_h", "c", order.alias("_o"), F.explode(F.array_distinct(F.transform(
        F.filter(F.array(*[at(x) for x in min_shares]), whole), lambda t: F.xxhash64(F.array_join(t, " "))))).alias("_t"))
    template = saved(template, "line-templates")
    counts = template.groupBy("_t").agg(F.sum("c").alias("n")).where(F.col("n") >= min_docs).select("_t")
    return template.join(counts, "_t").select("_h", "c", "_o", "_t")


def _drop_lines(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """``docs`` without the lines of ``hits`` (_key, _pos)."""
    hits = hits.groupBy("_key").agg(F.collect_list("_pos").alias("_drop"))
    keyed = docs.select(F.struct("*").alias("row"), "text", F.xxhash64("text").alias("_key"))
    out = keyed.join(hits, "_key", "left").withColumn("_lines", F.split("text", "\n"))
    out = out.withColumn("_cut", F.col("_drop").isNotNull())
    out = out.withColumn("_keep", F.when(F.col("_cut"), F.array_except(
        F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))))
    text = F.when(F.col("_cut"), F.array_join(
        F.transform("_keep", lambda i: F.get(F.col("_lines"), i)), "\n")).otherwise(F.col("text"))
    return out.select(
        *[(text.alias("text") if c == "text" else F.col("row")[c].alias(c)) for c in docs.columns if c not in ("n_lines", "n_dropped")],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("bigint").alias("n_lines"),
        F.when(F.col("_cut"), F.size("_drop")).otherwise(0).cast("bigint").alias("n_dropped"))


def recurring_lines(hits: DataFrame, templates: DataFrame, min_docs: int = MIN_DOCS, copy_share: float = COPY_SHARE) -> DataFrame:
    """Hashes ``_h`` of the masked lines with a template that ``min_docs`` groups of texts carry.

    ``hits`` has the lines of ``templates`` once for each text and position. A text is a group of its own, unless lines
    that as they are (masked) stand in ``min_docs`` texts make up more than ``copy_share`` of its lines and of its
    characters: then it is a near copy, and near copies are one group if the same such line is the first of each by md5.
    Only lines that about as many texts carry as the median of the text's such lines (half to twice as many) are asked,
    so that neither a line that families share nor a variant that few members have stands for a family.
    """
    copies = hits.where(F.col("c") >= min_docs).groupBy("_key").agg(
        F.sum("_len").alias("len"), F.max("_rows").alias("_rows"), F.max("_chars").alias("_chars"),
        F.sort_array(F.collect_list(F.struct("c", "_o", "_h"))).alias("_l")).where(
        (F.size("_l") > F.col("_rows") * copy_share) & (F.col("len") > F.col("_chars") * copy_share))
    middle = F.get("_l", F.floor((F.size("_l") - 1) / 2).cast("int"))["c"]
    near = F.filter("_l", lambda x: (x["c"] * 2 >= middle) & (x["c"] <= middle * 2))
    copies = copies.select("_key", F.array_min(F.transform(near, lambda x: F.struct(x["_o"].alias("o"), x["_h"].alias("h"))))["h"].alias("_family"))
    groups = hits.select("_key", "_h").join(copies, "_key", "left").select(
        "_h", F.struct(F.col("_family").isNotNull().alias("near"), F.coalesce("_family", "_key").alias("id")).alias("_group")).distinct()
    counts = groups.join(templates.select("_h", "_t"), "_h").groupBy("_t", "_group").agg(F.lit(1).alias("x")).groupBy("_t").agg(
        F.count("*").alias("n")).where(F.col("n") >= min_docs).select("_t")
    return templates.join(counts, "_t").select("_h").distinct()


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT,
               copy_share: float = COPY_SHARE) -> DataFrame:
    """``docs`` with ``text`` rid of the lines of recurring templates, plus ``n_lines`` and ``n_dropped``.

    A template recurs if ``min_docs`` different texts carry a line of it; exact copies of a text count once, and so do
    near copies (``recurring_lines``), so copying a document does not make its lines recur. Every line of a recurring
    template goes, in every document, whatever its share of the text and however short; lines without a token, and
    lines of fields only, stay.
    Null texts stay null with no lines; repeated rows are treated alike; an empty table gives an empty result; the
    other columns pass through, ``n_lines`` and ``n_dropped`` are replaced if present. Lines and texts are matched
    by 64-bit hashes. A text of any length is split whole; its line places are gathered in one row.
    """
    lines = saved(_lines(docs), "lines")
    templates = saved(line_templates(docs, lines, min_docs, min_constant), "line-candidates")
    hits = lines.join(templates.groupBy("_h").agg(F.max("c").alias("c"), F.max("_o").alias("_o")), "_h").groupBy("_key", "_pos").agg(
        *[F.max(x).alias(x) for x in ("_len", "_h", "_chars", "_rows", "c", "_o")])
    hits = saved(hits, "line-hits")
    found = saved(recurring_lines(hits, templates, min_docs, copy_share), "recurring-lines")
    return _drop_lines(docs, hits.join(found, "_h"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: lines of recurring templates go; ``n_chars`` follows the text.

    No document goes: null and empty texts, repeated rows and null ids stay as they are or lose lines like others; columns
    named n_lines and n_dropped are left out, others pass through.
    """
    out = line_dedup(docs.drop("n_lines", "n_dropped"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[c for c in docs.columns if c in out.columns])
