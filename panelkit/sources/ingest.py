"""Reading, repairing and writing panel files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_panel(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV scan: short rows are padded, over-long rows dropped."""
    width = len(T._parse_datatype_string(schema).fields)
    return parse_lines(spark.read.text(path), "value", {width: [f.name for f in T._parse_datatype_string(schema).fields]}, pad=True).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(schema).fields])


# a cell that opens with a quote runs to the closing one, doubled quotes inside, and takes what follows up to the comma
_QUOTED = '"(?:[^"]++|"")*+'
_CELL = f',({_QUOTED}(?:"[^,]*+)?+|[^",][^,]*+|)'


def cells(line: Column) -> Column:
    """The cells of a CSV line as an array of texts, as many as the line has.

    The rules are those of Python's csv reader for one line: quoted cells keep commas, a doubled quote in them is one
    quote, text after the closing quote is kept, a quote inside an unquoted cell is text, a quote that is never closed
    takes the rest of the line. Empty cells are empty texts, an empty line has no cells, a null line is null.
    """
    whole = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))

    def plain(c: Column) -> Column:
        body = F.replace(F.regexp_extract(c, f"^({_QUOTED})", 1).substr(F.lit(2), F.length(c)), F.lit('""'), F.lit('"'))
        return F.when(c.startswith('"'), F.concat(body, F.regexp_replace(c, f'^{_QUOTED}"?+', ""))).otherwise(c)

    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.transform(whole, plain))


def _tokenised(lines: DataFrame, col: str) -> DataFrame:
    """``_c``, the cells of each line that is not null; the generator keeps Spark from repeating the parse in filters above it."""
    return lines.where(F.col(col).isNotNull()).select(F.explode(F.array(cells(F.col(col)))).alias("_c"))


def parse_lines(lines: DataFrame, col: str, layouts: dict[int, list[str]], pad: bool = False) -> DataFrame:
    """Lines whose number of cells has a layout, as columns by name (all texts); each line is parsed once.

    With ``pad`` the only layout also takes shorter lines. Columns that a layout lacks and empty cells are missing; null
    and empty lines give no row.
    """
    names = list(dict.fromkeys(n for layout in layouts.values() for n in layout))
    most = max(layouts)
    n = F.size("_c")
    rows = _tokenised(lines, col).where(n > 0)
    rows = rows.where(n <= most) if pad else rows.where(n.isin(list(layouts)))
    out = []
    for name in names:
        value = F.lit(None).cast("string")
        for width, layout in layouts.items():
            if name in layout:
                at = F.get("_c", F.lit(layout.index(name)))
                value = at if pad else F.when(n == width, at).otherwise(value)
        out.append(F.nullif(value, F.lit("")).alias(name))
    return rows.select(*out)


def ragged_report(lines: DataFrame, col: str, accepted: list[int]) -> DataFrame:
    """Lines by number of cells and whether the number is accepted; null lines count nowhere."""
    n = _tokenised(lines, col).select(F.size("_c").alias("arity"))
    return n.groupBy("arity").agg(F.count("*").alias("n")).withColumn("accepted", F.col("arity").isin(accepted))


def read_fixtures(lines: DataFrame, col: str) -> DataFrame:
    """event, kickoff, team_h, team_a from CSV lines; kickoffs are instants in UTC."""
    c = lambda i: F.nullif(F.get("_c", F.lit(i)), F.lit(""))
    return _tokenised(lines, col).select(c(0).try_cast("int").alias("GW"), F.try_to_timestamp(c(1)).alias("kickoff"),
                                         c(2).try_cast("int").alias("team_h"), c(3).try_cast("int").alias("team_a"))


def clean_fixtures(df: DataFrame) -> DataFrame:
    return df.select("GW", "kickoff", "team_h", "team_a").dropna(subset=["kickoff"])


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as columns with dotted names."""
    def leaves(schema, at, name):
        for f in schema.fields:
            col, label = at[f.name] if at is not None else F.col(f.name), f"{name}{sep}{f.name}" if name else f.name
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, col, label)
            else:
                yield col.alias(label)

    return df.select(*leaves(df.schema, None, ""))


def normalise_json(df: DataFrame, col: str, schema: str, sep: str = ".") -> DataFrame:
    """An array of nested objects in a JSON column as a flat table."""
    return flatten(df.select(F.explode(F.from_json(F.col(col), f"array<{schema}>")).alias("x")).select("x.*"), sep)


ODDS_SCHEMA = ("struct<home_team:string,away_team:string,commence_time:string,bookmakers:array<struct<title:string,"
               "markets:array<struct<outcomes:array<struct<name:string,price:double>>>>>>>")


def extract_odds(df: DataFrame, col: str) -> DataFrame:
    """One row per match from nested odds: first bookmaker, first market, prices by team name or "Draw"."""
    m = df.select(F.explode(F.from_json(F.col(col), f"array<{ODDS_SCHEMA}>")).alias("m")).select("m.*").where(F.size("bookmakers") > 0)
    first = F.get("bookmakers", F.lit(0))
    outcomes = F.get(first["markets"], F.lit(0))["outcomes"]
    prices = m.withColumn("_p", F.map_from_entries(F.transform(outcomes, lambda o: F.struct(o["name"], o["price"])))).withColumn("bookmaker", first["title"])
    return prices.select("home_team", "away_team", F.try_to_timestamp("commence_time").alias("kickoff"), "bookmaker",
                         F.try_element_at("_p", F.col("home_team")).alias("odds_home"), F.try_element_at("_p", F.lit("Draw")).alias("odds_draw"),
                         F.try_element_at("_p", F.col("away_team")).alias("odds_away"))


def conform(stats: DataFrame, players: DataFrame, teams: DataFrame, renames: dict[str, str], fillers: dict[str, str], core: list[str]) -> DataFrame:
    """Bring a source to the panel's schema: players joined (left), teams joined (inner), renames, missing columns, core columns first.

    ``stats`` needs element; ``players`` id, web_name, team_id, element_type; ``teams`` id, name.
    """
    from panelkit.operators.clean import map_codes

    p = players.select(F.col("id").alias("_pid"), F.col("web_name").alias("name"), "team_id", "element_type")
    t = teams.select(F.col("id").alias("_tid"), F.col("name").alias("team"))
    out = stats.join(p, F.col("element") == F.col("_pid"), "left").join(t, F.col("team_id") == F.col("_tid")).drop("_pid", "_tid")
    out = out.withColumnsRenamed(renames).withColumn("position", map_codes(F.col("element_type")))
    out = out.withColumns({c: F.lit(None).cast(k) for c, k in fillers.items() if c not in out.columns})
    return out.select(*core, *[c for c in out.columns if c not in core])


def latest_snapshot(df: DataFrame, period: str = "GW") -> DataFrame:
    """Rows of the largest period; on a table partitioned by it the maximum comes from the listing."""
    last = df.agg(F.max(period).alias("_last"))
    return df.join(F.broadcast(last), F.col(period) == F.col("_last"), "left_semi")


def latest_files(spark: SparkSession, roots: list[str], pattern: str = r"GW(\d+)") -> str | None:
    """The file with the highest period in its name in the first folder that has one."""
    jvm = spark.sparkContext._jvm
    import re

    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            continue
        names = [str(f.getPath()) for f in fs.listStatus(path)]
        found = [(int(m[1]), n) for n in names if (m := re.search(pattern, n.rsplit("/", 1)[1]))]
        if found:
            return max(found)[1]
    return None


def latest_named(spark: SparkSession, roots: list[str], pattern: str = r"GW(\d+)") -> DataFrame | None:
    """Rows of the Parquet file or folder with the highest period in its name, in the first folder that has one.

    The name is what follows the folder; the choice is made on the listing, and only the chosen files are read. Folders
    that are missing, empty or without a matching name are passed over; null if none is left. Adds ``period``.
    """
    jvm = spark.sparkContext._jvm
    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            continue
        base = str(fs.getFileStatus(path).getPath()).rstrip("/")
        names = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
        name = F.regexp_extract(F.expr(f"substring(path, {len(base) + 2})"), pattern, 1).try_cast("int")
        last = names.select(name.alias("period")).agg(F.max("period")).first()[0]  # reads no contents
        if last is not None:
            rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root)
            at = F.regexp_extract(F.expr(f"substring(_metadata.file_path, {len(base) + 2})"), pattern, 1).try_cast("int")
            return rows.select("*", at.alias("period")).where(F.col("period") == last)
    return None


def write_predictions(df: DataFrame, path: str, cols: list[str], by: list[str], parts: int | None = None) -> None:
    """CSV with those of the columns that exist, sorted over all files in the order of their names; a second run replaces the first.

    ``by`` are names, "-" in front for descending. Rows are dealt out in ranges of ``by`` and sorted within each, in
    ``parts`` files (by default the shuffle's number).
    """
    order = [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_first() for c in by]
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).select(*[c for c in cols if c in df.columns]).write.mode("overwrite").option("header", True).csv(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Write a dimension unless there is something at ``path``."""
    df.write.mode("ignore").parquet(path)


def write_period_snapshots(df: DataFrame, path: str, period: str = "GW") -> None:
    """A partition for each period of ``df``; a period that is written again is replaced, the others stay."""
    df.repartition(period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)


def profile(df: DataFrame) -> DataFrame:
    """column, kind, n, n_null, lo, hi, first, last of every plain column, from one pass over the table.

    Numbers, flags (0 and 1) and times (seconds since 1970, UTC) have their extremes in ``lo`` and ``hi``, other columns as
    texts in ``first`` and ``last``. Arrays, maps and structs have counts only. NaN is the largest number.
    """
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    number = lambda t: isinstance(t, (T.NumericType, T.BooleanType, *times))

    def value(c: Column, t: T.DataType) -> Column:
        if isinstance(t, T.TimestampType):
            return F.unix_micros(c) / 1e6
        if isinstance(t, times):
            return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c.cast("timestamp_ntz")) / 1e6
        return c.cast("int").cast("double") if isinstance(t, T.BooleanType) else c.cast("double")

    parts, none = [], lambda kind: F.lit(None).cast(kind)
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(df.schema.fields):
        c, nested = F.col(f"`{f.name}`"), isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
        aggregates.append(F.count(c).alias(f"c{i}"))
        if not nested:
            aggregates += [F.min(c).alias(f"a{i}"), F.max(c).alias(f"b{i}")]
        a, b = F.col(f"a{i}") if not nested else None, F.col(f"b{i}") if not nested else None
        plain = not nested and number(f.dataType)
        parts.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("kind"), F.col("n"), (F.col("n") - F.col(f"c{i}")).alias("n_null"),
            (value(a, f.dataType) if plain else none("double")).alias("lo"), (value(b, f.dataType) if plain else none("double")).alias("hi"),
            (none("string") if plain or nested else a.cast("string")).alias("first"), (none("string") if plain or nested else b.cast("string")).alias("last")))
    return df.agg(*aggregates).select(F.explode(F.array(*parts)).alias("x")).select("x.*")
