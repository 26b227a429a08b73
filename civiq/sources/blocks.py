"""Files whose records cannot be found by splitting, read by many tasks all the same.

A text scan cuts a file into blocks of pieces. Whether a piece starts inside a quoted text depends on all before it, but
only through one bit, so each block is summed up for both cases, a running sum over the few blocks of a file decides
which case holds in each, and records are put together from the pieces that no block border may tear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

_BLOCK = ["file", "block"]

# A quoted text up to its closing quote, a doubled quote being part of it.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
# Whole fields, then one that opens a quote and doesn't close it.
_OPENS = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+"{_QUOTED}$'


def scan(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, line, value): the pieces between separators, numbered within their block."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", separator).text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line"), "value")


def is_large(spark: SparkSession, path: str) -> bool:
    """Whether any of the files is longer than what one task should read. Lengths are listed, contents are not read."""
    most = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    return most > int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")))


def _xor(a: Column, b: Column) -> Column:
    return a != b


def _running(rows: DataFrame, keys: list[str], order: str, cases: dict[str, bool]) -> DataFrame:
    """Add for each case (name → the bit a run starts with) the bit before and behind each row, as ``before_…`` and ``after_…``.

    ``a`` and ``b`` are what a row makes of a bit 0 and a bit 1. Rows either set the bit, or turn it, or leave it: what holds
    behind a row is what the last setting row made it, turned as often as rows since have turned it.
    """
    along = Window.partitionBy(*keys).orderBy(order)
    turned = F.sum(F.when(F.col("a") & ~F.col("b"), 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("turns", turned)
    setting = F.when(F.col("a") == F.col("b"), F.struct("a", "turns"))
    rows = rows.withColumn("last_set", F.last(setting, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    since = (F.col("turns") - F.coalesce("last_set.turns", F.lit(0))) % 2 == 1
    for name, start in cases.items():
        rows = rows.withColumn(f"after_{name}", _xor(F.coalesce("last_set.a", F.lit(start)), since))
    return rows.withColumns({
        f"before_{name}": F.coalesce(F.lag(f"after_{name}").over(along), F.lit(start)) for name, start in cases.items()
    }).drop("turns", "last_set")


def opens_quote(line: Column) -> Column:
    """Whether a line that starts outside quotes ends inside: its last field starts with one and has no closing one."""
    # Nearly all lines are told apart without the pattern.
    return F.when(line.startswith('"') | line.contains(',"'), line.rlike(f"^{_OPENS}")).otherwise(False)


def csv_records(lines: DataFrame) -> DataFrame:
    """(file, home, number, record): the records of CSV lines, quoted line breaks kept; ``home`` is the block a record starts in.

    A quote counts only at the start of a field, and there up to the quote that closes it; in an unquoted value it is a
    character like any other. A quote that no line of the file closes raises. Lines that are whole records aren't gathered.
    """
    value = F.col("value")
    closes = value.rlike(f'^{_QUOTED}"')
    marked = lines.withColumns({"a": opens_quote(value), "b": ~closes | value.rlike(f'^{_QUOTED}"(?!")[^,]*+,{_OPENS}')})
    stated = _running(marked, _BLOCK, "line", {"0": False, "1": True})
    along = Window.partitionBy(*_BLOCK).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    stated = stated.withColumns({f"n_{k}": F.sum(F.when(F.col(f"before_{k}"), 0).otherwise(1)).over(along) for k in "01"})

    blocks = stated.groupBy(*_BLOCK).agg(
        F.max_by("after_0", "line").alias("a"), F.max_by("after_1", "line").alias("b"), F.max("n_0").alias("n_0"), F.max("n_1").alias("n_1"))
    placed = _running(blocks, ["file"], "block", {"file": False})
    placed = placed.withColumn("starts", F.when(F.col("before_file"), F.col("n_1")).otherwise(F.col("n_0")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        *_BLOCK, F.col("before_file").alias("open"),
        F.last(F.when(F.col("starts") > 0, F.struct("block", "starts")), ignorenulls=True).over(earlier).alias("carried"))

    def chosen(name: str) -> Column:
        return F.when(F.col("open"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))

    known = stated.join(placed, _BLOCK).select(*_BLOCK, "line", "value", "carried", *[chosen(n).alias(n) for n in ("before", "after", "n")])
    # A line before the first start of its block goes on with a record of an earlier one.
    known = known.withColumns({
        "home": F.when(F.col("n") == 0, F.col("carried.block")).otherwise(F.col("block")),
        "number": F.when(F.col("n") == 0, F.col("carried.starts")).otherwise(F.col("n")),
    })
    alone = ~F.col("before") & ~F.col("after")
    whole = known.filter(alone).select("file", "home", "number", F.col("value").alias("record"))
    parts = known.filter(~alone).groupBy("file", "home", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts"),
        F.max_by("after", F.struct("block", "line")).alias("torn"))
    unclosed = F.raise_error(F.concat(F.lit("a quoted value is never closed: "), F.substring(F.get("parts.value", F.lit(0)), 1, 80)))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    gathered = parts.select("file", "home", "number", F.when(F.col("torn"), unclosed.cast("string")).otherwise(joined).alias("record"))
    return whole.unionByName(gathered)


def read_csv_blocks(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV with a header and quoted line breaks, every column a string; each file is read by as many tasks as it has blocks.

    Lines end in a line feed, with or without a carriage return. The first record of a file is its header; empty lines go.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    schema = schema or reader.csv(path).schema
    names = ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in schema.fields)
    records = csv_records(scan(spark, path, "\n")).filter((F.col("home") > 0) | (F.col("number") > 1))
    texts = records.select(F.regexp_replace("record", "\r$", "").alias("record")).filter("record <> ''")
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n"}
    return texts.select(F.from_csv("record", names, options).alias("row")).select("row.*")


def _outside(text: Column) -> Column:
    """What of a JSON text stands outside its strings, the text beginning outside."""
    return F.regexp_replace(text, r'"[^"]*+(?:"|$)', "")


def _surplus(text: Column, opening: str, closing: str) -> Column:
    def count(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    return (count(opening) - count(closing)).cast("bigint")


def json_elements(pieces: DataFrame, braces: int = 1, brackets: int = 1) -> tuple[DataFrame, DataFrame]:
    """The objects that open inside so many braces and brackets, as (file, position, text), and all pieces with their depths.

    ``pieces`` are cut at opening braces, whether those stand in a string or not. A position is an object's number among those of
    its file. ``text`` starts with the object and may go on behind it, where a JSON reader stops.
    """
    # An escaped character is no quote; what it is doesn't matter here.
    clean = F.regexp_replace("value", r"\\.", "_")
    inside = F.regexp_replace("clean", r'^[^"]*+(?:"|$)', "")
    quotes = (F.length("clean") - F.length(F.replace("clean", F.lit('"'), F.lit("")))) % 2 == 1
    marked = pieces.withColumn("clean", clean).withColumns({"out_0": _outside(F.col("clean")), "out_1": _outside(inside), "a": quotes, "b": ~quotes})
    stated = _running(marked.drop("clean"), _BLOCK, "line", {"0": False, "1": True})
    along = Window.partitionBy(*_BLOCK).orderBy("line")
    # The piece before a file's first brace is the only one that no brace stands before.
    leading = (F.col("block") == 0) & (F.row_number().over(along) == 1)
    stated = stated.withColumn("leading", leading)
    for k in "01":
        text = F.when(F.col(f"before_{k}"), F.col("out_1")).otherwise(F.col("out_0"))
        opened = F.when(F.col(f"before_{k}") | F.col("leading"), 0).otherwise(1)
        stated = stated.withColumns({f"braces_{k}": opened + _surplus(text, "{", "}"), f"brackets_{k}": _surplus(text, "[", "]")})
    blocks = stated.groupBy(*_BLOCK).agg(
        F.max_by("after_0", "line").alias("a"), F.max_by("after_1", "line").alias("b"),
        *[F.sum(f"{n}_{k}").alias(f"{n}_{k}") for n in ("braces", "brackets") for k in "01"])

    def chosen(name: str, case: str) -> Column:
        return F.when(F.col(case), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))

    placed = _running(blocks, ["file"], "block", {"file": False})
    placed = placed.withColumns({n: chosen(n, "before_file") for n in ("braces", "brackets")})
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        *_BLOCK, F.col("before_file").alias("open"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_start") for n in ("braces", "brackets")])
    known = stated.join(placed, _BLOCK).select(
        *_BLOCK, "line", "value", "leading", "braces_start", "brackets_start",
        *[chosen(n, "open").alias(n) for n in ("before", "braces", "brackets")])
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumns({
        f"{n}_before": F.col(f"{n}_start") + F.coalesce(F.sum(n).over(before), F.lit(0)) for n in ("braces", "brackets")})
    starts = ~F.col("before") & ~F.col("leading") & (F.col("braces_before") == braces) & (F.col("brackets_before") == brackets)
    known = known.withColumn("starts", starts)
    known = known.withColumn("number", F.sum(F.when(F.col("starts"), 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    counts = known.groupBy(*_BLOCK).agg(F.max("number").alias("n"))
    offsets = counts.select(*_BLOCK, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    deep = (F.col("braces_before") > braces) | F.col("starts") | F.col("before")
    members = known.join(offsets, _BLOCK).withColumn("position", F.col("offset") + F.col("number") - 1).filter(deep & (F.col("position") >= 0))
    gathered = members.groupBy("file", "position").agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
    text = F.concat(F.lit("{"), F.array_join(F.transform("parts", lambda p: p["value"]), "{"))
    return gathered.select("file", "position", text.alias("text")), known
