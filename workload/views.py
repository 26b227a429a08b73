"""Domain tables derived from the given ones, in the same expressions for Spark and DuckDB.

Every view covers its whole base table, so the work grows with the data. An
``@name@`` stands for the few functions whose spelling differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

SPARK_WORDS = {
    "@ts@": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    "@day@": "date_add(DATE '2015-01-01', CAST(floor(event_id / 1e2) AS INT))",
    "@dmy(": "date_format(",
    "@dmy)": ", 'dd/MM/yyyy')",
    "@iso(": "date_format(",
    "@iso)": ", 'yyyy-MM-dd')",
}
DUCK_WORDS = {
    "@ts@": "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
    "@day@": "(DATE '2015-01-01' + CAST(floor(event_id / 1e2) AS INT))",
    "@dmy(": "strftime(",
    "@dmy)": ", '%d/%m/%Y')",
    "@iso(": "strftime(",
    "@iso)": ", '%Y-%m-%d')",
}

# Supplier n owns a rectangle of 0.01 degrees in a lattice 100 wide. Ticket points lie on steps
# of 1e-4, the borders half a step beside them, so no point is on a border. Every seventh
# rectangle is double wide: it overlaps its right neighbour, and the lower index counts.
_X0 = "(1e2 + ((s_suppkey % 100) * 100 - 5e-1) / 1e4)"
_Y0 = "(13e0 + (floor(s_suppkey / 1e2) * 100 - 5e-1) / 1e4)"
_Y0_POINT = "(floor(user_id / 1e2) * 100 + (event_id * 104729) % 100)"
_WIDTH = "(CASE WHEN s_suppkey % 7 = 0 THEN 2e-2 ELSE 1e-2 END)"
_POINT = (
    "'100.' || lpad(CAST((user_id % 100) * 100 + (event_id * 7919) % 100 AS STRING), 4, '0')"
    f" || ',' || CAST(CAST(13 + floor({_Y0_POINT} / 1e4) AS BIGINT) AS STRING) || '.' ||"
    f" lpad(CAST(CAST({_Y0_POINT} AS BIGINT) % 10000 AS STRING), 4, '0')"
)

# name: (base, [(column, expression)])
VIEWS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "tickets": ("events", [
        ("ticket_id", "'T' || CAST(event_id AS STRING)"),
        ("type",
         "CASE event_id % 10 WHEN 0 THEN '{}' WHEN 1 THEN NULL WHEN 2 THEN '{' || event_type || '}'"
         " WHEN 3 THEN '{flood}' WHEN 4 THEN '{flood,' || event_type || '}' WHEN 5 THEN '{road, ''flood''}'"
         " WHEN 6 THEN '{flood,road,road}' WHEN 7 THEN '{floodway}' WHEN 8 THEN '{road,' || event_type || ',floodway}'"
         " ELSE '{' || event_type || ',road}' END"),
        ("organization", "CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'org' || CAST(user_id % 7 AS STRING) END"),
        ("coords", f"CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 97 = 1 THEN '100.5'"
                   f" WHEN event_id % 97 = 2 THEN '1,2,3' ELSE {_POINT} END"),
        ("timestamp", "CAST(2024 - event_id % 5 AS STRING) || substr(@ts@, 5) || '+00'"),
        ("last_activity", "@ts@ || '+00'"),
        ("photo", "'p' || CAST(event_id AS STRING)"),
        ("photo_after", "CASE WHEN event_id % 3 = 0 THEN 'a' || CAST(event_id AS STRING) END"),
        ("star", "CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 6 AS STRING) END"),
        ("province",
         "CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 'นนทบุรี' WHEN 2 THEN 'จังหวัดกรุงเทพมหานคร'"
         " WHEN 3 THEN 'กรุงเทพฯ' ELSE 'กรุงเทพมหานคร' END"),
        ("district",
         "CASE WHEN event_id % 17 = 0 THEN 'elsewhere' WHEN event_id % 17 = 1 THEN NULL"
         " ELSE 'NATION_' || CAST(user_id % 25 AS STRING) END"),
        ("subdistrict",
         "CASE WHEN event_id % 19 = 0 THEN 'elsewhere' WHEN event_id % 19 = 1 THEN NULL"
         " ELSE 'Supplier#' || lpad(CAST(user_id AS STRING), 9, '0') END"),
    ]),
    "boundaries": ("supplier JOIN nation ON n_nationkey = s_suppkey % 25", [
        ("poly_id", "s_suppkey"),
        ("SUBDISTR_1", "CASE WHEN s_suppkey % 20 = 3 THEN 'Suplier#' || CAST(s_suppkey AS STRING) ELSE s_name END"),
        ("SUBDISTRIC", "CAST(s_suppkey AS STRING)"),
        ("DISTRICT_N", "n_name"),
        ("DISTRICT_I", "CAST(n_nationkey AS STRING)"),
        ("x0", _X0), ("y0", _Y0), ("x1", f"{_X0} + {_WIDTH}"), ("y1", f"{_Y0} + 1e-2"),
    ]),
    # The second entry for a code is the newer one; some codes have none.
    "checks": ("supplier JOIN nation ON n_nationkey = s_suppkey % 25 CROSS_ENTRIES", [
        ("scode", "s_suppkey"),
        ("sname", "CASE WHEN entry = 0 AND s_suppkey % 40 = 5 THEN 'Old ' || s_name ELSE s_name END"),
        ("dcode", "n_nationkey"),
        ("dname", "n_name"),
        ("seq", "CAST(entry AS BIGINT) * 1000000000 + s_suppkey"),
    ]),
    "rain_lines": ("events", [
        ("day", "@day@"),
        ("station", "'S.' || lpad(CAST(event_id % 100 AS STRING), 2, '0')"),
        ("line",
         "CASE WHEN event_id % 23 = 5 THEN '5.0 RF.X' ELSE"
         " '13.70 100.50 ' || CASE event_id % 9 WHEN 0 THEN '     ' WHEN 1 THEN '-' WHEN 2 THEN '1.2.3'"
         " ELSE CAST(value AS STRING) END || ' RF.S.' || lpad(CAST(event_id % 100 AS STRING), 2, '0') || ' ok' END"),
    ]),
    "station_texts": ("supplier", [
        ("s_suppkey", "s_suppkey"),
        ("txt",
         "CASE WHEN s_suppkey % 10 = 9 THEN '[[broken' ELSE '[[' || CAST(13 + s_suppkey % 7 AS STRING) || '.25,100.5,''' || s_name ||"
         " ''',''0.0'',''0.5'',''19/11/2568 21:45'',''bg'',''' || CAST(s_suppkey AS STRING) || ''',''NATION_' ||"
         " CAST(s_suppkey % 25 AS STRING) || ''',''green.png'',''normal'',''0.0'',''0.0'',''0.0'',''0.0'',''0.0'',''RF.S.' ||"
         " CAST(s_suppkey AS STRING) || ''',''2'']]' END"),
    ]),
    "measures": ("lineitem", [
        ("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber"), ("l_returnflag", "l_returnflag"),
        ("quantity", "CASE WHEN (l_orderkey + l_linenumber) % 11 <> 0 THEN l_quantity END"),
        ("price", "CASE WHEN (l_orderkey + l_partkey) % 7 <> 0 THEN l_extendedprice END"),
        ("discount", "l_discount"),
        ("tax", "CASE WHEN l_partkey % 5 <> 0 THEN l_tax END"),
        ("level", "CASE WHEN l_suppkey % 3 <> 0 THEN l_linenumber END"),
    ]),
    "jobs": ("customer", [
        ("name", "'  ' || c_name || ' '"),
        ("status", "CASE c_custkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'closed' END"),
        ("value", "CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END"),
    ]),
}


def _worded(text: str, words: dict[str, str]) -> str:
    for mark, word in words.items():
        text = text.replace(mark, word)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in ("boundaries", "checks"):
        return table(spark, sf_dir, VIEWS[name][0])
    joined = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.expr("n_nationkey = s_suppkey % 25")
    )
    if name == "checks":
        joined = joined.filter("s_suppkey % 50 <> 7").withColumn("entry", F.explode(F.array(F.lit(0), F.lit(1))))
    return joined


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    columns = [f"{_worded(e, SPARK_WORDS)} AS `{c}`" for c, e in VIEWS[name][1]]
    return _base(spark, sf_dir, name).selectExpr(*columns)


def duck(name: str) -> str:
    """The view as a sub-select for DuckDB."""
    base = VIEWS[name][0].replace(
        "CROSS_ENTRIES", "CROSS JOIN (VALUES (0), (1)) AS e(entry) WHERE s_suppkey % 50 <> 7"
    )
    columns = ", ".join(f'{_worded(e, DUCK_WORDS)} AS "{c}"' for c, e in VIEWS[name][1])
    return f"(SELECT {columns} FROM {base})"


def polygons(boundaries: DataFrame) -> DataFrame:
    """The rectangles as edge arrays, the corner columns dropped."""
    corners = [("x0", "y0", "x1", "y0"), ("x1", "y0", "x1", "y1"), ("x1", "y1", "x0", "y1"), ("x0", "y1", "x0", "y0")]
    edges = F.array(*[
        F.struct(*[F.col(c).alias(n) for c, n in zip(edge, ("x1", "y1", "x2", "y2"))]) for edge in corners
    ])
    return boundaries.withColumn("edges", edges).drop("x0", "y0", "x1", "y1")
