"""S: scans, sources and sinks. Each query lands derived data with Spark and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiq.operators.rain import date_series, request_plan
from civiq.session import scratch_dir
from civiq.sources.blocks import read_csv_blocks
from civiq.sources.boundaries import read_boundaries
from civiq.sources.landing import lookup_pages, parse_bodies
from civiq.sources.rain_text import read_reports
from civiq.sources.stations import parse_station_arrays
from civiq.sources.tables import read_csv, read_csv_text, read_json, read_parquet, write_csv, write_json, write_parquet
from civiq.streaming.ingest import ingest_landed
from workload.registry import register
from workload.views import duck, table, view

EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


@register("s1_csv_scan", """
    SELECT CAST(doc_id AS STRING) AS doc_id, md5(text) AS text_md5, lang, source, CAST(n_chars AS STRING) AS n_chars
    FROM documents""")
def s1(spark, sf):
    """Texts with quotes and line breaks survive as single records."""
    path = scratch_dir(spark, "s1")
    documents = table(spark, sf, "documents")
    write_csv(documents, path, records_per_file=5000)
    back = read_csv_text(spark, path)
    return back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", "source", "n_chars")


@register("s1_csv_scan_blocks", """
    SELECT CAST(doc_id AS STRING) AS doc_id, md5(text) AS text_md5, lang, source, CAST(n_chars AS STRING) AS n_chars
    FROM documents""")
def s1_blocks(spark, sf):
    """The same records, found block by block."""
    path = scratch_dir(spark, "s1b")
    write_csv(table(spark, sf, "documents"), path)
    return read_csv_blocks(spark, path).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", "source", "n_chars")


@register("s2_csv_scan_inferred", f"""
    SELECT l_returnflag, count(*) AS n, count(quantity) AS n_quantity, CAST(sum(quantity) AS DOUBLE) AS sum_quantity,
           round(sum(price), 2) AS sum_price, CAST(sum(level) AS BIGINT) AS sum_level
    FROM {duck('measures')} GROUP BY l_returnflag""")
def s2(spark, sf):
    """Missing values are written as NA; sums need the inferred number types."""
    path = scratch_dir(spark, "s2")
    view(spark, sf, "measures").write.option("header", True).option("nullValue", "NA").csv(path)
    back = read_csv(spark, path, multiline=False)
    return back.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("quantity").alias("n_quantity"), F.sum("quantity").alias("sum_quantity"),
        F.round(F.sum("price"), 2).alias("sum_price"), F.sum("level").alias("sum_level"),
    )


@register("s3_parquet_scan", """
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_totalprice > 400000""")
def s3(spark, sf):
    df = read_parquet(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return df.filter(F.col("o_totalprice") > 400000)


@register("s4_json_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s4(spark, sf):
    path = scratch_dir(spark, "s4")
    customers = table(spark, sf, "customer")
    write_json(customers, path)
    return read_json(spark, path, customers.schema)


@register("s5_csv_sink", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def s5(spark, sf):
    path = scratch_dir(spark, "s5")
    parts = table(spark, sf, "part")
    write_csv(parts, path)
    return read_csv(spark, path, parts.schema, multiline=False)


@register("s6_parquet_sink", """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
           count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL""")
def s6(spark, sf):
    path = scratch_dir(spark, "s6")
    orders = table(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    write_parquet(orders, path, partition_by=("year", "month"))
    return read_parquet(spark, path).groupBy(
        F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month")
    ).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("s7_json_sink", f"SELECT * FROM {duck('jobs')}")
def s7(spark, sf):
    path = scratch_dir(spark, "s7")
    write_json(view(spark, sf, "jobs"), path)
    return read_json(spark, path, "name string, status string, value double")


def geojson_lines(spark, sf):
    """The boundaries as one GeoJSON feature per line."""
    def corner(x, y):
        return F.array(F.col(x), F.col(y))

    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("poly_id", "SUBDISTR_1", "SUBDISTRIC", "DISTRICT_N", "DISTRICT_I").alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    return view(spark, sf, "boundaries").select(F.to_json(feature).alias("value"))


_BOXES = f"""
    SELECT poly_id, SUBDISTR_1, DISTRICT_I, CAST(4326 AS BIGINT) AS epsg, CAST(4 AS BIGINT) AS n_edges,
           round(x0, 6) AS xmin, round(x1, 6) AS xmax, round(y0, 6) AS ymin, round(y1, 6) AS ymax
    FROM {duck('boundaries')}"""


def _boxes(polygons):
    def extreme(pick, a):
        return F.round(pick(F.transform("edges", lambda e: e[a])), 6)

    return polygons.select(
        "poly_id", "SUBDISTR_1", "DISTRICT_I", F.col("epsg").cast("bigint").alias("epsg"),
        F.size("edges").cast("bigint").alias("n_edges"),
        extreme(F.array_min, "x1").alias("xmin"), extreme(F.array_max, "x1").alias("xmax"),
        extreme(F.array_min, "y1").alias("ymin"), extreme(F.array_max, "y1").alias("ymax"),
    )


@register("s8_boundary_scan", _BOXES)
def s8(spark, sf):
    path = scratch_dir(spark, "s8")
    geojson_lines(spark, sf).write.text(path)
    return _boxes(read_boundaries(spark, path, ["SUBDISTR_1", "DISTRICT_I"], layout="lines", index="poly_id"))


@register("s8_boundary_collection", _BOXES)
def s8_collection(spark, sf):
    """One FeatureCollection document, its features found by depth."""
    path = scratch_dir(spark, "s8c")
    number = F.get_json_object("value", "$.properties.poly_id").cast("bigint")
    lines = geojson_lines(spark, sf).select(number.alias("at"), "value")
    ends = spark.createDataFrame([(-1, '{"type": "FeatureCollection", "features": ['), (1 << 62, "]}")], "at bigint, value string")
    last = lines.agg(F.max("at")).scalar()
    listed = lines.select("at", F.when(F.col("at") == last, F.col("value")).otherwise(F.concat("value", F.lit(","))).alias("value"))
    listed.unionByName(ends).coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    return _boxes(read_boundaries(spark, path, ["SUBDISTR_1", "DISTRICT_I"], layout="blocks", index="poly_id"))


# A folder has one small file; on a local disk each would have a second one beside it, made by a process of its own.
_NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def land_reports(spark, sf, label):
    """One folder of text per date, as the reports would be landed."""
    path = scratch_dir(spark, label)
    lines = view(spark, sf, "rain_lines").select("day", "line")
    # A fixed number of tasks, or adaptive execution would merge them into one writer.
    dealt = lines.repartition(spark.sparkContext.defaultParallelism, "day")
    dealt.write.options(**_NO_CHECKSUM_FILES).partitionBy("day").text(path)
    return path


@register("s9_rain_text_scan", f"""
    SELECT @dmy(day@dmy) AS "Date", CAST(day AS STRING) AS day, line FROM {duck('rain_lines')}"""
    .replace("@dmy(", "strftime(").replace("@dmy)", ", '%d/%m/%Y')"))
def s9(spark, sf):
    return read_reports(spark, land_reports(spark, sf, "s9")).withColumn("day", F.col("day").cast("string"))


@register("s10_station_array", """
    SELECT CAST(CAST(13 + s_suppkey % 7 AS STRING) || '.25' AS DOUBLE) AS Latitude, CAST(100.5 AS DOUBLE) AS Longitude,
           s_name AS StationName_Short, '0.5' AS Value_2_Rain_6Hrs, '19/11/2568 21:45' AS "Timestamp",
           CAST(s_suppkey AS STRING) AS DistrictCode_from_JS, 'RF.S.' || CAST(s_suppkey AS STRING) AS StationCode,
           '2' AS StatusID
    FROM supplier WHERE s_suppkey % 10 <> 9""")
def s10(spark, sf):
    return parse_station_arrays(view(spark, sf, "station_texts"), "txt").select(
        "Latitude", "Longitude", "StationName_Short", "Value_2_Rain_6Hrs", "Timestamp",
        "DistrictCode_from_JS", "StationCode", "StatusID",
    )


@register("s11_ingest_once", "SELECT event_id, user_id, event_type, value FROM events")
def s11(spark, sf):
    """Two landings, three runs: the table holds every event once."""
    source, target, checkpoint = (scratch_dir(spark, f"s11-{part}") for part in ("in", "out", "state"))
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    early = F.col("event_type").isin("click", "view")
    write_parquet(events.filter(early), f"{source}/first", "ignore")
    ingest_landed(spark, source, target, checkpoint, EVENT_SCHEMA)
    write_parquet(events.filter(~early), f"{source}/second", "ignore")
    ingest_landed(spark, source, target, checkpoint, EVENT_SCHEMA)
    ingest_landed(spark, source, target, checkpoint, EVENT_SCHEMA)
    return read_parquet(spark, target)


@register("s12_landed_bodies", r"""
    SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN CAST(regexp_extract(props, '-?\d+') AS BIGINT) END AS k FROM events""")
def s12(spark, sf):
    broken = F.col("event_id") % 10 == 3
    bodies = table(spark, sf, "events").select("event_id", F.when(broken, F.concat(F.lit("<oops>"), "props")).otherwise(F.col("props")).alias("raw"))
    return parse_bodies(bodies, "raw", "k bigint").select("event_id", "body.k")


# The request is written with a slash too many for every other page.
_ENDPOINT = "regexp_replace(url, '^[a-z]+://[^/]+/', '') || CASE WHEN page_id % 2 = 0 THEN '/' ELSE '' END"


@register("s13_landed_pages", r"""
    SELECT r.page_id AS page_id, r.request_url, md5(p.html) AS page_md5 FROM (
        SELECT page_id, rtrim(regexp_extract(url, '^[a-z]+://[^/]+') || '/' || regexp_replace(url, '^[a-z]+://[^/]+/', '')
               || CASE WHEN page_id % 2 = 0 THEN '/' ELSE '' END, '/') AS request_url FROM pages) r
    LEFT JOIN pages p ON p.url = r.request_url""")
def s13(spark, sf):
    """Nothing tells which page of a URL is the newer one, so a request has a row for each."""
    pages = table(spark, sf, "pages")
    requests = pages.select(
        "page_id", F.regexp_extract("url", "^[a-z]+://[^/]+", 0).alias("base"), F.expr(_ENDPOINT).alias("endpoint")
    )
    found = lookup_pages(requests, pages.select("url", "html"), "base", "endpoint", every=True)
    return found.select("page_id", "request_url", F.md5(F.col("html").cast("binary")).alias("page_md5"))


def order_days(spark, sf):
    bounds = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
    )
    return date_series(bounds, "first", "last")


_ORDER_DAYS = """
    (SELECT o_orderpriority, strftime(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)), '%d/%m/%Y') AS "Date"
     FROM orders GROUP BY o_orderpriority)"""


@register("s14_date_series", f'SELECT o_orderpriority, "Date" FROM {_ORDER_DAYS}')
def s14(spark, sf):
    return order_days(spark, sf)


@register("s15_request_plan", f"""
    SELECT o_orderpriority, "Date", "Date" AS "datePick_now", "Date" AS "datePick_now0to24", "Date" AS "datePick_start",
           "Date" AS "datePick_end", '00:00' AS "StationTime_start",
           CASE WHEN "Date" LIKE '31/12%' THEN '23:55' ELSE '23:59' END AS "StationTime_end",
           CASE WHEN "Date" LIKE '31/12%' THEN '10' ELSE '1' END AS rain_type, 'print' AS button
    FROM {_ORDER_DAYS}""")
def s15(spark, sf):
    return request_plan(order_days(spark, sf))
