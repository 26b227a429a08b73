"""P, L, F, G, D, U: projections, filters, scalar functions, generators, duplicates, union."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiq.functions.dates import parse_iso
from civiq.functions.gauges import has_reading, level_of, station_of
from civiq.functions.tags import parse_tags, split_tag_literal
from civiq.functions.values import text_to_bigint, text_to_double
from civiq.operators.columns import (
    clean_names, drop_columns, order_columns, select_numeric, select_renamed, standardize_names, union_by_name,
)
from civiq.operators.dedupe import drop_exact_duplicates, drop_rare_duplicates, first_rows, keep_first, sort_descending
from civiq.operators.filters import (
    any_missing, drop_incomplete, keep_agreeing, keep_matching, keep_not_equal, keep_present, keep_province,
    keep_tag, keep_years,
)
from civiq.operators.fill import fill_constant
from civiq.operators.spatial import assign_polygons
from civiq.operators.stats import value_counts
from civiq.operators.tags import explode_tags
from civiq.operators.tickets import (
    add_date_parts, add_status_flag, add_upper_name, cast_first_timestamp, cast_lat_lon, coordinate_rejects,
    normalize_dates, parse_timestamps, split_coordinates,
)
from civiq.schemas import UNUSED_TICKET_COLUMNS
from civiq.sources.stations import parse_station_arrays, station_metadata
from workload.registry import register
from workload.views import duck, polygons, table, view

TICKETS = duck("tickets")
# Ticket time without its offset, for DuckDB.
TICKET_TS = 'CAST(substr("timestamp", 1, 26) AS TIMESTAMP)'
# The engines' own list functions; results are joined to text so both return strings.
DUCK_TAGS = (
    "list_filter(list_transform(string_split(regexp_replace(\"type\", '[{}''\"]', '', 'g'), ','), lambda x: trim(x)), lambda x: x <> '')"
)


@register("p1_standardize_names", """
    SELECT event_id, user_id AS user_id_2, event_type AS user_id, value AS col_4 FROM events""")
def p1(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    named = standardize_names(df.toDF(" Event-ID!", "User ID", "user..id", "ค่า"))
    return named


@register("p2_clean_names", """
    SELECT event_id AS "_event_id_", user_id AS "user__id", event_type AS etype FROM events""")
def p2(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return clean_names(df.toDF(" Event ID ", "User  ID", "\tEType"))


@register("p3_drop_columns", f"""
    SELECT ticket_id, type, organization, coords, "timestamp", last_activity, province, district, subdistrict FROM {TICKETS}""")
def p3(spark, sf):
    return drop_columns(view(spark, sf, "tickets"), UNUSED_TICKET_COLUMNS)


@register("p4_subset_rename", """
    SELECT 'RF.S.' || CAST(s_suppkey AS STRING) AS "StationCode", s_name AS "StationName_Short",
           'NATION_' || CAST(s_suppkey % 25 AS STRING) AS "DistrictName",
           CAST(CAST(13 + s_suppkey % 7 AS STRING) || '.25' AS DOUBLE) AS "Latitude", CAST(100.5 AS DOUBLE) AS "Longitude",
           '19/11/2568 21:45' AS "LastReadingTime", CAST(s_suppkey AS STRING) AS "DistrictCode_from_JS"
    FROM supplier WHERE s_suppkey % 10 <> 9""")
def p4(spark, sf):
    return station_metadata(parse_station_arrays(view(spark, sf, "station_texts"), "txt"))


@register("p5_order_columns", "SELECT s_name AS s_name, s_acctbal AS a_bal, s_suppkey AS k_key FROM supplier")
def p5(spark, sf):
    """Names with dots are ordered as they are; only the result is renamed."""
    dotted = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_name").toDF("k.key", "a.bal", "s.name")
    ordered = order_columns(dotted, ["s.name"])
    return ordered.toDF(*[c.replace(".", "_") for c in ordered.columns])


@register("p6_numeric_columns", "SELECT p_partkey, p_size, p_retailprice FROM part")
def p6(spark, sf):
    return select_numeric(table(spark, sf, "part").withColumn("flag", F.col("p_size") > 10))


@register("p7_date_parts", f"""
    SELECT ticket_id, CAST(year({TICKET_TS}) AS BIGINT) AS y, CAST(month({TICKET_TS}) AS BIGINT) AS m,
           CAST(day(last_day({TICKET_TS})) AS BIGINT) AS d FROM {TICKETS}""")
def p7(spark, sf):
    parts = add_date_parts(parse_timestamps(view(spark, sf, "tickets")))
    return parts.select(
        "ticket_id", F.col("year_timestamp").cast("bigint").alias("y"), F.col("month_timestamp").cast("bigint").alias("m"),
        F.col("days_timestamp").cast("bigint").alias("d"),
    )


COORDS = f"""
    (SELECT *, TRY_CAST(split_part(coords, ',', 1) AS DOUBLE) AS longitude, TRY_CAST(split_part(coords, ',', 2) AS DOUBLE) AS latitude
     FROM {TICKETS} WHERE coords IS NULL OR coords NOT LIKE '%,%,%')"""


@register("p8_split_coordinates", f"SELECT ticket_id, longitude, latitude FROM {COORDS}")
def p8(spark, sf):
    return split_coordinates(view(spark, sf, "tickets")).select("ticket_id", "longitude", "latitude")


@register("p8_coordinate_rejects", f"SELECT ticket_id, coords FROM {TICKETS} WHERE coords LIKE '%,%,%'")
def p8_rejects(spark, sf):
    return coordinate_rejects(view(spark, sf, "tickets")).select("ticket_id", "coords")


@register("p9_status_flag", f"SELECT name, status, coalesce(status = 'active', FALSE) AS is_active FROM {duck('jobs')}")
def p9(spark, sf):
    return add_status_flag(view(spark, sf, "jobs")).select("name", "status", "is_active")


@register("p10_upper_trim", f"SELECT name, upper(trim(name)) AS name_upper FROM {duck('jobs')}")
def p10(spark, sf):
    return add_upper_name(view(spark, sf, "jobs")).select("name", "name_upper")


@register("l1_drop_incomplete", f"""
    SELECT ticket_id, star, province FROM {TICKETS} WHERE ticket_id IS NOT NULL AND type IS NOT NULL AND organization IS NOT NULL
    AND coords IS NOT NULL AND "timestamp" IS NOT NULL AND last_activity IS NOT NULL""")
def l1(spark, sf):
    return drop_incomplete(view(spark, sf, "tickets")).select("ticket_id", "star", "province")


@register("l2_not_null", f"SELECT name, value FROM {duck('jobs')} WHERE value IS NOT NULL")
def l2(spark, sf):
    return keep_present(view(spark, sf, "jobs"), "value").select("name", "value")


@register("l3_year_range", "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def l3(spark, sf):
    """On the raw Parquet column, so the range reaches the scan."""
    return keep_years(table(spark, sf, "orders"), 1996, 1998, "o_orderdate").select("o_orderkey", "o_custkey")


@register("l4_province", f"""
    SELECT ticket_id, 'กรุงเทพมหานคร' AS province FROM {TICKETS} WHERE province LIKE '%กรุงเทพ%'""")
def l4(spark, sf):
    return keep_province(view(spark, sf, "tickets")).select("ticket_id", "province")


@register("l5_not_equal", f"SELECT ticket_id, type FROM {TICKETS} WHERE type IS DISTINCT FROM '{{}}'")
def l5(spark, sf):
    return keep_not_equal(view(spark, sf, "tickets"), "type", "{}").select("ticket_id", "type")


@register("l6_tag_equality", f"""
    SELECT ticket_id, tag AS type_list FROM (SELECT ticket_id, unnest({DUCK_TAGS}) AS tag FROM {TICKETS}) WHERE tag = 'flood'""")
def l6(spark, sf):
    return keep_tag(explode_tags(view(spark, sf, "tickets")), "flood").select("ticket_id", "type_list")


@register("l7_regex_filter", f"SELECT ticket_id, type FROM {TICKETS} WHERE regexp_matches(type, 'flood')")
def l7(spark, sf):
    return keep_matching(view(spark, sf, "tickets"), "type", "flood").select("ticket_id", "type")


@register("l8_existence_test", f"""
    SELECT 'SUBDISTR_1' AS name, count(*) > 0 AS missing FROM {duck('boundaries')} b
    WHERE SUBDISTR_1 NOT IN (SELECT sname FROM {duck('checks')})
    UNION ALL
    SELECT 'DISTRICT_N', count(*) > 0 FROM {duck('boundaries')} b WHERE DISTRICT_N NOT IN (SELECT dname FROM {duck('checks')})""")
def l8(spark, sf):
    boundaries, checks = view(spark, sf, "boundaries"), view(spark, sf, "checks")
    tests = [("SUBDISTR_1", "sname"), ("DISTRICT_N", "dname")]
    flags = [any_missing(boundaries, a, checks, b).select(F.lit(a).alias("name"), "missing") for a, b in tests]
    return union_by_name(flags)


MATCHED = f"""
    (SELECT t.*, b.poly_id, b.SUBDISTR_1, b.DISTRICT_N FROM
      (SELECT c.*, (SELECT min(poly_id) FROM {duck('boundaries')} b
                    WHERE longitude > x0 AND longitude < x1 AND latitude > y0 AND latitude < y1) AS pid FROM {COORDS} c) t
     LEFT JOIN {duck('boundaries')} b ON b.poly_id = t.pid)"""


@register("l9_address_agreement", f"""
    SELECT ticket_id, district, subdistrict FROM {MATCHED} WHERE DISTRICT_N = district AND SUBDISTR_1 = subdistrict""")
def l9(spark, sf):
    points = split_coordinates(view(spark, sf, "tickets"))
    areas = polygons(view(spark, sf, "boundaries"))
    joined = assign_polygons(points, areas, ["DISTRICT_N", "SUBDISTR_1"])
    return keep_agreeing(joined, [("DISTRICT_N", "district"), ("SUBDISTR_1", "subdistrict")]).select(
        "ticket_id", "district", "subdistrict"
    )


@register("f1_strict_iso", f"""
    SELECT ticket_id, strftime({TICKET_TS}, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           strftime(CAST(substr(last_activity, 1, 26) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS last_ts FROM {TICKETS}""")
def f1(spark, sf):
    pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return view(spark, sf, "tickets").select(
        "ticket_id", F.date_format(parse_iso(F.col("timestamp")), pattern).alias("ts"),
        F.date_format(parse_iso(F.col("last_activity")), pattern).alias("last_ts"),
    )


_FORMS = {
    0: ("date_format(ts, \"yyyy-MM-dd'T'HH'Z'\")", "date_trunc('hour', ts)"),
    1: ("date_format(ts, \"yyyy-MM-dd'T'HH:mm'+7'\")", "date_trunc('minute', ts) - INTERVAL 7 HOUR"),
    2: ("date_format(ts, 'yyyyMMdd')", "date_trunc('day', ts)"),
    3: ("date_format(ts, 'yyyy-MM-dd HH')", "date_trunc('hour', ts)"),
    4: ("date_format(ts, \"yyyy-MM-dd'T'HH'-3:30'\")", "date_trunc('hour', ts) + INTERVAL 210 MINUTE"),
    5: ("date_format(ts, \"yyyyMMdd'T'HHmmss'+0130'\")", "date_trunc('second', ts) - INTERVAL 90 MINUTE"),
    6: ("date_format(ts, 'yyyyMM')", "NULL"),
}


@register("f1_iso_forms", f"""
    SELECT event_id, strftime(CASE event_id % 7 {' '.join(f'WHEN {k} THEN {sql}' for k, (_, sql) in _FORMS.items())} END,
        '%Y-%m-%d %H:%M:%S') AS ts FROM events""")
def f1_forms(spark, sf):
    """Bare hours, basic forms and short offsets; six digits are no date."""
    text = " ".join(f"WHEN {k} THEN {form}" for k, (form, _) in _FORMS.items())
    df = table(spark, sf, "events").selectExpr("event_id", f"CASE event_id % 7 {text} END AS text")
    return df.select("event_id", F.date_format(parse_iso(F.col("text"), "null"), "yyyy-MM-dd HH:mm:ss").alias("ts"))


# Every fourth date is broken.
_LOOSE_DATE = "CASE WHEN o_orderkey % 4 = 1 THEN 'soon' ELSE {iso} || ' 10:20:30' END"


@register("f2_tolerant_timestamp", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:20:30' END AS order_time FROM orders""")
def f2(spark, sf):
    text = _LOOSE_DATE.format(iso="date_format(o_orderdate, 'yyyy-MM-dd')")
    df = table(spark, sf, "orders").select("o_orderkey", F.expr(text).alias("order_time"))
    return cast_first_timestamp(df).withColumn("order_time", F.date_format("order_time", "yyyy-MM-dd HH:mm:ss"))


@register("f3_tolerant_lat_lon", """
    SELECT s_suppkey, CASE WHEN s_suppkey % 6 <> 2 THEN s_acctbal END AS site_lat,
           CASE WHEN s_suppkey % 5 <> 2 THEN CAST(s_suppkey AS DOUBLE) END AS site_lng FROM supplier""")
def f3(spark, sf):
    df = table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "CASE WHEN s_suppkey % 6 = 2 THEN 'north' ELSE CAST(s_acctbal AS STRING) END AS site_lat",
        "CASE WHEN s_suppkey % 5 = 2 THEN '' ELSE CAST(s_suppkey AS STRING) END AS site_lng",
    )
    return cast_lat_lon(df)


@register("f4_text_to_double", """
    SELECT event_id, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN value
           WHEN 4 THEN -value WHEN 5 THEN 0.5 ELSE 1250.0 END AS number FROM events""")
def f4(spark, sf):
    text = F.expr(
        "CASE event_id % 7 WHEN 0 THEN '-' WHEN 1 THEN '1.2.3' WHEN 2 THEN '1d' WHEN 3 THEN ' ' || CAST(value AS STRING) || '\t'"
        " WHEN 4 THEN '-' || CAST(value AS STRING) WHEN 5 THEN '.5' ELSE '1.25e3' END"
    )
    return table(spark, sf, "events").select("event_id", text_to_double(text, "null").alias("number"))


RAIN = duck("rain_lines")
READINGS = f"""
    (SELECT strftime(day, '%d/%m/%Y') AS "Date", regexp_extract(line, '{{p}}', 2) AS "Station",
            TRY_CAST(NULLIF(trim(regexp_extract(line, '{{p}}', 1)), '') AS DOUBLE) AS "WaterLevel"
     FROM {RAIN} WHERE regexp_matches(line, '{{p}}'))""".replace(
    "{p}", r"[-\d\.]+\s+[-\d\.]+\s+([\d\.\-]+|\s*)\s*RF\.(\S+)"
)


@register("f5_gauge_extract", f"""
    SELECT "Date", "Station", "WaterLevel" FROM {READINGS}""")
def f5(spark, sf):
    lines = view(spark, sf, "rain_lines").filter(has_reading(F.col("line")))
    return lines.select(
        F.date_format("day", "dd/MM/yyyy").alias("Date"), station_of(F.col("line")).alias("Station"),
        level_of(F.col("line")).alias("WaterLevel"),
    )


@register("f6_parse_tags", f"""
    SELECT ticket_id, array_to_string(coalesce({DUCK_TAGS}, []), '|') AS tags,
           CAST(len(coalesce({DUCK_TAGS}, [])) AS BIGINT) AS n FROM {TICKETS}""")
def f6(spark, sf):
    tags = parse_tags(F.col("type"))
    return view(spark, sf, "tickets").select(
        "ticket_id", F.array_join(tags, "|").alias("tags"), F.size(tags).cast("bigint").alias("n")
    )


@register("f7_split_literal", f"""
    SELECT ticket_id, array_to_string(string_split(trim(type, '{{}}'), ','), '|') AS parts FROM {TICKETS} WHERE type IS NOT NULL""")
def f7(spark, sf):
    df = view(spark, sf, "tickets").filter("type IS NOT NULL")
    return df.select("ticket_id", F.array_join(split_tag_literal(F.col("type")), "|").alias("parts"))


@register("f8_text_functions", """
    SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up, trim('  ' || p_brand || ' ') AS trimmed,
           replace(p_name, ' ', '_') AS replaced, split_part(p_name, ' ', 1) AS word, contains(p_name, 'ring') AS has_ring,
           starts_with(p_brand, 'Brand#1') AS brand_1 FROM part""")
def f8(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.lower("p_type").alias("low"), F.upper("p_name").alias("up"),
        F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("trimmed"),
        F.regexp_replace("p_name", " ", "_").alias("replaced"), F.split("p_name", " ")[0].alias("word"),
        F.col("p_name").contains("ring").alias("has_ring"), F.col("p_brand").startswith("Brand#1").alias("brand_1"),
    )


@register("f9_normalize_dates", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN strftime(o_orderdate, '%d %m %Y') END AS when_text FROM orders""")
def f9(spark, sf):
    text = F.expr(
        "CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'yyyy/MM/dd')"
        " WHEN 2 THEN date_format(o_orderdate, 'MM/dd/yyyy') WHEN 3 THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")"
        " ELSE 'someday' END"
    )
    df = table(spark, sf, "orders").select("o_orderkey", text.alias("when_text"))
    return normalize_dates(df, ["when_text", "unknown"], "%d %m %Y")


MEASURES = duck("measures")


@register("f10_fill_constant", f"""
    SELECT l_orderkey, l_linenumber, coalesce(quantity, 0) AS quantity, coalesce(price, 0) AS price, coalesce(tax, 0) AS tax,
           CAST(coalesce(level, 0) AS BIGINT) AS level FROM {MEASURES}""")
def f10(spark, sf):
    filled = fill_constant(view(spark, sf, "measures"), 0)
    return filled.select("l_orderkey", "l_linenumber", "quantity", "price", "tax", F.col("level").cast("bigint").alias("level"))


@register("f11_strict_int", f"""
    SELECT poly_id, CAST(SUBDISTRIC AS BIGINT) AS scode, CAST(DISTRICT_I AS BIGINT) AS dcode FROM {duck('boundaries')}""")
def f11(spark, sf):
    return view(spark, sf, "boundaries").select(
        "poly_id", text_to_bigint(F.col("SUBDISTRIC")).alias("scode"), text_to_bigint(F.col("DISTRICT_I")).alias("dcode")
    )


@register("g1_explode_tags", f"""
    SELECT ticket_id, unnest(CASE WHEN len({DUCK_TAGS}) = 0 THEN [NULL] ELSE {DUCK_TAGS} END) AS type_list
    FROM {TICKETS} WHERE type IS NOT NULL""")
def g1(spark, sf):
    return explode_tags(view(spark, sf, "tickets")).select("ticket_id", "type_list")


@register("d1_exact_duplicates", "SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag, l_discount FROM lineitem")
def d1(spark, sf):
    return drop_exact_duplicates(table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_discount"))


@register("d1_rare_duplicates", "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 50 = 0)")
def d1_rare(spark, sf):
    """Whole rows, few of them repeated."""
    rows = table(spark, sf, "lineitem")
    return drop_rare_duplicates(rows.unionByName(rows.filter("l_orderkey % 50 = 0")))


@register("d2_keep_first", """
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def d2(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    return keep_first(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@register("d3_sort_descending", f"""
    SELECT type AS value, count(*) AS count FROM {TICKETS} WHERE type IS NOT NULL GROUP BY type ORDER BY count DESC, value""")
def d3(spark, sf):
    return sort_descending(value_counts(view(spark, sf, "tickets"), "type"), "count", "value")


@register("d4_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def d4(spark, sf):
    """The sampling operator itself: the limit is the feature."""
    return first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10, "o_totalprice", "o_orderkey")


@register("u1_union_by_name", """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part""")
def u1(spark, sf):
    customers = select_renamed(
        table(spark, sf, "customer"), ["c_custkey", "c_name", "c_mktsegment"],
        {"c_custkey": "key", "c_name": "name", "c_mktsegment": "segment"},
    )
    suppliers = select_renamed(
        table(spark, sf, "supplier"), ["s_acctbal", "s_suppkey", "s_name"],
        {"s_suppkey": "key", "s_name": "name", "s_acctbal": "balance"},
    )
    parts = select_renamed(table(spark, sf, "part"), ["p_partkey", "p_name"], {"p_partkey": "key", "p_name": "name"})
    return union_by_name([customers, suppliers, parts])
