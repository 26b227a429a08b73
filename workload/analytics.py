"""J, A, M: joins, aggregates, feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiq.operators.boundaries import join_counts, repair_boundaries, report_counts, to_lonlat
from civiq.operators.features import feature_target, prepare_features, train_test_split
from civiq.operators.fill import fill_missing
from civiq.operators.rain import extract_readings, pivot_stations
from civiq.operators.spatial import assign_polygons, verify_addresses
from civiq.operators.stats import (
    correlation_matrix, describe_categories, group_size, histogram, null_counts, row_count, summary_stats,
    top_categories, value_counts,
)
from civiq.operators.tags import cooccurrence, explode_tags
from civiq.operators.tickets import split_coordinates
from workload.registry import register
from workload.rows import COORDS, DUCK_TAGS, MATCHED, MEASURES, READINGS, TICKETS
from workload.views import duck, polygons, table, view

BOUNDARIES, CHECKS = duck("boundaries"), duck("checks")
STATIONS = [f"S.{i:02d}" for i in range(100)]
NUMBERS = ["quantity", "price", "discount", "tax", "level"]


def points(spark, sf):
    return split_coordinates(view(spark, sf, "tickets"))


def areas(spark, sf):
    return polygons(view(spark, sf, "boundaries"))


@register("j1_spatial_join", f"""
    SELECT ticket_id, poly_id, "SUBDISTR_1", "DISTRICT_N" FROM {MATCHED}""")
def j1(spark, sf):
    joined = assign_polygons(points(spark, sf), areas(spark, sf), ["SUBDISTR_1", "DISTRICT_N"])
    return joined.select("ticket_id", "poly_id", "SUBDISTR_1", "DISTRICT_N")


@register("j1_spatial_join_shuffled", f"""
    SELECT ticket_id, poly_id, "SUBDISTR_1" FROM {MATCHED}""")
def j1_shuffled(spark, sf):
    """The plan for boundaries beyond a broadcast: both sides shuffled on the cell, busy cells salted."""
    joined = assign_polygons(points(spark, sf), areas(spark, sf), ["SUBDISTR_1"], broadcast_bytes=0, salt_rows=500)
    return joined.select("ticket_id", "poly_id", "SUBDISTR_1")


@register("j2_keep_first_match", f"""
    SELECT poly_id, count(*) AS n_points FROM (
      SELECT ticket_id, min(poly_id) AS poly_id FROM {COORDS} LEFT JOIN {BOUNDARIES} b
      ON longitude > x0 AND longitude < x1 AND latitude > y0 AND latitude < y1 GROUP BY ticket_id) GROUP BY poly_id""")
def j2(spark, sf):
    """A point in two overlapping polygons counts once, for the lower index."""
    first = assign_polygons(points(spark, sf), areas(spark, sf), [])
    return first.groupBy("poly_id").agg(F.count(F.lit(1)).alias("n_points"))


@register("j3_verified_tickets", f"""
    SELECT ticket_id, type, district, subdistrict, longitude, latitude FROM {MATCHED}
    WHERE "DISTRICT_N" = district AND "SUBDISTR_1" = subdistrict""")
def j3(spark, sf):
    return verify_addresses(points(spark, sf), areas(spark, sf)).select(
        "ticket_id", "type", "district", "subdistrict", "longitude", "latitude"
    )


@register("j4_choropleth_join", f"""
    SELECT poly_id, "SUBDISTR_1", subdistrict, n FROM {BOUNDARIES} LEFT JOIN
      (SELECT subdistrict, count(*) AS n FROM {TICKETS} WHERE subdistrict IS NOT NULL GROUP BY subdistrict) c
    ON "SUBDISTR_1" = subdistrict""")
def j4(spark, sf):
    counts = group_size(view(spark, sf, "tickets"), "subdistrict", "n")
    return join_counts(view(spark, sf, "boundaries"), counts).select("poly_id", "SUBDISTR_1", "subdistrict", "n")


REPAIRED = f"""
    (SELECT b.* REPLACE (
        CASE WHEN (SELECT count(*) > 0 FROM {BOUNDARIES} x WHERE x."SUBDISTR_1" NOT IN (SELECT sname FROM {CHECKS}))
             THEN (SELECT max_by(sname, seq) FROM {CHECKS} c WHERE c.scode = CAST(b."SUBDISTRIC" AS BIGINT)) ELSE b."SUBDISTR_1" END AS "SUBDISTR_1",
        CASE WHEN (SELECT count(*) > 0 FROM {BOUNDARIES} x WHERE x."DISTRICT_N" NOT IN (SELECT dname FROM {CHECKS}))
             THEN (SELECT max_by(dname, seq) FROM {CHECKS} c WHERE c.dcode = CAST(b."DISTRICT_I" AS BIGINT)) ELSE b."DISTRICT_N" END AS "DISTRICT_N")
     FROM {BOUNDARIES} b)"""


@register("j5_name_repair", f"""
    SELECT poly_id, "SUBDISTR_1", "DISTRICT_N", CAST("SUBDISTRIC" AS BIGINT) AS "SUBDISTRIC" FROM {REPAIRED}""")
def j5(spark, sf):
    return repair_boundaries(view(spark, sf, "boundaries"), view(spark, sf, "checks")).select(
        "poly_id", "SUBDISTR_1", "DISTRICT_N", "SUBDISTRIC"
    )


# Snyder's footpoint-latitude series, which differs from the one the library uses.
_SNYDER = """
  WITH c AS (SELECT 6378137.0::DOUBLE AS a, (2 - 1 / 298.257223563::DOUBLE) / 298.257223563::DOUBLE AS e2),
  k AS (SELECT a, e2, e2 / (1 - e2) AS ep2, (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2)) AS e1 FROM c),
  p AS (SELECT s_suppkey, 500000::DOUBLE + (s_suppkey % 100) * 1000 AS east, 1500000::DOUBLE + floor(s_suppkey / 1e2) * 1000 AS north FROM supplier),
  m AS (SELECT *, north / 0.9996 / (a * (1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * e2 ** 3 / 256)) AS mu FROM p, k),
  f AS (SELECT *, mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * sin(4 * mu)
        + (151 * e1 ** 3 / 96) * sin(6 * mu) + (1097 * e1 ** 4 / 512) * sin(8 * mu) AS p1 FROM m),
  g AS (SELECT *, ep2 * cos(p1) ** 2 AS c1, tan(p1) ** 2 AS t1, a / sqrt(1 - e2 * sin(p1) ** 2) AS n1,
        a * (1 - e2) / (1 - e2 * sin(p1) ** 2) ** 1.5 AS r1 FROM f),
  h AS (SELECT *, (east - 500000) / (n1 * 0.9996) AS d FROM g)
  SELECT s_suppkey AS poly_id,
    round(99 + degrees((d - (1 + 2 * t1 + c1) * d ** 3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1 ** 2 + 8 * ep2 + 24 * t1 ** 2) * d ** 5 / 120) / cos(p1)), 5) AS lon,
    round(degrees(p1 - (n1 * tan(p1) / r1) * (d ** 2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 ** 2 - 9 * ep2) * d ** 4 / 24
      + (61 + 90 * t1 + 298 * c1 + 45 * t1 ** 2 - 252 * ep2 - 3 * c1 ** 2) * d ** 6 / 720)), 5) AS lat
  FROM h"""


def _reprojected(spark, sf, epsg):
    """Rectangles in a zone 47, their first corner as longitude and latitude."""
    east, north = "double(500000 + (s_suppkey % 100) * 1000)", "double(1500000 + floor(s_suppkey / 1e2) * 1000)"
    edges = f"array(named_struct('x1', {east}, 'y1', {north}, 'x2', {east} + 1000, 'y2', {north}))"
    metric = table(spark, sf, "supplier").selectExpr("s_suppkey AS poly_id", f"{epsg} AS epsg", f"{edges} AS edges")
    first = F.get("edges", F.lit(0))
    return to_lonlat(metric).select("poly_id", F.round(first.x1, 5).alias("lon"), F.round(first.y1, 5).alias("lat"))


@register("j6_reproject", _SNYDER)
def j6(spark, sf):
    return _reprojected(spark, sf, 32647)


# Another series on another ellipsoid, then geocentric coordinates, the way back iterated.
_INDIAN = _SNYDER.replace("6378137.0", "6377276.345").replace("298.257223563", "300.8017").replace(", 5) AS l", ", 12) AS l") + """ """
_GEOCENTRIC = """
  SELECT poly_id, radians(lon) AS l, radians(lat) AS b, 6377276.345::DOUBLE AS a, (2 - 1 / 300.8017::DOUBLE) / 300.8017::DOUBLE AS e2 FROM old"""
_ITERATED = " ".join(f"""
  , i{k + 1} AS (SELECT *, atan2(z + 0.00669437999014132 * 6378137.0 / sqrt(1 - 0.00669437999014132 * sin(f{k}) ** 2) * sin(f{k}), r) AS f{k + 1} FROM i{k})"""
    for k in range(6))


@register("j6_reproject_indian", f"""
  WITH old AS ({_INDIAN}), g AS ({_GEOCENTRIC}),
  n AS (SELECT *, a / sqrt(1 - e2 * sin(b) ** 2) AS n FROM g),
  p AS (SELECT poly_id, n * cos(b) * cos(l) + 210 AS x, n * cos(b) * sin(l) + 814 AS y, n * (1 - e2) * sin(b) + 289 AS z FROM n),
  i0 AS (SELECT *, sqrt(x * x + y * y) AS r, atan2(z, sqrt(x * x + y * y)) AS f0 FROM p) {_ITERATED}
  SELECT poly_id, round(degrees(atan2(y, x)), 5) AS lon, round(degrees(f6), 5) AS lat FROM i6""")
def j6_indian(spark, sf):
    """The same rectangles on the datum usual for older maps of the region."""
    return _reprojected(spark, sf, 24047)


@register("a1_row_count", "SELECT count(*) AS rows FROM events")
def a1(spark, sf):
    return row_count(table(spark, sf, "events"))


_TICKET_COLUMNS = [
    "ticket_id", "type", "organization", "coords", "timestamp", "last_activity",
    "photo", "photo_after", "star", "province", "district", "subdistrict",
]


@register("a2_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS nulls FROM {TICKETS}" for c in _TICKET_COLUMNS))
def a2(spark, sf):
    return null_counts(view(spark, sf, "tickets"))


@register("a3_top_categories", f"""
    SELECT type AS category, count(*) AS count FROM {TICKETS} GROUP BY type ORDER BY count DESC, category LIMIT 10""")
def a3(spark, sf):
    return top_categories(view(spark, sf, "tickets"))


@register("a4_value_counts", f"SELECT type AS value, count(*) AS count FROM {TICKETS} WHERE type IS NOT NULL GROUP BY type")
def a4(spark, sf):
    return value_counts(view(spark, sf, "tickets"), "type")


@register("a5_group_size", f"""
    SELECT subdistrict, count(*) AS count FROM {TICKETS} WHERE subdistrict IS NOT NULL GROUP BY subdistrict""")
def a5(spark, sf):
    return group_size(view(spark, sf, "tickets"), "subdistrict")


def _summary_sql(source: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        x = f'CAST("{c}" AS DOUBLE)'
        stats = {
            "count": f"CAST(count({x}) AS DOUBLE)", "mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})",
            "25%": f"quantile_cont({x}, 0.25)", "50%": f"quantile_cont({x}, 0.5)", "75%": f"quantile_cont({x}, 0.75)",
            "max": f"max({x})",
        }
        parts += [f"SELECT '{c}' AS \"column\", '{s}' AS stat, round({e}, 4) AS value FROM {source}" for s, e in stats.items()]
    return " UNION ALL ".join(parts)


@register("a6_summary_stats", _summary_sql(MEASURES, NUMBERS))
def a6(spark, sf):
    stats = summary_stats(view(spark, sf, "measures").select(*NUMBERS))
    return stats.select("column", "stat", F.round("value", 4).alias("value"))


@register("a6_summary_timestamps", """
    SELECT 'ts' AS "column", unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS stat,
      unnest([count(ts), NULL, NULL, NULL, NULL, NULL, NULL, NULL])::DOUBLE AS value,
      unnest([NULL, CAST(round(avg(epoch_us(ts)) / 1e6) AS BIGINT), NULL, epoch_us(min(ts)) // 1000000,
              CAST(floor(quantile_cont(epoch_us(ts)::DOUBLE, 0.25) / 1e6) AS BIGINT), CAST(floor(quantile_cont(epoch_us(ts)::DOUBLE, 0.5) / 1e6) AS BIGINT),
              CAST(floor(quantile_cont(epoch_us(ts)::DOUBLE, 0.75) / 1e6) AS BIGINT), epoch_us(max(ts)) // 1000000]) AS epoch FROM events""")
def a6_times(spark, sf):
    stats = summary_stats(table(spark, sf, "events").select("ts"))
    seconds = F.unix_micros("ts_value") / 1e6
    epoch = F.when(F.col("stat") == "mean", F.round(seconds)).otherwise(F.floor(seconds)).cast("bigint")
    return stats.select("column", "stat", "value", epoch.alias("epoch"))


@register("a6_summary_categories", f"""
    WITH v AS (SELECT unnest(['status', 'name']) AS "column", unnest([status, name]) AS v FROM {duck('jobs')}),
    c AS (SELECT "column", v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY ALL),
    s AS (SELECT "column", CAST(sum(n) AS DOUBLE) AS cnt, CAST(count(*) AS DOUBLE) AS uniq, CAST(max(n) AS DOUBLE) AS freq,
                 first(v ORDER BY n DESC, v) AS top FROM c GROUP BY "column")
    SELECT "column", 'count' AS stat, cnt AS value, CAST(NULL AS STRING) AS top FROM s UNION ALL
    SELECT "column", 'unique', uniq, NULL FROM s UNION ALL SELECT "column", 'top', NULL, top FROM s UNION ALL
    SELECT "column", 'freq', freq, NULL FROM s""")
def a6_categories(spark, sf):
    return describe_categories(view(spark, sf, "jobs").select("status", "name"))


_CORR = "SELECT '{a}' AS \"row\", '{b}' AS col, round(corr({a}, {b}), 6) AS corr FROM {source}"


@register("a7_correlation", " UNION ALL ".join(_CORR.format(a=a, b=b, source=MEASURES) for a in NUMBERS for b in NUMBERS))
def a7(spark, sf):
    matrix = correlation_matrix(view(spark, sf, "measures").select(*NUMBERS))
    return matrix.select("row", "col", F.round("corr", 6).alias("corr"))


def histogram_sql(source: str, column: str) -> str:
    return f"""
      SELECT '{column}' AS "column", b.bin AS bin, round(lo + b.bin * w, 6) AS "left",
             round(CASE WHEN b.bin = 19 THEN hi ELSE lo + (b.bin + 1) * w END, 6) AS "right", coalesce(n, 0) AS count
      FROM (SELECT min({column}) AS lo, max({column}) AS hi, (max({column}) - min({column})) / 20 AS w FROM {source}) m
      CROSS JOIN (SELECT unnest(range(20)) AS bin) b
      LEFT JOIN (SELECT bin, count(*) AS n FROM (
          SELECT CASE WHEN v < lo + g * w THEN g - 1 WHEN g < 19 AND v >= lo + (g + 1) * w THEN g + 1 ELSE g END AS bin FROM (
            SELECT CAST(v AS DOUBLE) AS v, lo, w, CAST(least(floor((v - lo) / (hi - lo) * 20), 19) AS BIGINT) AS g
            FROM (SELECT {column} AS v FROM {source} WHERE {column} IS NOT NULL),
                 (SELECT min({column}) AS lo, max({column}) AS hi, (max({column}) - min({column})) / 20 AS w FROM {source})))
        GROUP BY bin) c ON c.bin = b.bin"""


@register("a8_histogram", " UNION ALL ".join(histogram_sql(MEASURES, c) for c in ("quantity", "price")))
def a8(spark, sf):
    bins = histogram(view(spark, sf, "measures"), ["quantity", "price"])
    return bins.select("column", "bin", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"), "count")


@register("a9_cooccurrence", f"""
    SELECT tag, CAST(sum(n) AS BIGINT) AS count FROM (
      SELECT n, unnest(CASE WHEN len(parts) = 1 THEN ['flood'] ELSE list_filter(parts, lambda x: x <> 'flood') END) AS tag FROM (
        SELECT string_split(trim(type, '{{}}'), ',') AS parts, count(*) AS n FROM {TICKETS}
        WHERE regexp_matches(type, 'flood') GROUP BY type)) GROUP BY tag""")
def a9(spark, sf):
    return cooccurrence(view(spark, sf, "tickets"), "flood")


def pivot_sql(prefix: str = "") -> str:
    columns = ", ".join(
        f"""max("WaterLevel") FILTER (WHERE "Station" = '{s}') AS {s.lower().replace('.', '_')}""" for s in STATIONS
    )
    return f'{prefix}SELECT "Date", {columns} FROM {READINGS} GROUP BY "Date"'


def plain_names(wide):
    return wide.toDF(*[c if c == "Date" else c.lower().replace(".", "_") for c in wide.columns])


@register("a10_pivot", pivot_sql())
def a10(spark, sf):
    lines = view(spark, sf, "rain_lines").withColumn("Date", F.date_format("day", "dd/MM/yyyy"))
    return plain_names(pivot_stations(extract_readings(lines), STATIONS))


@register("a11_choropleth", f"""
    SELECT poly_id, "SUBDISTR_1", "DISTRICT_N", coalesce(n, 0) AS flood_report_count FROM {BOUNDARIES} LEFT JOIN (
      SELECT subdistrict, count(*) AS n FROM (SELECT subdistrict, unnest({DUCK_TAGS}) AS tag FROM {TICKETS})
      WHERE tag = 'flood' AND subdistrict IS NOT NULL GROUP BY subdistrict) c ON "SUBDISTR_1" = subdistrict""")
def a11(spark, sf):
    exploded = explode_tags(view(spark, sf, "tickets"))
    counted = report_counts(exploded, view(spark, sf, "boundaries"), "flood")
    return counted.select("poly_id", "SUBDISTR_1", "DISTRICT_N", "flood_report_count")


def _fill_sql(statistic: str) -> str:
    cells = ", ".join(f"round(coalesce({c}, (SELECT {statistic.format(c=c)} FROM {MEASURES})), 4) AS {c}" for c in NUMBERS)
    return f"SELECT l_orderkey, l_linenumber, l_returnflag, {cells} FROM {MEASURES}"


def _filled(spark, sf, strategy):
    measures = view(spark, sf, "measures")
    keys = measures.select("l_orderkey", "l_linenumber", "l_returnflag")
    # Keys travel as text: they are not to be filled.
    as_text = measures.withColumns({c: F.col(c).cast("string") for c in keys.columns})
    filled = fill_missing(as_text, strategy)
    return filled.select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"),
        "l_returnflag", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in NUMBERS],
    )


@register("a12_fill_mean", _fill_sql("avg({c})"))
def a12_mean(spark, sf):
    return _filled(spark, sf, "mean")


@register("a12_fill_median", _fill_sql("quantile_cont(CAST({c} AS DOUBLE), 0.5)"))
def a12_median(spark, sf):
    return _filled(spark, sf, "median")


@register("a12_fill_mode", f"""
    SELECT l_orderkey, l_linenumber, l_returnflag, {', '.join(
        f"CAST(coalesce({c}, (SELECT {c} FROM {MEASURES} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS DOUBLE) AS {c}"
        for c in NUMBERS)} FROM {MEASURES}""")
def a12_mode(spark, sf):
    return _filled(spark, sf, "mode")


@register("a12_fill_zero", f"""
    SELECT l_orderkey, l_linenumber, l_returnflag, {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in NUMBERS)} FROM {MEASURES}""")
def a12_zero(spark, sf):
    return _filled(spark, sf, "zero")


def _features(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice")


@register("m1_feature_target", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def m1(spark, sf):
    return feature_target(_features(spark, sf), "o_totalprice", ("o_orderkey",))


RANKED = """
    (SELECT o_orderkey, o_custkey, o_totalprice,
            CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS STRING))) <= ceil(count(*) OVER () * CAST(0.2 AS DOUBLE))
                 THEN 'test' ELSE 'train' END AS split FROM orders)"""


@register("m2_train_test_split", f"SELECT o_orderkey, split FROM {RANKED}")
def m2(spark, sf):
    return train_test_split(_features(spark, sf), ["o_orderkey"]).select("o_orderkey", "split")


@register("m3_standard_scale", f"""
    SELECT o_orderkey, round((o_custkey - (SELECT avg(o_custkey) FROM {RANKED} WHERE split = 'train'))
        / (SELECT stddev_pop(o_custkey) FROM {RANKED} WHERE split = 'train'), 6) AS o_custkey, o_totalprice, split FROM {RANKED}""")
def m3(spark, sf):
    prepared = prepare_features(_features(spark, sf), "o_totalprice", ["o_orderkey"])
    return prepared.withColumn("o_custkey", F.round("o_custkey", 6))
