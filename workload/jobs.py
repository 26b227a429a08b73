"""E: the composite jobs, end to end over landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiq.operators.columns import union_by_name
from civiq.operators.rain import pivot_stations
from civiq.plans.jobs import clean_tickets, clean_tickets_from_files, explore, generic_etl, rain_history, station_table, ticket_etl
from civiq.session import scratch_dir
from civiq.sources.tables import read_csv, read_parquet, write_csv
from civiq.streaming.ingest import ingest_rain_reports, ingest_wide_history
from workload.analytics import REPAIRED, STATIONS, histogram_sql, pivot_sql, plain_names
from workload.registry import register
from workload.rows import COORDS, DUCK_TAGS, TICKETS
from workload.sources import geojson_lines, land_reports
from workload.views import duck, polygons, table, view


@register("e1_ticket_etl", """
    SELECT DISTINCT event_id, event_type, CASE WHEN event_id % 8 <> 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time_stamp,
           CASE WHEN event_id % 6 <> 1 THEN value END AS lat, CAST(user_id AS DOUBLE) AS lon FROM events""")
def e1(spark, sf):
    """Every third row is landed twice; some times and positions are broken."""
    raw = table(spark, sf, "events").selectExpr(
        "event_id AS `Event-ID`", "event_type AS `Event Type`",
        "CASE WHEN event_id % 8 = 3 THEN 'then' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS `Time Stamp`",
        "CASE WHEN event_id % 6 = 1 THEN 'here' ELSE CAST(value AS STRING) END AS ` Lat `", "user_id AS `Lon.`",
    )
    copies = F.when(F.col("Event-ID") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    source, target = scratch_dir(spark, "e1-in"), scratch_dir(spark, "e1-out")
    write_csv(raw.withColumn("copy", F.explode(copies)).drop("copy"), source)
    ticket_etl(spark, source, target, multiline=False)
    return read_parquet(spark, target).select(
        F.col("event_id").cast("bigint").alias("event_id"), "event_type",
        F.date_format("time_stamp", "yyyy-MM-dd HH:mm:ss").alias("time_stamp"), "lat", "lon",
    )


@register("e2_generic_etl", f"""
    SELECT name, status, value, upper(trim(name)) AS name_upper, coalesce(status = 'active', FALSE) AS is_active
    FROM {duck('jobs')} WHERE value IS NOT NULL""")
def e2(spark, sf):
    source, target = scratch_dir(spark, "e2-in"), scratch_dir(spark, "e2-out")
    write_csv(view(spark, sf, "jobs"), source)
    generic_etl(spark, source, target)
    return read_parquet(spark, target)


_CLEAN = f"""
    (SELECT t.* FROM (SELECT *, CAST(substr("timestamp", 1, 4) AS BIGINT) AS y,
        (SELECT min(poly_id) FROM {REPAIRED} b WHERE longitude > x0 AND longitude < x1 AND latitude > y0 AND latitude < y1) AS pid FROM {COORDS}) t
     JOIN {REPAIRED} b ON b.poly_id = t.pid
     WHERE ticket_id IS NOT NULL AND type IS NOT NULL AND organization IS NOT NULL AND coords IS NOT NULL AND "timestamp" IS NOT NULL
       AND last_activity IS NOT NULL AND y BETWEEN 2022 AND 2024 AND province LIKE '%กรุงเทพ%'
       AND b."DISTRICT_N" = district AND b."SUBDISTR_1" = subdistrict AND type <> '{{}}')"""


@register("e3_clean_tickets", f"""
    SELECT ticket_id, type, 'กรุงเทพมหานคร' AS province, district, subdistrict, y, longitude, latitude FROM {_CLEAN}""")
def e3(spark, sf):
    clean = clean_tickets(view(spark, sf, "tickets"), polygons(view(spark, sf, "boundaries")), view(spark, sf, "checks")).tickets
    return clean.select(
        "ticket_id", "type", "province", "district", "subdistrict", F.col("year_timestamp").cast("bigint").alias("y"),
        "longitude", "latitude",
    )


@register("e3_clean_tickets_exploded", f"""
    SELECT ticket_id, unnest({DUCK_TAGS}) AS type_list FROM {_CLEAN}""")
def e3_exploded(spark, sf):
    clean = clean_tickets(
        view(spark, sf, "tickets"), polygons(view(spark, sf, "boundaries")), view(spark, sf, "checks"), explode=True
    ).tickets
    return clean.select("ticket_id", "type_list")


@register("e4_rain_history", pivot_sql())
def e4(spark, sf):
    target = scratch_dir(spark, "e4-out")
    rain_history(spark, land_reports(spark, sf, "e4-in"), target, STATIONS)
    # Station columns hold numbers only where inference would see some; they are doubles by contract.
    back = spark.read.option("header", True).csv(target)
    return plain_names(back).select("Date", *[F.col(s.lower().replace(".", "_")).cast("double") for s in STATIONS])


@register("e4_rain_history_incremental", pivot_sql())
def e4_incremental(spark, sf):
    source = land_reports(spark, sf, "e4i-in")
    target, checkpoint = scratch_dir(spark, "e4i-out"), scratch_dir(spark, "e4i-state")
    for _ in range(2):  # the second run finds nothing new
        ingest_rain_reports(spark, source, target, checkpoint)
    return plain_names(pivot_stations(read_parquet(spark, target), STATIONS))


@register("e4_rain_history_by_month", pivot_sql())
def e4_by_month(spark, sf):
    """The wide table kept by month: the second run finds nothing new and rewrites nothing."""
    source = land_reports(spark, sf, "e4m-in")
    target, checkpoint = scratch_dir(spark, "e4m-out"), scratch_dir(spark, "e4m-state")
    for _ in range(2):
        ingest_wide_history(spark, source, target, checkpoint, STATIONS)
    return plain_names(read_parquet(spark, target).drop("month"))


@register("e5_station_metadata", """
    SELECT 'RF.S.' || CAST(s_suppkey AS STRING) AS "StationCode", s_name AS "StationName_Short",
           'NATION_' || CAST(s_suppkey % 25 AS STRING) AS "DistrictName",
           CAST(CAST(13 + s_suppkey % 7 AS STRING) || '.25' AS DOUBLE) AS "Latitude", CAST(100.5 AS DOUBLE) AS "Longitude",
           '19/11/2568 21:45' AS "LastReadingTime", s_suppkey AS "DistrictCode_from_JS"
    FROM supplier WHERE s_suppkey % 10 <> 9""")
def e5(spark, sf):
    target = scratch_dir(spark, "e5")
    station_table(view(spark, sf, "station_texts"), "txt", target)
    return read_csv(spark, target, multiline=False)


@register("s10_unreadable", f"SELECT s_suppkey FROM {duck('station_texts')} WHERE txt LIKE '[[broken%'")
def s10_unreadable(spark, sf):
    return station_table(view(spark, sf, "station_texts"), "txt")[1].select("s_suppkey")


@register("e3_from_files", f"""
    SELECT ticket_id, type, 'กรุงเทพมหานคร' AS province, district, subdistrict, y, longitude, latitude FROM {_CLEAN}""")
def e3_from_files(spark, sf):
    """Landed CSV, features and a check file of four columns."""
    tickets, areas, check = (scratch_dir(spark, f"e3-{part}") for part in ("tickets", "areas", "check"))
    write_csv(view(spark, sf, "tickets"), tickets)
    geojson_lines(spark, sf).write.text(areas)
    write_csv(view(spark, sf, "checks").coalesce(1).sortWithinPartitions("seq").drop("seq"), check)
    clean = clean_tickets_from_files(spark, tickets, areas, check, layout="lines", index="poly_id", multiline=False).tickets
    return clean.select(
        "ticket_id", "type", "province", "district", "subdistrict", F.col("year_timestamp").cast("bigint").alias("y"),
        "longitude", "latitude",
    )


@register("e3_rejects", f"""
    SELECT ticket_id, coords FROM {TICKETS}
    WHERE coords LIKE '%,%,%' AND CAST(substr("timestamp", 1, 4) AS BIGINT) BETWEEN 2022 AND 2024 AND ticket_id IS NOT NULL
      AND type IS NOT NULL AND organization IS NOT NULL AND "timestamp" IS NOT NULL AND last_activity IS NOT NULL""")
def e3_rejects(spark, sf):
    found = clean_tickets(view(spark, sf, "tickets"), polygons(view(spark, sf, "boundaries")), view(spark, sf, "checks"))
    return found.rejects.select("ticket_id", "coords")


@register("e1_profile", f"""
    WITH raw AS (
      SELECT event_id, event_type, CASE WHEN event_id % 8 <> 3 THEN ts END AS ts, CASE WHEN event_id % 6 <> 1 THEN value END AS value,
             user_id FROM events),
    landed AS (SELECT *, unnest(CASE WHEN event_id % 3 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM raw),
    cleaned AS (SELECT DISTINCT event_id, event_type, ts, value, user_id FROM raw)
    SELECT 'before' AS part, count(*) AS n_rows, count(*) - count(event_type) AS no_type, 0 AS no_time, 0 AS no_lat,
           count(*) - count(user_id) AS no_lon FROM landed
    UNION ALL
    SELECT 'after', count(*), count(*) - count(event_type), count(*) - count(ts), count(*) - count(value),
           count(*) - count(user_id) FROM cleaned""")
def e1_profile(spark, sf):
    """Both profiles of the ticket job: rows and nulls before and after."""
    raw = table(spark, sf, "events").selectExpr(
        "event_id AS `Event-ID`", "event_type AS `Event Type`",
        "CASE WHEN event_id % 8 = 3 THEN 'then' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS `Time Stamp`",
        "CASE WHEN event_id % 6 = 1 THEN 'here' ELSE CAST(value AS STRING) END AS ` Lat `", "user_id AS `Lon.`",
    )
    copies = F.when(F.col("Event-ID") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    source, target = scratch_dir(spark, "e1p-in"), scratch_dir(spark, "e1p-out")
    write_csv(raw.withColumn("copy", F.explode(copies)).drop("copy"), source)
    rows = []
    for part, profile in zip(("before", "after"), ticket_etl(spark, source, target, multiline=False)):
        nulls = list(profile.nulls.values())
        rows.append((part, profile.rows, *nulls[1:]))
    return spark.createDataFrame(rows, "part string, n_rows long, no_type long, no_time long, no_lat long, no_lon long")


_FRAME = """
    (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS cust, o_totalprice AS price, o_orderkey % 2 AS target FROM orders)"""


def _explore_sql() -> str:
    parts = []
    for c in ("cust", "price", "target"):
        x = f"CAST({c} AS DOUBLE)"
        stats = {
            "count": f"count({x})", "mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})", "max": f"max({x})",
            **{f"{int(q * 100)}%": f"quantile_cont({x}, {q})" for q in (0.25, 0.5, 0.75)},
        }
        parts += [f"SELECT 'summary' AS section, '{c}' AS name, '{s}' AS item, round(CAST({e} AS DOUBLE), 4) AS value FROM {_FRAME}" for s, e in stats.items()]
        parts.append(f"SELECT 'missing', '{c}', 'nulls', CAST(count(*) - count({c}) AS DOUBLE) FROM {_FRAME}")
        parts += [f"SELECT 'correlation', '{c}', '{d}', round(corr({c}, {d}), 4) FROM {_FRAME}" for d in ("cust", "price", "target")]
        parts.append(f"SELECT 'histogram', '{c}', 'total', CAST(count({c}) AS DOUBLE) FROM {_FRAME}")
    wanted = "ceil(count(*) * CAST(0.2 AS DOUBLE))"
    parts.append(f"SELECT 'features', 'split', 'test', {wanted} FROM {_FRAME}")
    parts.append(f"SELECT 'features', 'split', 'train', count(*) - {wanted} FROM {_FRAME}")
    return " UNION ALL ".join(parts)


def _explored(spark, sf):
    frame = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS cust", "o_totalprice AS price", "o_orderkey % 2 AS target"
    )
    return explore(frame, "target", ["o_orderkey"])


@register("e6_exploration_bins", " UNION ALL ".join(histogram_sql(_FRAME, c) for c in ("cust", "price", "target")))
def e6_bins(spark, sf):
    """Every bin of the job's histograms."""
    return _explored(spark, sf).histograms.select(
        "column", "bin", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"), "count")


_SPLIT = f"""
    (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS STRING))) <= ceil(count(*) OVER () * CAST(0.2 AS DOUBLE))
                    THEN 'test' ELSE 'train' END AS split FROM {_FRAME})"""


def _scaled_sql(column: str) -> str:
    def fit(statistic):
        return f"(SELECT {statistic}({column}) FROM {_SPLIT} WHERE split = 'train')"

    return f"round(({column} - {fit('avg')}) / {fit('stddev_pop')}, 6) AS {column}"


@register("e6_exploration_features", f"SELECT o_orderkey, {_scaled_sql('cust')}, {_scaled_sql('price')}, target, split FROM {_SPLIT}")
def e6_features(spark, sf):
    """Every row of the job's feature table."""
    return _explored(spark, sf).features.withColumns({c: F.round(c, 6) for c in ("cust", "price")})


@register("e6_exploration", _explore_sql())
def e6(spark, sf):
    found = _explored(spark, sf)

    def section(name, df, label, item, value):
        return df.select(F.lit(name).alias("section"), label.alias("name"), item.alias("item"), F.round(value.cast("double"), 4).alias("value"))

    col = F.col
    totals = found.histograms.groupBy("column").agg(F.sum("count").alias("n"))
    splits = found.features.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return union_by_name([
        section("summary", found.summary, col("column"), col("stat"), col("value")),
        section("missing", found.missing, col("column"), F.lit("nulls"), col("nulls")),
        section("correlation", found.correlations, col("row"), col("col"), col("corr")),
        section("histogram", totals, col("column"), F.lit("total"), col("n")),
        section("features", splits, F.lit("split"), col("split"), col("n")),
    ])
