"""Administrative boundaries: name repair, reprojection and counts per area."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from civiq.functions.geometry import EVEREST_1937, INDIAN_1975_SHIFT, WGS_84, edge_ends, ends_to_edges, shift_datum, utm_to_lonlat
from civiq.functions.values import free_name, quoted, text_to_bigint
from civiq.operators.filters import keep_tag
from civiq.operators.stats import group_size
from civiq.schemas import FLOOD_TAG


# What is checked together: name and code of the boundaries, name and code of the check table.
_NAMED = [("SUBDISTR_1", "SUBDISTRIC", "sname", "scode"), ("DISTRICT_N", "DISTRICT_I", "dname", "dcode")]


def unknown_names(boundaries: DataFrame, check: DataFrame) -> set[str]:
    """The name columns of which some value is unknown to the check table; null is a value.

    One aggregate over the values of both tables and all columns tells on which sides each value stands: each table is
    read once. At most one row per name column comes to the driver.
    """
    def values(table: DataFrame, columns: list[str], ours: bool) -> DataFrame:
        cells = [F.struct(F.lit(k).alias("kind"), quoted(c).alias("value")) for k, c in enumerate(columns)]
        return table.select(F.inline(F.array(*cells))).withColumn("ours", F.lit(ours))

    both = values(boundaries, [n[0] for n in _NAMED], True).unionByName(values(check, [n[2] for n in _NAMED], False))
    sides = both.groupBy("kind", "value").agg(F.bool_and("ours").alias("unknown"))
    return {_NAMED[r["kind"]][0] for r in sides.filter("unknown").select("kind").distinct().collect()}


def repair_boundaries(boundaries: DataFrame, check: DataFrame | None, order_by: str = "seq") -> DataFrame:
    """Repair subdistrict and district names, each on its own; no check table, no change.

    If any name of a column is unknown to the check table, all its names are replaced by looking their codes up:
    an unknown code gives null; of several entries for a code the last in ``order_by`` order counts. Whether one is unknown
    is found out when this is called, so a column in order costs no join.
    """
    if check is None:
        return boundaries
    columns, fixed = boundaries.columns, boundaries
    wrong = unknown_names(boundaries, check)
    for name, code, known, number in _NAMED:
        fixed = fixed.withColumn(code, text_to_bigint(quoted(code)))
        if name in wrong:
            key, value = free_name(columns, "known_code"), free_name(columns, "known_name")
            lookup = check.groupBy(quoted(number).cast("bigint").alias(key)).agg(F.max_by(quoted(known), quoted(order_by)).alias(value))
            fixed = fixed.join(lookup, quoted(code) == F.col(key), "left").withColumn(name, F.col(value)).drop(key, value)
    return fixed.select(*[quoted(c) for c in columns])


def to_lonlat(boundaries: DataFrame, epsg: str = "epsg") -> DataFrame:
    """Edges in EPSG:4326: passed through, or converted from a UTM zone of WGS 84 (326xx north, 327xx south) or Indian 1975 (24047, 24048)."""
    code = quoted(epsg)
    zone, south = code % 100, F.floor(code / 100) == 327
    is_utm = F.floor(code / 100).isin(326, 327) & zone.between(1, 60)

    places = edge_ends(F.col("edges"))
    indian = shift_datum(utm_to_lonlat(places, zone, F.lit(False), EVEREST_1937), EVEREST_1937, WGS_84, INDIAN_1975_SHIFT)
    edges = (
        F.when(code == 4326, F.col("edges"))
        .when(is_utm, ends_to_edges(utm_to_lonlat(places, zone, south)))
        .when(code.isin(24047, 24048), ends_to_edges(indian))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported EPSG code "), code.cast("string"))))
    )
    return boundaries.withColumn("edges", edges).withColumn(epsg, F.lit(4326))


def join_counts(
    boundaries: DataFrame, counts: DataFrame, name: str = "SUBDISTR_1", key: str = "subdistrict"
) -> DataFrame:
    """Every boundary with the counts of its name, both keys kept.

    ``counts`` has one row per key; whether it is broadcast is left to its measured size.
    """
    return boundaries.join(counts, quoted(name) == quoted(key), "left")


def report_counts(
    tickets: DataFrame, boundaries: DataFrame, tag: str = FLOOD_TAG,
    key: str = "subdistrict", name: str = "SUBDISTR_1", count: str = "flood_report_count",
) -> DataFrame:
    """Reports carrying ``tag`` per area, 0 where there is none; ``tickets`` holds exploded tags."""
    counts = group_size(keep_tag(tickets, tag), key, count)
    return join_counts(boundaries, counts, name, key).withColumn(count, F.coalesce(quoted(count), F.lit(0)))
