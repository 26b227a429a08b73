"""Batch jobs."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from civiq.operators.boundaries import repair_boundaries, to_lonlat
from civiq.operators.columns import drop_columns, standardize_names
from civiq.operators.dedupe import drop_exact_duplicates
from civiq.operators.features import prepare_features
from civiq.operators.filters import drop_incomplete, keep_not_equal, keep_present, keep_province, keep_years
from civiq.operators.rain import extract_readings, pivot_stations
from civiq.operators.spatial import verify_addresses
from civiq.operators.stats import (
    category_column, correlation_matrix, histogram, null_count_exprs, null_counts, summary_stats, top_categories,
)
from civiq.operators.tags import explode_tags
from civiq.operators.tickets import (
    add_date_parts, add_status_flag, add_upper_name, cast_first_timestamp, cast_lat_lon, coordinate_rejects, parse_timestamps,
    split_coordinates,
)
from civiq.schemas import UNUSED_TICKET_COLUMNS
from civiq.session import scratch_dir
from civiq.sources.boundaries import read_boundaries, read_check_file
from civiq.sources.rain_text import read_reports
from civiq.sources.stations import parse_station_arrays, station_metadata, unreadable_station_texts
from civiq.sources.tables import read_csv, read_csv_text, read_parquet, reject_open_quotes, write_csv, write_parquet


@dataclass
class Profile:
    """What the ticket job reports about a table."""

    schema: str
    rows: int
    nulls: dict[str, int]
    top: list[tuple[str | None, int]]
    sample: list


def _watched(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    metrics = [m.alias(f"n{i}") for i, m in enumerate(null_count_exprs(df, df.columns))]
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *metrics), watch


def _profile(df: DataFrame, watch: Observation, top: list, sample: list) -> Profile:
    seen = watch.get
    nulls = {c: seen[f"n{i}"] for i, c in enumerate(df.columns)}
    return Profile(df.schema.simpleString(), seen["rows"], nulls, [(r["category"], r["count"]) for r in top], sample)


def profile_table(df: DataFrame) -> Profile:
    """Row count, null counts, the ten most frequent categories and five rows.

    Counts are observed on the scan that counts the categories: one pass.
    """
    watched, watch = _watched(df, "profile")
    if category_column(df):
        top = top_categories(watched).collect()
    else:
        top = []
        watched.agg(F.count(F.lit(1))).collect()
    return _profile(df, watch, top, df.take(5))


def clean_tickets_basic(df: DataFrame) -> DataFrame:
    """Standard names, tolerant time and position casts, exact duplicates dropped."""
    return drop_exact_duplicates(cast_lat_lon(cast_first_timestamp(standardize_names(df))))


def ticket_etl(spark: SparkSession, source: str, target: str, multiline: bool = True) -> tuple[Profile, Profile]:
    """CSV → profile → clean → Parquet → profile.

    Null and row counts of the cleaned table are observed on its write, so the
    deduplicating shuffle runs once; its categories come from the written file.
    """
    raw = read_csv_text(spark, source, multiline=multiline)
    before = profile_table(raw)
    clean, watch = _watched(clean_tickets_basic(raw), "clean")
    write_parquet(clean, target)
    written = spark.read.parquet(target)
    top = top_categories(written).collect() if category_column(written) else []
    return before, _profile(written, watch, top, written.take(5))


def generic_transform(df: DataFrame) -> DataFrame:
    """Upper-case name, activity flag, rows with a value only."""
    return keep_present(add_status_flag(add_upper_name(df)), "value")


def generic_etl(
    spark: SparkSession, source: str, target: str, mode: str = "overwrite", multiline: bool = False
) -> None:
    """CSV with inferred types → transform → Parquet.

    Without ``multiline`` a quoted line break would tear a record apart, so the file is searched for one first, and it raises.
    """
    if not multiline:
        reject_open_quotes(spark, source)
    write_parquet(generic_transform(read_csv(spark, source, multiline=multiline)), target, mode)


class CleanTickets(NamedTuple):
    """The cleaned tickets, and those whose coordinates have too many parts."""

    tickets: DataFrame
    rejects: DataFrame


def clean_tickets(
    raw: DataFrame, boundaries: DataFrame, check: DataFrame | None = None, check_order: str = "seq",
    start: int = 2022, stop: int = 2024, explode: bool = False, **grid,
) -> CleanTickets:
    """Tickets with complete fields, typed times and coordinates, of the wanted years and province,
    whose coordinates agree with their address, and with at least one tag.

    Complete tickets of the wanted years whose coordinates have more than two parts are the rejects.
    Calling this repairs and stores the boundaries and sizes their grid; the tickets are read by the results
    alone, and are not shuffled while the boundaries fit a broadcast.
    """
    typed = parse_timestamps(drop_incomplete(raw))
    # The year range comes first: it needs nothing but the timestamp and shrinks the rest.
    timely = add_date_parts(keep_years(typed, start, stop))
    parts = split_coordinates(timely)
    local = keep_province(drop_columns(parts, UNUSED_TICKET_COLUMNS))
    if "epsg" in boundaries.columns:
        boundaries = to_lonlat(boundaries)
    areas = repair_boundaries(boundaries, check, check_order)
    stored = scratch_dir(areas.sparkSession, "areas")
    write_parquet(areas, stored)
    verified = verify_addresses(local, read_parquet(areas.sparkSession, stored), **grid)
    tagged = keep_not_equal(verified, "type", "{}")
    return CleanTickets(explode_tags(tagged) if explode else tagged, coordinate_rejects(timely))


AREA_PROPERTIES = ["SUBDISTR_1", "SUBDISTRIC", "DISTRICT_N", "DISTRICT_I"]


def clean_tickets_from_files(
    spark: SparkSession, tickets: str, boundaries: str, check: str | None = None, layout: str = "collection",
    index: str | None = None, multiline: bool = True, **options,
) -> CleanTickets:
    """``clean_tickets`` from a CSV of tickets, a GeoJSON boundary file and a CSV check file; of several entries
    for a code in the check file the last counts."""
    areas = read_boundaries(spark, boundaries, AREA_PROPERTIES, layout, index)
    known = read_check_file(spark, check) if check else None
    return clean_tickets(read_csv_text(spark, tickets, multiline=multiline), areas, known, **options)


def rain_history(spark: SparkSession, source: str, target: str | None = None, stations: list[str] | None = None) -> DataFrame:
    """Landed reports to one row per date and one column per station, written as CSV if asked."""
    wide = pivot_stations(extract_readings(read_reports(spark, source)), stations)
    if target:
        write_csv(wide, target)
    return wide


def station_table(texts: DataFrame, column: str, target: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Array literals to the station metadata table, written as CSV if asked; and the texts that cannot be read."""
    table = station_metadata(parse_station_arrays(texts, column))
    if target:
        write_csv(table, target)
    return table, unreadable_station_texts(texts, column)


@dataclass
class Exploration:
    """Lazy results of the exploratory job."""

    summary: DataFrame
    missing: DataFrame
    correlations: DataFrame
    histograms: DataFrame
    features: DataFrame


def explore(df: DataFrame, target: str, key: list[str], test_size: float = 0.2, seed: int = 42) -> Exploration:
    """Summary, missing values, correlations, histograms, and the prepared feature table."""
    measured = df.drop(*key)
    return Exploration(
        summary_stats(measured),
        null_counts(measured, nan_is_missing=True),
        correlation_matrix(measured),
        histogram(measured),
        prepare_features(df, target, key, test_size, seed),
    )
