"""Rain readings: extraction, pivot, date series and request plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from civiq.functions.gauges import has_reading, level_of, station_of
from civiq.functions.values import free_name, quoted
from civiq.operators.columns import order_columns

# Fixed values of the request form.
DATE_PATTERN = "dd/MM/yyyy"
REQUEST_DATE_FIELDS = ["datePick_now", "datePick_now0to24", "datePick_start", "datePick_end"]


def extract_readings(lines: DataFrame, line: str = "line", date: str = "Date") -> DataFrame:
    """(Date, Station, WaterLevel) from report lines; lines without a station go. Map-only."""
    text = quoted(line)
    return lines.filter(has_reading(text)).select(
        quoted(date).alias("Date"), station_of(text).alias("Station"), level_of(text).alias("WaterLevel")
    )


def pivot_stations(readings: DataFrame, stations: list[str] | None = None) -> DataFrame:
    """One row per Date, one column per station; two readings for the same pair raise.

    Give ``stations`` (the metadata's) to save the job in which Spark lists them; a reading of another station raises.
    """
    if stations is not None:
        unlisted = F.raise_error(F.concat(F.lit("station is not listed: "), F.col("Station"))).cast("string")
        known = F.col("Station").isNull() | F.col("Station").isin(stations)
        readings = readings.withColumn("Station", F.when(known, F.col("Station")).otherwise(unlisted))
    single = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("two readings for one date and station")).cast("double")
    ).otherwise(F.max("WaterLevel"))
    wide = readings.groupBy("Date").pivot("Station", stations).agg(single)
    return order_columns(wide, ["Date"])


def date_series(bounds: DataFrame, start: str, end: str, name: str = "Date") -> DataFrame:
    """Every day from ``start`` to ``end`` of each row, both included, as ``dd/MM/yyyy`` text."""
    days = F.when(quoted(start) <= quoted(end), F.sequence(quoted(start), quoted(end), F.expr("interval 1 day")))
    rest = [quoted(c) for c in bounds.columns if c not in (start, end)]
    day = free_name([*bounds.columns, name], "_day")
    exploded = bounds.select(*rest, F.explode(days).alias(day))
    return exploded.withColumn(name, F.date_format(day, DATE_PATTERN)).drop(day)


def request_plan(dates: DataFrame, date: str = "Date", note: Column | None = None) -> DataFrame:
    """The form fields of the request for each date; 31 December has its own rain type and end time."""
    day = quoted(date)
    year_end = day.startswith("31/12")
    plan = dates.withColumns({f: day for f in REQUEST_DATE_FIELDS}).withColumns({
        "StationTime_start": F.lit("00:00"),
        "StationTime_end": F.when(year_end, "23:55").otherwise("23:59"),
        "rain_type": F.when(year_end, "10").otherwise("1"),
        "button": F.lit("print"),
    })
    return plan.withColumn("note", note) if note is not None else plan
