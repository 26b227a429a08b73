"""Station metadata from the array literal of a map page."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from civiq.functions.values import quoted
from civiq.operators.columns import select_renamed
from civiq.schemas import STATION_FIELDS, STATION_METADATA_FIELDS

_NUMBERS = ("Latitude", "Longitude")


def _fits(record):
    return F.size(record) <= len(STATION_FIELDS)


def parse_station_arrays(texts: DataFrame, column: str) -> DataFrame:
    """A row per record of each text, with 18 named columns; what a shorter record lacks is null.

    A text that is no nested array, or has a longer record, gives no rows; ``unreadable_station_texts`` lists those.
    """
    records = F.from_json(quoted(column), "array<array<string>>", {"allowSingleQuotes": "true"})
    good = F.when(F.forall(records, _fits), records)
    exploded = texts.select(F.explode(good).alias("r"))
    return exploded.select(*[
        (F.get("r", F.lit(i)).try_cast("double") if name in _NUMBERS else F.get("r", F.lit(i))).alias(name)
        for i, name in enumerate(STATION_FIELDS)
    ])


def unreadable_station_texts(texts: DataFrame, column: str) -> DataFrame:
    records = F.from_json(quoted(column), "array<array<string>>", {"allowSingleQuotes": "true"})
    good = F.coalesce(F.forall(records, _fits), F.lit(False))
    return texts.filter(~good)


def station_metadata(stations: DataFrame) -> DataFrame:
    """The seven metadata columns, the reading time under its own name."""
    return select_renamed(stations, STATION_METADATA_FIELDS, {"Timestamp": "LastReadingTime"})
