"""Declared input schemas and the fixed names of the source systems."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, codes and texts of the source data.
TICKET_COLUMNS = [
    "ticket_id", "type", "organization", "coords", "timestamp", "last_activity",
    "photo", "photo_after", "star", "province", "district", "subdistrict",
]
REQUIRED_TICKET_COLUMNS = ["ticket_id", "type", "organization", "coords", "timestamp", "last_activity"]
UNUSED_TICKET_COLUMNS = ["photo", "photo_after", "star"]
PROVINCE_PATTERN = "กรุงเทพ"
PROVINCE_NAME = "กรุงเทพมหานคร"
FLOOD_TAG = "น้ำท่วม"
STATION_FIELDS = [
    "Latitude", "Longitude", "StationName_Short", "Value_1_Rain_3Hrs", "Value_2_Rain_6Hrs",
    "Timestamp", "StatusClass", "DistrictCode_from_JS", "DistrictName", "Icon",
    "StatusText", "Value_4_Rain_12Hrs", "Value_5_Rain_24Hrs", "Value_6", "Value_7",
    "Value_8", "StationCode", "StatusID",
]
STATION_METADATA_FIELDS = [
    "StationCode", "StationName_Short", "DistrictName", "Latitude", "Longitude",
    "Timestamp", "DistrictCode_from_JS",
]

TICKET_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in TICKET_COLUMNS])

EDGE_TYPE = T.StructType([T.StructField(name, T.DoubleType()) for name in ("x1", "y1", "x2", "y2")])
