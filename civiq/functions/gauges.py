"""Rain-gauge report lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from civiq.functions.values import strip_blanks, text_to_double

# Fixed value: two numbers, an optional reading, then the station code after "RF.".
# (?U) because the reports may carry Thai digits and non-ASCII blanks.
LINE_PATTERN = r"(?U)[-\d\.]+\s+[-\d\.]+\s+([\d\.\-]+|\s*)\s*RF\.(\S+)"
THAI_DIGITS = "๐๑๒๓๔๕๖๗๘๙"


def has_reading(line: Column) -> Column:
    return line.rlike(LINE_PATTERN)


def station_of(line: Column) -> Column:
    """Station code without its ``RF.`` prefix."""
    return F.regexp_extract(line, LINE_PATTERN, 2)


def level_of(line: Column) -> Column:
    """The reading; null for a blank or an unreadable one."""
    text = strip_blanks(F.regexp_extract(line, LINE_PATTERN, 1))
    return text_to_double(F.translate(text, THAI_DIGITS, "0123456789"), on_error="null")
