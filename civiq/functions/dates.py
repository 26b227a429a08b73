"""Timestamp parsing and formatting."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Strftime tokens and the Spark pattern letters of the same meaning.
STRFTIME_TOKENS = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm",
    "%S": "ss", "%f": "SSSSSS", "%p": "a", "%b": "MMM", "%B": "MMMM", "%a": "EEE", "%A": "EEEE",
    "%j": "DDD", "%F": "yyyy-MM-dd", "%T": "HH:mm:ss", "%%": "'%'",
}
# Tried in this order; month-first comes before day-first.
DATE_PATTERNS = [
    "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm",
    "yyyy/MM/dd", "yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss",
    "dd/MM/yyyy", "dd/MM/yyyy HH:mm:ss", "dd-MM-yyyy", "yyyyMMdd",
]


# What a strict parse takes: extended or basic dates and times, T or one blank between, a fraction behind a point, an offset.
# Six digits could be a month or a day of a short year and are refused; an offset without a colon has two digits or four.
ISO_PATTERN = (
    r"^\d{4}(-\d{2}(-\d{2})?|\d{2}\d{2})?"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?|\d{2}(\d{2}(\.\d+)?)?)?(Z|[+-](\d{1,2}(:\d{2})?|\d{4}))?)?$"
)
# What a tolerant reading takes as well: fields of one digit.
_LOOSE_ISO = r"^\d{4}(-\d{1,2}(-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?)?)?$"
_OFFSET = r"(?<=:\d{1,2}(\.\d{1,9})?)(Z|[+-]\d{2}(:?\d{2})?)$"


def parse_iso(column: Column, on_error: str = "raise") -> Column:
    """ISO-8601 text to timestamp; the basic form (``20240102T0304``), bare hours and short offsets take a second attempt."""
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    full = F.regexp_replace(column, r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3")
    full = F.regexp_replace(full, r"[T ](\d{2})(\d{2})(\d{2})?(?![\d:])", "T$1:$2:$3")
    full = F.regexp_replace(full, r"[T ](\d{2})(?![\d:])", "T$1:00")
    full = F.regexp_replace(full, r"(T\d{2}:\d{2}):?(?![\d:])", "$1:00")
    full = F.regexp_replace(full, r"([+-])(\d)(:\d{2})?$", "$10$2$3")
    # The pattern keeps out what a cast also takes: blanks around, zone names, a time without a date.
    parsed = F.when(column.rlike(ISO_PATTERN), F.coalesce(column.try_cast("timestamp"), full.try_cast("timestamp")))
    if on_error == "null":
        return parsed
    bad = F.raise_error(F.concat(F.lit("not an ISO-8601 timestamp: "), column)).cast("timestamp")
    return F.when(column.isNotNull(), F.coalesce(parsed, bad))


def strftime_to_pattern(fmt: str) -> str:
    """A strftime format as a Spark datetime pattern; literal letters are quoted."""
    out = []
    for piece in re.findall(r"%.|[^%]+", fmt):
        if piece.startswith("%"):
            if piece not in STRFTIME_TOKENS:
                raise ValueError(f"unsupported strftime token {piece}")
            out.append(STRFTIME_TOKENS[piece])
        else:
            out.append(re.sub(r"[A-Za-z]+", lambda m: f"'{m.group(0)}'", piece.replace("'", "''")))
    return "".join(out)


def parse_any(column: Column, patterns: list[str] | None = None) -> Column:
    """The ISO reading, else the first pattern of the list that fits; null when none does.

    Blanks around are ignored. An offset is read over: the result is the time as written. Given patterns are tried alone.
    """
    text = F.trim(column.cast("string"))
    tries = [F.try_to_timestamp(text, F.lit(p)) for p in (patterns or DATE_PATTERNS)]
    if patterns:
        return F.coalesce(*tries)
    local = F.regexp_replace(text, _OFFSET, "")
    return F.coalesce(F.when(local.rlike(_LOOSE_ISO), local.try_cast("timestamp")), *tries)
