import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from civiq.functions.dates import parse_iso, strftime_to_pattern
from civiq.functions.gauges import has_reading, level_of, station_of
from civiq.functions.tags import parse_tags, split_tag_literal
from civiq.functions.values import nan_to_null, text_to_bigint, text_to_double


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def evaluate(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", expression.alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


def python_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def test_text_to_double_follows_python(spark):
    texts = ["1", " 1.5\t", "-2", "+.5", "5.", "1e3", "-1.5E-2", "-", "1.2.3", "1d", "1f", "0x10", "", " ", "inf", "-Infinity",
             "abc", None, "--5", "1-2", "e5", " 7 ", ".", "+"]
    assert evaluate(spark, texts, text_to_double(F.col("v"), "null")) == [python_float(t) for t in texts]


def test_text_to_double_nan_is_missing_and_bad_text_raises(spark):
    assert evaluate(spark, ["nan", None, "2"], text_to_double(F.col("v"))) == [None, None, 2.0]
    with pytest.raises(Exception, match="not a number: 1d"):
        evaluate(spark, ["1d"], text_to_double(F.col("v")))


def test_text_to_bigint_is_strict(spark):
    assert evaluate(spark, ["12", None, "-3"], text_to_bigint(F.col("v"))) == [12, None, -3]
    with pytest.raises(Exception, match="not an integer"):
        evaluate(spark, ["1x"], text_to_bigint(F.col("v")))


def test_nan_to_null_only_touches_floating_columns(spark):
    df = spark.createDataFrame([(float("nan"), 1, "NaN"), (2.0, None, "x")], "a double, b int, `c.d` string")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, 1, "NaN"), (2.0, None, "x")]


def slow_tags(text):
    if text is None:
        return []
    kept = "".join(c for c in text if c not in "{}'\"")
    return [t.strip() for t in kept.split(",") if t.strip()]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab {},'\"\t น้ำ", max_size=12), min_size=1, max_size=30))
def test_parse_tags_matches_a_plain_reading(spark, texts):
    assert evaluate(spark, texts, parse_tags(F.col("v"))) == [slow_tags(t) for t in texts]


def test_parse_tags_null_is_empty(spark):
    assert evaluate(spark, [None, "{}"], parse_tags(F.col("v"))) == [[], []]


def test_split_literal_keeps_blanks_and_empties(spark):
    texts = ["{a, b}", "{}", "a,,", "{{x}}", "{road, 'flood'}"]
    assert evaluate(spark, texts, split_tag_literal(F.col("v"))) == [
        ["a", " b"], [""], ["a", "", ""], ["x"], ["road", " 'flood'"]
    ]


LINES = {
    "13.7 100.5 0.5 RF.KTY.01": ("KTY.01", 0.5),
    "13.7 100.5         RF.KTY.02": ("KTY.02", None),
    "1 2 - RF.A": ("A", None),
    "1 2 3 4 RF.B x": ("B", 4.0),
    "5.0 RF.A": None,
    "1 2 1.2.3 RF.C": ("C", None),
    "๑ ๒ ๓.๕ RF.Z๑": ("Z๑", 3.5),
    "": None,
}


def test_gauge_lines(spark):
    df = spark.createDataFrame([(k,) for k in LINES], "line string")
    line = F.col("line")
    rows = df.filter(has_reading(line)).select("line", station_of(line).alias("s"), level_of(line).alias("l")).collect()
    assert {r.line: (r.s, r.l) for r in rows} == {k: v for k, v in LINES.items() if v}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.- RFAB ", max_size=30).map(lambda t: "1 2 " + t), min_size=1, max_size=40))
def test_gauge_lines_match_python(spark, lines):
    pattern = re.compile(r"[-\d\.]+\s+[-\d\.]+\s+([\d\.\-]+|\s*)\s*RF\.(\S+)")
    df = spark.createDataFrame([(t,) for t in set(lines)], "line string")
    line = F.col("line")
    got = {r.line: (r.s, r.l) for r in df.filter(has_reading(line)).select("line", station_of(line).alias("s"), level_of(line).alias("l")).collect()}
    want = {}
    for text in set(lines):
        match = pattern.search(text)
        if match:
            want[text] = (match.group(2), python_float(match.group(1).strip()))
    assert got == want


def test_parse_iso_forms(spark):
    texts = ["2022-01-02 03:04:05.678901+00", "20240102T030405", "20240102", "2024-01-02T03:04:05+07:00", None,
             "20240102T0304Z", "2024-01-02T03:04", "2024-01-02"]
    shown = F.date_format(parse_iso(F.col("v")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert evaluate(spark, texts, shown) == [
        "2022-01-02 03:04:05.678901", "2024-01-02 03:04:05.000000", "2024-01-02 00:00:00.000000", "2024-01-01 20:04:05.000000",
        None, "2024-01-02 03:04:00.000000", "2024-01-02 03:04:00.000000", "2024-01-02 00:00:00.000000",
    ]
    with pytest.raises(Exception, match="not an ISO-8601"):
        evaluate(spark, ["02/01/2024"], parse_iso(F.col("v")))
    for loose in ("2024-01-05 10:00:00 Asia/Bangkok", " 2024-01-05 ", "2024-1-5"):
        assert evaluate(spark, [loose], parse_iso(F.col("v"), "null")) == [None]
        with pytest.raises(Exception, match="not an ISO"):
            evaluate(spark, [loose], parse_iso(F.col("v")))
    assert evaluate(spark, ["02/01/2024", "10:20", "T10:20:30", "x"], parse_iso(F.col("v"), "null")) == [None] * 4


def test_bare_hours_and_short_offsets(spark):
    shown = F.date_format(parse_iso(F.col("v")), "yyyy-MM-dd HH:mm:ss.SSS")
    forms = {
        "2024-01-05T10Z": "10:00:00.000", "2024-01-05T10:00+7": "03:00:00.000", "2024-01-05 10": "10:00:00.000",
        "2024-01-05T10+07:00": "03:00:00.000", "2024-01-05T10:00-3:30": "13:30:00.000", "2024-01-05T10:00:01.5+07": "03:00:01.500",
        "20240105T10": "10:00:00.000", "2024-01-05T10:00:00.25+0130": "08:30:00.250", "20240105T101112-1": "11:11:12.000",
    }
    assert evaluate(spark, list(forms), shown) == [f"2024-01-05 {v}" for v in forms.values()]
    refused = ["202401", "2024-01-05T10:00:00,5", "2024-01-05T10:00+730", "2024-01-05T1", "2024-01-05+7"]
    assert evaluate(spark, refused, parse_iso(F.col("v"), "null")) == [None] * len(refused)
    for text in refused:
        with pytest.raises(Exception, match="not an ISO"):
            evaluate(spark, [text], parse_iso(F.col("v")))


def test_strftime_patterns():
    assert strftime_to_pattern("%Y-%m-%d") == "yyyy-MM-dd"
    assert strftime_to_pattern("%d/%m/%Y at %H:%M") == "dd/MM/yyyy 'at' HH:mm"
    with pytest.raises(ValueError):
        strftime_to_pattern("%Q")
