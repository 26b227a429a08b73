"""Columns, filters, tickets, duplicates, fill."""

import datetime

import pytest
from pyspark.sql import functions as F

from civiq.operators.columns import clean_names, drop_columns, order_columns, select_numeric, standardize_names, union_by_name
from civiq.operators.dedupe import drop_exact_duplicates, drop_rare_duplicates, keep_first
from civiq.operators.fill import fill_constant, fill_missing
from civiq.operators.filters import any_missing, drop_incomplete, keep_matching, keep_not_equal, keep_province, keep_years
from civiq.operators.tags import cooccurrence, explode_tags
from civiq.operators.tickets import add_date_parts, cast_lat_lon, coordinate_rejects, normalize_dates, split_coordinates
from plan_text import plan_of


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_standardize_names_numbers_clashes(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a int, b int, c int, d int, e int").toDF("A b!", "a-B", "ค่า", "_x_", "a b 2")
    assert standardize_names(df).columns == ["a_b", "a_b_2", "col_3", "x", "a_b_2_2"]


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" A b ", "D  E")
    assert clean_names(df).columns == ["_a_b_", "d__e"]


def test_drop_columns_needs_them(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b.c` int")
    assert drop_columns(df, ["b.c"]).columns == ["a"]
    with pytest.raises(KeyError):
        drop_columns(df, ["z"])


def test_order_and_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2.0, True, "x")], "`KTY.02` int, `KTY.01` double, flag boolean, Date string")
    assert order_columns(df, ["Date"]).columns == ["Date", "KTY.01", "KTY.02", "flag"]
    assert select_numeric(df).columns == ["KTY.02", "KTY.01"]


def test_union_of_nothing_is_an_error():
    with pytest.raises(ValueError):
        union_by_name([])


def test_drop_incomplete_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, y string")
    assert rows(drop_incomplete(df, ["x", "y"])) == [(1.0, "a")]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_keep_years_includes_both_ends_and_is_pushed_down(spark, tmp_path, kind):
    texts = ["2021-12-31 23:59:59.999999", "2022-01-01", "2024-12-31 23:59:59.999999", "2025-01-01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast(kind).alias("timestamp"))
    df.write.parquet(str(tmp_path / "t"))
    kept = keep_years(spark.read.parquet(str(tmp_path / "t")), 2022, 2024)
    assert [r.timestamp.year for r in kept.orderBy("timestamp").collect()] == [2022, 2024]
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan_of(kept)


def test_keep_province(spark):
    df = spark.createDataFrame([("จังหวัดกรุงเทพมหานคร",), ("กรุงเทพฯ",), ("นนทบุรี",), (None,)], "province string")
    assert rows(keep_province(df)) == [("กรุงเทพมหานคร",)] * 2


def test_not_equal_keeps_null_and_pattern_is_a_search(spark):
    df = spark.createDataFrame([("{}",), ("{a}",), (None,), ("{ab}",)], "type string")
    assert rows(keep_not_equal(df, "type", "{}")) == [("{ab}",), ("{a}",), (None,)]
    assert rows(keep_matching(df, "type", "a")) == [("{ab}",), ("{a}",)]


def test_any_missing_is_null_safe(spark):
    names = spark.createDataFrame([("a",), (None,)], "n string")
    known = spark.createDataFrame([("a",), ("b",)], "k string")
    assert any_missing(names, "n", known, "k").first().missing is True
    assert any_missing(names.dropna(), "n", known, "k").first().missing is False
    assert any_missing(names, "n", names, "n").first().missing is False


def test_split_coordinates_and_rejects(spark):
    df = spark.createDataFrame([("100.5,13.7",), ("100.5",), ("1,2,3",), (None,), (" 1 , 2 ",)], "coords string")
    assert rows(split_coordinates(df).select("longitude", "latitude")) == [
        (1.0, 2.0), (100.5, 13.7), (100.5, None), (None, None)
    ]
    assert rows(coordinate_rejects(df)) == [("1,2,3",)]
    with pytest.raises(Exception, match="not a number"):
        split_coordinates(spark.createDataFrame([("x,1",)], "coords string")).collect()


def test_date_parts_give_the_month_length(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 2, 3),)], "timestamp timestamp_ntz")
    assert rows(add_date_parts(df).drop("timestamp")) == [(2024, 2, 29)]


def test_cast_lat_lon_needs_both(spark):
    df = spark.createDataFrame([("1", "x")], "latitude string, lngitude string")
    assert rows(cast_lat_lon(df.withColumnRenamed("lngitude", "lng"))) == [(1.0, None)]
    assert cast_lat_lon(df.select("latitude")).schema["latitude"].dataType.typeName() == "string"


def test_normalize_dates_reads_iso_first(spark):
    texts = ["2024-01-05T10:00:00Z", "2024-01-05T23:30:00.123+07:00", " 2024-01-05 ", "2024-1-5", "2024", "2024-01-05T1:2:3", "2024-13-05", "5"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    want = ["2024-01-05 10:00", "2024-01-05 23:30", "2024-01-05 00:00", "2024-01-05 00:00", "2024-01-01 00:00", "2024-01-05 01:02", None, None]
    assert [r.d for r in normalize_dates(df, ["d"], "%Y-%m-%d %H:%M").collect()] == want


def test_normalize_dates(spark):
    df = spark.createDataFrame([("2024-01-02",), ("13/02/2024",), ("02/03/2024",), ("x",), (None,)], "d string")
    assert rows(normalize_dates(df, ["d", "none"])) == [("2024-01-02",), ("2024-02-03",), ("2024-02-13",), (None,), (None,)]


def test_exact_duplicates_treat_nan_and_null_as_equal(spark):
    df = spark.createDataFrame([(float("nan"), None), (float("nan"), None), (0.0, 1), (-0.0, 1)], "x double, y int")
    assert drop_exact_duplicates(df).count() == 2


def test_keep_first_takes_the_first_row_whole(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 5, "z"), (None, 3, "n"), (None, 2, "m")], "k string, o int, v string")
    assert rows(keep_first(df, ["k"], ["o"])) == [("a", 1, "x"), ("b", 5, "z"), (None, 2, "m")]
    with pytest.raises(ValueError):
        keep_first(df, ["k"], [])


def test_explode_keeps_empty_sets_and_drops_null(spark):
    df = spark.createDataFrame([(1, "{a, b}"), (2, "{}"), (3, None)], "i int, type string")
    assert rows(explode_tags(df).select("i", "type_list")) == [(1, "a"), (1, "b"), (2, None)]


def slow_cooccurrence(sets, tag):
    out = {}
    for text in sets:
        if text is None or tag not in text:
            continue
        tags = text.strip("{}").split(",")
        for t in ([tag] if len(tags) == 1 else [t for t in tags if t != tag]):
            out[t] = out.get(t, 0) + 1
    return out


def test_cooccurrence(spark):
    sets = ["{a,b}"] * 3 + ["{a}", "{ab}", "{a,b,b}", "{c,ab}", None, "{}", "{c}", "{ a,b}"]
    df = spark.createDataFrame([(s,) for s in sets], "type string")
    got = [tuple(r) for r in cooccurrence(df, "a").collect()]
    assert dict(got) == slow_cooccurrence(sets, "a")
    assert got == sorted(got, key=lambda r: (-r[1], r[0]))


def test_fill_missing_strategies(spark):
    data = [(1.0, 1, "a", None), (float("nan"), None, None, None), (4.0, 2, "b", None), (4.0, 2, "c", None)]
    df = spark.createDataFrame(data, "x double, n int, s string, e double")
    filled = lambda how: rows(fill_missing(df, how).filter("s IS NULL"))
    assert filled("mean") == [(3.0, 5 / 3, None, None)]
    assert filled("median") == [(4.0, 2.0, None, None)]
    assert filled("mode") == [(4.0, 2, None, None)]
    assert filled("zero") == [(0.0, 0, None, 0.0)]
    assert rows(fill_constant(df, 7, ["x"]).select("x"))[-1] == (7.0,)
    with pytest.raises(ValueError):
        fill_missing(df, "most")
    assert "NestedLoop" not in plan_of(fill_missing(df, "mean"))


def test_rare_duplicates_are_found_by_digests(spark, tmp_path):
    wide = [f"md5(cast(id * {i} AS string)) AS c{i}" for i in range(2, 22)]
    rows = spark.range(20_000).selectExpr("id", "cast(null AS string) AS empty", "double('NaN') AS nan", *wide)
    path = str(tmp_path / "rows")
    rows.unionByName(rows.filter("id % 2000 = 0")).unionByName(rows.filter("id % 4000 = 0")).write.parquet(path)
    df = spark.read.parquet(path)
    found = drop_rare_duplicates(df)
    assert found.columns == df.columns and found.count() == 20_000 and found.distinct().count() == 20_000
    # Only rows with a digest that occurs more than once go into a shuffle of whole rows.
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastExchange") >= 1
    assert drop_rare_duplicates(df, most=3).count() == 20_000
    assert drop_rare_duplicates(spark.createDataFrame([(1, 2)] * 5, "_digest int, `a.b` int")).count() == 1
