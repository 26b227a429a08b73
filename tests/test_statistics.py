import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from civiq.operators.features import prepare_features, standard_scale, train_test_split
from civiq.operators import quantiles
from civiq.operators.quantiles import exact_quantiles
from civiq.operators.stats import correlation_matrix, histogram, null_counts, row_count, summary_stats, top_categories
from plan_text import plan_of

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def long_frame(spark, **columns):
    data = [(name, float(v)) for name, values in columns.items() for v in values]
    return spark.createDataFrame(data, "column string, x double")


def check_quantiles(spark, columns):
    got = {(r.column, r.prob): r.value for r in exact_quantiles(long_frame(spark, **columns), PROBS).collect()}
    for name, values in columns.items():
        for p in PROBS:
            assert got[(name, p)] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), (name, p)


def test_quantiles_of_tiny_columns(spark):
    rng = np.random.default_rng(1)
    check_quantiles(spark, {f"n{n}": rng.normal(size=n) for n in range(1, 12)})


def test_quantiles_of_awkward_distributions(spark):
    rng = np.random.default_rng(2)
    hot = np.concatenate([np.full(3000, 7.0), rng.normal(size=6000)])
    columns = {
        "normal": rng.normal(size=5000), "lognormal": rng.lognormal(sigma=4, size=5000), "constant": np.ones(500),
        "hot": hot, "steps": rng.integers(0, 4, 5000), "sorted": np.arange(4000), "two": np.array([1.0, 2.0] * 50),
        "huge": 10.0 ** rng.integers(-300, 300, 3000), "signs": rng.choice([-1, 0, 1], 3000) * rng.lognormal(sigma=20, size=3000),
        "times": 1.7e15 + rng.integers(0, 10**10, 3000), "near": 1 + rng.integers(0, 5, 3000) * 2.0**-52,
    }
    check_quantiles(spark, columns)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_quantiles_of_anything(spark, values):
    check_quantiles(spark, {"x": np.array(values)})


def test_quantiles_do_not_rank_a_whole_column(spark):
    df = spark.range(1000).select(F.lit("x").alias("column"), F.col("id").cast("double").alias("x"))
    plan = plan_of(exact_quantiles(df, PROBS))
    assert "functions=[percentile(" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_no_spread_of_values_takes_more_than_four_scans(spark, monkeypatch):
    scans, following = [], quantiles._next_pass
    monkeypatch.setattr(quantiles, "_next_pass", lambda long, known, *rest: scans.append(known) or following(long, known, *rest))
    half = 500_000
    x = F.when(F.col("id") < half, 0.97 + F.col("id") * 1e-8).otherwise(1e9 + (F.col("id") - half) * 1e-7)
    far = spark.range(2 * half, numPartitions=8).select(F.lit("far").alias("column"), x.alias("x"))
    found = quantiles.profile(far, [0.25, 0.5])["far"]
    assert found.quantiles[0.5] == pytest.approx((0.97 + (half - 1) * 1e-8 + 1e9) / 2, rel=1e-15)
    assert found.n == 2 * half and found.low == 0.97
    assert scans[0] == 16 and len(scans) < quantiles.PASSES == 4
    # The tenth of a thousandth apart, and a quarter of a million of one value beside them: no digit but the last tells them apart.
    near = F.when(F.col("id") % 4 == 0, 1.0).otherwise(1 + (F.col("id") % 100_000) * 2.0**-52)
    close = spark.range(2 * half, numPartitions=8).select(F.lit("near").alias("column"), near.alias("x"))
    scans.clear()
    values = close.toPandas()["x"].to_numpy()
    found = quantiles.profile(close, [0.1, 0.5, 0.9])["near"].quantiles
    assert found == {p: np.quantile(values, p) for p in (0.1, 0.5, 0.9)} and scans == [16, 32, 48]


def test_largest_smallest_and_infinite_numbers(spark):
    edge = [1.7e308, -1.7e308, 1.79e308, -1.79e308, 5e-324, -5e-324, 0.0, -0.0, 2.0**-1022, 2.0**-1023]
    got = {(r.column, r.prob): r.value for r in exact_quantiles(long_frame(spark, edge=edge, ends=[-float("inf"), 1.0, float("inf")]), (0, 0.5, 1)).collect()}
    assert (got["edge", 0], got["edge", 1]) == (-1.79e308, 1.79e308) and got["edge", 0.5] == 0
    assert [got["ends", p] for p in (0, 0.5, 1)] == [-float("inf"), 1.0, float("inf")]
    two = exact_quantiles(long_frame(spark, two=[-1.7e308, 1.7e308]), (0.5,)).first()
    assert two.value == 0


def test_keys_are_those_of_the_binary_form_and_in_its_order(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate([
        rng.integers(0, 2**63 - 2**53, 20_000).view(np.float64), [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 2.2250738585072014e-308],
        np.nextafter(2.0 ** np.arange(-1070, 1023), 0), 2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1074, 1023), np.inf),
    ])
    values = np.concatenate([values, -values])
    values = values[~np.isnan(values)]
    df = quantiles.with_key(spark.createDataFrame(pd.DataFrame({"x": values}))).toPandas()
    bits = np.abs(df["x"].to_numpy()).view(np.int64)
    assert (df["key"].to_numpy() == np.where(df["x"] < 0, -bits, bits)).all()


def test_summary_agrees_with_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=301), "b": rng.integers(0, 50, 301), "e": np.nan})
    pdf.loc[::7, "a"] = np.nan
    start = datetime.datetime(2024, 1, 1)
    pdf["t"] = [start + datetime.timedelta(hours=int(h)) for h in rng.integers(0, 900, 301)]
    df = spark.createDataFrame(pdf.assign(flag=True, s="x"))
    got = {(r.column, r.stat): (r.value, r.ts_value) for r in summary_stats(df).collect()}
    want = pdf.describe()
    assert {c for c, _ in got} == {"a", "b", "e", "t"}
    for c in ("a", "b"):
        for stat in want.index:
            assert got[(c, stat)][0] == pytest.approx(want.loc[stat, c]), (c, stat)
    assert got[("e", "count")][0] == 0 and got[("e", "50%")][0] is None
    assert got[("t", "50%")][1] == want.loc["50%", "t"].to_pydatetime()
    assert got[("t", "max")][1] == want.loc["max", "t"].to_pydatetime()
    assert got[("t", "std")] == (None, None) and got[("t", "count")][0] == 301


def test_summary_of_text_only(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "s string")
    got = {r.stat: (r.value, r.top) for r in summary_stats(df).collect()}
    assert got == {"count": (3, None), "unique": (2, None), "top": (None, "b"), "freq": (2, None)}


def test_correlations_are_pairwise_complete(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200), "c": 1.0})
    pdf["b"] += pdf["a"]
    pdf.loc[::5, "a"] = np.nan
    pdf.loc[::9, "b"] = np.nan
    got = {(r.row, r.col): r.corr for r in correlation_matrix(spark.createDataFrame(pdf)).collect()}
    want = pdf.corr()
    assert len(got) == 9
    for x in "ab":
        for y in "ab":
            assert got[(x, y)] == pytest.approx(want.loc[x, y])
    assert got[("a", "c")] is None and got[("c", "c")] is None


def test_correlations_of_many_columns_stack_no_rows(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(rng.normal(size=(300, 40)), columns=[f"v{i}" for i in range(40)])
    pdf = pdf.mask(rng.random(pdf.shape) < 0.1)
    df = spark.createDataFrame(pdf)
    matrix = correlation_matrix(df, tile=16)
    plan = plan_of(matrix)
    assert "Expand" not in plan and "stack" not in plan and "hashpartitioning" not in plan
    got = matrix.toPandas().pivot(index="row", columns="col", values="corr").loc[pdf.columns, pdf.columns]
    assert np.allclose(got.to_numpy(), pdf.corr().to_numpy(), rtol=0, atol=1e-12)
    assert correlation_matrix(df.select(F.lit("x").alias("t"))).collect() == []


def test_histogram_agrees_with_numpy(spark):
    rng = np.random.default_rng(5)
    columns = {"a": rng.normal(size=500), "b": np.round(rng.uniform(0, 1, 500), 2), "k": np.full(500, 3.0)}
    rows = histogram(spark.createDataFrame(pd.DataFrame(columns)), list(columns)).collect()
    for name, values in columns.items():
        counts, edges = np.histogram(values, bins=20)
        mine = sorted((r for r in rows if r.column == name), key=lambda r: r.bin)
        assert [r["count"] for r in mine] == counts.tolist()
        assert [r.left for r in mine] == pytest.approx(edges[:-1]) and mine[-1].right == pytest.approx(edges[-1])


def test_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "a")], "x double, kind_type string")
    assert {r.column: r.nulls for r in null_counts(df).collect()} == {"x": 1, "kind_type": 1}
    assert {r.column: r.nulls for r in null_counts(df, nan_is_missing=True).collect()} == {"x": 2, "kind_type": 1}
    assert row_count(df).first().rows == 3
    assert [tuple(r) for r in top_categories(df).collect()] == [("a", 2), (None, 1)]


@pytest.mark.parametrize("n,test_size", [(1, 0.2), (7, 0.2), (100, 0.25), (1003, 0.1), (50, 1.0), (50, 0.0)])
def test_split_has_the_exact_size_and_repeats(spark, n, test_size):
    df = spark.range(n).withColumn("v", F.col("id") * 2)
    split = train_test_split(df, ["id"], test_size)
    chosen = {r.id for r in split.filter("split = 'test'").collect()}
    assert len(chosen) == int(np.ceil(n * test_size))
    again = train_test_split(df.repartition(5), ["id"], test_size)
    assert {r.id for r in again.filter("split = 'test'").collect()} == chosen
    other = train_test_split(df, ["id"], test_size, seed=7)
    if n > 50 and 0 < test_size < 1:
        assert {r.id for r in other.filter("split = 'test'").collect()} != chosen


def test_rows_that_share_a_key_are_split_by_their_content(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    for size in (0.2, 0.5):
        assert train_test_split(df, ["k"], size).filter("split = 'test'").count() == 100 * size
    with pytest.raises(ValueError, match="cannot be told apart"):
        train_test_split(spark.range(10).selectExpr("1 AS k"), ["k"])


def test_the_plan_does_not_grow_with_the_features(spark):
    def relations(count):
        df = spark.range(50).select("id", *[(F.col("id") % (i + 2)).alias(f"f{i}") for i in range(count)], F.lit(1).alias("y"))
        return plan_of(prepare_features(df, "y", ["id"])).count("Range")

    assert relations(1) == relations(10) == 1


def test_scaling_is_fitted_on_the_training_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0, "train"), (3.0, 5.0, "train"), (9.0, 6.0, "test"), (float("nan"), 5.0, "test")], "a double, b double, split string")
    rows = {tuple(r) for r in standard_scale(df, ["a", "b"]).collect()}
    assert rows == {(-1.0, 0.0, "train"), (1.0, 0.0, "train"), (7.0, 1.0, "test"), (None, 0.0, "test")}


def test_prepared_features_keep_key_and_target(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("x"), F.lit("s").alias("s"), (F.col("id") % 2).alias("y"))
    prepared = prepare_features(df, "y", ["id"])
    assert prepared.columns == ["id", "x", "y", "split"]
    assert prepared.filter("split = 'test'").count() == 20
    mean, deviation = prepared.filter("split = 'train'").agg(F.avg("x"), F.stddev_pop("x")).first()
    assert mean == pytest.approx(0) and deviation == pytest.approx(1)
