"""Feature preparation: target split, exact-size train/test split, standard scaling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from civiq.functions.values import quoted, without_nan
from civiq.operators.columns import numeric_columns

_PREFIX = 4  # hex digits of a pass: 65,536 counts


def feature_target(df: DataFrame, target: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The numeric columns other than the target, then the target; ``keep`` names key columns in front."""
    features = numeric_columns(df, exclude=(target, *keep))
    return df.select(*[quoted(c) for c in [*keep, *features, target]])


def _digest(key: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[quoted(c).cast("string") for c in key]).cast("binary"))


def _tie(df: DataFrame) -> Column:
    """64 more bits, of the whole row, as digits that sort like a number."""
    return F.lpad(F.lower(F.hex(F.xxhash64(*[quoted(c) for c in df.columns]))), 16, "0")


def _cut(orders: DataFrame, test_size: float) -> str:
    """The order of the last row of the test part; empty where there is none.

    Radix descent: a pass counts the next four digits of the orders that share those found so far, at most 65,536 counts. The
    orders are digests, so a pass leaves about a 65,536th of the rows, and few passes are made, whatever the number of rows.
    """
    prefix, before, wanted, length = "", 0, None, 48
    while len(prefix) < length:
        digit = F.substring("order", len(prefix) + 1, _PREFIX)
        inside = orders.filter(F.col("order").startswith(prefix)) if prefix else orders
        counts = inside.groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        # An unpartitioned window, over counts only.
        running = counts.withColumn("upto", F.sum("n").over(Window.orderBy("digit")))
        if wanted is None:
            wanted = math.ceil((running.agg(F.max("upto")).first()[0] or 0) * float(test_size))
            if wanted == 0:
                return ""
        home = running.filter(F.col("upto") >= wanted - before).orderBy("digit").first()
        prefix, upto = prefix + home["digit"], before + home["upto"]
        if upto == wanted:
            return prefix.ljust(length, "g")  # behind every order with this prefix
        before = upto - home["n"]
    raise ValueError("train_test_split: equal rows at the cut cannot be told apart")


def train_test_split(df: DataFrame, key: list[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: exactly ceil(n · test_size) rows are "test", the ones with the smallest md5(seed|key).

    Rows that share a key are ordered by a digest of the whole row; where the cut falls among wholly equal rows, it raises. The cut is
    found when this is called, by counting digits of the digests, and stands in the plan as a constant: rows are never shuffled.
    """
    if not key:
        raise ValueError("train_test_split needs a key")
    order = F.concat(_digest(key, seed), _tie(df))
    cut = _cut(df.select(order.alias("order")), test_size)
    is_test = F.coalesce(order <= F.lit(cut), F.lit(False))
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def standard_scale(df: DataFrame, columns: list[str], split: str = "split") -> DataFrame:
    """Scale by mean and population deviation of the training rows; a zero deviation divides by 1.

    The training rows are measured when this is called, all columns in one pass, and the fit is constants of the plan.
    """
    if not columns:
        return df
    clean = {c: without_nan(quoted(c).cast("double")) for c in columns}
    fitted = df.filter(quoted(split) == "train").agg(
        *[F.avg(clean[c]).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(clean[c]).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = {}
    for i, c in enumerate(columns):
        mean, deviation = fitted[f"m{i}"], fitted[f"s{i}"]
        scaled[c] = (clean[c] - F.lit(mean).cast("double")) / F.lit(1.0 if deviation == 0 else deviation).cast("double")
    return df.withColumns(scaled)


def prepare_features(
    df: DataFrame, target: str, key: list[str], test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Key, scaled numeric features, target and ``split``."""
    table = feature_target(df, target, tuple(key))
    features = [c for c in table.columns if c != target and c not in key]
    return standard_scale(train_test_split(table, key, test_size, seed), features)
