"""Exact quantiles by radix descent, without holding a column's values in one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one
buffer, and approximate sketches are merged one by one in a single task. Here
every value becomes a 64-bit integer of the same order, read as four digits of
16 bits. A pass counts the next digit of the values that share the digits found
so far, and the running counts tell which digit holds a wanted rank. Four
passes spell out every wanted value, however the values are spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window, functions as F

from civiq.functions.values import quoted

DIGIT_BITS = 16
PASSES = 64 // DIGIT_BITS
_MANTISSA = 52
_INFINITY = 0x7FF << _MANTISSA


@dataclass(frozen=True)
class Profile:
    """What the passes learn about one column; ``std`` is the sample deviation."""

    n: int
    mean: float
    std: float | None
    low: float
    high: float
    quantiles: dict[float, float]


def with_key(df: DataFrame, x: str = "x", key: str = "key") -> DataFrame:
    """Add a bigint that grows with the double ``x``: the bits of its magnitude, negated for negative numbers.

    The exponent is guessed by logarithm and corrected by one where rounding
    misled it; scaling by powers of two is exact, so no two values share a key.
    Every step is a column of its own: written as one expression, the logarithm
    would stand in it, and be taken, dozens of times.
    """
    kept = [quoted(c) for c in df.columns]
    size, guess, part, low = (quoted(key + n) for n in ("_size", "_guess", "_part", "_low"))
    name = lambda n: key + n
    steps = df.withColumn(name("_size"), F.abs(quoted(x)))
    steps = steps.withColumn(name("_guess"), F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(size)).cast("double"))))
    steps = steps.withColumn(name("_part"), size / F.pow(F.lit(2.0), guess))
    # Below 2^-1022 there is no further exponent: the part is under 1 by right.
    steps = steps.withColumn(name("_low"), (part < 1) & (guess > -1022))
    steps = steps.withColumns({
        name("_guess"): guess + F.when(part >= 2, 1.0).when(low, -1.0).otherwise(0.0),
        name("_part"): F.when(part >= 2, part / 2).when(low, part * 2).otherwise(part),
    })
    bits = (guess + 1022).cast("bigint") * (1 << _MANTISSA) + (part * float(1 << _MANTISSA)).cast("bigint")
    bits = F.when(size == 0, 0).when(size == float("inf"), _INFINITY).otherwise(bits)
    signed = bits * F.when(quoted(x) < 0, -1).otherwise(1)
    # The coalesce never acts, but tells Spark that the key is not null: a filter for that, made for a join, would take it apart again.
    return steps.select(*kept, F.coalesce(signed, F.lit(0).cast("bigint")).alias(key))


def _running(counts: DataFrame, *place: str) -> DataFrame:
    """With the ranks ``start`` to ``end`` a digit covers; a place has at most 65,536 digits."""
    end = F.sum("cnt").over(Window.partitionBy(*place).orderBy("digit"))
    return counts.withColumn("end", end).withColumn("start", F.col("end") - F.col("cnt"))


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """The two ranks around (n - 1)·p and the share of the upper one."""
    place = (n - 1) * float(p)
    return floor(place), ceil(place), place - floor(place)


class _Wanted:
    """The wanted ranks: values of those found, and for the others the bits known, the rank among values that share them."""

    def __init__(self) -> None:
        self.values: dict[tuple[str, int], float] = {}
        self.places: dict[tuple[str, int], tuple[int, int]] = {}
        self.most = 0  # rows of the fullest place

    def settle(self, wanted: tuple[str, int], prefix: int, rank: int, home: dict) -> None:
        """A place whose values are all equal needs no further digit."""
        if home["lo"] == home["hi"]:
            self.values[wanted] = home["lo"] if home["lo"] else 0.0
        else:
            self.places[wanted] = (prefix, rank - home["start"])
            self.most = max(self.most, home["end"] - home["start"])


def _first_pass(long: DataFrame, probs: Sequence[float]) -> tuple[dict, _Wanted]:
    """Moments per column, and the first digit of every wanted rank.

    Digits' means and variances are merged pairwise, so one scan gives moments and places alike.
    """
    counts = with_key(long).groupBy("column", F.shiftright("key", 64 - DIGIT_BITS).alias("digit")).agg(
        F.count(F.lit(1)).alias("cnt"), F.avg("x").alias("mean"), F.var_pop("x").alias("var"), F.min("x").alias("lo"), F.max("x").alias("hi"),
    )
    # One row per column and digit; what comes to the driver are the digits of two ranks per probability.
    whole = Window.partitionBy("column")
    spread = _running(counts, "column").withColumn("n", F.sum("cnt").over(whole))
    spread = spread.withColumn("centre", F.sum(F.col("mean") * (F.col("cnt") / F.col("n"))).over(whole))
    inner = F.col("cnt") * (F.col("var") + (F.col("mean") - F.col("centre")) ** 2)
    places = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    hit = F.lit(False)
    for rank in (end.cast("bigint") for place in places for end in (F.floor(place), F.ceil(place))):
        hit = hit | ((rank >= F.col("start")) & (rank < F.col("end")))
    moments = spread.groupBy("column").agg(
        F.max("n").alias("n"), F.max("centre").alias("mean"), F.sum(inner).alias("inner"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.collect_list(F.when(hit, F.struct("start", "end", "digit", "lo", "hi"))).alias("digits"),
    )
    found, wanted = {}, _Wanted()
    for r in moments.collect():
        deviation = None if r["n"] < 2 else (r["inner"] / (r["n"] - 1)) ** 0.5
        found[r["column"]] = (r["n"], r["mean"], deviation, r["lo"], r["hi"])
        for rank in {rank for p in probs for rank in _ranks(r["n"], p)[:2]}:
            home = next(d for d in r["digits"] if d["start"] <= rank < d["end"])
            wanted.settle((r["column"], rank), home["digit"], rank, home)
    return found, wanted


def _next_pass(long: DataFrame, known: int, bits: int, wanted: _Wanted) -> _Wanted:
    """Every wanted rank's place with ``bits`` more than the ``known`` ones.

    Only values that share the bits found so far are counted. The broadcast
    prefixes are at most two per probability and column.
    """
    ranks: dict[tuple[str, int], list[int]] = {}
    for (column, _), (prefix, rank) in wanted.places.items():
        ranks.setdefault((column, prefix), []).append(rank)
    table = F.broadcast(long.sparkSession.createDataFrame(
        [(c, p, sorted(set(r))) for (c, p), r in ranks.items()], "column string, prefix bigint, ranks array<bigint>"))
    left = 64 - known
    needed = long.filter(F.col("column").isin(sorted({c for c, _ in ranks})))
    digits = with_key(needed).select(
        "column", "x", F.shiftright("key", left).alias("prefix"),
        F.shiftright(F.col("key").bitwiseAND((1 << left) - 1), left - bits).alias("digit"),
    )
    counts = digits.join(table.select("column", "prefix"), ["column", "prefix"]).groupBy("column", "prefix", "digit").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    hits = _running(counts, "column", "prefix").join(table, ["column", "prefix"]).filter(
        F.exists("ranks", lambda r: (r >= F.col("start")) & (r < F.col("end"))))
    homes: dict[tuple[str, int], list] = {}
    for r in hits.select("column", "prefix", "digit", "start", "end", "lo", "hi").collect():
        homes.setdefault((r["column"], r["prefix"]), []).append(r)
    out = _Wanted()
    for (column, place), (prefix, rank) in wanted.places.items():
        home = next(r for r in homes[column, prefix] if r["start"] <= rank < r["end"])
        out.settle((column, place), (prefix << bits) | home["digit"], rank, home)
    out.values |= wanted.values
    return out


def profile(long: DataFrame, probs: Sequence[float]) -> dict[str, Profile]:
    """Moments and exact quantiles, linearly interpolated, of a long frame (column, x) without nulls or NaN.

    At most ``PASSES`` scans for any input, each ending in counts that are combined
    before their shuffle; the driver sees a few rows per column. Once no place of a wanted
    rank holds more than 65,536 rows, one pass reads all bits left, as there cannot be
    more different digits than rows. A column without rows has no profile.
    """
    moments, wanted = _first_pass(long, probs)
    known = DIGIT_BITS
    while wanted.places:
        bits = 64 - known if wanted.most <= 1 << DIGIT_BITS else DIGIT_BITS
        wanted = _next_pass(long, known, bits, wanted)
        known += bits
    out = {}
    for column, (n, mean, std, low, high) in moments.items():
        values = {}
        for p in probs:
            below, above, weight = _ranks(n, p)
            a, b = wanted.values[column, below], wanted.values[column, above]
            # Equal ends may be infinite, and the difference of far ends may not fit a double.
            values[p] = a if a == b else a * (1 - weight) + b * weight if abs(b - a) == float("inf") else a + (b - a) * weight
        out[column] = Profile(n, mean, std, low, high, values)
    return out


def exact_quantiles(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, prob, value) of ``profile``, as a table of one row per column and probability."""
    rows = [(c, float(p), v) for c, found in profile(long, probs).items() for p, v in found.quantiles.items()]
    return long.sparkSession.createDataFrame(rows, "column string, prob double, value double")
