"""Landed API bodies and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from civiq.functions.values import quoted


def parse_bodies(bodies: DataFrame, column: str, schema: str | T.StructType, name: str = "body") -> DataFrame:
    """A JSON body column as typed fields under ``name``; a failed or malformed body gives nulls."""
    parsed = F.from_json(quoted(column), schema, {"mode": "PERMISSIVE"})
    return bodies.withColumn(name, parsed)


def request_url(base: Column, endpoint: Column) -> Column:
    """base + "/" + endpoint without slashes at the end; no endpoint gives the base."""
    return F.regexp_replace(F.concat(base, F.lit("/"), F.coalesce(endpoint, F.lit(""))), "/+$", "")


def lookup_pages(
    requests: DataFrame, pages: DataFrame, base: str, endpoint: str, url: str = "url", landed: str | None = None,
    every: bool = False,
) -> DataFrame:
    """Every request with the page landed under its URL, nulls where none is.

    A URL landed more than once counts with its greatest ``landed`` value; without such a column it raises, or with
    ``every`` the request has a row for each of its pages. The pages are gathered by URL for the join anyway, so this
    costs no further shuffle. Requests of a much-requested URL are split over tasks by the adaptive skew join.
    """
    if every and landed:
        raise ValueError("give landed or every, not both")
    wanted = requests.withColumn("request_url", request_url(quoted(base), quoted(endpoint)))
    page = F.struct(*[quoted(c) for c in pages.columns if c != url])
    if every:
        single = pages.select(quoted(url).alias("_landed_url"), page.alias("_page"))
    elif landed:
        single = pages.groupBy(quoted(url).alias("_landed_url")).agg(F.max_by(page, quoted(landed)).alias("_page"))
    else:
        twice = F.raise_error(F.concat(F.lit("landed more than once: "), F.first(quoted(url)))).cast("boolean")
        chosen = F.when(F.when(F.count(F.lit(1)) > 1, twice).otherwise(True), F.first(page))
        single = pages.groupBy(quoted(url).alias("_landed_url")).agg(chosen.alias("_page"))
    joined = wanted.join(single, F.col("request_url") == F.col("_landed_url"), "left")
    return joined.select(*[quoted(c) for c in wanted.columns], *[
        F.col("_page").getField(c).alias(c) for c in pages.columns if c != url])
