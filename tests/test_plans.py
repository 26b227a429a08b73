"""What the plans must look like at scale."""

import re

from pyspark.sql import functions as F

from civiq.operators.dedupe import keep_first
from civiq.operators.features import train_test_split
from civiq.operators.rain import extract_readings, pivot_stations
from civiq.operators.tags import cooccurrence
from civiq.plans.jobs import clean_tickets, clean_tickets_basic
from plan_text import plan_of
from workload.views import polygons, view

SF = "/root/testdata/sf0.001"


def ticket_scan(plan: str) -> str:
    return next(line for line in plan.splitlines() if "FileScan" in line and "organization#" in line)


def above(plan: str, line: str) -> list[str]:
    """The operators between the top of the plan and a line, by indentation."""
    lines = plan.splitlines()
    at = lines.index(line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    path, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            path.append(line.strip(" :+-"))
    return path


def test_tickets_are_not_shuffled_while_they_are_cleaned(spark, tmp_path):
    view(spark, SF, "tickets").write.parquet(str(tmp_path / "raw_tickets"))
    raw = spark.read.parquet(str(tmp_path / "raw_tickets"))
    clean = clean_tickets(raw, polygons(view(spark, SF, "boundaries")), view(spark, SF, "checks")).tickets
    plan = plan_of(clean)
    path = above(plan, ticket_scan(plan))
    assert any("BroadcastHashJoin" in op for op in path)
    assert not any("Exchange" in op or "Window" in op or "Aggregate" in op for op in path)


def test_tickets_scan_filters_early_and_reads_no_unused_column(spark, tmp_path):
    view(spark, SF, "tickets").write.parquet(str(tmp_path / "raw_tickets"))
    raw = spark.read.parquet(str(tmp_path / "raw_tickets"))
    clean = clean_tickets(raw, polygons(view(spark, SF, "boundaries")), view(spark, SF, "checks")).tickets
    plan = plan_of(clean)
    scan = ticket_scan(plan)
    columns = scan[:scan.index("]")]
    assert "photo" not in columns and "star#" not in columns
    nearest = above(plan, scan)[0]  # even the tests of the joined address reach the scan
    assert "Filter" in nearest and "isnotnull(district" in nearest


def test_split_moves_no_rows(spark):
    df = spark.range(1000).withColumn("v", F.rand(1))
    main = plan_of(train_test_split(df, ["id"])).split("Subquery")[0]
    assert "Exchange" not in main and "Sort" not in main and "Window" not in main


def test_keep_first_aggregates_before_its_only_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS o", "cast(id AS string) AS v")
    plan = plan_of(keep_first(df, ["k"], ["o"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min_by" in plan and "Window" not in plan


def test_cooccurrence_explodes_counted_sets(spark):
    df = spark.createDataFrame([("{a,b}",)], "type string")
    plan = plan_of(cooccurrence(df, "a"))
    assert plan.index("Generate explode") < plan.rindex("partial_count")


def test_pivot_is_two_aggregates_and_a_map(spark):
    lines = spark.createDataFrame([("1 2 0.5 RF.A", "d")], "line string, Date string")
    plan = plan_of(pivot_stations(extract_readings(lines), ["A", "B"]))
    assert len(re.findall("Exchange hashpartitioning", plan)) <= 2 and "Python" not in plan


def test_basic_cleaning_shuffles_once(spark):
    df = spark.createDataFrame([("1", "2", "3")], "`Time Stamp` string, lat string, lon string")
    assert plan_of(clean_tickets_basic(df)).count("Exchange") == 1
