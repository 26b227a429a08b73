import json
import math
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from civiq.operators.boundaries import join_counts, repair_boundaries, report_counts, to_lonlat
from civiq.functions.geometry import EVEREST_1937, INDIAN_1975_SHIFT, WGS_84, Shift, shift_datum
from civiq.operators import spatial
from civiq.operators.spatial import assign_polygons, grid_rows, grow_tree, hot_cells, plan_grid, verify_addresses
from civiq.sources.boundaries import read_boundaries
from plan_text import plan_of

POLYGONS = "poly_id bigint, name string, edges array<struct<x1: double, y1: double, x2: double, y2: double>>"


def ring(*corners):
    return [(*a, *b) for a, b in zip(corners, (*corners[1:], corners[0]))]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def polygon_table(spark, shapes):
    return spark.createDataFrame([(i, f"p{i}", [tuple(map(float, e)) for e in edges]) for i, edges in enumerate(shapes)], POLYGONS)


def exactly_within(x, y, edges):
    """Even-odd rule in exact arithmetic, the border excluded."""
    x, y = Fraction(x), Fraction(y)
    odd = False
    for x1, y1, x2, y2 in (map(Fraction, e) for e in edges):
        side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def brute_force(points, shapes):
    return {i: next((k for k, e in enumerate(shapes) if x is not None and exactly_within(x, y, e)), None) for i, x, y in points}


def joined(spark, points, shapes, **options):
    df = spark.createDataFrame(points, "id bigint, longitude double, latitude double")
    rows = assign_polygons(df, polygon_table(spark, shapes), ["name"], **options).collect()
    assert len(rows) == len(points)
    assert all(r.name == (None if r.poly_id is None else f"p{r.poly_id}") for r in rows)
    return {r.id: r.poly_id for r in rows}


HOLED = box(0, 0, 4, 4) + box(1, 1, 2, 2)
PARTS = box(10, 0, 11, 1) + box(12, 0, 13, 1)


def test_borders_corners_holes_and_parts(spark):
    places = {
        (0.5, 0.5): 0, (0, 0): None, (4, 2): None, (2, 0): None, (1.5, 1.5): None, (1, 1.5): None, (2, 2): None,
        (3, 3): 0, (2.5, 1): 0, (10.5, 0.5): 1, (11.5, 0.5): None, (12.5, 0.5): 1, (-1, 2): None, (0.5, 4): None,
        (3, 1): 0, (0.5, 1): 0, (0.5, 2): 0,
    }
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(places)]
    for cell in (0.3, 0.5, 1.0, 7.0):
        got = joined(spark, points, [HOLED, PARTS], cell=cell)
        assert list(got[i] for i in range(len(points))) == list(places.values()), cell


def random_shape(rng):
    cx, cy, n = rng.uniform(-3, 3), rng.uniform(-3, 3), rng.randint(3, 9)
    corners = []
    for k in range(n):
        r, a = rng.uniform(0.2, 1.6), 2 * math.pi * k / n
        corners.append((round(cx + r * math.cos(a), 2), round(cy + r * math.sin(a), 2)))
    return ring(*corners)


@pytest.mark.parametrize("options", [{"cell": 0.1}, {"cell": 0.5}, {"cell": 5.0}, {"cell": 0.5, "broadcast_bytes": 0, "salt_rows": 5}, {"cell": 5.0, "crowd": 4, "broadcast_bytes": 0}])
def test_random_polygons_match_exact_brute_force(spark, options):
    rng = random.Random(11)
    shapes = [random_shape(rng) for _ in range(25)] + [HOLED]
    points = [(i, round(rng.uniform(-5, 5), 1), round(rng.uniform(-5, 5), 1)) for i in range(1500)]
    corners = [(x, y) for s in shapes for x, y, _, _ in s]
    points += [(2000 + i, float(x), float(y)) for i, (x, y) in enumerate(corners)]
    points += [(9000, None, 1.0), (9001, float("nan"), 1.0), (9002, 1.0, None), (9003, math.inf, 0.0)]
    want = brute_force([(i, x, y) for i, x, y in points if i < 9000], shapes) | dict.fromkeys(range(9000, 9004))
    assert joined(spark, points, shapes, **options) == want


def test_hot_point_in_the_shuffled_plan(spark):
    """A third of all rows on one spot spreads over the salts and stays whole."""
    points = [(i, 0.5, 0.5) if i % 3 == 0 else (i, 3.0, float(i % 5)) for i in range(3000)]
    df = spark.createDataFrame(points, "id bigint, longitude double, latitude double")
    out = assign_polygons(df, polygon_table(spark, [HOLED]), [], cell=1.0, broadcast_bytes=0, salt_rows=50)
    assert out.filter("poly_id = 0").count() == sum((i % 3 == 0) or 0 < i % 5 < 4 for i in range(3000))
    assert "salt" in plan_of(out) and "SortMergeJoin" in plan_of(out)


def test_plans(spark):
    df = spark.range(100).selectExpr("id", "id * 0.1D AS longitude", "id * 0.1D AS latitude")
    plan = plan_of(assign_polygons(df, polygon_table(spark, [HOLED, PARTS]), ["name"]))
    assert "BroadcastHashJoin" in plan
    for bad in ("NestedLoop", "Cartesian", "Python", "SortMergeJoin"):
        assert bad not in plan


def test_a_hot_cell_is_dealt_by_its_count(spark):
    places = spark.range(3000).select(F.lit(0).alias("level"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("gx"), F.lit(1).alias("gy"))
    hot = hot_cells(places, ["level", "gx", "gy"], 50)
    assert [tuple(r) for r in hot.collect()] == [(0, 7, 1, 21)]  # 1000 and the one of id 7, by fifties: more than 16 tasks
    same = spark.createDataFrame([(0.5, 0.5)] * 2000, "longitude double, latitude double").repartition(4)
    out = assign_polygons(same, polygon_table(spark, [HOLED]), [], cell=1.0, broadcast_bytes=0, salt_rows=50)
    salts = re.findall(r"__?salt#\d+", plan_of(out))
    assert salts and out.filter("poly_id = 0").count() == 2000


def test_grid_stays_within_its_bound(spark):
    shapes = [box(0, 0, 50, 50), box(3, 3, 4, 4), HOLED]
    polygons = polygon_table(spark, shapes)
    grid = plan_grid(polygons, cell=0.01, max_rows=5000)
    assert grid.cell > 0.01 and grid.rows <= 5000
    rows = grid_rows(polygons, ["name"], grid.cell)
    assert rows.count() <= grid.rows
    # Cells wholly inside carry no edges at all.
    assert rows.filter("whole AND size(kept) = 0").count() > rows.count() / 2


def first_box(points, corners):
    return {i: next((k for k, (a, b, c, d) in enumerate(corners) if a < x < c and b < y < d), None) for i, x, y in points}


def tree_of(spark, shapes, places, **options):
    return grow_tree(polygon_table(spark, shapes), ["name"], spark.createDataFrame(places, "px double, py double"), **options)


def test_crowded_cells_are_cut_until_their_polygons_are_apart(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_SPLIT_WORK", 100)
    rng = random.Random(5)
    corners = [(x, y, x + 0.01, y + 0.01) for x, y in ((rng.random(), rng.random()) for _ in range(600))]
    shapes = [box(*c) for c in corners]
    places = [(rng.random(), rng.random()) for _ in range(800)]
    tree = tree_of(spark, shapes, places, cell=4.0, crowd=20)
    assert len(tree.splits) >= 3
    sizes = tree.leaves.groupBy("level", "gx", "gy").count()
    assert sizes.agg(F.max("count")).first()[0] <= 20 and tree.crowded is None
    assert tree.leaves.count() < 3 * len(shapes)
    points = [(i, x, y) for i, (x, y) in enumerate(places)]
    assert joined(spark, points, shapes, cell=4.0, crowd=20, broadcast_bytes=0, salt_rows=10) == first_box(points, corners)


def test_polygons_on_one_another_stay_rows(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_SPLIT_WORK", 100)
    monkeypatch.setattr(spatial, "_PAIR_BLOCK", 50)
    rng = random.Random(6)
    corners = [(0.1, 0.1, 0.4 + i * 1e-4, 0.4 + i * 1e-4) for i in range(300)]
    rng.shuffle(corners)
    stack = [box(*c) for c in corners]
    points = [(i, rng.random(), rng.random()) for i in range(500)] + [(1000 + i, 0.41, 0.405) for i in range(100)]
    tree = tree_of(spark, stack, [(x, y) for _, x, y in points], cell=1.0, crowd=10)
    assert tree.crowded.count() > 0
    # Where a cell is wholly inside a polygon, none behind that one is a candidate.
    whole = tree.leaves.groupBy("level", "gx", "gy").agg(F.min(F.when(F.col("whole"), F.col("poly_id"))).alias("w"), F.max("poly_id").alias("m"))
    assert whole.filter("level > 0 AND w < m").count() == 0
    assert joined(spark, points, stack, cell=1.0, crowd=10) == first_box(points, corners)


def test_very_many_polygons_in_one_cell(spark):
    """100,000 of them: no list is longer than the bound, and every point has its own."""
    side = 400
    edges = ", ".join(f"struct({a} AS x1, {b} AS y1, {c} AS x2, {d} AS y2)" for a, b, c, d in (
        ("x", "y", "x + s", "y"), ("x + s", "y", "x + s", "y + s"), ("x + s", "y + s", "x", "y + s"), ("x", "y + s", "x", "y")))
    polygons = spark.range(100_000).selectExpr("id AS poly_id", f"double(id % {side}) / {2 * side} AS x", f"double(floor(id / {side})) / {2 * side} AS y", "0.001D AS s")
    polygons = polygons.selectExpr("poly_id", f"array({edges}) AS edges")
    points = spark.range(20_000).selectExpr("id", f"double(id % {side}) / {2 * side} + 0.0005D AS longitude", f"double(floor(id / {side})) / {2 * side} + 0.0005D AS latitude")
    tree = grow_tree(polygons, [], points.selectExpr("longitude AS px", "latitude AS py"), cell=1.0)
    listed = tree.leaves if tree.crowded is None else tree.leaves.join(tree.crowded, ["level", "gx", "gy"], "left_anti")
    assert tree.splits and listed.groupBy("level", "gx", "gy").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0] <= 64
    out = assign_polygons(points, polygons, [], cell=1.0)
    assert out.filter("poly_id = id").count() == 20_000


def test_verified_tickets(spark):
    areas = polygon_table(spark, [box(0, 0, 1, 1), box(1, 0, 2, 1)]).withColumns({
        "DISTRICT_N": F.lit("d"), "SUBDISTR_1": F.concat(F.lit("s"), F.col("poly_id").cast("string"))
    })
    data = [(1, 0.5, 0.5, "d", "s0"), (2, 1.5, 0.5, "d", "s0"), (3, 0.5, 0.5, None, "s0"), (4, 9.0, 9.0, "d", "s0")]
    df = spark.createDataFrame(data, "id int, longitude double, latitude double, district string, subdistrict string")
    out = verify_addresses(df, areas)
    assert out.columns == df.columns and [r.id for r in out.collect()] == [1]


def boundary_rows(spark, names):
    data = [(f" {i}".strip(), n, "9", "D") for i, n in enumerate(names)]
    return spark.createDataFrame(data, "SUBDISTRIC string, SUBDISTR_1 string, DISTRICT_I string, DISTRICT_N string")


CHECK = "scode int, sname string, dcode int, dname string, seq int"


def test_repair_replaces_all_names_or_none(spark):
    check = spark.createDataFrame([(0, "old", 9, "D", 1), (0, "A", 9, "D", 2), (1, "B", 9, "D", 3)], CHECK)
    fixed = {r.SUBDISTRIC: r.SUBDISTR_1 for r in repair_boundaries(boundary_rows(spark, ["A", "b", "C"]), check).collect()}
    assert fixed == {0: "A", 1: "B", 2: None}
    right = {r.SUBDISTRIC: r.SUBDISTR_1 for r in repair_boundaries(boundary_rows(spark, ["B", "A"]), check).collect()}
    assert right == {0: "B", 1: "A"}
    same = boundary_rows(spark, ["x"])
    assert repair_boundaries(same, None) is same
    with pytest.raises(Exception, match="not an integer"):
        repair_boundaries(same.withColumn("SUBDISTRIC", F.lit("x1")), check).collect()


def test_report_counts_keep_every_area(spark):
    tickets = spark.createDataFrame([("A", "น้ำท่วม"), ("A", "น้ำท่วม"), ("B", "road"), (None, "น้ำท่วม")], "subdistrict string, type_list string")
    out = report_counts(tickets, boundary_rows(spark, ["A", "B", "C"]))
    assert sorted((r.SUBDISTR_1, r.flood_report_count) for r in out.collect()) == [("A", 2), ("B", 0), ("C", 0)]
    assert join_counts(boundary_rows(spark, ["A"]), tickets.groupBy("subdistrict").count()).columns[-2:] == ["subdistrict", "count"]


def test_utm_of_known_places(spark):
    """Published coordinates of the CN Tower (zone 17 north), and points on a central meridian."""
    data = [(32617, 630084.0, 4833438.0), (32647, 500000.0, 0.0), (32747, 500000.0, 10000000.0), (4326, 100.5, 13.7)]
    df = spark.createDataFrame([(e, [(x, y, x, y + 1)]) for e, x, y in data], "epsg int, edges array<struct<x1: double, y1: double, x2: double, y2: double>>")
    got = [(r.edges[0].x1, r.edges[0].y1) for r in to_lonlat(df).collect()]
    assert got[0] == (pytest.approx(-79.387139, abs=1e-5), pytest.approx(43.642567, abs=1e-5))
    assert got[1] == (pytest.approx(99.0), pytest.approx(0.0, abs=1e-9)) and got[2] == (pytest.approx(99.0), pytest.approx(0.0, abs=1e-9))
    assert got[3] == (100.5, 13.7)
    with pytest.raises(Exception, match="unsupported EPSG"):
        to_lonlat(df.withColumn("epsg", F.lit(3857))).collect()


def test_datum_shifts(spark):
    def shifted(lon, lat, *how):
        point = F.array(F.struct(F.lit(lon).alias("x"), F.lit(lat).alias("y")))
        return spark.range(1).select(F.inline(shift_datum(point, *how))).first()

    same = shifted(100.5, 13.75, WGS_84, WGS_84, Shift(0, 0, 0))
    assert tuple(same) == (pytest.approx(100.5, abs=1e-12), pytest.approx(13.75, abs=1e-11))
    # On the equator at the prime meridian, a turn about the axis by an arc second moves the longitude by as much.
    assert shifted(0.0, 0.0, WGS_84, WGS_84, Shift(0, 0, 0, rz=1.0)).x == pytest.approx(1 / 3600, rel=1e-9)
    assert shifted(0.0, 0.0, WGS_84, WGS_84, Shift(0, 100.0, 0)).x == pytest.approx(math.degrees(math.atan(100 / 6378137)), rel=1e-12)
    pole = shifted(10.0, 90.0, WGS_84, WGS_84, Shift(0, 0, 50.0, ppm=3.0))
    assert pole.y == pytest.approx(90.0, abs=1e-9)
    # In Bangkok the older coordinates lie some 400 m to the south-east; the query beside its SQL checks the digits.
    moved = shifted(100.5, 13.75, EVEREST_1937, WGS_84, INDIAN_1975_SHIFT)
    assert 250 < (100.5 - moved.x) * 108_000 < 450 and 150 < (moved.y - 13.75) * 110_600 < 250


def test_geojson_collection(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    far = [[[10, 0], [11, 0], [11, 1], [10, 1]]]  # open ring
    features = [
        {"type": "Feature", "properties": {"n": "a", "code": 7}, "geometry": {"type": "Polygon", "coordinates": [square, hole]}},
        {"type": "Feature", "properties": {"n": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [far, [hole]]}},
        {"type": "Feature", "properties": {"n": "c"}, "geometry": None},
    ]
    document = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32647"}}, "features": features}
    path = tmp_path / "areas.geojson"
    path.write_text(json.dumps(document, indent=1))
    rows = {r.n: r for r in read_boundaries(spark, str(path), ["n", "code"]).collect()}
    assert [(r.poly_id, r.code, r.epsg) for r in (rows["a"], rows["b"], rows["c"])] == [(0, "7", 32647), (1, None, 32647), (2, None, 32647)]
    assert len(rows["a"].edges) == 8 and len(rows["b"].edges) == 8 and not rows["c"].edges
    assert (10.0, 1.0, 10.0, 0.0) in [tuple(e) for e in rows["b"].edges]
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps(f) for f in features[:1]))
    line = read_boundaries(spark, str(lines), ["n"], layout="lines", index="code").first()
    assert (line.poly_id, line.epsg, len(line.edges)) == (7, 4326, 8)
    with pytest.raises(ValueError):
        read_boundaries(spark, str(lines), ["n"], layout="lines")


@pytest.mark.parametrize("limit", [128 << 20, 0])
def test_columns_of_the_points_are_kept_whatever_their_names(spark, limit):
    names = ["gx", "gy", "px", "py", "nx", "salt", "hit", "candidates", "_gx", "_salt"]
    points = spark.createDataFrame([(0.5, 0.5, *names)], "longitude double, latitude double, " + ", ".join(f"{n} string" for n in names))
    found = assign_polygons(points, polygon_table(spark, [box(0, 0, 1, 1)]), ["name"], broadcast_bytes=limit).first()
    assert [found[n] for n in names] == names and found.poly_id == 0 and found.name == "p0"


@pytest.mark.parametrize("crowd", [64, 1])
def test_points_may_have_columns_named_like_the_new_ones(spark, crowd):
    points = spark.createDataFrame([(0.5, 0.5, "a", "b", "p0", "d")], "longitude double, latitude double, poly_id string, Name string, subdistrict string, district string")
    areas = polygon_table(spark, [box(0, 0, 1, 1), box(0, 0, 2, 2), box(0, 0, 3, 3)])
    found = assign_polygons(points, areas, ["name"], crowd=crowd, cell=1.0)
    assert found.columns == [*points.columns, "poly_id_", "name_"]
    assert tuple(found.first()) == (0.5, 0.5, "a", "b", "p0", "d", 0, "p0")
    named = areas.withColumns({"DISTRICT_N": F.lit("d"), "SUBDISTR_1": F.col("name")})
    tickets = points.withColumns({"DISTRICT_N": F.lit("own"), "SUBDISTR_1": F.lit("own")})
    kept = verify_addresses(tickets, named, crowd=crowd, cell=1.0)
    assert kept.columns == tickets.columns and kept.first().DISTRICT_N == "own" and kept.first().poly_id == "a"
