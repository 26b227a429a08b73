"""Points in polygons through a tree of cells: an equi-join on cells and an exact test of the few candidates.

Polygons are laid out over a grid. A cell with many candidates is cut into four, and again, as long as that separates
them and enough points lie in it to pay. A leaf of few candidates is one row with their list; where many polygons lie on
one another and cannot be separated, candidates stay rows, and an aggregate picks the first that holds a place.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from civiq.functions.geometry import strictly_inside, upward
from civiq.functions.values import free_name, quoted, without_nan
from civiq.operators.columns import drop_columns
from civiq.operators.filters import keep_agreeing
from civiq.session import scratch_dir

_EDGE_BYTES = 72        # six doubles in a struct in an array
_CANDIDATE_BYTES = 256  # per polygon and cell, attributes apart
_WIDTHS = 40            # doublings of the cell that are considered
_DEPTH = 8              # times a cell can be cut
_SPLIT_WORK = 100_000  # tests of a place against a polygon that pay cutting a cell
_PAIR_BLOCK = 4096      # candidates, and places, of a crowded cell that meet in one group
_HOT_CELLS = 10_000     # cells whose points are salted, at most
_CELL = ["level", "gx", "gy"]


@dataclass(frozen=True)
class Grid:
    """A cell width, and how many (polygon, cell) pairs the boxes make at that width."""

    cell: float
    rows: int


@dataclass(frozen=True)
class Tree:
    """``leaves``: candidate rows of all leaves. ``splits[level]``: the cells cut at that level. ``crowded``: leaves with more
    candidates than a list may have, with their numbers of candidates and places."""

    cell: float
    leaves: DataFrame
    bytes: int
    splits: list[DataFrame] = field(default_factory=list)
    crowded: DataFrame | None = None


def _index(value: Column, cell: float | Column) -> Column:
    return F.floor(value / (F.lit(cell) if isinstance(cell, float) else cell))


def _width(cell: float, level: Column) -> Column:
    """Halving is exact, so a child's index is twice its parent's, or one more, for every value."""
    return F.lit(cell) / F.pow(F.lit(2.0), level.cast("double"))


def _boxed(polygons: DataFrame) -> DataFrame:
    def extreme(pick, low: bool, a: str, b: str) -> Column:
        ends = F.transform("edges", lambda e: (F.least if low else F.greatest)(e[a], e[b]))
        return pick(ends)

    return polygons.filter(F.size("edges") > 0).withColumns({
        "xmin": extreme(F.array_min, True, "x1", "x2"), "xmax": extreme(F.array_max, False, "x1", "x2"),
        "ymin": extreme(F.array_min, True, "y1", "y2"), "ymax": extreme(F.array_max, False, "y1", "y2"),
    })


def _spread(low: Column, high: Column, width: Column) -> Column:
    """Cells between two values, as a double: far too many cells must not overflow."""
    return F.floor(high / width).cast("double") - F.floor(low / width) + 1


def plan_grid(polygons: DataFrame, cell: float = 0.01, max_rows: int = 2_000_000) -> Grid:
    """The first of the widths ``cell``, 2·``cell``, 4·``cell``… that makes at most ``max_rows`` rows.

    The width never changes a result. All widths are counted arithmetically in one
    small aggregate over the polygons; nothing is exploded.
    """
    boxes = _boxed(polygons).select("xmin", "xmax", "ymin", "ymax", F.explode(F.sequence(F.lit(0), F.lit(_WIDTHS - 1))).alias("k"))
    width = F.lit(cell) * F.pow(F.lit(2.0), F.col("k").cast("double"))
    pairs = _spread(F.col("xmin"), F.col("xmax"), width) * _spread(F.col("ymin"), F.col("ymax"), width)
    found = boxes.groupBy("k").agg(F.count(F.lit(1)).alias("polygons"), F.sum(pairs).alias("rows")).orderBy("k").collect()
    # Four cells per polygon are as coarse as is useful.
    fit = next((r for r in found if r["rows"] <= max(max_rows, 4 * r["polygons"])), found[-1] if found else None)
    return Grid(cell * 2 ** fit["k"], int(fit["rows"])) if fit else Grid(cell, 0)


def _mirrored(e: Column) -> Column:
    return F.struct((-e.x1).alias("x1"), e.y1.alias("y1"), (-e.x2).alias("x2"), e.y2.alias("y2"))


def _left(e: Column) -> Column:
    return F.least(e.x1, e.x2)


def _right(e: Column) -> Column:
    return F.greatest(e.x1, e.x2)


def _facing(kept: str) -> Column:
    """The edges as the test wants them: mirrored where they are those to the left."""
    return upward(F.when(F.col("flip"), F.transform(kept, _mirrored)).otherwise(F.col(kept)))


def _classified(rows: DataFrame, cell: float) -> DataFrame:
    """Candidates that matter to their cell: an edge touches it, or it is all inside and then needs no edges."""
    gx, gy = F.col("gx"), F.col("gy")
    touched = F.exists("kept", lambda e: (_index(_left(e), cell) <= gx) & (_index(_right(e), cell) >= gx))
    x = F.when(F.col("flip"), -(gx + 0.5)).otherwise(gx + 0.5) * F.lit(cell)
    judged = rows.withColumn("touched", touched & ~F.col("whole")).withColumn(
        "whole", F.col("whole") | (~F.col("touched") & strictly_inside(x, (gy + 0.5) * F.lit(cell), _facing("kept"))))
    none = F.slice("kept", 1, 0)
    return judged.filter(F.col("touched") | F.col("whole")).withColumn(
        "kept", F.when(F.col("whole"), none).otherwise(F.col("kept"))).drop("touched")


def grid_rows(polygons: DataFrame, attributes: list[str], cell: float) -> DataFrame:
    """One row per cell and candidate: (level, gx, gy, poly_id, attributes, whole, flip, kept).

    A candidate carries only edges that can matter to a point of the cell: those
    in its band of rows and not wholly to its left, or else those not
    wholly to its right, whichever are fewer. If no edge touches the cell, it is
    all inside or all outside: the former needs no edges, the latter goes.
    All comparisons are between floor(value / cell) numbers, which never
    decrease with the value, so rounding cannot lose an edge.
    """
    at = lambda v: _index(v, cell)
    gx, gy = F.col("gx"), F.col("gy")

    def in_band(e: Column) -> Column:
        return gy.between(at(F.least(e.y1, e.y2)), at(F.greatest(e.y1, e.y2)))

    packed = F.struct(*[quoted(a) for a in attributes]) if attributes else F.lit(None).cast("int")
    laid_out = (
        _boxed(polygons).withColumn("attributes", packed)
        .withColumn("gy", F.explode(F.sequence(at(F.col("ymin")), at(F.col("ymax")))))
        .withColumn("band", F.filter("edges", in_band))
        .withColumn("gx", F.explode(F.sequence(at(F.col("xmin")), at(F.col("xmax")))))
        .withColumn("right", F.filter("band", lambda e: at(_right(e)) >= gx))
        .withColumn("left", F.filter("band", lambda e: at(_left(e)) <= gx))
    )
    flip = F.size("left") < F.size("right")
    sided = laid_out.select(
        F.lit(0).alias("level"), "gx", "gy", "poly_id", "attributes", F.lit(False).alias("whole"), flip.alias("flip"),
        F.when(flip, F.col("left")).otherwise(F.col("right")).alias("kept"),
    )
    return _classified(sided, cell)


def _quartered(rows: DataFrame, cell: float) -> DataFrame:
    """The candidates of cells in their four children of width ``cell``, each with the edges that still matter."""
    at = lambda v: _index(v, cell)
    gx, gy = F.col("gx"), F.col("gy")

    def matters(e: Column) -> Column:
        band = gy.between(at(F.least(e.y1, e.y2)), at(F.greatest(e.y1, e.y2)))
        return band & F.when(F.col("flip"), at(_left(e)) <= gx).otherwise(at(_right(e)) >= gx)

    half = F.explode(F.array(F.lit(0), F.lit(1)))
    children = rows.withColumn("dx", half).withColumn("dy", half).withColumns({
        "level": F.col("level") + 1, "gx": gx * 2 + F.col("dx"), "gy": gy * 2 + F.col("dy")}).drop("dx", "dy")
    return _classified(children.withColumn("kept", F.filter("kept", matters)), cell)


def _counted(rows: DataFrame) -> DataFrame:
    """Per cell its candidates, their size, and the first polygon that it lies wholly in."""
    text = F.coalesce(F.octet_length(F.to_json(F.struct("attributes"))), F.lit(0))
    return rows.groupBy(*_CELL).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("whole"), F.col("poly_id"))).alias("least"),
        F.sum(F.size("kept") * _EDGE_BYTES + text + _CANDIDATE_BYTES).alias("bytes"),
    )


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pruned(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Without candidates behind a polygon that the whole cell lies in: one before them always holds."""
    first = cells.select(*_CELL, "least")
    return rows.join(first, _CELL).filter(F.col("least").isNull() | (F.col("poly_id") <= F.col("least"))).drop("least")


def _local(df: DataFrame) -> DataFrame:
    """A bounded table by way of the driver, so that it can be broadcast any number of times."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _places_of(cells: DataFrame, spots: DataFrame, level: int, width: float) -> dict[tuple[int, int], int]:
    """How many places lie in each of the cells; none without any."""
    here = spots.select(F.lit(level).alias("level"), _index(F.col("px"), width).alias("gx"), _index(F.col("py"), width).alias("gy"))
    found = here.join(F.broadcast(cells), _CELL).groupBy("gx", "gy").agg(F.count(F.lit(1)).alias("places"))
    return {(r["gx"], r["gy"]): r["places"] for r in found.collect()}


def grow_tree(
    polygons: DataFrame, attributes: list[str], places: DataFrame, cell: float = 0.01, crowd: int = 64, max_rows: int = 2_000_000,
) -> Tree:
    """Lay the polygons out, and cut cells with more than ``crowd`` candidates; ``places`` has the points' px and py.

    Candidates and places of such cells are counted, and a cell is cut where both together make much work. A cut is not made
    if the children would have over twice the candidates: then the polygons lie on one another. Crowded cells without any place go.
    Tables of cells that come to the driver have at most ``4 · max_rows / crowd`` rows, as each crowded cell stands for more
    than ``crowd`` candidates. Without a crowded cell nothing is stored and the points are not looked at.
    """
    grid = plan_grid(polygons, cell, max_rows)
    rows = grid_rows(polygons, attributes, grid.cell)
    cells = _counted(rows)
    seen = cells.agg(F.max("n").alias("most"), F.sum("bytes").alias("bytes")).first()
    if (seen["most"] or 0) <= crowd:
        return Tree(grid.cell, rows, seen["bytes"] or 0)

    spark = polygons.sparkSession

    def table(level: int, found) -> DataFrame:
        return spark.createDataFrame([(level, gx, gy) for gx, gy in found], "level int, gx bigint, gy bigint")

    def sizes(candidates: DataFrame) -> dict[tuple[int, int], int]:
        return {(r["gx"], r["gy"]): r["n"] for r in candidates.groupBy("gx", "gy").agg(F.count(F.lit(1)).alias("n")).collect()}

    many = F.broadcast(_local(cells.filter(F.col("n") > crowd).select(*_CELL, "least")))
    leaves = [rows.join(many.select(*_CELL), _CELL, "left_anti")]
    rows = _stored(_pruned(rows, many), "cells")
    here = places.withColumns({"level": F.lit(0), "gx": _index(F.col("px"), grid.cell), "gy": _index(F.col("py"), grid.cell)})
    # Every place once, whatever the number of points on it.
    spots = _stored(here.join(many.select(*_CELL), _CELL).select("px", "py").distinct(), "places")
    counts, splits, crowded = sizes(rows), [], []
    for level in range(_DEPTH + 1):
        width = grid.cell / 2**level
        big = {c: n for c, n in counts.items() if n > crowd}
        full = _places_of(table(level, big), spots, level, width) if big else {}
        worth = {c for c, m in full.items() if level < _DEPTH and big[c] * m > _SPLIT_WORK}
        cut = set()
        if worth:
            children = _stored(_quartered(rows.join(F.broadcast(table(level, worth)), _CELL), width / 2), "cells")
            kept = _pruned(children, _counted(children))
            below, after = sizes(kept), dict.fromkeys(worth, 0)
            for (gx, gy), n in below.items():
                after[gx // 2, gy // 2] += n
            cut = {c for c in worth if after[c] <= 2 * big[c]}
        gone = cut | (big.keys() - full.keys())
        leaves.append(rows.join(F.broadcast(table(level, gone)), _CELL, "left_anti") if gone else rows)
        crowded += [(level, *c, big[c], m) for c, m in full.items() if c not in cut]
        if not cut:
            break
        splits.append(table(level, cut))
        counts = {(gx, gy): n for (gx, gy), n in below.items() if (gx // 2, gy // 2) in cut}
        rows = kept.join(F.broadcast(table(level + 1, counts)), _CELL)

    whole = leaves[0]
    for part in leaves[1:]:
        whole = whole.unionByName(part)
    whole = _stored(whole, "leaves")
    size = _counted(whole).agg(F.sum("bytes")).first()[0]
    named = spark.createDataFrame(crowded, "level int, gx bigint, gy bigint, n bigint, places bigint")
    return Tree(grid.cell, whole, size or 0, splits, named if crowded else None)


def _listed(leaves: DataFrame) -> DataFrame:
    """One row per cell with its candidates, lowest ``poly_id`` first."""
    candidate = F.struct("poly_id", "whole", "flip", F.when(~F.col("whole"), _facing("kept")).alias("edges"), "attributes")
    # Distinct poly_ids: sorting the structs sorts by poly_id and looks no further.
    return leaves.groupBy(*_CELL).agg(F.sort_array(F.collect_list(candidate)).alias("candidates"))


def hot_cells(located: DataFrame, keys: list[str], salt_rows: int) -> DataFrame:
    """(keys, n): cells of more than ``salt_rows`` points, and into how many parts each is dealt.

    There are at most ``_HOT_CELLS`` of them: the more points, the more a part may have.
    """
    counts = located.groupBy(*keys).agg(F.count(F.lit(1)).alias("points")).filter(F.col("points") > salt_rows)
    total = counts.agg(F.sum("points")).first()[0] or 0
    sized = counts.withColumn("n", F.ceil(F.col("points") / float(max(salt_rows, total / _HOT_CELLS))).cast("int"))
    return _local(sized.filter("n > 1").select(*keys, "n"))


def assign_polygons(
    points: DataFrame,
    polygons: DataFrame,
    attributes: list[str],
    longitude: str = "longitude",
    latitude: str = "latitude",
    cell: float = 0.01,
    broadcast_bytes: int = 128 << 20,
    salt_rows: int = 200_000,
    crowd: int = 64,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Every point with ``poly_id`` and attributes of the first polygon it is strictly within, else nulls.

    ``polygons`` has ``poly_id``, ``edges`` and the attributes. New columns are called as in ``names``, by default as they are; one that
    the points have already gets underscores behind. The candidates' size is counted first; within ``broadcast_bytes`` the
    points are not shuffled at all. Beyond it both sides are shuffled on the cell, and a cell of more than ``salt_rows`` points
    is dealt to as many tasks as its count asks for. No list has more than ``crowd`` candidates: places
    in cells that keep more meet them row by row, and the least ``poly_id`` is an aggregate.
    """
    x, y = (without_nan(quoted(c).cast("double")) for c in (longitude, latitude))
    # Names of our own that no column of the points has.
    own = "_"
    while any(c.lower().startswith(own) for c in points.columns):
        own += "_"
    px, py, near, found, salt, flag = (own + n for n in ("px", "py", "candidates", "hit", "salt", "crowded"))
    keys = [own + c for c in _CELL]
    outputs = {}
    for column in ["poly_id", *attributes]:
        outputs[column] = free_name([*points.columns, *outputs.values()], (names or {}).get(column, column))

    located = points.withColumns({px: x, py: y})
    tree = grow_tree(polygons, attributes, located.select(F.col(px).alias("px"), F.col(py).alias("py")), cell, crowd)
    located = _with_leaf(located, tree, px, py, keys, own)

    def holds(c: Column) -> Column:
        return c.whole | F.when(c.flip, strictly_inside(-F.col(px), F.col(py), c.edges)).otherwise(strictly_inside(F.col(px), F.col(py), c.edges))

    leaves, parts = tree.leaves, []
    if tree.crowded is not None:
        full = tree.crowded.withColumnsRenamed(dict(zip(_CELL, keys)))
        marked = located.join(F.broadcast(full.select(*keys, F.lit(True).alias(flag))), keys, "left")
        inside = marked.filter(F.col(flag)).drop(flag)
        parts.append(_by_rows(inside, tree, full, polygons, attributes, px, py, keys, outputs, points.columns, holds))
        located = marked.filter(F.col(flag).isNull()).drop(flag)
        leaves = leaves.join(F.broadcast(tree.crowded.select(*_CELL)), _CELL, "left_anti")
    lists = _listed(leaves).withColumnsRenamed({**dict(zip(_CELL, keys)), "candidates": near})
    on = list(keys)
    if tree.bytes <= broadcast_bytes:
        lists = F.broadcast(lists)
    else:
        hot = hot_cells(located, keys, salt_rows)
        spread = F.xxhash64(F.monotonically_increasing_id())  # equal rows are dealt too
        located = located.join(F.broadcast(hot), keys, "left").withColumn(
            salt, F.pmod(spread, F.coalesce("n", F.lit(1))).cast("int")).drop("n")
        lists = lists.join(F.broadcast(hot), keys, "left").withColumn(
            salt, F.explode(F.sequence(F.lit(0), F.coalesce("n", F.lit(1)) - 1))).drop("n").hint("merge")
        on.append(salt)
    hit = located.join(lists, on, "left").withColumn(found, F.get(F.filter(near, holds), F.lit(0)))
    parts.append(hit.select(
        *[quoted(c) for c in points.columns],
        F.col(found)["poly_id"].alias(outputs["poly_id"]),
        *[F.col(found)["attributes"].getField(a).alias(outputs[a]) for a in attributes],
    ))
    return parts[0] if len(parts) == 1 else parts[1].unionByName(parts[0])


def _with_leaf(located: DataFrame, tree: Tree, px: str, py: str, keys: list[str], own: str) -> DataFrame:
    """The leaf of each point: as deep as the cells it lies in are cut. The broadcast tables of cut cells are bounded with the tree."""
    level = F.lit(0)
    for depth, split in enumerate(tree.splits):
        width, mark = tree.cell / 2**depth, f"{own}cut{depth}"
        at = {f"{own}gx{depth}": _index(F.col(px), width), f"{own}gy{depth}": _index(F.col(py), width)}
        cells = split.select(F.col("gx").alias(f"{own}gx{depth}"), F.col("gy").alias(f"{own}gy{depth}"), F.lit(1).alias(mark))
        located = located.withColumns(at).join(F.broadcast(cells), list(at), "left").drop(*at)
        level = level + F.coalesce(mark, F.lit(0))
    marks = [f"{own}cut{d}" for d in range(len(tree.splits))]
    # A cell cut at some depth lies in cells cut before, so the marks of a point are those of its path.
    located = located.withColumn(keys[0], level.cast("int")).drop(*marks)
    width = _width(tree.cell, F.col(keys[0])) if tree.splits else tree.cell
    return located.withColumns({keys[1]: _index(F.col(px), width), keys[2]: _index(F.col(py), width)})


def _by_rows(
    inside: DataFrame, tree: Tree, full: DataFrame, polygons: DataFrame, attributes: list[str], px: str, py: str,
    keys: list[str], outputs: dict[str, str], columns: list[str], holds,
) -> DataFrame:
    """Points of crowded cells: each different place meets the cell's candidates, dealt in blocks, and the least that holds it counts.

    ``full`` has a row per crowded cell, which bounds its broadcast.
    """
    own = keys[0].removesuffix("level")
    rows, shares, block, part, c = (own + n for n in ("rows", "shares", "block", "part", "c"))
    sizes = F.broadcast(full.select(
        *keys, F.ceil(F.col("n") / _PAIR_BLOCK).cast("int").alias(rows), F.ceil(F.col("places") / _PAIR_BLOCK).cast("int").alias(shares)))
    dealt = (
        tree.leaves.withColumnsRenamed(dict(zip(_CELL, keys))).join(sizes, keys)
        .withColumn(block, F.pmod(F.xxhash64("poly_id"), rows).cast("int"))
        .withColumn(part, F.explode(F.sequence(F.lit(0), F.col(shares) - 1)))
        .select(*keys, block, part, F.struct("poly_id", "whole", "flip", _facing("kept").alias("edges")).alias(c))
    )
    places = (
        inside.select(*keys, px, py).distinct().join(sizes, keys)
        .withColumn(part, F.pmod(F.xxhash64(px, py), shares).cast("int"))
        .withColumn(block, F.explode(F.sequence(F.lit(0), F.col(rows) - 1)))
    )
    first = places.join(dealt, [*keys, block, part]).filter(holds(F.col(c))).groupBy(px, py).agg(F.min(f"{c}.poly_id").alias("poly_id"))
    named = first.join(polygons.select("poly_id", *[quoted(a) for a in attributes]), "poly_id").select(
        px, py, *[quoted(a).alias(f"{own}out{i}") for i, a in enumerate(["poly_id", *attributes])])
    return inside.join(named, [px, py], "left").select(
        *[quoted(name) for name in columns],
        *[F.col(f"{own}out{i}").alias(outputs[a]) for i, a in enumerate(["poly_id", *attributes])])


def verify_addresses(points: DataFrame, polygons: DataFrame, **grid) -> DataFrame:
    """Tickets whose coordinates lie in the district and subdistrict they name; helper columns dropped."""
    attributes = ["DISTRICT_N", "SUBDISTR_1"]
    names = {}
    for column in ["poly_id", *attributes]:
        names[column] = free_name([*points.columns, *names.values()], column)
    joined = assign_polygons(points, polygons, attributes, names=names, **grid)
    agreeing = keep_agreeing(joined, [(names["DISTRICT_N"], "district"), (names["SUBDISTR_1"], "subdistrict")])
    return drop_columns(agreeing, list(names.values()))
