"""Radius joins: pairs and counts of points within a great-circle distance."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderfield.contract import EARTH_RADIUS_M
from cinderfield.functions.geo import RadiusBins, checked_coordinate, haversine_m
from cinderfield.operators import circles
from cinderfield.scratch import settle

# A bin whose two sides make more pairs than this many rows squared is cut into
# slices of about this many rows of each side.
ROWS_PER_SLICE = 4_000


def _unit_vector(lat: str, lon: str, prefix: str) -> list[Column]:
    return [
        F.expr(f"cos(radians({lat})) * cos(radians({lon}))").alias(f"{prefix}x"),
        F.expr(f"cos(radians({lat})) * sin(radians({lon}))").alias(f"{prefix}y"),
        F.expr(f"sin(radians({lat}))").alias(f"{prefix}z"),
    ]


def _within(radius_m: float, distance: Column) -> Column:
    """Haversine distance <= radius, inclusive.

    The squared chord between unit vectors decides all but a sliver around the
    circle with three multiplications; only there is the distance itself taken.
    """
    chord2 = F.expr(" + ".join(f"(_l{a} - _r{a}) * (_l{a} - _r{a})" for a in "xyz"))
    half = min(radius_m / (2.0 * EARTH_RADIUS_M), math.pi / 2.0)
    limit = 4.0 * math.sin(half) ** 2
    clear, beyond = limit * (1 - 1e-6) - 1e-15, limit * (1 + 1e-6) + 1e-15
    return (chord2 <= clear) | ((chord2 <= beyond) & (distance <= radius_m))


def _heavy_bins(left: DataFrame, right: DataFrame, rows_per_slice: int) -> DataFrame:
    """Bins whose two sides make too many pairs for one task, and the slices their left and right rows are cut into.

    A table, mostly empty or small, and written so that its size is known: where
    it is small, no row moves to learn its bin's slices. No slice makes more than
    about ``rows_per_slice`` squared pairs, however the rows are split between the sides.
    """
    nl = left.groupBy("_bin").agg(F.count(F.lit(1)).alias("_nl"))
    nr = right.groupBy("_bin").agg(F.count(F.lit(1)).alias("_nr"))
    most = float(rows_per_slice)
    heavy = nl.join(nr, "_bin").filter(F.col("_nl").cast("double") * F.col("_nr") > most * most)
    cuts = [F.ceil(F.col(f"_n{side}") / most).cast("int").alias(f"_cut_{side}") for side in "lr"]
    return settle(heavy.select("_bin", *cuts), "heavy")


def _sliced(df: DataFrame, heavy: DataFrame, own: str, other: str) -> DataFrame:
    """Give each row one slice on its own side and a copy per slice of the other."""
    payload = [c for c in df.columns if c != "_bin"]
    mine, theirs = (F.coalesce(F.col(f"_cut_{side}"), F.lit(1)) for side in (own, other))
    return (
        df.join(heavy, "_bin", "left")
        .withColumn(f"_slice_{own}", F.pmod(F.xxhash64(*payload), mine).cast("int"))
        .withColumn(f"_slice_{other}", F.explode(F.sequence(F.lit(0), theirs - 1)))
        .drop("_cut_l", "_cut_r")
    )


def _bin_join(left: DataFrame, right: DataFrame, left_cols: tuple[str, str], right_cols: tuple[str, str], condition: Column, rows_per_slice: int) -> DataFrame:
    """Join on ``_bin`` and ``condition``, which may use the unit vectors ``_l`` and ``_r``; heavy bins are cut on both sides.

    Each pair of rows meets in exactly one slice. Slices are dealt over the
    session's shuffle partitions, at least its parallelism: AQE would merge small
    ones, however many pairs they make. Other column names differ.
    """
    spark = left.sparkSession
    keys = ["_bin", "_slice_l", "_slice_r"]
    heavy = _heavy_bins(left, right, rows_per_slice)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # Unit vectors are taken after the rows have moved.
    own, theirs = [c for c in left.columns if c != "_bin"], [c for c in right.columns if c != "_bin"]
    left = _sliced(left, heavy, "l", "r").repartition(tasks, *keys).select("*", *_unit_vector(*left_cols, "_l"))
    right = _sliced(right, heavy, "r", "l").repartition(tasks, *keys).select("*", *_unit_vector(*right_cols, "_r"))
    a, b = left.alias("a"), right.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    return a.join(b, [*same, condition], "inner").select(*[F.col(f"a.{c}") for c in own], *[F.col(f"b.{c}") for c in theirs])


def _checked(df: DataFrame, columns: tuple[str, str], what: str) -> DataFrame:
    return df.withColumns({c: checked_coordinate(c, what) for c in columns})


def joined_sides(
    centres: DataFrame, points: DataFrame, radius_m: float, centre_cols: tuple[str, str], point_cols: tuple[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Both tables with a bin key: rows of the larger one once, those of the smaller one once for each bin their circle touches."""
    bins = RadiusBins(radius_m)
    left, right = _checked(centres, centre_cols, "centre table"), _checked(points, point_cols, "point table")
    if centres.count() < points.count():
        return bins.with_reach(left, *centre_cols, "_bin"), right.select("*", bins.home(*point_cols).alias("_bin"))
    return left.select("*", bins.home(*centre_cols).alias("_bin")), bins.with_reach(right, *point_cols, "_bin")


def radius_pairs(
    centres: DataFrame,
    points: DataFrame,
    radius_m: float,
    centre_cols: tuple[str, str] = ("lat", "lon"),
    point_cols: tuple[str, str] = ("latitude", "longitude"),
    rows_per_slice: int = ROWS_PER_SLICE,
    with_distance: bool = False,
) -> DataFrame:
    """Every (centre, point) pair at most ``radius_m`` apart, once.

    Both sides get a bin key and meet in an equi-join (``joined_sides``): of the
    smaller table, each row is copied to the bins its circle touches. Bins that are too heavy are cut on both sides,
    so no task meets more than about ``rows_per_slice`` rows of each. Column
    names of the two sides must differ.
    """
    (clat, clon), (plat, plon) = centre_cols, point_cols
    left, right = joined_sides(centres, points, radius_m, centre_cols, point_cols)
    distance = haversine_m(clat, clon, plat, plon)
    pairs = _bin_join(left, right, centre_cols, point_cols, _within(radius_m, distance), rows_per_slice)
    out = [*centres.columns, *points.columns]
    return pairs.select(*out, distance.alias("distance_m")) if with_distance else pairs.select(*out)


# The coarsest blocks are half a radius high; a block of more rows than SPLIT_ROWS
# has four children, down to DEPTH levels below.
BLOCKS_PER_RADIUS = 2
DEPTH = 4
SPLIT_ROWS = 256
_SIDE = 1 << DEPTH


def _node(level: str) -> Column:
    """Number of the block of this level that holds the row; levels never share numbers."""
    return F.expr(
        f"((_base * {DEPTH + 1} + {level}) * {_SIDE} + shiftright(_row, {DEPTH} - {level})) * {_SIDE} + shiftright(_col, {DEPTH} - {level})"
    )


def _blocks(rows: DataFrame, bins: RadiusBins, point_cols: tuple[str, str]) -> DataFrame:
    """Per block of each row's ``_level``: its middle, its rows, and how far they reach from the middle."""
    mid = bins.part_centre("_base", f"shiftright(_row, {DEPTH} - _level)", f"shiftright(_col, {DEPTH} - _level)", "shiftleft(1, _level)")
    middles = rows.select(*rows.columns, mid[0].alias("_mlat"), mid[1].alias("_mlon"))
    return middles.groupBy("_node", "_level", "_mlat", "_mlon").agg(
        F.count(F.lit(1)).alias("_rows"), F.max(haversine_m("_mlat", "_mlon", *point_cols)).alias("_extent")
    )


@dataclass(frozen=True)
class Cover:
    """``asked``: place columns and ``_bin``; ``offered``: what each bin holds. A bin's last digit tells whole blocks from cut ones."""

    asked: DataFrame
    offered: DataFrame


def block_cover(
    places: DataFrame,
    points: DataFrame,
    radius_m: float,
    place_cols: tuple[str, str],
    point_cols: tuple[str, str] = ("latitude", "longitude"),
    rows_per_slice: int = ROWS_PER_SLICE,
    split_rows: int = SPLIT_ROWS,
) -> Cover:
    """The blocks that stand for each place's circle: the coarsest that lie wholly inside, and those its rim cuts.

    Blocks form a quadtree. A place meets the coarsest blocks near it in one radius
    join; of those that its rim cuts it goes on to the children, where there are
    any, and so looks at fine blocks along the rim only. Blocks of few rows are not
    divided, so thin areas have no levels below and no join for them.
    """
    plat, plon = point_cols
    bins = RadiusBins(radius_m / BLOCKS_PER_RADIUS)
    base, row, col = bins.nested(plat, plon, DEPTH)
    placed = _checked(points.select(plat, plon, "_t", "_n", "_at"), point_cols, "point table")
    placed = placed.select("*", base.alias("_base"), row.alias("_row"), col.alias("_col"))
    coarse = placed.withColumn("_level", F.lit(0)).withColumn("_node", _node("_level"))
    blocks = settle(_blocks(coarse, bins, point_cols), "blocks")
    crowded = blocks.filter(F.col("_rows") > split_rows).select("_node")
    reach, deep = blocks.agg(F.max("_extent"), F.max("_rows") > split_rows).first()

    margin = radius_m * 1e-9 + 1e-6
    near = radius_pairs(
        places, blocks.drop("_level"), radius_m + (reach or 0.0) + 1.0, place_cols, ("_mlat", "_mlon"), rows_per_slice, with_distance=True
    )
    inside = F.col("distance_m") + F.col("_extent") <= radius_m - margin
    outside = F.col("distance_m") - F.col("_extent") > radius_m + margin

    def judged(pairs: DataFrame, last: bool) -> DataFrame:
        leaf = F.lit(True) if last else F.col("_rows") <= split_rows
        state = F.when(inside, 0).when(leaf, 1).otherwise(2)
        return pairs.filter(inside | ~outside).select(*place_cols, "_node", state.alias("_state"))

    def bins_of(pairs: DataFrame) -> DataFrame:
        return pairs.filter(F.col("_state") < 2).select(*place_cols, (F.col("_node") * 2 + F.col("_state")).alias("_bin"))

    first = judged(near, last=False)
    rest = placed
    if deep:
        first = settle(first, "cover")
        inner = coarse.join(crowded, "_node", "left_semi").drop("_level", "_node")
        levels = inner.select("*", F.explode(F.sequence(F.lit(1), F.lit(DEPTH))).alias("_level")).withColumn("_node", _node("_level"))
        levels = levels.withColumn("_parent", _node("(_level - 1)"))
        fine = _blocks(levels, bins, point_cols)
        parents = levels.select("_node", "_parent").distinct()
        tree = settle(fine.join(parents, "_node"), "tree")
        asked, cut = bins_of(first), first.filter(F.col("_state") == 2)
        for level in range(1, DEPTH + 1):
            children = tree.filter(F.col("_level") == level).select(
                F.col("_parent").alias("_up"), F.col("_node").alias("_child"), "_mlat", "_mlon", "_rows", "_extent"
            )
            pairs = cut.join(children, F.col("_node") == F.col("_up")).drop("_node").withColumnRenamed("_child", "_node")
            pairs = judged(pairs.withColumn("distance_m", haversine_m(*place_cols, "_mlat", "_mlon")), last=level == DEPTH)
            pairs = settle(pairs, "cover")
            asked, cut = asked.unionByName(bins_of(pairs)), pairs.filter(F.col("_state") == 2)
        # A row of a crowded block stands in the one leaf that has no children, and in every block above it.
        held = tree.select("_node", (F.col("_level") == DEPTH).alias("_last"), "_rows")
        open_ = tree.filter(F.col("_rows") > split_rows).select("_node").unionByName(crowded)
        held = held.join(tree.select("_node", "_parent"), "_node").join(open_.withColumnRenamed("_node", "_parent"), "_parent", "left_semi")
        stands = levels.join(held.drop("_parent"), "_node")
        leaf = F.col("_last") | (F.col("_rows") <= split_rows)
        offered = _offered(stands.filter(leaf), stands, plat, plon)
        sums = coarse.join(crowded, "_node", "left_semi")
        offered = offered.unionByName(_sums(sums, plat, plon))
        rest = coarse.join(crowded, "_node", "left_anti")
        offered = offered.unionByName(_offered(rest, rest, plat, plon))
    else:
        asked, offered = bins_of(first), _offered(coarse, coarse, plat, plon)
    return Cover(settle(asked, "asked"), settle(offered, "offered"))


def _sums(rows: DataFrame, plat: str, plon: str) -> DataFrame:
    nowhere = F.lit(0.0)
    whole = rows.groupBy("_node", "_t").agg(F.sum("_n").alias("_n"), F.max("_at").alias("_at"))
    return whole.select((F.col("_node") * 2).alias("_bin"), nowhere.alias(plat), nowhere.alias(plon), "_t", "_n", "_at")


def _offered(leaves: DataFrame, held: DataFrame, plat: str, plon: str) -> DataFrame:
    """Sums per block and ``_t`` for whole blocks, single rows for cut ones."""
    single = leaves.select((F.col("_node") * 2 + 1).alias("_bin"), plat, plon, "_t", "_n", "_at")
    return _sums(held, plat, plon).unionByName(single)


# Places and points meet in tiles this many radii high; a tile of more places or
# points than so many times ``rows_per_slice`` is cut into slices of both. A point goes
# to (1 + 2 / RADII_PER_TILE)^2 tiles, and once more to each slice of places.
RADII_PER_TILE = 6
PLACES, POINTS = 16, 64


def _tile_slices(places: DataFrame, points: DataFrame, rows_per_slice: int) -> DataFrame:
    """Tiles that hold too much for one group, and the slices their places and points are cut into."""
    counts = [side.groupBy("_bin").agg(F.count(F.lit(1)).alias(name)) for side, name in ((places, "_nl"), (points, "_nr"))]
    cuts = [F.ceil(F.col(n) / (float(rows_per_slice) * most)).cast("int").alias(cut) for n, most, cut in (("_nl", PLACES, "_cut_l"), ("_nr", POINTS, "_cut_r"))]
    cut = counts[0].join(counts[1], "_bin").select("_bin", *cuts)
    return settle(cut.filter("_cut_l > 1 or _cut_r > 1"), "heavy")


def _in_tiles(
    places: DataFrame,
    points: DataFrame,
    radius_m: float,
    place_cols: tuple[str, str],
    point_cols: tuple[str, str],
    rows_per_slice: int,
    fold: Callable,
    columns: str,
) -> DataFrame:
    """What ``fold`` gives for each group of places and points that meet in a tile.

    ``points`` carries ``_n, _at`` and, where ``fold`` needs it, ``_t``. Places go to the tile they lie in, points to the
    tiles within one radius. Tiles that hold more than about ``PLACES`` and ``POINTS`` times
    ``rows_per_slice`` rows are cut into slices, so a group is bounded and a place may
    meet its points in several groups.
    """
    spark = places.sparkSession
    plat, plon = point_cols
    tiles = RadiusBins(radius_m * RADII_PER_TILE)
    asked = _checked(places.select(*place_cols), place_cols, "centre table")
    asked = asked.select(*[F.col(c).alias(own) for c, own in zip(place_cols, ("_plat", "_plon"), strict=True)], tiles.home(*place_cols).alias("_bin"))
    carried = [c for c in ("_t", "_n") if c in points.columns]
    placed = _checked(points.select(plat, plon, *carried, "_at"), point_cols, "point table")
    offered = tiles.with_reach(placed, plat, plon, "_bin", radius_m)
    offered = offered.select(F.col(plat).alias("_plat"), F.col(plon).alias("_plon"), "_bin", *carried, F.coalesce("_at", F.lit(circles.NEVER)).alias("_ever"))
    slices = _tile_slices(asked, offered, rows_per_slice)
    both = _sliced(offered, slices, "r", "l").unionByName(_sliced(asked, slices, "l", "r"), allowMissingColumns=True)
    # Dealt over as many tasks as there are: AQE would merge small ones, whatever their work.
    keys = ["_bin", "_slice_l", "_slice_r"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return both.repartition(tasks, *keys).groupBy(*keys).applyInArrow(fold, columns)


def radius_fold(
    places: DataFrame,
    points: DataFrame,
    radius_m: float,
    place_cols: tuple[str, str],
    point_cols: tuple[str, str] = ("latitude", "longitude"),
    rows_per_slice: int = ROWS_PER_SLICE,
    split_rows: int = circles.LEAF,
    merged: bool = True,
) -> DataFrame:
    """Per place and ``_t``: ``_n`` summed and ``_at`` at its largest over the points within the radius.

    ``points`` carries ``_t, _n, _at``. No pair of a place and a point, or of a place
    and a block, is ever a row: each group of a tile (``_in_tiles``) walks a tree of blocks
    (``circles.BlockTree``) for all its places: sums of the largest blocks that lie wholly inside a circle,
    single points only of the smallest blocks that its rim cuts. Without ``merged`` a place
    may have a row for each slice of points.
    """
    found = _in_tiles(places, points, radius_m, place_cols, point_cols, rows_per_slice, circles.folded(radius_m, split_rows), circles.COLUMNS)
    found = found.select(F.col("_plat").alias(place_cols[0]), F.col("_plon").alias(place_cols[1]), "_t", "_n", "_at")
    return found.groupBy(*place_cols, "_t").agg(F.sum("_n").alias("_n"), F.max("_at").alias("_at")) if merged else found


def radius_windows(
    places: DataFrame,
    points: DataFrame,
    radius_m: float,
    ends: np.ndarray,
    place_cols: tuple[str, str],
    point_cols: tuple[str, str] = ("latitude", "longitude"),
    rows_per_slice: int = ROWS_PER_SLICE,
    split_rows: int = circles.LEAF,
) -> DataFrame:
    """``_ahead, _past, _last`` per place, each an array with an element per row of ``ends`` (``circles.windowed``).

    ``points`` carries ``_n`` and ``_at``, which says which windows hold a point, so no other time moves.

    A place is one row whatever the dates, and each group takes its windows from the sums
    it has at hand: what moves is a row per place and slice of points, none per time.
    Places without a point near give no row.
    """
    found = _in_tiles(places, points, radius_m, place_cols, point_cols, rows_per_slice, circles.windowed(radius_m, split_rows, ends), circles.WINDOWS)
    place = Window.partitionBy("_plat", "_plon")
    parts = F.collect_list(F.struct("_ahead", "_past", "_last")).over(place)  # as many as slices of the tile's points, mostly one

    def both(a: Column, b: Column) -> Column:
        return F.struct(
            F.zip_with(a["_ahead"], b["_ahead"], lambda x, y: x | y).alias("_ahead"),
            F.zip_with(a["_past"], b["_past"], lambda x, y: x + y).alias("_past"),
            F.zip_with(a["_last"], b["_last"], lambda x, y: F.greatest(x, y)).alias("_last"),
        )

    # A window and not an aggregation: its rows leave it sorted by place, as a join needs them.
    gathered = found.withColumns({"_parts": parts, "_nth": F.row_number().over(place.orderBy("_plat"))}).filter("_nth = 1")
    rest = F.slice("_parts", F.lit(2), F.greatest(F.size("_parts") - 1, F.lit(0)))
    names = [F.col(own).alias(c) for own, c in zip(("_plat", "_plon"), place_cols, strict=True)]
    return gathered.select(*names, F.aggregate(rest, F.element_at("_parts", 1), both).alias("_all")).select(*place_cols, "_all.*")


def radius_count(
    centres: DataFrame,
    points: DataFrame,
    radius_m: float,
    out: str = "n_points",
    centre_cols: tuple[str, str] = ("lat", "lon"),
    point_cols: tuple[str, str] = ("latitude", "longitude"),
    rows_per_slice: int = ROWS_PER_SLICE,
    split_rows: int = circles.LEAF,
) -> DataFrame:
    """``centres`` plus the number of points within the radius; no point gives 0.

    Equal points and equal centres are folded before the join, so copies of one
    location cost one row.
    """
    clat, clon = centre_cols
    plat, plon = point_cols
    none = F.lit(None).cast("long")
    folded = points.groupBy(plat, plon).agg(F.count(F.lit(1)).alias("_n"))
    folded = folded.withColumns({"_t": F.lit(0).cast("long"), "_at": none})
    places = centres.select(
        F.col(clat).cast("double").alias("_clat"), F.col(clon).cast("double").alias("_clon")
    ).distinct()
    counted = radius_fold(
        places, folded, radius_m, ("_clat", "_clon"), point_cols, rows_per_slice, split_rows
    ).select("_clat", "_clon", F.col("_n").alias(out))
    joined = centres.join(
        counted,
        (F.col(clat).cast("double") == F.col("_clat"))
        & (F.col(clon).cast("double") == F.col("_clon")),
        "left",
    )
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("long"))).drop(
        "_clat", "_clon"
    )
