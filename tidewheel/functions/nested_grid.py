"""Sums within radii and nearest points, for neighbourhoods of any density, on a nested grid.

Points are put into cells of a grid whose lines halve twice from level to level. A cell has its centre, the greatest
distance of its points from it, and the sums of its points. Compared with a place, a cell lies wholly inside a radius,
wholly outside, or on its edge, by the triangle inequality, which holds on the sphere at any latitude. Cells inside count by
their sums; only cells on the edge are taken apart, into their own cells and in the end into points. So a place meets some
cells on each level, not all points around it; cells are taken apart on
further levels for as long as too many points are left to be compared one by one, and points at one spot are one row, as are
places at one spot. Each step is an equi join with the cells' children.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.geo import EARTH_DIAMETER_M, haversine_m, near_spots, valid_point
from tidewheel.sources.io import at_rest

#: Pairs of places and points that are compared one by one rather than on another level; levels at most; how much finer each is.
DIRECT, LEVELS, FINER = 4_000_000, 6, 4
METRES_PER_DEGREE = EARTH_DIAMETER_M * 3.141592653589793 / 360
_EPS = 1e-9


def _cell(lat: Column, lon: Column, degrees: float) -> Column:
    """The cell of a level. Its shape does not matter: distances come from its own points."""
    return F.struct(F.floor((lat + 90) / degrees).alias("y"), F.floor((lon + 180) / degrees).alias("x"))


def _degrees(metres: float, level: int) -> float:
    return metres / 2 / METRES_PER_DEGREE / FINER**level


def _cells(spots: DataFrame, metres: float, level: int, sums: list[str], by: list[str]) -> DataFrame:
    """by, cell, parent, clat, clon, reach, spots, n and sums of the cells of a level; level 0 is the coarsest."""
    degrees = _degrees(metres, level)
    placed = spots.withColumns({"cell": _cell(F.col("plat"), F.col("plon"), degrees), "parent": _cell(F.col("plat"), F.col("plon"), degrees * FINER)})
    # A centre stays on the sphere; the reach is measured from where it is.
    placed = placed.withColumns({"clat": F.least((F.col("cell.y") + 0.5) * degrees - 90, F.lit(89.999999)), "clon": (F.col("cell.x") + 0.5) * degrees - 180})
    far = haversine_m("clat", "clon", "plat", "plon")
    return placed.groupBy(*by, "cell", "parent", "clat", "clon").agg(F.max(far).alias("reach"), F.count("*").alias("spots"), F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in sums))


def _goes_on(edge: DataFrame, level: int) -> bool:
    """Whether the cells on the edge hold more points than are worth comparing one by one."""
    return level + 1 < LEVELS and (edge.agg(F.sum("spots")).first()[0] or 0) > DIRECT


def _first_pairs(places: DataFrame, cells: DataFrame, metres: float) -> DataFrame:
    """Places with the coarsest cells that may reach into the radius."""
    most = 1.5 * _degrees(metres, 0) * METRES_PER_DEGREE  # a cell's diagonal, so no reach is greater
    return near_spots(places, cells, ("_lat", "_lon"), ("clat", "clon"), metres + most)


def _placed(places: DataFrame, key: str, at: tuple[str, str]) -> DataFrame:
    return places.filter(valid_point(*at)).select(F.col(key).alias("_key"), F.col(at[0]).cast("double").alias("_lat"), F.col(at[1]).cast("double").alias("_lon"))


def sums_within(places: DataFrame, key: str, at: tuple[str, str], points: DataFrame, points_at: tuple[str, str], radii: tuple[int, ...], sums: dict[str, Column]) -> DataFrame:
    """key, and for each name and radius <name>_<radius>m: the sum over the points within it; 0 where there is none.

    Keys without a point within the greatest radius are absent. sums: name -> a whole number made of a point's columns,
    null for none. Places and points that are not valid take no part. Keys are distinct.
    """
    names = list(sums)
    spots = points.filter(valid_point(*points_at)).groupBy(F.col(points_at[0]).cast("double").alias("plat"), F.col(points_at[1]).cast("double").alias("plon")).agg(F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(s) for s, c in sums.items()))
    spots = at_rest(spots)
    metres = float(max(radii))
    left = _placed(places, key, at)
    every = F.array(*map(F.lit, range(len(radii))))
    radius = lambda i: F.element_at(F.array(*(F.lit(float(r)) for r in radii)), i + 1)
    own, found = ["_lat", "_lon"], []
    inside = lambda i: F.col("_d") + F.col("reach") <= radius(i) * (1 - _EPS) - 1e-6
    outside = lambda i: F.col("_d") - F.col("reach") > radius(i) * (1 + _EPS) + 1e-6
    for level in range(LEVELS):
        cells = _cells(spots, metres, level, names, [])
        pairs = edge.join(cells, F.col("_cell") == F.col("parent")) if level else _first_pairs(left.select(*own).distinct(), cells, metres).withColumn("open", every)
        met = pairs.withColumn("_d", haversine_m("_lat", "_lon", "clat", "clon"))
        met = met.withColumns({"in": F.filter("open", inside), "edge": F.filter("open", lambda i: ~inside(i) & ~outside(i))})
        met = at_rest(met.filter((F.size("in") > 0) | (F.size("edge") > 0)).select(*own, "cell", "spots", "n", *names, "in", "edge"))
        found.append(met.filter(F.size("in") > 0).select(*own, F.col("in").alias("of"), "n", *names))
        edge = met.filter(F.size("edge") > 0).select(*own, F.col("cell").alias("_cell"), "spots", F.col("edge").alias("open"))
        goes_on = _goes_on(edge, level)
        edge = edge.drop("spots")
        if not goes_on:
            break
    last = edge.join(spots.withColumn("cell", _cell(F.col("plat"), F.col("plon"), _degrees(metres, level))), F.col("_cell") == F.col("cell")).withColumn("_d", haversine_m("_lat", "_lon", "plat", "plon"))
    found.append(last.withColumn("of", F.filter("open", lambda i: F.col("_d") <= radius(i))).filter(F.size("of") > 0).select(*own, "of", "n", *names))
    rows = reduce(DataFrame.unionByName, found).select(*own, F.explode("of").alias("i"), "n", *names)
    value = lambda s, i: F.coalesce(F.sum(F.when(F.col("i") == i, F.col(s))), F.lit(0)).alias(f"{s}_{radii[i]}m")
    per = rows.groupBy(*own).agg(*(value(s, i) for s in names for i in range(len(radii))))
    return left.join(per, own).groupBy(F.col("_key").alias(key)).agg(*(F.sum(c).alias(c) for c in per.columns if c not in own))


def nearest_within(places: DataFrame, key: str, at: tuple[str, str], points: DataFrame, points_at: tuple[str, str], metres: float, by: list[str], carry: list[str], other: str | None = None) -> DataFrame:
    """key, by, distance and the carried columns of the nearest point of each group of ``by`` within the radius; ties to the
    smallest carried columns, in order. other: a column of points that must differ from the key.

    On each level a cell stays only if it may hold a point nearer than one that another cell is sure to hold. Points at one
    spot are one row, or two of different ``other``; a place whose own is the nearest takes the nearest of another.
    """
    first = F.struct(F.lit(1).alias("n"), *carry)
    named = points.filter(valid_point(*points_at))
    named = named.filter(F.col(other).isNotNull()) if other else named
    spot = [*by, *(["_other"] if other else []), "plat", "plon"]
    spots = named.withColumns({"plat": F.col(points_at[0]).cast("double"), "plon": F.col(points_at[1]).cast("double")} | ({"_other": F.col(other)} if other else {})).groupBy(*spot).agg(F.min(first).alias("_c"))
    two = lambda df, of, order: df.withColumn("_r", F.row_number().over(Window.partitionBy(*of).orderBy(*order))).filter("_r <= 2")
    if other:
        spots = two(spots, [*by, "plat", "plon"], ["_c"]).drop("_r")
    spots = at_rest(spots.select(*spot, "_c.*"))
    left, own = _placed(places, key, at), ["_lat", "_lon"]
    # With other, as many of a cell's points may be the place's own.
    sure = 1 + ((spots.groupBy("_other").count().agg(F.max("count")).first()[0] or 0) if other else 0)
    low = F.col("_d") - F.col("reach")
    children = lambda df, of: edge.join(df, reduce(lambda a, b: a & b, (F.col(b).eqNullSafe(F.col(f"_{b}_of")) for b in by), F.col("_cell") == F.col(of)))
    for level in range(LEVELS):
        cells = _cells(spots, float(metres), level, [], by)
        pairs = children(cells, "parent") if level else _first_pairs(left.select(*own).distinct(), cells, metres)
        met = pairs.withColumn("_d", haversine_m("_lat", "_lon", "clat", "clon"))
        upper = F.min(F.when(F.col("n") >= sure, F.col("_d") + F.col("reach"))).over(Window.partitionBy(*own, *by))
        met = met.withColumn("_upper", upper).filter((low <= metres * (1 + _EPS) + 1e-6) & (F.col("_upper").isNull() | (low <= F.col("_upper") * (1 + _EPS) + 1e-6)))
        met = at_rest(met.select(*own, *(F.col(b).alias(f"_{b}_of") for b in by), F.col("cell").alias("_cell"), "spots"))
        edge = met.drop("spots")
        if not _goes_on(met, level):
            break
    pairs = children(spots.withColumn("cell", _cell(F.col("plat"), F.col("plon"), _degrees(float(metres), level))), "cell")
    near = pairs.withColumn("distance", haversine_m("_lat", "_lon", "plat", "plon")).filter(F.col("distance") <= metres)
    best = F.min(F.struct("distance", *carry)).alias("b")
    if not other:
        found = left.join(near.groupBy(*own, *by).agg(best), own)
        return found.groupBy(F.col("_key").alias(key), *by).agg(F.min("b").alias("b")).select(key, *by, "b.*")
    ranked = two(near.groupBy(*own, *by, "_other").agg(best), [*own, *by], ["b"]).withColumn("_b", F.struct("_r", "_other", "b"))
    pair = ranked.groupBy(*own, *by).agg(F.array_sort(F.collect_list("_b")).alias("_two"))  # two at most
    found = left.join(pair, own).withColumn("_x", F.get(F.filter("_two", lambda x: x["_other"] != F.col("_key")), F.lit(0)))
    return found.filter("_x is not null").groupBy(F.col("_key").alias(key), *by).agg(F.min("_x.b").alias("b")).select(key, *by, "b.*")
