"""Grid cells and distances as columns.

A cell is that of a five-character geohash: 13 bits of longitude and 12 of latitude. Joins use the pair of integers; the
text is made of them where it is wanted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LON_CELLS, LAT_CELLS = 8192, 4096
#: The geohash alphabet.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
EARTH_DIAMETER_M = 12_742_000
#: Rows of a spot in one list, about, of the left and the right side of near_pairs.
LEFT_ROWS, RIGHT_ROWS = 8, 512


def valid_point(lat: str, lon: str) -> Column:
    """Both numbers, latitude in [-90, 90)."""
    return F.coalesce(F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & (F.col(lat) >= -90) & (F.col(lat) < 90), F.lit(False))


def cell_x(lon: str | Column) -> Column:
    c = F.col(lon) if isinstance(lon, str) else lon
    return F.pmod(F.floor((c + 180) / 360 * LON_CELLS), F.lit(LON_CELLS)).cast("int")


def cell_y(lat: str | Column) -> Column:
    c = F.col(lat) if isinstance(lat, str) else lat
    return F.floor((c + 90) / 180 * LAT_CELLS).cast("int")


def geohash5(x: Column, y: Column) -> Column:
    """Five characters of five bits, longitude and latitude bits taken in turn."""
    bits = [F.shiftright(x, 12 - k // 2).bitwiseAND(F.lit(1)) if k % 2 == 0 else F.shiftright(y, 11 - k // 2).bitwiseAND(F.lit(1)) for k in range(25)]
    chars = []
    for at in range(0, 25, 5):
        value = sum((bits[at + j] * (16 >> j) for j in range(1, 5)), bits[at] * 16)
        chars.append(F.substring(F.lit(BASE32), value + 1, F.lit(1)))
    return F.concat(*chars)


def geohash(lat: str, lon: str) -> Column:
    """Geohash of precision 5; null where the point is not valid."""
    return F.when(valid_point(lat, lon), geohash5(cell_x(lon), cell_y(lat)))


def with_cells(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows with valid points and their cell_x, cell_y."""
    return df.filter(valid_point(lat, lon)).withColumns({"cell_x": cell_x(lon), "cell_y": cell_y(lat)})


def expand_cells(df: DataFrame, reach: int = 1, own: bool = True) -> DataFrame:
    """One row for each cell within ``reach`` of a row's cell; longitude wraps, latitude ends at the poles."""
    steps = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if own or (i, j) != (0, 0)]
    near = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps)))
    out = df.withColumn("_s", near).withColumns({"cell_x": F.pmod(F.col("cell_x") + F.col("_s.i"), F.lit(LON_CELLS)), "cell_y": F.col("cell_y") + F.col("_s.j")})
    return out.filter(F.col("cell_y").between(0, LAT_CELLS - 1)).drop("_s")


def haversine_m(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return EARTH_DIAMETER_M * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def _columns(y: Column, height: float, angle: float) -> Column:
    """Columns of a band of latitude: each as wide as two points of the angular distance can lie apart there, or one around a pole."""
    edge = F.greatest(F.abs(y * height - 90), F.abs((y + 1) * height - 90))
    widest = F.degrees(F.asin(F.least(F.lit(1.0), math.sin(angle) / F.cos(F.radians(edge)))))
    return F.when(edge + math.degrees(angle) >= 90, 1).otherwise(F.greatest(F.lit(1), F.floor(360 / widest))).cast("long")


def _in_lists(df: DataFrame, at: tuple[str, str], most: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Spots with ``{name}_n``, the number of their lists; and the lists: spot, ``{name}_k``, and ``name``, some ``most`` rows of the spot.

    Rows are dealt to a spot's lists by their hash, so rows equal in all columns share one.
    """
    own = [c for c in df.columns if c not in at] or [*at]
    rows = df.filter(valid_point(*at))
    spots = rows.groupBy(*at).agg(F.ceil(F.count("*") / most).cast("int").alias(f"{name}_n"))
    dealt = rows.join(spots, [*at]).groupBy(*at, F.pmod(F.xxhash64(*own), f"{name}_n").cast("int").alias(f"{name}_k"))
    lists = dealt.agg(F.collect_list(F.struct(*own)).alias(name))
    # A list of one column is one of plain values, nulls included; its rows are made faster.
    return spots, lists.withColumn(name, F.col(name)[own[0]]) if len(own) == 1 else lists


def near_pairs(left: DataFrame, right: DataFrame, left_at: tuple[str, str], right_at: tuple[str, str], metres: float, digits: int | None = None) -> DataFrame:
    """Rows of left and right within ``metres``, with ``distance``, rounded to ``digits`` if given.

    Spots are compared, each once however many rows lie on it. The rows of a spot are kept in short lists, and a pair of
    lists is what is dealt to the tasks: a spot of very many rows is shared by all of them, none holds more than two lists'
    pairs at once, and no row of the result comes from a lookup of its own.
    """
    (a, lefts), (b, rights) = _in_lists(left, left_at, LEFT_ROWS, "_left"), _in_lists(right, right_at, RIGHT_ROWS, "_right")
    near = near_spots(a, b, left_at, right_at, metres)
    near = near.withColumn("distance", F.round("distance", digits)) if digits is not None else near
    for side in ("_left", "_right"):
        near = near.withColumn(f"{side}_k", F.explode(F.sequence(F.lit(0), F.col(f"{side}_n") - 1))).drop(f"{side}_n")
    # Few pairs of lists can stand for very many rows, so they are dealt to all tasks whatever their bytes.
    near = near.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), *left_at, "_left_k", *right_at, "_right_k")
    both = near.join(lefts, [*left_at, "_left_k"]).join(rights, [*right_at, "_right_k"])
    both = both.withColumn("_left", F.explode("_left")).withColumn("_right", F.explode("_right"))
    of = lambda df, at, row: [F.col(c) if c in at else F.col(f"{row}.{c}" if len(df.columns) > len(at) + 1 else row).alias(c) for c in df.columns]
    return both.select(*of(left, left_at, "_left"), *of(right, right_at, "_right"), "distance")


def near_spots(left: DataFrame, right: DataFrame, left_at: tuple[str, str], right_at: tuple[str, str], metres: float) -> DataFrame:
    """Rows of left and right within ``metres``, with ``distance``; complete at any latitude and for any radius.

    An equi join on a grid made for the radius: bands of latitude of its height, each cut into columns as wide as the
    radius is there. The right side is copied to the cells that its circle touches, some nine of them.
    """
    angle = min(metres / (EARTH_DIAMETER_M / 2) * (1 + 1e-9) + 1e-12, math.pi / 2)
    bands = max(1, int(180 / math.degrees(angle)))
    height = 180 / bands
    band = lambda lat: F.least(F.floor((F.col(lat) + 90) / height), F.lit(bands - 1))
    at = lambda lon, n: F.floor((lon + 180) / 360 * n)
    a = left.filter(valid_point(*left_at)).withColumn("_y", band(left_at[0]))
    a = a.withColumn("_k", _columns(F.col("_y"), height, angle)).withColumn("_x", F.pmod(at(F.col(left_at[1]), F.col("_k")), F.col("_k"))).drop("_k")
    lat, lon = F.col(right_at[0]), F.col(right_at[1])
    b = right.filter(valid_point(*right_at)).withColumn("_y", F.explode(F.sequence(F.greatest(band(right_at[0]) - 1, F.lit(0)), F.least(band(right_at[0]) + 1, F.lit(bands - 1)))))
    half = F.when(F.abs(lat) + math.degrees(angle) >= 90, 180.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), math.sin(angle) / F.cos(F.radians(lat)))))) * (1 + 1e-9)
    b = b.withColumn("_k", _columns(F.col("_y"), height, angle))
    first, last = at(lon - half, F.col("_k")), at(lon + half, F.col("_k"))
    cells = F.when(last - first + 1 >= F.col("_k"), F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)).otherwise(F.sequence(first, last))
    b = b.withColumn("_x", F.explode(cells)).withColumn("_x", F.pmod("_x", "_k")).drop("_k")
    near = a.join(b, ["_y", "_x"]).withColumn("distance", haversine_m(*left_at, *right_at))
    return near.filter(F.col("distance") <= metres).drop("_y", "_x")
