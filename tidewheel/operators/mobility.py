"""Stays, places and areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.frames import distinct_over_window, rolling
from tidewheel.functions.geo import haversine_m, near_spots, valid_point, with_cells
from tidewheel.functions.nested_grid import nearest_within, sums_within


def stay_months(stays: DataFrame, keys: list[str]) -> DataFrame:
    """G3, G4. stays: keys, mo_id, cell, start, end, village. Per month and cell: days, seconds, villages, longest flag."""
    seconds = F.unix_timestamp("end") - F.unix_timestamp("start")
    per = stays.groupBy(*keys, "mo_id", "cell").agg(F.countDistinct(F.to_date("start")).alias("days"), F.sum(seconds).alias("duration"), F.countDistinct("village").alias("villages"))
    longest = F.max("duration").over(Window.partitionBy(*keys, "mo_id"))
    return per.withColumn("is_longest", (F.col("duration") == longest).cast("int"))


def poi_with_categories(pois: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """G5. Two category maps (category -> category_type); what neither names is dropped."""
    both = first.select("category", "category_type", F.lit(1).alias("p")).union(second.select("category", "category_type", F.lit(2)))
    best = both.groupBy("category").agg(F.min(F.struct("p", "category_type")).alias("x")).select("category", F.col("x.category_type").alias("category_type"))
    return pois.join(best, "category")


def clusters(cases: DataFrame, by_village: DataFrame, by_district: DataFrame, threshold: int) -> DataFrame:
    """G6. Monthly mean and maximum per village, coordinates by village or else by district, flag from a threshold."""
    per = cases.groupBy("mo_id", "village", "district").agg(F.avg("cases").alias("avg_cases"), F.max("cases").alias("max_cases"))
    v = by_village.select("village", F.col("lat").alias("v_lat"), F.col("lon").alias("v_lon"))
    w = by_district.select("district", F.col("lat").alias("d_lat"), F.col("lon").alias("d_lon"))
    joined = per.join(v, "village", "left").join(w, "district", "left").withColumns({"lat": F.coalesce("v_lat", "d_lat"), "lon": F.coalesce("v_lon", "d_lon")})
    return joined.drop("v_lat", "v_lon", "d_lat", "d_lon").withColumn("is_cluster", (F.col("max_cases") >= threshold).cast("int"))


def area_indicators(points: DataFrame, sums: list[str], means: list[str], modal: str | None = None) -> DataFrame:
    """G7. Per cell sums and means, and the most frequent value of a column (ties to the greatest)."""
    at = with_cells(points, "lat", "lon")
    out = at.groupBy("cell_x", "cell_y").agg(*(F.sum(c).alias(f"{c}_sum") for c in sums), *(F.avg(c).alias(f"{c}_avg") for c in means))
    if not modal:
        return out
    n = at.groupBy("cell_x", "cell_y", modal).agg(F.count("*").alias("n")).groupBy("cell_x", "cell_y").agg(F.max(F.struct("n", modal)).alias("m"))
    return out.join(n.select("cell_x", "cell_y", F.col(f"m.{modal}").alias(f"{modal}_mode")), ["cell_x", "cell_y"])


def join_area_tables(homes: DataFrame, areas: list[DataFrame], districts: DataFrame) -> DataFrame:
    """G8. Area tables by cell and a district table by name."""
    out = with_cells(homes, "lat", "lon")
    for a in areas:
        out = out.join(a, ["cell_x", "cell_y"], "left")
    return out.join(districts, "district", "left").drop("cell_x", "cell_y")


def poi_near(homes: DataFrame, pois: DataFrame, categories: list[str], keys: list[str]) -> DataFrame:
    """G9. Per key: distance to the nearest POI within 2 km and number within 1 km, one column pair per category."""
    place, point = ("lat", "lon"), ("poi_lat", "poi_lon")
    named = homes.select(F.struct(*keys).alias("_place"), *place).distinct()
    near = nearest_within(named, "_place", place, pois.filter(F.col("category").isin(categories)), point, 2000, ["category"], [])
    counts = sums_within(named, "_place", place, pois, point, (1000, 2000), {f"n{i}": F.when(F.col("category") == c, 1) for i, c in enumerate(categories)})
    wide = near.groupBy("_place").pivot("category", categories).agg(F.min("distance"))
    out = counts.join(wide, "_place", "left")
    columns = [x for i, c in enumerate(categories) for x in (F.col(c).alias(f"{c}_min_distance"), F.when(F.col(c).isNotNull(), F.col(f"n{i}_1000m")).alias(f"{c}_n_1km"))]
    return out.select("_place.*", *columns)


def poi_visits(stays: DataFrame, pois: DataFrame, months: tuple[int, ...] = (1, 3, 6)) -> DataFrame:
    """G10. stays: msisdn, month_mapped_dt, cell, visits. pois: cell, category. Visits over months, summed by category."""
    rolled = stays.select("msisdn", "month_mapped_dt", "cell", *(F.sum("visits").over(rolling(m, ["msisdn", "cell"], "month_mapped_dt")).alias(f"v{m}") for m in months))
    cells = pois.groupBy("cell", "category").agg(F.count("*").alias("n_poi"))
    return rolled.join(cells, "cell").groupBy("msisdn", "month_mapped_dt", "category").agg(*(F.sum(f"v{m}").alias(f"visits_{m:02d}m") for m in months))


def stay_frequency(stays: DataFrame, level: str, months: tuple[int, ...] = (1, 3, 6)) -> DataFrame:
    """G11. Counts per place over months, and each month's place with the highest sum (ties to the smaller name)."""
    per = stays.groupBy("msisdn", "month_mapped_dt", level).agg(F.sum("visits").alias("visits"))
    sums = per.select("msisdn", "month_mapped_dt", level, *(F.sum("visits").over(rolling(m, ["msisdn", level], "month_mapped_dt")).alias(f"n_{m}") for m in months))
    best = lambda m: F.max_by(level, F.struct(F.col(f"n_{m}"), -F.col("place_rank"))).alias(f"top_{level}_{m:02d}m")
    ranked = sums.withColumn("place_rank", F.dense_rank().over(Window.partitionBy("msisdn", "month_mapped_dt").orderBy(level)))
    return ranked.groupBy("msisdn", "month_mapped_dt").agg(*(best(m) for m in months), *(F.max(f"n_{m}").alias(f"top_visits_{m:02d}m") for m in months))


def unique_places(stays: DataFrame, levels: list[str], months: tuple[int, ...] = (1, 3, 6)) -> DataFrame:
    """G12."""
    sets = stays.groupBy("msisdn", "month_mapped_dt").agg(*(F.collect_set(v).alias(v) for v in levels))
    counts = {f"n_{v}_{m:02d}m": (v, m) for v in levels for m in months}
    return distinct_over_window(sets, counts, order="month_mapped_dt").select("msisdn", "month_mapped_dt", *counts)


def home_work(home: DataFrame, work: DataFrame) -> DataFrame:
    """G13, G14. Per id and month: same place flag, distance, and the mean distance over three months."""
    h = home.select("msisdn", "month_mapped_dt", F.col("cell").alias("home_cell"), F.col("lat").alias("h_lat"), F.col("lon").alias("h_lon"))
    w = work.select("msisdn", "month_mapped_dt", F.col("cell").alias("work_cell"), F.col("lat").alias("w_lat"), F.col("lon").alias("w_lon"))
    both = h.join(w, ["msisdn", "month_mapped_dt"], "full").withColumn("same", F.when(F.col("home_cell") == F.col("work_cell"), 1).otherwise(0))
    both = both.withColumn("distance", haversine_m("h_lat", "h_lon", "w_lat", "w_lon"))
    return both.select("msisdn", "month_mapped_dt", "same", "distance", F.avg("distance").over(rolling(3, "msisdn", "month_mapped_dt")).alias("distance_03m"))


def distinct_cells_in_triples(stays: DataFrame) -> DataFrame:
    """G15. Distinct cells per id in the months up to each, three at most."""
    return unique_places(stays, ["cell"], (3,))


def cells_by_calendar_month(stays: DataFrame) -> DataFrame:
    """G15. One row per id: for each calendar month the most distinct cells of a triple of months that ends in it.

    month_mapped_dt counts a day for each month since a January.
    """
    month = F.pmod(F.datediff("month_mapped_dt", F.trunc("month_mapped_dt", "year")), F.lit(12)) + 1
    triples = distinct_cells_in_triples(stays).withColumn("month", month)
    return triples.groupBy("msisdn").agg(*(F.max(F.when(F.col("month") == m, F.col("n_cell_03m"))).alias(f"max_cells_{m:02d}") for m in range(1, 13)))


def nearest_cluster(homes: DataFrame, found: DataFrame, metres: float = 5000) -> DataFrame:
    """G16. Smallest and mean distance of an id's places to the clusters near them.

    Spots are compared, not rows: a spot's clusters count by their number, and a spot's ids share its result.
    """
    point = ("poi_lat", "poi_lon")
    at = found.filter("is_cluster = 1").groupBy(F.col("lat").alias("poi_lat"), F.col("lon").alias("poi_lon")).agg(F.count("*").alias("_n"))
    valid = homes.filter(valid_point("lat", "lon"))
    near = near_spots(valid.select("lat", "lon").distinct(), at, ("lat", "lon"), point, metres)
    per = near.groupBy("lat", "lon").agg(F.min("distance").alias("_least"), F.sum(F.col("distance") * F.col("_n")).alias("_sum"), F.sum("_n").alias("_of"))
    return valid.join(per, ["lat", "lon"]).groupBy("msisdn").agg(F.min("_least").alias("min_distance"), (F.sum("_sum") / F.sum("_of")).alias("avg_distance"))


def cluster_distance_by_period(stays: DataFrame, found: DataFrame, periods: dict[str, tuple[str, str]], metres: float = 5000) -> DataFrame:
    """G16. Per id and period: smallest and mean distance of its places of the period's months to their nearest cluster.

    stays: msisdn, month, lat, lon. A place is compared once, however many ids and months have it. Places without a cluster
    within the radius do not count.
    """
    at = found.filter("is_cluster = 1").select(F.col("lat").alias("poi_lat"), F.col("lon").alias("poi_lon")).distinct()
    spot = F.struct("lat", "lon")
    spots = stays.filter("lat is not null and lon is not null").select(spot.alias("_spot"), "lat", "lon").distinct()
    near = nearest_within(spots, "_spot", ("lat", "lon"), at, ("poi_lat", "poi_lon"), metres, [], [])
    rows = stays.withColumn("_spot", spot).join(near, "_spot")
    inside = {n: F.col("month").between(F.lit(a).cast("date"), F.lit(b).cast("date")) for n, (a, b) in periods.items()}
    per = rows.groupBy("msisdn").agg(*(f(F.when(c, F.col("distance"))).alias(f"{m}_distance_{n}") for n, c in inside.items() for m, f in (("min", F.min), ("avg", F.avg))))
    return stays.select("msisdn").distinct().join(per, "msisdn", "left")


def case_stats(homes: DataFrame, stats: DataFrame) -> DataFrame:
    """G17. Monthly case statistics at an id's cell."""
    return homes.join(stats, ["cell", "month_mapped_dt"], "left")


def mobility_master(tables: list[DataFrame], weeks: DataFrame) -> DataFrame:
    """G18. Monthly tables joined in full and dealt to weeks. weeks: weekstart, month_mapped_dt."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, ["msisdn", "month_mapped_dt"], "full")
    return out.join(weeks, "month_mapped_dt").drop("month_mapped_dt")
