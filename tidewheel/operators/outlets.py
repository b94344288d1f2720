"""Outlets: cleaning, daily tables, and what lies around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.geo import with_cells
from tidewheel.functions.nested_grid import nearest_within, sums_within
from tidewheel.functions.relational import mode_with_count

RADII = (200, 500, 1000, 2500, 5000)
PLACE, POINT = ("lat", "lon"), ("poi_lat", "poi_lon")


def clean_outlets(daily: DataFrame) -> DataFrame:
    """O1. Outlets with one coordinate pair and one type in all of their rows, with cell; rows without an id are dropped."""
    rows = daily.filter("outlet_id is not null and lat is not null and lon is not null")
    per = rows.groupBy("outlet_id").agg(F.countDistinct("lat", "lon").alias("n_at"), F.countDistinct("type").alias("n_type"))
    bad = per.filter("n_at <> 1 or n_type <> 1").select("outlet_id")
    first = rows.groupBy("outlet_id").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.min("type").alias("type"))
    return with_cells(first.join(bad, "outlet_id", "left_anti"), "lat", "lon")


def latest_classification(daily: DataFrame) -> DataFrame:
    """O2."""
    return daily.groupBy("outlet_id").agg(F.max_by("classification", F.struct("event_date", "classification")).alias("classification"))


def clean_pois(sources: list[DataFrame], columns: list[str]) -> DataFrame:
    """O3. Distinct columns of interest of all sources, valid coordinates only."""
    every = sources[0].select(*columns)
    for s in sources[1:]:
        every = every.union(s.select(*columns))
    return with_cells(every.distinct(), "poi_lat", "poi_lon").drop("cell_x", "cell_y")


def cell_coordinates(cells: DataFrame) -> DataFrame:
    """O5. A cell's coordinates: the most frequent pair, then the latest."""
    n = cells.groupBy("cell", "lat", "lon").agg(F.count("*").alias("n"), F.max("event_date").alias("last"))
    best = Window.partitionBy("cell").orderBy(F.col("n").desc(), F.col("last").desc(), "lat", "lon")
    return n.withColumn("r", F.row_number().over(best)).filter("r = 1").select("cell", "lat", "lon")


def recharges_by_radius(outlets: DataFrame, cells: DataFrame, recharges: DataFrame) -> DataFrame:
    """O5. Recharges of the cells near an outlet, by radius."""
    per = recharges.groupBy("cell").agg(F.sum("amount").alias("amount"))
    at = cell_coordinates(cells).join(per, "cell").withColumnsRenamed({"lat": "poi_lat", "lon": "poi_lon"})
    return sums_within(outlets, "outlet_id", PLACE, at, POINT, RADII, {"amount": F.col("amount")})


def exclude_outlets(outlets: DataFrame, lists: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """O6. Outlets on none of the lists, and (outlet_id, reason) of those removed."""
    removed = None
    for name, listed in lists.items():
        tagged = listed.select("outlet_id").distinct().withColumn("reason", F.lit(name))
        removed = tagged if removed is None else removed.union(tagged)
    removed = removed.join(outlets.select("outlet_id").distinct(), "outlet_id", "left_semi")
    return outlets.join(removed.select("outlet_id"), "outlet_id", "left_anti"), removed


def daily_network(kpis: DataFrame, sums: list[str], means: list[str]) -> DataFrame:
    """O7."""
    return kpis.groupBy("outlet_id", "event_date").agg(*(F.sum(c).alias(f"{c}_sum") for c in sums), *(F.avg(c).alias(f"{c}_avg") for c in means))


def daily_recharge(records: DataFrame) -> DataFrame:
    """O8. Daily sums by code, mean and median, sellers."""
    return records.groupBy("outlet_id", "event_date").agg(
        F.sum("amount").alias("amount"),
        F.coalesce(F.sum(F.when(F.col("code") == "A", F.col("amount"))), F.lit(0)).alias("amount_a"),
        F.coalesce(F.sum(F.when(F.col("code") != "A", F.col("amount"))), F.lit(0)).alias("amount_other"),
        F.avg("amount").alias("amount_avg"),
        F.percentile("amount", 0.5).alias("amount_median"),
        F.array_sort(F.collect_set("seller")).alias("sellers"),
    )


def channel_by_cell_daily(records: DataFrame, channels: list[str], last: str) -> DataFrame:
    """O9. cell, event_date, one amount per channel: every day from a cell's first to ``last``; a missing seller cell is the month's mode."""
    month = F.trunc("event_date", "month")
    known = records.filter("cell is not null").withColumns({"month": month, "one": F.lit(1).cast("long")})
    mode = mode_with_count(known, ["seller", "month"], "cell", "one").select("seller", "month", "cell_mode")
    filled = records.withColumn("month", month).join(mode, ["seller", "month"], "left").withColumn("cell", F.coalesce("cell", "cell_mode")).filter("cell is not null")
    per = filled.groupBy("cell", "event_date").pivot("channel", channels).agg(F.sum("amount"))
    days = per.groupBy("cell").agg(F.min("event_date").alias("lo")).select("cell", F.explode(F.sequence("lo", F.lit(last).cast("date"))).alias("event_date"))
    return days.join(per, ["cell", "event_date"], "left").fillna(0, channels)


def channel_totals_by_outlet(by_cell: DataFrame, channels: list[str], cells: DataFrame, start: str) -> DataFrame:
    """O9. outlet_id, event_date, total: all channels of all cells of an outlet, each cell from its first day with the outlet or
    its own first day, whichever is earlier, but not before ``start``. cells: outlet_id, cell, first_date. by_cell: O9 by cell and day."""
    own = cells.filter("cell is not null").groupBy("outlet_id", "cell").agg(F.min("first_date").alias("_first"))
    begun = by_cell.groupBy("cell").agg(F.min("event_date").alias("_begun"))
    spans = own.join(begun, "cell").select("outlet_id", "cell", F.greatest(F.least("_first", "_begun"), F.lit(start).cast("date")).alias("_from"))
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in channels[1:]), F.coalesce(F.col(channels[0]), F.lit(0)))
    return by_cell.withColumn("_total", total).join(spans, "cell").filter("event_date >= _from").groupBy("outlet_id", "event_date").agg(F.sum("_total").alias("total"))


def vouchers_daily(records: DataFrame) -> DataFrame:
    """O10. Per outlet and day: vouchers, distinct cells, cities and sellers, and of the union of cells and cities."""
    return records.groupBy("outlet_id", "event_date").agg(
        F.sum("amount").alias("amount"),
        F.countDistinct("cell").alias("cells"),
        F.countDistinct("city").alias("cities"),
        F.countDistinct("seller").alias("sellers"),
        F.size(F.array_union(F.collect_set("cell"), F.collect_set("city"))).alias("places"),
    )


def daily_master(tables: list[DataFrame], last: str, zero: list[str]) -> DataFrame:
    """O11. Outlet-day tables joined in full, on a grid of every day from an outlet's first to ``last``, zero filled."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, ["outlet_id", "event_date"], "full")
    grid = out.groupBy("outlet_id").agg(F.min("event_date").alias("lo")).select("outlet_id", F.explode(F.sequence("lo", F.lit(last).cast("date"))).alias("event_date"))
    return grid.join(out, ["outlet_id", "event_date"], "left").fillna(0, zero)


def population_by_radius(outlets: DataFrame, points: DataFrame) -> DataFrame:
    """O12."""
    return sums_within(outlets, "outlet_id", PLACE, points, POINT, RADII, {"population": F.col("population")})


def nearest_by_category(outlets: DataFrame, pois: DataFrame, categories: list[str]) -> DataFrame:
    """O13. One distance column per category."""
    wanted = pois.filter(F.col("category").isin(categories))
    near = nearest_within(outlets, "outlet_id", PLACE, wanted, POINT, max(RADII), ["category"], [])
    some = sums_within(outlets, "outlet_id", PLACE, pois, POINT, (max(RADII),), {"any": F.lit(1)}).select("outlet_id")
    return some.join(near.groupBy("outlet_id").pivot("category", categories).agg(F.min("distance")), "outlet_id", "left")


def radius_counts(outlets: DataFrame, pois: DataFrame, categories: list[str], radii: tuple[int, ...] = RADII) -> DataFrame:
    """O14. Number of POIs of each category within each radius; 0 where there is none."""
    sums = {c.lower(): F.when(F.col("category") == c, 1) for c in categories}
    found = sums_within(outlets, "outlet_id", PLACE, pois, POINT, tuple(sorted({*radii, max(RADII)})), sums)
    return found.select("outlet_id", *(f"{c.lower()}_{r}m" for c in categories for r in radii))


def outlets_near_outlets(outlets: DataFrame) -> DataFrame:
    """O15. Other outlets within each radius, and the nearest. One row an outlet."""
    other = outlets.select(F.col("outlet_id").alias("other_id"), F.col("lat").alias("poi_lat"), F.col("lon").alias("poi_lon"))
    counts = sums_within(outlets, "outlet_id", PLACE, other, POINT, RADII, {"outlets": F.lit(1)})
    others = counts.select("outlet_id", *((F.col(f"outlets_{r}m") - 1).alias(f"outlets_{r}m") for r in RADII))
    near = nearest_within(outlets, "outlet_id", PLACE, other, POINT, max(RADII), [], [], other="other_id")
    return others.join(near.withColumnRenamed("distance", "nearest_m"), "outlet_id")


def outlet_surroundings(outlets: DataFrame, pois: DataFrame, categories: list[str]) -> DataFrame:
    """O16. O13, O14 and O15 side by side."""
    out = outlets.select("outlet_id")
    for t in (nearest_by_category(outlets, pois, categories), radius_counts(outlets, pois, categories, (1000,)), outlets_near_outlets(outlets)):
        out = out.join(t, "outlet_id", "left")
    return out


def pick_nearest(outlets: DataFrame, pois: DataFrame, attributes: list[str]) -> DataFrame:
    """O17. Attributes and distance of the nearest POI (ties to the smaller id)."""
    return nearest_within(outlets, "outlet_id", PLACE, pois, POINT, max(RADII), [], ["poi_id", *attributes])


def map_to_outlets(outlets: DataFrame, dealers: DataFrame, key: str) -> DataFrame:
    """O18. The latest row of a table by its key, attached to outlets. dealers: key, event_date, dealer."""
    last = dealers.groupBy(key).agg(F.max_by("dealer", F.struct("event_date", "dealer")).alias("dealer"))
    return outlets.join(last, key, "left")


def join_accuracy(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """O19. Share (in percent, two places) of distinct keys of the left table that the right one has, and how many it lacks."""
    a, b = left.select(key).distinct(), right.select(key).distinct().withColumn("hit", F.lit(1))
    return a.join(b, key, "left").agg(F.round(F.try_divide(F.count("hit") * 100.0, F.count("*")), 2).alias("matched_percent"), (F.count("*") - F.count("hit")).alias("missing"))


def continuity(daily: DataFrame) -> DataFrame:
    """O19. Days that an outlet lacks between its first and last."""
    return daily.groupBy("outlet_id").agg((F.datediff(F.max("event_date"), F.min("event_date")) + 1 - F.countDistinct("event_date")).alias("missing_days"))


def daily_attributes(rows: DataFrame, attributes: list[str], numbers: DataFrame) -> DataFrame:
    """O6. rows: outlet_id, event_date, created_at, attributes. numbers: outlet_id, number.

    Attributes of the day (the greatest that is not blank or 0, else null), the outlet's first date of creation and its number.
    """
    given = lambda c: F.when(~F.trim(F.col(c).cast("string")).isin("", "0", "0.0"), F.col(c))
    daily = rows.groupBy("outlet_id", "event_date").agg(*(F.max(given(c)).alias(c) for c in attributes))
    created = rows.groupBy("outlet_id").agg(F.min("created_at").alias("created_at"))
    one = numbers.groupBy("outlet_id").agg(F.min("number").alias("number"))
    return daily.join(created, "outlet_id").join(one, "outlet_id", "left")


def daily_modes(records: DataFrame, columns: list[str], parts: list[str], amount: str = "amount") -> DataFrame:
    """O11. Per outlet and day: cash flow, the most frequent value of each column with its count, and each part's share of the cash flow.

    parts: values of the column ``part``.
    """
    key = ["outlet_id", "event_date"]
    of = lambda p: F.coalesce(F.sum(F.when(F.col("part") == p, F.col(amount))), F.lit(0)).cast("double")
    out = records.groupBy(*key).agg(F.sum(amount).alias("cash_flow"), *(F.try_divide(of(p), F.sum(amount).cast("double")).alias(f"share_{p.lower()}") for p in parts))
    for c in columns:
        out = out.join(mode_with_count(records.withColumn("_one", F.lit(1)), key, c, "_one"), key, "left")
    return out


def outlets_by_kind(outlets: DataFrame, kinds: list[str], radii: tuple[int, ...] = RADII) -> DataFrame:
    """O16. outlets: also kind and amount. Outlets of each kind within each radius and the sum of their amounts; an outlet counts itself."""
    other = outlets.select("kind", "amount", F.col("lat").alias("poi_lat"), F.col("lon").alias("poi_lon"))
    own = {k: F.when(F.col("kind") == k, 1) for k in kinds} | {f"{k}_amount": F.when(F.col("kind") == k, F.col("amount")) for k in kinds}
    return sums_within(outlets, "outlet_id", PLACE, other, POINT, radii, own)
