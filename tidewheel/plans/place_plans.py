"""Scaffolds (P), mobility (G) and outlets (O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.functions import geo
from tidewheel.operators import mobility as G
from tidewheel.operators import outlets as O
from tidewheel.operators import scaffold as P
from tidewheel.plans.registry import query
from tidewheel.plans.time_plans import WEEKLY_SQL, weekly
from tidewheel.sources.derived import ctes, outlets, places, products, profiles, revenue, usage

SCAFFOLD_SQL = WEEKLY_SQL + """, scaffold AS (SELECT msisdn, CAST(w AS DATE) AS weekstart FROM (SELECT msisdn, min(weekstart)::TIMESTAMP AS lo, max(weekstart)::TIMESTAMP AS hi FROM weekly GROUP BY 1), unnest(generate_series(lo, hi, INTERVAL 7 DAYS)) AS t(w))"""


@query(SCAFFOLD_SQL + " SELECT * FROM scaffold")
def p1_weekly_scaffold(spark, d):
    w = weekly(spark, d)
    return P.weekly_scaffold("msisdn")(w.filter("loan > 0"), w.filter("loan = 0"))


@query(ctes("revenue") + ", b AS (SELECT msisdn, min(date_trunc('month', event_date))::TIMESTAMP AS lo, max(date_trunc('month', event_date))::TIMESTAMP AS hi FROM revenue GROUP BY 1) SELECT msisdn, strftime(m, '%Y-%m') AS mo_id FROM b, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS t(m)")
def p2_monthly_scaffold(spark, d):
    return P.monthly_scaffold("msisdn")(revenue(spark, d).select("msisdn", F.date_format("event_date", "yyyy-MM").alias("mo_id")))


@query(ctes("usage") + ", b AS (SELECT party, min(event_date)::TIMESTAMP AS lo, max(event_date)::TIMESTAMP AS hi FROM usage GROUP BY 1) SELECT party, CAST(x AS DATE) AS event_date FROM b, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS t(x)")
def p3_daily_scaffold(spark, d):
    b = usage(spark, d).groupBy("party").agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    return P.daily_scaffold(b, "party", "lo", "hi")


@query(SCAFFOLD_SQL + " SELECT * FROM scaffold WHERE msisdn IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY') AND weekstart BETWEEN DATE '1996-01-01' AND DATE '1997-01-06'")
def p4_id_scaffold(spark, d):
    w = weekly(spark, d)
    return P.id_scaffold(w.filter("loan > 0"), w.filter("loan = 0"), profiles(spark, d).filter("segment = 'MACHINERY'"), ("1996-01-01", "1997-01-06"))


@query(SCAFFOLD_SQL + " SELECT msisdn, weekstart, amt FROM scaffold LEFT JOIN weekly USING (msisdn, weekstart)")
def p5_fill_time_series(spark, d):
    w = weekly(spark, d)
    return P.dense_weekly(w.select("msisdn", "weekstart", "amt"))


USAGE_WEEKLY_SQL = ctes("usage") + """, uw AS (SELECT msisdn, weekstart, kind, CAST(sum(amount) AS BIGINT) AS amt FROM usage GROUP BY ALL),
us AS (SELECT msisdn, CAST(w AS DATE) AS weekstart FROM (SELECT msisdn, min(weekstart)::TIMESTAMP AS lo, max(weekstart)::TIMESTAMP AS hi FROM uw GROUP BY 1), unnest(generate_series(lo, hi, INTERVAL 7 DAYS)) AS t(w))"""


@query(USAGE_WEEKLY_SQL + " SELECT us.msisdn, us.weekstart, k.kind, amt FROM us, (VALUES ('view'), ('click')) k(kind) LEFT JOIN uw ON uw.msisdn = us.msisdn AND uw.weekstart = us.weekstart AND uw.kind = k.kind")
def p6_fill_with_category(spark, d):
    w = usage(spark, d).groupBy("msisdn", "weekstart", "kind").agg(F.sum("amount").alias("amt"))
    return P.fill_with_category(P.weekly_scaffold()(w), ["view", "click"], w, ["msisdn", "weekstart"], "kind")


@query(SCAFFOLD_SQL + " SELECT msisdn, weekstart, coalesce(amt, 0) AS amt, coalesce(trx, 0) AS trx FROM scaffold LEFT JOIN weekly USING (msisdn, weekstart)")
def p7_fill_with_zero(spark, d):
    w = weekly(spark, d)
    return P.dense_weekly(w.select("msisdn", "weekstart", "amt", "trx"), zero=True)


@query(ctes("profiles") + " SELECT msisdn, CAST(w AS DATE) AS weekstart FROM (SELECT DISTINCT msisdn FROM profiles), unnest(generate_series(TIMESTAMP '1998-01-05', TIMESTAMP '1998-02-02', INTERVAL 7 DAYS)) AS t(w)")
def p8_id_week_grid(spark, d):
    return P.id_week_grid(profiles(spark, d), F.lit("1998-01-05").cast("date"), F.lit("1998-02-02").cast("date"))


PACK_SQL = ctes("usage") + ", packed AS (SELECT msisdn, list_sort(list(DISTINCT kind)) AS use_case FROM usage GROUP BY 1)"


def packed(spark, d):
    u = usage(spark, d)
    return P.pack_use_cases({k: u.filter(F.col("kind") == k) for k in ("view", "click", "purchase", "signup", "error")})


@query(PACK_SQL + " SELECT * FROM packed")
def p9_pack_use_cases(spark, d):
    return packed(spark, d)


@query(PACK_SQL + ", e AS (SELECT msisdn, unnest(use_case) AS use_case FROM packed) SELECT use_case, count(*) AS total, count(*) FILTER (CAST(msisdn AS BIGINT) % 3 <> 0) AS new FROM e GROUP BY 1")
def p10_new_id_report(spark, d):
    p = packed(spark, d)
    return P.new_id_report(p, p.filter(F.col("msisdn").cast("long") % 3 == 0))


@query(WEEKLY_SQL + """, r AS (SELECT DISTINCT msisdn, 'x' || msisdn AS alias, event_date - CAST(isodow(event_date) - 1 AS INTEGER) AS weekstart FROM revenue WHERE status = 'O')
SELECT alias AS msisdn, weekstart, amt FROM weekly JOIN r USING (msisdn, weekstart)""")
def p11_unpack(spark, d):
    r = revenue(spark, d).filter("status = 'O'").select("msisdn", F.col("event_date").alias("request_date"), F.concat(F.lit("x"), "msisdn").alias("alias"))
    return P.unpack(weekly(spark, d).select("msisdn", "weekstart", "amt"), r)


CELL = "CAST(floor((lon + 180) / 360 * 8192) AS INTEGER) AS cell_x, CAST(floor((lat + 90) / 180 * 4096) AS INTEGER) AS cell_y"
#: The geohash of a pair of cells, bit by bit, in DuckDB.
_BITS = [f"((x >> {12 - k // 2}) & 1)" if k % 2 == 0 else f"((y >> {11 - k // 2}) & 1)" for k in range(25)]
HASH = " || ".join("substr('" + geo.BASE32 + "', CAST(" + " + ".join(f"{_BITS[a + j]} * {16 >> j}" for j in range(5)) + " AS INTEGER) + 1, 1)" for a in range(0, 25, 5))


@query(ctes("outlets") + f", c AS (SELECT outlet_id, {CELL} FROM outlets) SELECT outlet_id, {HASH.replace('(x', '(cell_x').replace('(y', '(cell_y')} AS geohash FROM c")
def g1_geohash(spark, d):
    return outlets(spark, d).select("outlet_id", geo.geohash("lat", "lon").alias("geohash"))


@query(ctes("outlets") + f", c AS (SELECT outlet_id, {CELL} FROM outlets) SELECT outlet_id, CAST((cell_x + i + 8192) % 8192 AS INTEGER) AS cell_x, CAST(cell_y + j AS INTEGER) AS cell_y FROM c, (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j) WHERE NOT (i = 0 AND j = 0)")
def g1_neighbours(spark, d):
    return geo.expand_cells(geo.with_cells(outlets(spark, d), "lat", "lon").select("outlet_id", "cell_x", "cell_y"), own=False)


@query(ctes("outlets", "places") + f""", c AS (SELECT 'outlet' AS kind, outlet_id AS id, {CELL} FROM outlets UNION ALL SELECT 'poi', poi_id, {CELL.replace('lon', 'poi_lon').replace('lat', 'poi_lat')} FROM places)
SELECT kind, id, CAST((cell_x + i + 8192) % 8192 AS INTEGER) AS cell_x, CAST(cell_y + j AS INTEGER) AS cell_y FROM c, (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j)""")
def o4_neighbour_cells(spark, d):
    of = lambda df, kind, key, lat, lon: geo.with_cells(df, lat, lon).select(F.lit(kind).alias("kind"), F.col(key).alias("id"), "cell_x", "cell_y")
    both = of(outlets(spark, d), "outlet", "outlet_id", "lat", "lon").unionByName(of(places(spark, d), "poi", "poi_id", "poi_lat", "poi_lon"))
    return geo.expand_cells(both)


def haversine_sql(a: str, b: str, c: str, e: str) -> str:
    h = f"(pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin((radians({e}) - radians({b})) / 2), 2))"
    return f"12742000 * atan2(sqrt({h}), sqrt(1 - {h}))"


NEAR_SQL = ctes("outlets", "places") + f", near AS (SELECT * FROM (SELECT o.outlet_id, o.lat, o.lon, p.*, {haversine_sql('o.lat', 'o.lon', 'p.poi_lat', 'p.poi_lon')} AS distance FROM outlets o, places p) WHERE distance <= 5000)"


@query(NEAR_SQL + " SELECT outlet_id, poi_id, round(distance, 3) AS distance FROM near WHERE distance <= 1000")
def g2_near_pairs(spark, d):
    at, point = ("lat", "lon"), ("poi_lat", "poi_lon")
    near = geo.near_pairs(outlets(spark, d).select("outlet_id", *at), places(spark, d).select("poi_id", *point), at, point, 1000, digits=3)
    return near.select("outlet_id", "poi_id", "distance")


STAYS_SQL = ctes("usage") + """, stays AS (SELECT msisdn, strftime(event_date, '%Y-%m') AS mo_id, party AS cell, u.ts AS start, u.ts + to_seconds(CAST(amount % 5000 AS INTEGER)) AS e, 'v' || amount % 3 AS village
  FROM usage JOIN (SELECT event_id, date_trunc('second', ts) AS ts FROM events) u USING (event_id))"""


@query(STAYS_SQL + """, p AS (SELECT msisdn, mo_id, cell, count(DISTINCT CAST(start AS DATE)) AS days, CAST(sum(date_diff('second', start, e)) AS BIGINT) AS duration, count(DISTINCT village) AS villages FROM stays GROUP BY ALL)
SELECT *, CAST(duration = max(duration) OVER (PARTITION BY msisdn, mo_id) AS INTEGER) AS is_longest FROM p""")
def g3_g4_stay_months(spark, d):
    u = usage(spark, d).join(spark.read.parquet(f"{d}/events.parquet").select("event_id", F.date_trunc("second", "ts").cast("timestamp").alias("start")), "event_id")
    s = u.select("msisdn", F.date_format("event_date", "yyyy-MM").alias("mo_id"), F.col("party").alias("cell"), "start", F.expr("timestampadd(SECOND, cast(amount % 5000 as int), start)").alias("end"), F.concat(F.lit("v"), (F.col("amount") % 3).cast("string")).alias("village"))
    return G.stay_months(s, ["msisdn"])


@query(ctes("places") + " SELECT poi_id, CASE category WHEN 'ECONOMY' THEN 'shop' ELSE 'other' END AS category_type FROM places WHERE category IN ('ECONOMY', 'PROMO')")
def g5_poi_categories(spark, d):
    p = places(spark, d)
    c = p.select("category").distinct()
    first = c.filter("category = 'ECONOMY'").withColumn("category_type", F.lit("shop"))
    second = c.filter("category in ('ECONOMY', 'PROMO')").withColumn("category_type", F.lit("other"))
    return G.poi_with_categories(p, first, second).select("poi_id", "category_type")


@query(ctes("usage", "outlets") + """, c AS (SELECT strftime(event_date, '%Y-%m') AS mo_id, CAST(substr(party, 2) AS BIGINT) AS village, CAST(substr(party, 2) AS BIGINT) % 25 AS district, amount AS cases FROM usage),
p AS (SELECT mo_id, village, district, avg(cases) AS avg_cases, max(cases) AS max_cases FROM c GROUP BY ALL)
SELECT mo_id, village, p.district, avg_cases, max_cases, coalesce(v.lat, e.lat) AS lat, coalesce(v.lon, e.lon) AS lon, CAST(max_cases >= 15000 AS INTEGER) AS is_cluster
FROM p LEFT JOIN (SELECT * FROM outlets WHERE outlet_id % 2 = 0) v ON v.outlet_id = village LEFT JOIN (SELECT district, min(lat) AS lat, min(lon) AS lon FROM outlets GROUP BY 1) e ON e.district = p.district""")
def g6_clusters(spark, d):
    o = outlets(spark, d)
    number = F.substring("party", 2, 9).cast("long")
    c = usage(spark, d).select(F.date_format("event_date", "yyyy-MM").alias("mo_id"), number.alias("village"), (number % 25).alias("district"), F.col("amount").alias("cases"))
    by_district = o.groupBy("district").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    return G.clusters(c, o.filter("outlet_id % 2 = 0").withColumnRenamed("outlet_id", "village"), by_district, 15000)


AREAS_SQL = ctes("places") + f", c AS (SELECT *, {CELL} FROM (SELECT *, poi_lat AS lat, poi_lon AS lon FROM places)), areas AS (SELECT cell_x, cell_y, CAST(sum(weight) AS BIGINT) AS weight_sum, avg(weight) AS weight_avg FROM c GROUP BY ALL), m AS (SELECT cell_x, cell_y, category, count(*) AS n FROM c GROUP BY ALL)"


def areas(spark, d, modal="category"):
    return G.area_indicators(places(spark, d).withColumnsRenamed({"poi_lat": "lat", "poi_lon": "lon"}), ["weight"], ["weight"], modal)


@query(AREAS_SQL + " SELECT areas.*, (SELECT arg_max(category, struct_pack(a := n, b := category)) FROM m WHERE m.cell_x = areas.cell_x AND m.cell_y = areas.cell_y) AS category_mode FROM areas")
def g7_area_indicators(spark, d):
    return areas(spark, d)


@query(AREAS_SQL.replace("WITH ", "WITH " + ctes("outlets")[5:] + ", ", 1) + f", o AS (SELECT outlet_id, district, {CELL} FROM outlets) SELECT outlet_id, district, weight_sum, weight_avg, n_name AS district_name FROM o LEFT JOIN areas USING (cell_x, cell_y) LEFT JOIN nation ON n_nationkey = district")
def g8_join_area_tables(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("district"), F.col("n_name").alias("district_name"))
    return G.join_area_tables(outlets(spark, d).select("outlet_id", "district", "lat", "lon"), [areas(spark, d, None)], n).drop("lat", "lon")


@query(NEAR_SQL + " SELECT outlet_id, " + ", ".join(f"round(min(distance) FILTER (category = '{c}'), 3) AS {c.lower()}_min, CASE WHEN count(*) FILTER (category = '{c}') > 0 THEN count(*) FILTER (category = '{c}' AND distance <= 1000) END AS {c.lower()}_n" for c in ("ECONOMY", "PROMO")) + " FROM near WHERE distance <= 2000 GROUP BY 1")
def g9_poi_near(spark, d):
    g = G.poi_near(outlets(spark, d), places(spark, d), ["ECONOMY", "PROMO"], ["outlet_id"])
    return g.select("outlet_id", *(c for k in ("ECONOMY", "PROMO") for c in (F.round(f"{k}_min_distance", 3).alias(f"{k.lower()}_min"), F.col(f"{k}_n_1km").alias(f"{k.lower()}_n"))))


MONTHS_SQL = ctes("products") + """, v AS (SELECT msisdn, CAST(date_diff('month', DATE '1995-01-01', event_date) AS INTEGER) + DATE '2000-01-01' AS month_mapped_dt, outlet_id AS cell, count(*) AS visits FROM products GROUP BY ALL)"""


def month_stays(spark, d):
    mapped = F.expr("date_add(date'2000-01-01', cast(months_between(trunc(event_date, 'month'), date'1995-01-01') as int))")
    return products(spark, d).groupBy("msisdn", mapped.alias("month_mapped_dt"), F.col("outlet_id").alias("cell")).agg(F.count("*").alias("visits"))


def months(m: int, keys: str = "msisdn, cell") -> str:
    return f"(PARTITION BY {keys} ORDER BY month_mapped_dt RANGE BETWEEN INTERVAL {m - 1} DAYS PRECEDING AND CURRENT ROW)"


@query(MONTHS_SQL + ", r AS (SELECT msisdn, month_mapped_dt, cell, " + ", ".join(f"sum(visits) OVER {months(m)} AS v{m}" for m in (1, 3, 6)) + " FROM v) SELECT msisdn, month_mapped_dt, s_nationkey AS category, " + ", ".join(f"CAST(sum(v{m}) AS BIGINT) AS visits_{m:02d}m" for m in (1, 3, 6)) + " FROM r JOIN supplier ON s_suppkey = cell GROUP BY ALL")
def g10_poi_visits(spark, d):
    return G.poi_visits(month_stays(spark, d), outlets(spark, d).select(F.col("outlet_id").alias("cell"), F.col("district").alias("category")))


@query(MONTHS_SQL + ", s AS (SELECT msisdn, month_mapped_dt, cell, " + ", ".join(f"sum(visits) OVER {months(m)} AS n_{m}" for m in (1, 3, 6)) + " FROM v) SELECT msisdn, month_mapped_dt, " + ", ".join(f"arg_max(cell, struct_pack(a := n_{m}, b := -cell)) AS top_cell_{m:02d}m, CAST(max(n_{m}) AS BIGINT) AS top_visits_{m:02d}m" for m in (1, 3, 6)) + " FROM s GROUP BY ALL")
def g11_stay_frequency(spark, d):
    return G.stay_frequency(month_stays(spark, d), "cell")


@query(MONTHS_SQL + ", g AS (SELECT msisdn, month_mapped_dt, list(cell) AS c FROM v GROUP BY ALL) SELECT msisdn, month_mapped_dt, " + ", ".join(f"CAST(len(list_distinct(flatten(list(c) OVER {months(m, 'msisdn')}))) AS INTEGER) AS n_cell_{m:02d}m" for m in (1, 3, 6)) + " FROM g")
def g12_unique_places(spark, d):
    return G.unique_places(month_stays(spark, d), ["cell"])


@query(MONTHS_SQL + ", g AS (SELECT msisdn, month_mapped_dt, list(cell) AS c FROM v GROUP BY ALL), "
       + f"t AS (SELECT msisdn, (month_mapped_dt - DATE '2000-01-01') % 12 + 1 AS month, CAST(len(list_distinct(flatten(list(c) OVER {months(3, 'msisdn')}))) AS INTEGER) AS n FROM g) "
       + "SELECT msisdn, " + ", ".join(f"max(n) FILTER (month = {m}) AS max_cells_{m:02d}" for m in range(1, 13)) + " FROM t GROUP BY ALL")
def g15_cells_by_calendar_month(spark, d):
    return G.cells_by_calendar_month(month_stays(spark, d))


HOME_SQL = MONTHS_SQL + ", " + ctes("outlets")[5:] + """, home AS (SELECT msisdn, month_mapped_dt, min(cell) AS cell FROM v GROUP BY ALL), work AS (SELECT msisdn, month_mapped_dt, max(cell) AS cell FROM v WHERE cell % 3 <> 0 GROUP BY ALL)"""


def home_and_work(spark, d):
    s, o = month_stays(spark, d), outlets(spark, d).select(F.col("outlet_id").alias("cell"), "lat", "lon")
    home = s.groupBy("msisdn", "month_mapped_dt").agg(F.min("cell").alias("cell"))
    work = s.filter("cell % 3 <> 0").groupBy("msisdn", "month_mapped_dt").agg(F.max("cell").alias("cell"))
    return home.join(o, "cell"), work.join(o, "cell")


@query(HOME_SQL + f""", j AS (SELECT msisdn, month_mapped_dt, CASE WHEN h.cell = w.cell THEN 1 ELSE 0 END AS same, {haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS distance
  FROM home h FULL JOIN work w USING (msisdn, month_mapped_dt) LEFT JOIN outlets a ON a.outlet_id = h.cell LEFT JOIN outlets b ON b.outlet_id = w.cell)
SELECT msisdn, month_mapped_dt, same, round(distance, 3) AS distance, round(avg(distance) OVER {months(3, 'msisdn')}, 3) AS distance_03m FROM j""")
def g13_g14_home_work(spark, d):
    return G.home_work(*home_and_work(spark, d)).select("msisdn", "month_mapped_dt", "same", F.round("distance", 3).alias("distance"), F.round("distance_03m", 3).alias("distance_03m"))


@query(NEAR_SQL + " SELECT CAST(outlet_id AS VARCHAR) AS msisdn, round(min(distance), 3) AS min_distance, round(avg(distance), 3) AS avg_distance FROM near WHERE weight >= 45 GROUP BY 1")
def g16_nearest_cluster(spark, d):
    found = places(spark, d).select(F.col("poi_lat").alias("lat"), F.col("poi_lon").alias("lon"), (F.col("weight") >= 45).cast("int").alias("is_cluster"))
    homes = outlets(spark, d).select(F.col("outlet_id").cast("string").alias("msisdn"), "lat", "lon")
    return G.nearest_cluster(homes, found).select("msisdn", F.round("min_distance", 3).alias("min_distance"), F.round("avg_distance", 3).alias("avg_distance"))


G16_PERIODS = {"early": ("1992-01-01", "1994-12-01"), "late": ("1995-01-01", "1998-12-01")}


@query(ctes("outlets", "places", "products") + f""", st AS (
  SELECT DISTINCT msisdn, CAST(date_trunc('month', event_date) AS DATE) AS month, lat, lon FROM products JOIN outlets USING (outlet_id)),
n AS (
  SELECT o.lat, o.lon, min({haversine_sql('o.lat', 'o.lon', 'p.poi_lat', 'p.poi_lon')}) AS distance
  FROM (SELECT DISTINCT lat, lon FROM outlets) o, places p WHERE p.weight >= 45 AND {haversine_sql('o.lat', 'o.lon', 'p.poi_lat', 'p.poi_lon')} <= 5000 GROUP BY ALL)
SELECT msisdn, """ + ", ".join(f"round({f}(distance) FILTER (month BETWEEN DATE '{a}' AND DATE '{b}'), 3) AS {f}_distance_{n}" for n, (a, b) in G16_PERIODS.items() for f in ("min", "avg")) + """
FROM st LEFT JOIN n USING (lat, lon) GROUP BY msisdn""")
def g16_distance_by_period(spark, d):
    found = places(spark, d).select(F.col("poi_lat").alias("lat"), F.col("poi_lon").alias("lon"), (F.col("weight") >= 45).cast("int").alias("is_cluster"))
    at = outlets(spark, d).select("outlet_id", "lat", "lon")
    stays = products(spark, d).select("msisdn", "outlet_id", F.trunc("event_date", "month").alias("month")).distinct().join(at, "outlet_id").drop("outlet_id").distinct()
    out = G.cluster_distance_by_period(stays, found, G16_PERIODS)
    return out.select("msisdn", *(F.round(c, 3).alias(c) for c in out.columns if c != "msisdn"))


@query(HOME_SQL + ", s AS (SELECT cell, month_mapped_dt, CAST(sum(visits) AS BIGINT) AS cases FROM v GROUP BY ALL HAVING sum(visits) > 1) SELECT msisdn, cell, month_mapped_dt, cases FROM home LEFT JOIN s USING (cell, month_mapped_dt)")
def g17_case_stats(spark, d):
    s = month_stays(spark, d).groupBy("cell", "month_mapped_dt").agg(F.sum("visits").alias("cases")).filter("cases > 1")
    return G.case_stats(home_and_work(spark, d)[0].select("msisdn", "cell", "month_mapped_dt"), s)


@query(HOME_SQL + ", weeks AS (SELECT DISTINCT CAST(date_diff('month', DATE '1995-01-01', weekstart) - 1 AS INTEGER) + DATE '2000-01-01' AS month_mapped_dt, weekstart FROM products) SELECT msisdn, weekstart, home.cell AS home, work.cell AS work FROM home FULL JOIN work USING (msisdn, month_mapped_dt) JOIN weeks USING (month_mapped_dt)")
def g18_mobility_master(spark, d):
    home, work = home_and_work(spark, d)
    weeks = products(spark, d).select("weekstart", F.expr("date_add(date'2000-01-01', cast(months_between(trunc(weekstart, 'month'), date'1995-01-01') as int) - 1)").alias("month_mapped_dt")).distinct()
    return G.mobility_master([home.select("msisdn", "month_mapped_dt", F.col("cell").alias("home")), work.select("msisdn", "month_mapped_dt", F.col("cell").alias("work"))], weeks)


OUTLET_DAYS_SQL = ctes("products", "outlets") + ", days AS (SELECT p.outlet_id, event_date, CASE WHEN p.outlet_id % 4 = 0 THEN product ELSE 'PROMO' END AS type, maker AS classification, lat, lon + CASE WHEN p.outlet_id % 10 = 0 AND amount % 2 = 0 THEN 0.1 ELSE 0 END AS lon FROM products p JOIN outlets o ON o.outlet_id = p.outlet_id)"


def outlet_days(spark, d):
    j = products(spark, d).join(outlets(spark, d), "outlet_id")
    return j.select("outlet_id", "event_date", F.when(F.col("outlet_id") % 4 == 0, F.col("product")).otherwise("PROMO").alias("type"), F.col("maker").alias("classification"), "lat", (F.col("lon") + F.when((F.col("outlet_id") % 10 == 0) & (F.col("amount") % 2 == 0), 0.1).otherwise(0)).alias("lon"))


@query(OUTLET_DAYS_SQL + f" SELECT outlet_id, min(lat) AS lat, min(lon) AS lon, min(type) AS type, CAST(floor((min(lon) + 180) / 360 * 8192) AS INTEGER) AS cell_x, CAST(floor((min(lat) + 90) / 180 * 4096) AS INTEGER) AS cell_y FROM days GROUP BY 1 HAVING count(DISTINCT (lat, lon)) = 1 AND count(DISTINCT type) = 1")
def o1_clean_outlets(spark, d):
    return O.clean_outlets(outlet_days(spark, d))


@query(OUTLET_DAYS_SQL + " SELECT outlet_id, arg_max(classification, struct_pack(a := event_date, b := classification)) AS classification FROM days GROUP BY 1")
def o2_latest_classification(spark, d):
    return O.latest_classification(outlet_days(spark, d))


@query(ctes("places") + " SELECT DISTINCT category, poi_lat, poi_lon FROM places")
def o3_clean_pois(spark, d):
    p = places(spark, d)
    return O.clean_pois([p, p.withColumn("poi_lat", F.lit(95.0))], ["category", "poi_lat", "poi_lon"])


CELLS_SQL = ctes("products", "outlets") + """, raw AS (SELECT p.maker AS cell, event_date, lat, lon, amount FROM products p JOIN outlets o ON o.outlet_id = p.outlet_id),
n AS (SELECT cell, lat, lon, count(*) AS n, max(event_date) AS last FROM raw GROUP BY ALL), spot AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, last DESC, lat, lon) AS r FROM n) WHERE r = 1)"""


def cell_rows(spark, d):
    return products(spark, d).join(outlets(spark, d), "outlet_id").select(F.col("maker").alias("cell"), "event_date", "lat", "lon", "amount")


@query(CELLS_SQL + f""", per AS (SELECT cell, sum(amount) AS amount FROM raw GROUP BY 1), near AS (SELECT outlet_id, amount, {haversine_sql('o.lat', 'o.lon', 'spot.lat', 'spot.lon')} AS distance FROM outlets o, spot JOIN per USING (cell))
SELECT outlet_id, """ + ", ".join(f"CAST(coalesce(sum(amount) FILTER (distance <= {r}), 0) AS BIGINT) AS amount_{r}m" for r in O.RADII) + " FROM near WHERE distance <= 5000 GROUP BY 1")
def o5_recharges_by_radius(spark, d):
    rows = cell_rows(spark, d)
    return O.recharges_by_radius(outlets(spark, d), rows, rows)


@query(ctes("outlets") + " SELECT outlet_id, 'poor' AS reason FROM outlets WHERE balance < 1000 UNION ALL SELECT outlet_id, 'far' FROM outlets WHERE lat > -5.85")
def o6_excluded_outlets(spark, d):
    o = outlets(spark, d)
    return O.exclude_outlets(o, {"poor": o.filter("balance < 1000"), "far": o.filter("lat > -5.85")})[1]


@query(ctes("outlets") + " SELECT outlet_id FROM outlets WHERE balance >= 1000 AND lat <= -5.85")
def o6_kept_outlets(spark, d):
    o = outlets(spark, d)
    return O.exclude_outlets(o, {"poor": o.filter("balance < 1000"), "far": o.filter("lat > -5.85")})[0].select("outlet_id")


@query(ctes("products") + " SELECT outlet_id, event_date, CAST(sum(amount) AS BIGINT) AS amount_sum, avg(quantity) AS quantity_avg FROM products GROUP BY ALL")
def o7_daily_network(spark, d):
    return O.daily_network(products(spark, d), ["amount"], ["quantity"])


@query(ctes("products") + """ SELECT outlet_id, event_date, CAST(sum(amount) AS BIGINT) AS amount, CAST(coalesce(sum(amount) FILTER (product = 'PROMO'), 0) AS BIGINT) AS amount_a, CAST(coalesce(sum(amount) FILTER (product <> 'PROMO'), 0) AS BIGINT) AS amount_other,
  avg(amount) AS amount_avg, quantile_cont(amount, 0.5)::DOUBLE AS amount_median, list_sort(list(DISTINCT maker)) AS sellers FROM products GROUP BY ALL""")
def o8_daily_recharge(spark, d):
    p = products(spark, d)
    return O.daily_recharge(p.withColumns({"code": F.when(F.col("product") == "PROMO", "A").otherwise("B"), "seller": F.col("maker")}))


@query(ctes("usage") + """, r AS (SELECT kind AS channel, event_date, amount, 's' || event_id % 7 AS seller, CASE WHEN event_id % 4 <> 0 THEN party END AS cell FROM usage),
m AS (SELECT seller, date_trunc('month', event_date) AS month, cell, count(*) AS n FROM r WHERE cell IS NOT NULL GROUP BY ALL),
mode AS (SELECT seller, month, cell FROM (SELECT *, row_number() OVER (PARTITION BY seller, month ORDER BY n DESC, cell) AS k FROM m) WHERE k = 1),
f AS (SELECT coalesce(r.cell, mode.cell) AS cell, event_date, channel, amount FROM r LEFT JOIN mode ON mode.seller = r.seller AND mode.month = date_trunc('month', event_date)),
p AS (SELECT cell, event_date, sum(amount) FILTER (channel = 'view') AS v, sum(amount) FILTER (channel = 'click') AS c FROM f WHERE cell IS NOT NULL GROUP BY ALL),
g AS (SELECT cell, CAST(x AS DATE) AS event_date FROM (SELECT cell, min(event_date)::TIMESTAMP AS lo FROM p GROUP BY 1), unnest(generate_series(lo, TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS t(x))
SELECT cell, event_date, CAST(coalesce(v, 0) AS BIGINT) AS view, CAST(coalesce(c, 0) AS BIGINT) AS click FROM g LEFT JOIN p USING (cell, event_date)""")
def o9_channel_by_cell_daily(spark, d):
    u = usage(spark, d).select(F.col("kind").alias("channel"), "event_date", "amount", F.concat(F.lit("s"), F.pmod("event_id", F.lit(7)).cast("string")).alias("seller"), F.when(F.pmod("event_id", F.lit(4)) != 0, F.col("party")).alias("cell"))
    return O.channel_by_cell_daily(u, ["view", "click"], "2024-02-05")


@query(ctes("usage") + """, r AS (
  SELECT kind AS channel, event_date, amount, party AS cell, event_id % 11 AS outlet_id FROM usage),
p AS (SELECT cell, event_date, sum(amount) FILTER (channel IN ('view', 'click', 'purchase')) AS t FROM r GROUP BY ALL),
b AS (SELECT cell, min(event_date) AS lo FROM p GROUP BY 1),
g AS (SELECT cell, CAST(x AS DATE) AS event_date FROM b, unnest(generate_series(lo::TIMESTAMP, TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS t(x)),
o AS (SELECT outlet_id, cell, min(event_date) AS f FROM r GROUP BY ALL)
SELECT outlet_id, g.event_date, CAST(sum(coalesce(t, 0)) AS BIGINT) AS total
FROM g LEFT JOIN p USING (cell, event_date) JOIN o USING (cell) JOIN b USING (cell)
WHERE g.event_date >= greatest(least(f, lo), DATE '2024-01-10') GROUP BY ALL""")
def o9_totals_by_outlet(spark, d):
    channels = ["view", "click", "purchase"]
    u = usage(spark, d).select(F.col("kind").alias("channel"), "event_date", "amount", F.lit("s").alias("seller"), F.col("party").alias("cell"), F.pmod("event_id", F.lit(11)).alias("outlet_id"))
    cells = u.groupBy("outlet_id", "cell").agg(F.min("event_date").alias("first_date"))
    return O.channel_totals_by_outlet(O.channel_by_cell_daily(u.drop("outlet_id"), channels, "2024-02-05"), channels, cells, "2024-01-10")


@query(ctes("products") + " SELECT outlet_id, event_date, CAST(sum(amount) AS BIGINT) AS amount, count(DISTINCT maker) AS cells, count(DISTINCT product) AS cities, count(DISTINCT msisdn) AS sellers, CAST(count(DISTINCT maker) + count(DISTINCT product) AS INTEGER) AS places FROM products GROUP BY ALL")
def o10_vouchers_daily(spark, d):
    p = products(spark, d)
    return O.vouchers_daily(p.withColumns({"cell": F.col("maker"), "city": F.col("product"), "seller": F.col("msisdn")}))


KIND_NAMES = ("economy", "large", "medium", "promo", "small", "standard")


@query(ctes("products") + ", t AS (SELECT outlet_id, event_date, " + ", ".join(f"sum(amount) FILTER (product = '{n.upper()}') AS {n}" for n in KIND_NAMES) + """ FROM products GROUP BY ALL),
g AS (SELECT outlet_id, CAST(x AS DATE) AS event_date FROM (SELECT outlet_id, min(event_date)::TIMESTAMP AS lo FROM t GROUP BY 1), unnest(generate_series(lo, TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS s(x))
SELECT outlet_id, event_date, """ + ", ".join(f"CAST(coalesce({n}, 0) AS BIGINT) AS {n}" for n in KIND_NAMES) + " FROM g LEFT JOIN t USING (outlet_id, event_date)")
def o11_daily_master(spark, d):
    p = products(spark, d)
    tables = [p.filter(F.col("product") == n.upper()).groupBy("outlet_id", "event_date").agg(F.sum("amount").alias(n)) for n in KIND_NAMES]
    return O.daily_master(tables, "2001-12-31", list(KIND_NAMES))


@query(NEAR_SQL + " SELECT outlet_id, " + ", ".join(f"CAST(coalesce(sum(weight) FILTER (distance <= {r}), 0) AS BIGINT) AS population_{r}m" for r in O.RADII) + " FROM near GROUP BY 1")
def o12_population_by_radius(spark, d):
    return O.population_by_radius(outlets(spark, d), places(spark, d).withColumn("population", F.col("weight")))


@query(NEAR_SQL + " SELECT outlet_id, round(min(distance) FILTER (category = 'ECONOMY'), 3) AS economy, round(min(distance) FILTER (category = 'PROMO'), 3) AS promo FROM near GROUP BY 1")
def o13_nearest_by_category(spark, d):
    n = O.nearest_by_category(outlets(spark, d), places(spark, d), ["ECONOMY", "PROMO"])
    return n.select("outlet_id", F.round("ECONOMY", 3).alias("economy"), F.round("PROMO", 3).alias("promo"))


@query(NEAR_SQL + " SELECT outlet_id, " + ", ".join(f"count(*) FILTER (category = '{c}' AND distance <= {r}) AS {c.lower()}_{r}m" for c in ("ECONOMY", "PROMO") for r in O.RADII) + " FROM near GROUP BY 1")
def o14_radius_counts(spark, d):
    return O.radius_counts(outlets(spark, d), places(spark, d), ["ECONOMY", "PROMO"])


@query(ctes("outlets") + f", near AS (SELECT a.outlet_id, b.outlet_id AS other_id, {haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS distance FROM outlets a, outlets b WHERE a.outlet_id <> b.outlet_id) SELECT outlet_id, " + ", ".join(f"count(DISTINCT other_id) FILTER (distance <= {r}) AS outlets_{r}m" for r in O.RADII) + ", round(min(distance), 3) AS nearest_m FROM near WHERE distance <= 5000 GROUP BY 1")
def o15_outlets_near_outlets(spark, d):
    return O.outlets_near_outlets(outlets(spark, d)).withColumn("nearest_m", F.round("nearest_m", 3))


@query(NEAR_SQL + f""", oo AS (SELECT a.outlet_id, count(DISTINCT b.outlet_id) FILTER ({haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 1000) AS n FROM outlets a, outlets b WHERE a.outlet_id <> b.outlet_id AND {haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 5000 GROUP BY 1)
SELECT o.outlet_id, round(min(distance) FILTER (category = 'PROMO'), 3) AS promo, CASE WHEN count(near.outlet_id) > 0 THEN count(*) FILTER (category = 'PROMO' AND distance <= 1000) END AS promo_1000m, any_value(oo.n) AS outlets_1000m
FROM outlets o LEFT JOIN near ON near.outlet_id = o.outlet_id LEFT JOIN oo ON oo.outlet_id = o.outlet_id GROUP BY 1""")
def o16_outlet_surroundings(spark, d):
    s = O.outlet_surroundings(outlets(spark, d), places(spark, d), ["PROMO"])
    return s.select("outlet_id", F.round("PROMO", 3).alias("promo"), "promo_1000m", "outlets_1000m")


@query(NEAR_SQL + " SELECT outlet_id, arg_min(poi_id, struct_pack(a := distance, b := poi_id)) AS poi_id, arg_min(category, struct_pack(a := distance, b := poi_id)) AS category, round(min(distance), 3) AS distance FROM near GROUP BY 1")
def o17_pick_nearest(spark, d):
    return O.pick_nearest(outlets(spark, d), places(spark, d), ["category"]).withColumn("distance", F.round("distance", 3))


@query(ctes("products", "outlets") + ", l AS (SELECT outlet_id % 25 AS district, arg_max(maker, struct_pack(a := event_date, b := maker)) AS dealer FROM products GROUP BY 1) SELECT outlet_id, district, dealer FROM outlets LEFT JOIN l USING (district)")
def o18_map_to_outlets(spark, d):
    dealers = products(spark, d).select(F.expr("cast(outlet_id % 25 as int)").alias("district"), "event_date", F.col("maker").alias("dealer"))
    return O.map_to_outlets(outlets(spark, d).select("outlet_id", "district"), dealers, "district")


@query(ctes("products", "outlets") + ", p AS (SELECT DISTINCT msisdn FROM products), a AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS msisdn FROM customer) SELECT round(count(p.msisdn) * 100.0::DOUBLE / count(*), 2) AS matched_percent, count(*) - count(p.msisdn) AS missing FROM a LEFT JOIN p USING (msisdn)")
def o19_join_accuracy(spark, d):
    return O.join_accuracy(profiles(spark, d), products(spark, d), "msisdn")


@query(ctes("products") + " SELECT outlet_id, CAST(max(event_date) - min(event_date) + 1 - count(DISTINCT event_date) AS BIGINT) AS missing_days FROM products GROUP BY 1")
def o19_continuity(spark, d):
    return O.continuity(products(spark, d))


@query(ctes("products", "outlets") + """, r AS (SELECT p.*, CASE WHEN quantity % 4 = 0 THEN ' ' WHEN quantity % 4 = 1 THEN '0' ELSE maker END AS type, validity % 3 AS grade FROM products p),
c AS (SELECT outlet_id, min(event_date) AS created_at FROM r GROUP BY 1)
SELECT r.outlet_id, r.event_date, max(type) FILTER (trim(type) NOT IN ('', '0')) AS type, max(grade) FILTER (grade <> 0) AS grade, any_value(c.created_at) AS created_at, any_value(o.name) AS number
FROM r JOIN c ON c.outlet_id = r.outlet_id LEFT JOIN outlets o ON o.outlet_id = r.outlet_id AND o.balance > 0 GROUP BY ALL""")
def o6_daily_attributes(spark, d):
    q = F.col("quantity") % 4
    rows = products(spark, d).withColumns({"created_at": F.col("event_date"), "type": F.when(q == 0, " ").when(q == 1, "0").otherwise(F.col("maker")), "grade": F.col("validity") % 3})
    numbers = outlets(spark, d).filter("balance > 0").select("outlet_id", F.col("name").alias("number"))
    return O.daily_attributes(rows, ["type", "grade"], numbers)


def _day_mode(c: str) -> str:
    return f"m_{c} AS (SELECT * FROM (SELECT outlet_id, event_date, {c} AS {c}_mode, count(*) AS {c}_mode_count, row_number() OVER (PARTITION BY outlet_id, event_date ORDER BY count(*) DESC, {c}) AS r FROM products GROUP BY outlet_id, event_date, {c}) WHERE r = 1)"


@query(ctes("products") + f", {_day_mode('quantity')}, {_day_mode('maker')}, t AS (SELECT outlet_id, event_date, CAST(sum(amount) AS BIGINT) AS cash_flow, " + ", ".join(
    f"coalesce(sum(amount) FILTER (product = '{p}'), 0)::DOUBLE / nullif(sum(amount)::DOUBLE, 0) AS share_{p.lower()}" for p in ("PROMO", "ECONOMY")) + " FROM products GROUP BY ALL) SELECT t.*, quantity_mode, quantity_mode_count, maker_mode, maker_mode_count FROM t LEFT JOIN m_quantity USING (outlet_id, event_date) LEFT JOIN m_maker USING (outlet_id, event_date)")
def o11_daily_modes(spark, d):
    return O.daily_modes(products(spark, d).withColumn("part", F.col("product")), ["quantity", "maker"], ["PROMO", "ECONOMY"])


KINDS = ["k0", "k1", "k2"]


@query(ctes("outlets", "products") + f""", a AS (SELECT o.*, 'k' || o.outlet_id % 3 AS kind, coalesce((SELECT sum(amount) FROM products p WHERE p.outlet_id = o.outlet_id), 0) AS amount FROM outlets o),
near AS (SELECT x.outlet_id, y.kind, y.amount, {haversine_sql('x.lat', 'x.lon', 'y.lat', 'y.lon')} AS distance FROM a x, a y) SELECT outlet_id, """ + ", ".join(
    f"count(*) FILTER (kind = '{k}' AND distance <= {r}) AS {k}_{r}m, CAST(coalesce(sum(amount) FILTER (kind = '{k}' AND distance <= {r}), 0) AS BIGINT) AS {k}_amount_{r}m" for k in KINDS for r in O.RADII) + " FROM near WHERE distance <= 5000 GROUP BY 1")
def o16_outlets_by_kind(spark, d):
    sold = products(spark, d).groupBy("outlet_id").agg(F.sum("amount").alias("amount"))
    rows = outlets(spark, d).join(sold, "outlet_id", "left").fillna(0, ["amount"])
    return O.outlets_by_kind(rows.withColumn("kind", F.concat(F.lit("k"), F.pmod("outlet_id", F.lit(3)).cast("string"))), KINDS)
