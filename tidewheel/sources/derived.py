"""Operator-like inputs derived from the star-schema tables by Spark, so that queries grow with the tables given.

``SQL`` holds the same derivations as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.timekeys import next_week_start


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily usage records from events: a user is a subscriber, an event's type its kind, its value an amount."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("msisdn"),
        F.to_date("ts").alias("event_date"),
        next_week_start("ts").alias("weekstart"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("kind"),
        F.floor(F.col("value") * 100).cast("long").alias("amount"),
        "event_id",
        F.concat(F.lit("n"), F.pmod("event_id", F.lit(50)).cast("string")).alias("party"),
    )


def revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue records from orders, amounts in cents."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("msisdn"),
        F.to_date("o_orderdate").alias("event_date"),
        next_week_start("o_orderdate").alias("weekstart"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("amount"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("trx_id"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product purchases from line items and parts."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return joined.select(
        F.col("o_custkey").cast("string").alias("msisdn"),
        F.to_date("l_shipdate").alias("event_date"),
        next_week_start("l_shipdate").alias("weekstart"),
        F.col("p_type").alias("product"),
        F.col("p_brand").alias("maker"),
        F.col("p_size").cast("long").alias("validity"),
        F.when(F.pmod("l_orderkey", F.lit(3)) == 0, "Days").when(F.pmod("l_orderkey", F.lit(3)) == 1, "Hours").otherwise("Weeks").alias("validity_unit"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trx_id"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("amount"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_suppkey").alias("outlet_id"),
    )


def _placed(df: DataFrame, key: str) -> DataFrame:
    """A third of the rows within some two kilometres, the others spread over one degree."""
    width = F.when(F.pmod(key, F.lit(3)) == 0, 50_000).otherwise(1_000)
    lat = -6 + F.pmod(F.col(key) * 37, F.lit(1000)) / width
    lon = 106 + F.pmod(F.col(key) * 91, F.lit(1000)) / width
    return df.withColumns({"lat": lat.cast("double"), "lon": lon.cast("double")})


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _placed(table(spark, sf_dir, "supplier"), "s_suppkey")
    return s.select(F.col("s_suppkey").alias("outlet_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("district"), F.col("s_acctbal").alias("balance"), "lat", "lon")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of interest from parts."""
    p = _placed(table(spark, sf_dir, "part"), "p_partkey")
    return p.select(F.col("p_partkey").alias("poi_id"), F.col("p_type").alias("category"), F.col("p_size").cast("long").alias("weight"), F.col("lat").alias("poi_lat"), F.col("lon").alias("poi_lon"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").cast("string").alias("msisdn"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("area"), F.col("n_regionkey").alias("region"), F.round(F.col("c_acctbal") * 100).cast("long").alias("balance"))


_WEEK = "CAST({d} AS DATE) + CAST(8 - isodow(CAST({d} AS DATE)) AS INTEGER)"

SQL = {
    "usage": f"""usage AS (
  SELECT CAST(user_id AS VARCHAR) AS msisdn, CAST(ts AS DATE) AS event_date, {_WEEK.format(d="ts")} AS weekstart,
         CAST(extract(hour FROM ts) AS INTEGER) AS hour, event_type AS kind, CAST(floor(value * 100) AS BIGINT) AS amount, event_id,
         'n' || CAST(event_id % 50 AS VARCHAR) AS party FROM events)""",
    "revenue": f"""revenue AS (
  SELECT CAST(o_custkey AS VARCHAR) AS msisdn, CAST(o_orderdate AS DATE) AS event_date, {_WEEK.format(d="o_orderdate")} AS weekstart,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount, o_orderpriority AS channel, o_orderstatus AS status, o_orderkey AS trx_id FROM orders)""",
    "products": f"""products AS (
  SELECT CAST(o_custkey AS VARCHAR) AS msisdn, CAST(l_shipdate AS DATE) AS event_date, {_WEEK.format(d="l_shipdate")} AS weekstart,
         p_type AS product, p_brand AS maker, CAST(p_size AS BIGINT) AS validity,
         CASE l_orderkey % 3 WHEN 0 THEN 'Days' WHEN 1 THEN 'Hours' ELSE 'Weeks' END AS validity_unit,
         l_orderkey || '-' || l_linenumber AS trx_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
         CAST(l_quantity AS BIGINT) AS quantity, l_suppkey AS outlet_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)""",
    "outlets": """outlets AS (
  SELECT s_suppkey AS outlet_id, s_name AS name, s_nationkey AS district, s_acctbal AS balance,
         -6 + ((s_suppkey * 37) % 1000) / (CASE WHEN s_suppkey % 3 = 0 THEN 50000 ELSE 1000 END)::DOUBLE AS lat,
         106 + ((s_suppkey * 91) % 1000) / (CASE WHEN s_suppkey % 3 = 0 THEN 50000 ELSE 1000 END)::DOUBLE AS lon FROM supplier)""",
    "places": """places AS (
  SELECT p_partkey AS poi_id, p_type AS category, CAST(p_size AS BIGINT) AS weight,
         -6 + ((p_partkey * 37) % 1000) / (CASE WHEN p_partkey % 3 = 0 THEN 50000 ELSE 1000 END)::DOUBLE AS poi_lat,
         106 + ((p_partkey * 91) % 1000) / (CASE WHEN p_partkey % 3 = 0 THEN 50000 ELSE 1000 END)::DOUBLE AS poi_lon FROM part)""",
    "profiles": """profiles AS (
  SELECT CAST(c_custkey AS VARCHAR) AS msisdn, c_mktsegment AS segment, n_name AS area, n_regionkey AS region,
         CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
}


def ctes(*names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names)
