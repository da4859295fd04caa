"""Synthetic dirty order lines, generated by Spark (no driver-side rows).

Every random draw is a hash of (line identity, draw name, seed) mapped to
[0, 1), so the output is identical for any partitioning and any number of
executors, and a lost task regenerates exactly its own rows.

Shape: orders of 1–5 lines sharing an id drawn from [10000, 1010000]; one
facility per line out of 10 cities × 30; 90 % of lines forced to "Coffee",
the rest uniform over the menu; a time uniform over 365 days from
2024-01-01; one draw decides NULL facility (5 %), NULL item (3 %) or NULL id
(2 %); lat and lng are each replaced by the sentinel with 5 %; facility
coordinates are the city centre jittered by ±0.01.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ordered import cumulative_sums

# Cities (name, country, centre lat, centre lng) and menu (item, price).
CITIES = [
    ("Moscow", "Russia", 55.7558, 37.6173),
    ("Saint Petersburg", "Russia", 59.9311, 30.3609),
    ("Novosibirsk", "Russia", 55.0084, 82.9357),
    ("Yekaterinburg", "Russia", 56.8389, 60.6057),
    ("Kazan", "Russia", 55.7963, 49.1088),
    ("Nizhny Novgorod", "Russia", 56.2965, 43.9361),
    ("Chelyabinsk", "Russia", 55.1644, 61.4368),
    ("Samara", "Russia", 53.1959, 50.1008),
    ("Rostov-on-Don", "Russia", 47.2357, 39.7015),
    ("Ufa", "Russia", 54.7388, 55.9721),
]
MENU = [
    ("Pizza", 450), ("Tea", 120), ("Apple Juice", 180), ("Burger", 350),
    ("Salad", 250), ("Soup", 220), ("Pasta", 390), ("Cake", 400),
    ("Coffee", 200), ("Ice Cream", 160),
]
FACILITIES_PER_CITY = 30
ORDER_ID_MIN, ORDER_ID_MAX = 10_000, 1_010_000
START = "2024-01-01 00:00:00"
SECONDS_IN_YEAR = 365 * 24 * 3600
SENTINEL = -999.999

_TWO53 = float(2 ** 53)


def uniform(*cols: Column, draw: str, seed: int) -> Column:
    """Deterministic U[0, 1) from a hash of ``cols``, the draw name and seed."""
    h = F.xxhash64(*cols, F.lit(draw), F.lit(seed))
    return F.pmod(h, F.lit(2 ** 53)).cast("double") / F.lit(_TWO53)


def facilities(spark: SparkSession, seed: int = 42) -> DataFrame:
    """The 300 facilities (a fixed-size table)."""
    n = len(CITIES) * FACILITIES_PER_CITY
    ci = (F.col("id") / FACILITIES_PER_CITY).cast("int")
    pick = lambda k: F.element_at(F.array(*[F.lit(c[k]) for c in CITIES]), ci + 1)
    return spark.range(n).select(
        F.col("id").cast("int").alias("facility_idx"),
        pick(0).alias("city"), pick(1).alias("country"),
        F.concat(F.lit("Cafe "), pick(0), F.lit(" "),
                 (F.col("id") % FACILITIES_PER_CITY + 1).cast("string")).alias("facility_name"),
        (pick(2) + uniform(F.col("id"), draw="lat", seed=seed) * 0.02 - 0.01).alias("f_lat"),
        (pick(3) + uniform(F.col("id"), draw="lng", seed=seed) * 0.02 - 0.01).alias("f_lng"))


def generate_orders(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` order lines (schema of the raw order CSV).

    Orders get their sizes first; a distributed running total of sizes
    gives every order its first line number, and lines past ``rows`` are
    dropped, so the count is exact without a driver loop."""
    n_orders = int(math.ceil(rows / 3.0 * 1.1)) + 16
    orders = spark.range(n_orders).select(
        F.col("id").alias("order_seq"),
        (F.lit(ORDER_ID_MIN) + F.floor(uniform(F.col("id"), draw="oid", seed=seed) *
                                       (ORDER_ID_MAX - ORDER_ID_MIN + 1))).cast("long").alias("order_id"),
        (F.lit(1) + F.floor(uniform(F.col("id"), draw="n", seed=seed) * 5)).cast("long").alias("n_items"))
    orders = cumulative_sums(orders, [F.col("order_seq").asc()], ["n_items"])
    first_line = F.col("cum_n_items") - F.col("n_items")
    lines = (orders.filter(first_line < rows)
             .select("order_id", first_line.alias("first_line"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_items") - 1)).alias("k"))
             .withColumn("line", F.col("first_line") + F.col("k"))
             .filter(F.col("line") < rows))
    return dirty_lines(lines, seed)


def dirty_lines(lines: DataFrame, seed: int = 42) -> DataFrame:
    """A drawn order line (schema of the raw order CSV) for every row of
    ``lines`` (order_id, line): facility, item, time and dirt are hash draws
    of ``line``, so equal rows get equal lines whatever the partitioning."""
    spark = lines.sparkSession
    u = lambda name: uniform(F.col("line"), draw=name, seed=seed)
    n_fac = len(CITIES) * FACILITIES_PER_CITY
    menu_item = F.element_at(F.array(*[F.lit(m[0]) for m in MENU]), (F.floor(u("menu") * len(MENU)) + 1).cast("int"))
    menu_price = F.element_at(F.array(*[F.lit(m[1]) for m in MENU]), (F.floor(u("menu") * len(MENU)) + 1).cast("int"))
    forced = u("forced") >= 0.1
    lines = lines.select(
        "order_id", "line",
        F.floor(u("facility") * n_fac).cast("int").alias("facility_idx"),
        F.when(forced, F.lit("Coffee")).otherwise(menu_item).alias("item"),
        F.when(forced, F.lit(200)).otherwise(menu_price).alias("price"),
        F.floor(u("dt") * (SECONDS_IN_YEAR + 1)).cast("long").alias("secs"),
        u("dirty").alias("dirty"), u("lat_bad").alias("lat_bad"), u("lng_bad").alias("lng_bad"))
    # 300 rows by construction: a broadcast with a fixed bound
    j = lines.join(F.broadcast(facilities(spark, seed)), "facility_idx")
    dt = F.timestamp_add("SECOND", F.col("secs"), F.lit(START).cast("timestamp_ntz"))
    d = F.col("dirty")
    return j.select(
        F.when((d >= 0.08) & (d < 0.10), F.lit(None)).otherwise(F.col("order_id")).cast("long").alias("Order_id"),
        "city", "country",
        F.when(d < 0.05, F.lit(None)).otherwise(F.col("facility_name")).alias("facility_name"),
        F.when(F.col("lat_bad") < 0.05, F.lit(SENTINEL)).otherwise(F.col("f_lat")).alias("lat"),
        F.when(F.col("lng_bad") < 0.05, F.lit(SENTINEL)).otherwise(F.col("f_lng")).alias("lng"),
        F.when((d >= 0.05) & (d < 0.08), F.lit(None)).otherwise(F.col("item")).alias("menu_item"),
        F.col("price").cast("int").alias("price"),
        F.date_format(dt, "yyyy-MM-dd HH:mm:ss").alias("datetime"))
