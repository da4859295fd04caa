"""Generator: exact size, determinism, distribution shares."""

from pyspark.sql import functions as F

from quarry.operators import generate as G
from quarry.operators import quality as Q


def test_generator_exact_and_deterministic(spark):
    a = G.generate_orders(spark, 5000, seed=7)
    assert a.count() == 5000
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    b = G.generate_orders(spark, 5000, seed=7)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_generator_shares(spark):
    g = G.generate_orders(spark, 40000, seed=42)
    typed = Q.parse_orders(g.select(*[F.col(c).cast("string") for c in g.columns]))
    sp = Q.split_by_rules(typed, Q.order_rules())
    bad = sp["bad"].count() / 40000
    assert abs(bad - (1 - 0.90 * 0.95 ** 2)) < 0.01       # 18.775 % expected
    s = g.agg(F.avg((F.col("menu_item") == "Coffee").cast("double")).alias("c"),
              F.countDistinct("facility_name").alias("f"), F.min("datetime").alias("lo"),
              F.max("datetime").alias("hi")).first()
    assert abs(s.c - 0.91) < 0.01 and s.f == 300
    assert s.lo >= "2024-01-01" and s.hi <= "2024-12-31 00:00:00"
    sizes = g.groupBy("Order_id").count().agg(F.max("count")).first()[0]
    assert sizes >= 5
