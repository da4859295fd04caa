"""3NF, star schema and documents: properties on FIXTURES.md §2 rows."""

from datetime import datetime

from pyspark.sql import functions as F

from quarry.operators import modeling as M

SCHEMA = "Order_id long, city string, country string, facility_name string, lat double, lng double, " \
         "menu_item string, price int, datetime timestamp_ntz"

ROWS = [
    (1, "Springfield", "A", "Cafe S", 1.0, 2.0, "Tea", 120, datetime(2024, 2, 29, 9)),
    (1, "Springfield", "A", "Cafe S", 1.0, 2.0, "Tea", 120, datetime(2024, 2, 29, 9)),   # repeated line
    (2, "Springfield", "B", "Cafe S", 5.0, 6.0, "Cake", 400, datetime(2024, 3, 1, 9)),  # same city, other country
    (3, "Kazan", "Russia", "Cafe K", 7.0, 8.0, "Tea", 130, datetime(2024, 3, 2, 9)),    # Tea at 2nd price
    (4, "Kazan", "Russia", "Cafe K", 7.5, 8.5, "Coffee", 200, datetime(2024, 3, 2, 10)),  # 2nd coordinate
    (4, "Kazan", "Russia", "Cafe Z", 9.0, 9.0, "Coffee", 200, datetime(2024, 3, 2, 11)),  # order over 2 facilities
]


def _df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_assign_keys_consecutive_and_stable(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    for n in (1, 4, 7):
        keyed = M.assign_keys(df.repartition(n), ["k"], "key")
        rows = sorted((r.k, r.key) for r in keyed.collect())
        assert rows == [(k, k + 1) for k in range(1000)]


def test_star_no_fanout_and_unique_keys(spark):
    star = M.to_star(_df(spark))
    assert star["fact_sales"].count() == len(ROWS)
    cities = star["dim_city"].collect()
    assert len(cities) == 3 and sorted(r.city_key for r in cities) == [1, 2, 3]
    fac = star["dim_facility"].collect()
    assert len({(r.facility_name, r.city_key) for r in fac}) == len(fac) == 4
    kazan = [r for r in fac if r.facility_name == "Cafe K"][0]
    assert (kazan.lat, kazan.lng) == (7.0, 8.0)         # min of the two coordinates
    dates = {r.date_key for r in star["dim_date"].collect()}
    assert 20240229 in dates
    M.assert_unique(star["dim_menu"], ["menu_key"])
    # referential completeness
    f = star["fact_sales"]
    assert f.join(star["dim_facility"], "facility_key", "left_anti").count() == 0


def test_unknown_member_mode(spark):
    df = _df(spark).unionByName(spark.createDataFrame(
        [(9, "Nowhere", "X", None, 0.0, 0.0, "Tea", 1, datetime(2024, 1, 1))], SCHEMA))
    star = M.to_star(df, fact_mode="unknown_member")
    f = star["fact_sales"]
    assert f.count() == len(ROWS) + 1
    assert f.filter("order_id = 9").first().facility_key == -1


def test_3nf_shapes(spark):
    nf = M.to_3nf(_df(spark))
    assert nf["cities"].count() == 3
    assert nf["menu_items"].count() == 4
    items = nf["order_items"].collect()
    assert len(items) == len(ROWS) and sorted(r.order_item_id for r in items) == list(range(1, 7))
    assert M.to_3nf(_df(spark), dedupe_items=True)["order_items"].count() == 4


def test_documents_totals_and_grouping(spark):
    docs = M.to_documents(_df(spark)).collect()
    o4 = [d for d in docs if d._id == 4]
    assert len(o4) == 2                                  # grouped by facility too
    one = M.to_documents(_df(spark), unique_id=True).collect()
    d4 = [d for d in one if d._id == 4][0]
    assert d4.order_total == 400 and len(d4["items"]) == 2
    assert sum(d.order_total for d in one) == sum(r[7] for r in ROWS)


def test_one_document_for_any_group_size(spark):
    lines = spark.range(0, 100_001).select(F.lit(7).cast("long").alias("Order_id"),
                                           F.lit("c").alias("city"), F.lit("x").alias("country"),
                                           F.lit("f").alias("facility_name"), F.lit(1.0).alias("lat"),
                                           F.lit(1.0).alias("lng"), F.concat(F.lit("i"), F.col("id").cast("string")).alias("menu_item"),
                                           F.lit(1).alias("price"), F.lit(datetime(2024, 1, 1)).alias("datetime"))
    docs = M.to_documents(lines).select("_id", "order_total", F.size("items").alias("n")).collect()
    assert [(d._id, d.order_total, d.n) for d in docs] == [(7, 100_001, 100_001)]


def test_facility_coordinates_come_from_one_row(spark):
    rows = [(1, "c", "x", "f", 1.0, 9.0, "m", 1, datetime(2024, 1, 1)), (2, "c", "x", "f", 5.0, 2.0, "m", 1, datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "Order_id long, city string, country string, facility_name string, lat double, "
                                     "lng double, menu_item string, price int, datetime timestamp")
    fac = M.to_star(df)["dim_facility"].collect()
    assert [(r.lat, r.lng) for r in fac] == [(1.0, 9.0)]


def test_assign_keys_distributed(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3000).alias("k"))
    for n in (1, 5):
        keyed = M.assign_keys(df.repartition(n), ["k"], "key")
        assert sorted((r.k, r.key) for r in keyed.collect()) == [(k, k + 1) for k in range(3000)]


def test_descending_text_order(spark):
    from quarry.operators.aggregates import ordered
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "t string")
    got = {r.t: r.pos for r in ordered(df, ["-t"]).collect()}
    assert got == {"c": 1, "b": 2, "a": 3, None: 4}


def test_hash_keys_checked_for_collisions(spark):
    import pytest
    df = spark.range(0, 500).select(F.col("id").cast("string").alias("k"))
    keyed = M.assign_keys(df, ["k"], "key", mode="hash")
    assert keyed.select("key").distinct().count() == 500
    # force a collision: a key column that ignores the natural key
    with pytest.raises(AssertionError):
        M.assert_no_collisions(df.withColumn("key", F.lit(1)), "key", ["k"])


def test_3nf_numbers_lines_only_when_asked(spark, monkeypatch):
    calls, real = [], M.assign_keys
    monkeypatch.setattr(M, "assign_keys", lambda *a, **k: calls.append(a[2]) or real(*a, **k))
    nf = M.to_3nf(_df(spark))
    assert nf["orders"].count() == 5 and nf["cities"].count() == 3 and calls == []
    assert list(nf) == ["cities", "facilities", "menu_items", "orders", "order_items"]
    assert nf["order_items"].count() == len(ROWS) and nf["order_items"] is nf["order_items"]
    assert calls == ["order_item_id"]


def test_star_lines_are_not_shuffled_by_small_dimensions(spark, monkeypatch):
    def joins(df):
        plan = M.to_star(df)["fact_sales"]._jdf.queryExecution().sparkPlan().toString()
        return plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")

    df = _df(spark)
    few = M.to_star(df)["fact_sales"].collect()
    assert joins(df)[1] <= 1                            # at most the facility's own city key
    monkeypatch.setattr(M, "BROADCAST_BYTES", 1)
    assert joins(df)[1] >= 3
    assert sorted(map(str, M.to_star(df)["fact_sales"].collect())) == sorted(map(str, few))


def test_star_members_are_found_by_hashing(spark, monkeypatch):
    plans, real = [], M.materialize
    monkeypatch.setattr(M, "materialize", lambda t: plans.append(t._jdf.queryExecution().sparkPlan().toString()) or real(t))
    far = spark.createDataFrame([(7, "Kazan", "Russia", "Cafe K", 7.0, None, "Tea", 1, datetime(2024, 3, 2))], SCHEMA)
    fac = [r for r in M.to_star(_df(spark).unionByName(far))["dim_facility"].collect() if r.facility_name == "Cafe K"]
    assert [(r.lat, r.lng) for r in fac] == [(7.0, None)]  # still the least pair, null first
    assert "SortAggregate" not in plans[0] and "HashAggregate" in plans[0]
