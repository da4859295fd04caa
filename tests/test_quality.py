"""Quality split: every fixture row from FIXTURES.md §2 lands on exactly one side."""

from pyspark.sql import functions as F

from quarry.operators import quality as Q

RAW = "Order_id string, city string, country string, facility_name string, lat string, lng string, " \
      "menu_item string, price string, datetime string"

ROWS = [
    ("1", "Kazan", "Russia", "Cafe 1", "55.1", "49.1", "Tea", "120", "2024-02-29 10:00:00"),   # clean
    ("2", "Kazan", "Russia", "Cafe 1", "-999.999", "49.1", "Tea", "120", "2024-01-01 00:00:00"),
    ("3", "Kazan", "Russia", "Cafe 1", "55.1", "-999.999", "Tea", "120", "2024-01-01 00:00:00"),
    ("4", "Kazan", "Russia", None, "55.1", "49.1", "Tea", "120", "2024-01-01 00:00:00"),
    ("5", "Kazan", "Russia", "Cafe 1", "55.1", "49.1", None, "120", "2024-01-01 00:00:00"),
    (None, "Kazan", "Russia", "Cafe 1", "55.1", "49.1", "Tea", "120", "2024-01-01 00:00:00"),
    ("7", "Kazan", "Russia", "Cafe 1", "not-a-number", "49.1", "Tea", "120", "2024-01-01 00:00:00"),
    ("8", "Kazan", "Russia", "Cafe 1", "55.1", "49.1", "Tea", "120", "yesterday"),
    ("9", "Kazan", "Russia", None, "-999.999", "49.1", "Tea", "120", "2024-01-01 00:00:00"),
]


def test_total_split_with_reasons(spark):
    typed = Q.parse_orders(spark.createDataFrame(ROWS, RAW))
    sp = Q.split_by_rules(typed, Q.order_rules())
    good = {r.Order_id for r in sp["good"].collect()}
    bad = {r.Order_id: r.reject_reason for r in sp["bad"].collect()}
    assert good == {1}
    assert len(good) + len(bad) == len(ROWS)
    assert bad[2] == ["lat_sentinel"] and bad[3] == ["lng_sentinel"]
    assert bad[4] == ["facility_missing"] and bad[5] == ["item_missing"]
    assert bad[None] == ["id_missing"]
    assert bad[7] == ["lat_sentinel:unknown"]          # NULL lat: unknown predicate, still rejected
    assert bad[8] == ["datetime_invalid"]
    assert bad[9] == ["lat_sentinel", "facility_missing"]


def test_reference_rule_set_without_datetime(spark):
    typed = Q.parse_orders(spark.createDataFrame(ROWS, RAW))
    sp = Q.split_by_rules(typed, Q.order_rules(check_datetime=False))
    assert {r.Order_id for r in sp["good"].collect()} == {1, 8}


def test_case_insensitive_id_column(spark):
    df = spark.createDataFrame([("11", "x", "y", "f", "1", "2", "Tea", "1", "2024-01-01 00:00:00")],
                               RAW.replace("Order_id", "order_id"))
    assert Q.parse_orders(df).first().Order_id == 11


def test_null_profile_single_pass(spark):
    typed = Q.parse_orders(spark.createDataFrame(ROWS, RAW))
    prof = {r.column_name: r.null_count for r in Q.null_profile(typed).collect()}
    assert prof["facility_name"] == 2 and prof["lat"] == 1 and prof["datetime"] == 1 and prof["city"] == 0
    from quarry.plans.inspect import plan_text
    assert plan_text(Q.null_profile(typed), "simple").count("HashAggregate") <= 2


def test_keep_present_and_dropna(spark):
    df = spark.createDataFrame([(1, "US"), (2, None), (3, "NULL"), (4, "")], "id int, country string")
    assert [r.id for r in Q.keep_present(df, "country").collect()] == [1]
    assert Q.drop_incomplete(df).count() == 3
