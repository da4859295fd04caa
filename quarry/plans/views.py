"""Pipeline-shaped inputs derived from the driver tables.

The jobs this library rebuilds read inputs the driver does not ship (a
dirty order CSV, a detection event log, a user sign-up stream, four ML
CSVs). Each function here derives such an input from the driver tables
with plain Spark expressions, so every query's work grows with the tables.
All derivations are deterministic arithmetic, so an independent SQL engine
can rebuild the same rows (see ``quarry.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.features import SKILL_KEYWORDS
from quarry.sources.tables import load_table

# Fixed values of the derivations (shared with the SQL oracle).
SENTINEL = -999.999
EPOCH = "2024-01-01 00:00:00"
VIDEO_FPS = [24.0, 25.0, 30.0, 0.0]       # fps by pmod(user_id, 4); 0 → default 30
FRAME_WIDTH, FRAME_HEIGHT = 640, 480
BOX_SIDE = 32
MEASURES = [f"m{i}" for i in range(64)]   # the components of an embedding


#: Tables to deal out by a key before the derivation. None by default: a
#: scan of many files is spread already, and dealing it out would shuffle the
#: whole input. ``bench.py`` sets keys, as its tables are single row groups.
DEAL_BY: dict[str, str] = {}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    t = load_table(spark, d, name)
    return t.repartition(DEAL_BY[name]) if name in DEAL_BY else t


def event_log(spark: SparkSession, d: str) -> DataFrame:
    """Event log for the streak job: key ``user_id``, time ``ts``,
    state ``broken`` (a hit) for clicks and ``whole`` otherwise."""
    ev = _t(spark, d, "events")
    return ev.select(
        "user_id", "ts", "event_id",
        F.when(F.col("event_type") == "click", F.lit("broken"))
         .otherwise(F.lit("whole")).alias("state"))


def dirty_orders(spark: SparkSession, d: str, one_year: bool = False) -> DataFrame:
    """Raw order lines as the CSV reader sees them (every column a string).
    ``one_year`` puts all ship dates into the 365 days of 1997 (all rows
    stay): the cleaning job's own input is one year of orders.

    lineitem ⋈ supplier ⋈ nation ⋈ region ⋈ part; dirt is injected by
    arithmetic on the keys so it is reproducible in any engine."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                         "l_linenumber", "l_shipdate")
    su = _t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = _t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    re = _t(spark, d, "region").select("r_regionkey", "r_name")
    pa = _t(spark, d, "part").select("p_partkey", "p_type", "p_retailprice")
    # nation (25 rows) and region (5 rows) are fixed-size by the TPC-H
    # spec; supplier and part grow with the data and are left to AQE.
    geo = na.join(F.broadcast(re), na.n_regionkey == re.r_regionkey)
    j = (li.join(su, li.l_suppkey == su.s_suppkey)
           .join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"))
           .join(pa, li.l_partkey == pa.p_partkey))
    dirt = (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber")) % 100
    lat = F.when((F.col("l_suppkey") * 13 + F.col("l_orderkey")) % 20 == 0, F.lit(SENTINEL)) \
        .otherwise(F.col("s_suppkey") * F.lit(0.01))
    lng = F.when((F.col("l_partkey") * 11 + F.col("l_orderkey")) % 20 == 0, F.lit(SENTINEL)) \
        .otherwise(F.col("s_suppkey") * F.lit(0.02))
    day = F.col("l_shipdate")
    if one_year:
        day = F.date_add(F.lit("1997-01-01").cast("date"), F.pmod(F.dayofyear("l_shipdate") - 1, F.lit(365)))
    return j.select(
        F.when(dirt.between(8, 9), F.lit(None)).otherwise(F.col("l_orderkey").cast("string")).alias("Order_id"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.when(dirt < 5, F.lit(None)).otherwise(F.col("s_name")).alias("facility_name"),
        lat.cast("string").alias("lat"),
        lng.cast("string").alias("lng"),
        F.when(dirt.between(5, 7), F.lit(None)).otherwise(F.col("p_type")).alias("menu_item"),
        F.floor("p_retailprice").cast("string").alias("price"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("datetime"),
    )


def _frame_idx() -> F.Column:
    return F.expr(f"timestampdiff(HOUR, TIMESTAMP_NTZ'{EPOCH}', ts)")


def _video_file() -> F.Column:
    return F.concat(F.lit("video_"), F.col("user_id").cast("string"), F.lit(".MP4"))


def videos(spark: SparkSession, d: str) -> DataFrame:
    """One video per user: fps from a fixed list, total_frames = last
    event hour + 1, fixed frame size."""
    ev = _t(spark, d, "events").select("user_id", "ts")
    fps = F.element_at(F.array(*[F.lit(x) for x in VIDEO_FPS]),
                       (F.pmod(F.col("user_id"), F.lit(len(VIDEO_FPS))) + 1).cast("int"))
    return (ev.groupBy("user_id").agg((F.max(_frame_idx()) + 1).cast("int").alias("total_frames"))
              .select(_video_file().alias("video_file"), fps.alias("fps"),
                      "total_frames",
                      F.lit(FRAME_WIDTH).alias("width"), F.lit(FRAME_HEIGHT).alias("height")))


def detections(spark: SparkSession, d: str) -> DataFrame:
    """Detector output stand-in: one box per event, frame = event hour."""
    ev = _t(spark, d, "events")
    x1 = (F.col("event_id") % 600).cast("double")
    y1 = (F.col("event_id") % 400).cast("double")
    return ev.select(
        _video_file().alias("video_file"),
        _frame_idx().cast("int").alias("frame_idx"),
        F.col("event_id").alias("det_idx"),
        F.when(F.col("event_type") == "click", 1)
         .when(F.col("event_type") == "view", 0).otherwise(9).alias("cls"),
        (F.col("value") / 500.0).alias("conf"),
        x1.alias("x1"), y1.alias("y1"),
        (x1 + BOX_SIDE).alias("x2"), (y1 + BOX_SIDE).alias("y2"))


def clicks(spark: SparkSession, d: str) -> DataFrame:
    """Annotation clicks: one per click event, point = box centre."""
    det = detections(spark, d).filter(F.col("cls") == 1)
    return det.select("video_file", "frame_idx",
                      F.lit(FRAME_WIDTH).alias("width"), F.lit(FRAME_HEIGHT).alias("height"),
                      (F.col("x1") + BOX_SIDE // 2).cast("int").alias("cx"),
                      (F.col("y1") + BOX_SIDE // 2 + 60).cast("int").alias("cy"),
                      F.lit(1).alias("cls"))


def _email_of(name: F.Column) -> F.Column:
    return F.concat(F.lower(F.regexp_replace(name, "#", "")), F.lit("@example.com"))


def user_events(spark: SparkSession, d: str) -> DataFrame:
    """Sign-up records as the web API writes them (all strings) plus
    ``seq``, the arrival order (stand-in for a topic offset)."""
    ev = _t(spark, d, "events").select("event_id", "user_id", "ts")
    cu = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    na = _t(spark, d, "nation").select("n_nationkey", "n_name")
    j = (ev.join(cu, ev.user_id == cu.c_custkey)
           .join(F.broadcast(na), F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(
        F.col("user_id").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        _email_of(F.col("c_name")).alias("email"),
        F.col("n_name").alias("country"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
        F.col("event_id").alias("seq"))


def users_existing(spark: SparkSession, d: str) -> DataFrame:
    cu = _t(spark, d, "customer")
    na = _t(spark, d, "nation").select("n_nationkey", "n_name")
    return (cu.filter(F.col("c_acctbal") > 0)
              .join(F.broadcast(na), F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.col("c_custkey").cast("string").alias("id"),
                      F.col("c_name").alias("name"), _email_of(F.col("c_name")).alias("email"),
                      F.col("n_name").alias("country")))


def users_incoming(spark: SparkSession, d: str) -> DataFrame:
    """A sign-up batch: e-mail of customer ``c_custkey div 2`` (so pairs
    collide inside the batch and many collide with existing users);
    negative balances carry a malformed address."""
    cu = _t(spark, d, "customer")
    na = _t(spark, d, "nation").select("n_nationkey", "n_name")
    local = F.concat(F.lit("customer"), F.lpad((F.col("c_custkey") / 2).cast("long").cast("string"), 9, "0"))
    email = F.when(F.col("c_acctbal") < 0, F.concat(local, F.lit(".example.com"))) \
        .otherwise(F.concat(local, F.lit("@example.com")))
    return (cu.join(F.broadcast(na), F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("name"),
                      email.alias("email"), F.col("n_name").alias("country")))


def iris(spark: SparkSession, d: str) -> DataFrame:
    em = _t(spark, d, "embeddings")
    return em.select(F.col("vec_id").alias("row_id"),
                     *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(MEASURES)],
                     F.concat(F.lit("class_"), F.col("label").cast("string")).alias("Species"))


def bike_stations(spark: SparkSession, d: str) -> DataFrame:
    pa = _t(spark, d, "part")
    return pa.select(F.col("p_partkey").alias("row_id"),
                     (F.lit(20.0) + F.col("p_size") * F.lit(0.01)).alias("latitude"),
                     (F.lit(-103.0) - (F.col("p_partkey") % 50) * F.lit(0.01)).alias("longitude"),
                     F.col("p_type").alias("status"), F.col("p_brand").alias("location"))


def job_postings(spark: SparkSession, d: str) -> DataFrame:
    """Documents as job postings: title = whole text, a skill word after
    every third one; ``is_hourly`` is NULL for unlabelled documents."""
    do = _t(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    la = _t(spark, d, "labels").select("doc_id", "quality")
    skill = F.element_at(F.array(*[F.lit(k) for k in SKILL_KEYWORDS]),
                         (F.col("doc_id") % len(SKILL_KEYWORDS) + 1).cast("int"))
    title = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" "), skill)).otherwise(F.col("text"))
    country = F.when(F.col("lang") == "de", F.lit("NULL")) \
        .when(F.col("lang") == "es", F.lit("")).otherwise(F.upper("lang"))
    return (do.join(la, "doc_id", "left")
              .select("doc_id", title.alias("title"), country.alias("country"),
                      F.col("source").alias("payment_type"),
                      F.when(F.col("quality") == 1, F.lit("True")).when(F.col("quality") == 0, F.lit("False"))
                       .alias("is_hourly"),
                      F.col("n_chars").cast("double").alias("budget_clean"),
                      (F.length("text") / F.lit(100.0)).alias("hourly_rate")))


def used_cars(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                         "l_extendedprice", "l_linestatus", "l_returnflag", "l_shipdate")
    pa = _t(spark, d, "part").select("p_partkey", "p_type")
    return (li.join(pa, li.l_partkey == pa.p_partkey)
              .select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
                      F.col("l_extendedprice").alias("Price"), F.col("l_quantity").alias("Mileage"),
                      F.year("l_shipdate").alias("Year"), F.col("p_type").alias("Body Type"),
                      F.col("l_linestatus").alias("Fuel Type"), F.col("l_returnflag").alias("Condition")))
