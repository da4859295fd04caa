"""The query catalog: one callable ``(spark, data_dir) -> DataFrame`` per
operator family. Result columns are flat and engine-neutral (timestamps as
text with microseconds, doubles rounded to 6 places) so the SQL twins in
``quarry.plans.oracle`` can be compared value by value."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.expressions import fmt_ts, r6
from quarry.operators import aggregates as A
from quarry.operators import detections as B
from quarry.operators import durable_keys as DK
from quarry.operators import evaluate as EV
from quarry.operators import features as FE
from quarry.operators import fits as FT
from quarry.operators import generate as G
from quarry.operators import heavy_hitters as HH
from quarry.operators import messages as MS
from quarry.operators import modeling as M
from quarry.operators import models as ML
from quarry.operators import quality as Q
from quarry.operators import runs as R
from quarry.operators import segments as SG
from quarry.operators import unique_index as UX
from quarry.plans import views as V
from quarry.session import checkpoint_dir
from quarry.sinks import files as SK
from quarry.sources import files as SR
from quarry.sources.tables import TABLES, load_table
from quarry.streaming import jobs as ST
from quarry.streaming import tables as TB

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- streaks
def _streak_report(spark, d, n=10):
    log = V.event_log(spark, d)
    return R.longest_streaks(log, key="user_id", order="ts",
                             hit=F.col("state") == "broken", n=n)


def _runs_out(df: DataFrame) -> DataFrame:
    return df.select("user_id", "grp", "run_id", F.col("streak_len").cast("long").alias("streak_len"),
                     fmt_ts("start_t").alias("start_t"), fmt_ts("end_t").alias("end_t"))


@query("streak_runs")
def streak_runs(spark, d):
    return _runs_out(_streak_report(spark, d)["runs"])


@query("streak_longest_per_key")
def streak_longest_per_key(spark, d):
    return _runs_out(_streak_report(spark, d)["per_key"])


@query("streak_topn")
def streak_topn(spark, d):
    top = _streak_report(spark, d, n=10)["topn"]
    w = Window.orderBy(F.desc("streak_len"), F.asc("user_id"), F.asc("start_t"), F.asc("run_id"))
    # window over the N result rows only
    return _runs_out(top).withColumn("pos", F.row_number().over(w).cast("long"))


@query("running_miss_count")
def running_miss_count(spark, d):
    log = V.event_log(spark, d)
    lab = R.running_miss_count(log, "user_id", "ts", F.col("state") == "broken", keep=["event_id"])
    return lab.select("user_id", "event_id", fmt_ts("ts").alias("ts"),
                      F.col("is_hit").cast("long").alias("is_hit"), "miss_cum")


# ---------------------------------------------------------------- quality


def _orders_typed(spark, d):
    return Q.parse_orders(V.dirty_orders(spark, d))


def _orders_out(df: DataFrame, *extra) -> DataFrame:
    return df.select(*extra, "Order_id", "city", "country", "facility_name", "lat", "lng", "menu_item",
                     F.col("price").cast("long").alias("price"),
                     fmt_ts("datetime").alias("datetime"),
                     F.date_format("date", "yyyy-MM-dd").alias("date"))


@query("typed_parse")
def typed_parse(spark, d):
    return _orders_out(_orders_typed(spark, d))


@query("clean_good")
def clean_good(spark, d):
    return _orders_out(Q.split_by_rules(_orders_typed(spark, d), Q.order_rules())["good"])


@query("clean_bad")
def clean_bad(spark, d):
    bad = Q.split_by_rules(_orders_typed(spark, d), Q.order_rules())["bad"]
    return _orders_out(bad, F.array_join("reject_reason", ";").alias("reject_reason"))


@query("clean_reason_counts")
def clean_reason_counts(spark, d):
    bad = Q.split_by_rules(_orders_typed(spark, d), Q.order_rules())["bad"]
    return Q.reason_counts(bad)


@query("null_profile")
def null_profile(spark, d):
    return Q.null_profile(_orders_typed(spark, d))


@query("dropna_rows")
def dropna_rows(spark, d):
    return _orders_out(Q.drop_incomplete(_orders_typed(spark, d)))


@query("missing_country_filter")
def missing_country_filter(spark, d):
    return Q.keep_present(V.job_postings(spark, d), "country").select("doc_id", "country")


# ---------------------------------------------------------------- modelling


def _good_lines(spark, d):
    return Q.split_by_rules(_orders_typed(spark, d), Q.order_rules())["good"]


def _nf(spark, d, name):
    return M.to_3nf(_good_lines(spark, d))[name]


@query("nf_cities")
def nf_cities(spark, d):
    return _nf(spark, d, "cities")


@query("nf_facilities")
def nf_facilities(spark, d):
    return _nf(spark, d, "facilities")


@query("nf_menu_items")
def nf_menu_items(spark, d):
    return _nf(spark, d, "menu_items").select("menu_item", F.col("price").cast("long").alias("price"))


@query("nf_orders")
def nf_orders(spark, d):
    o = _nf(spark, d, "orders")
    return o.select("order_id", fmt_ts("datetime").alias("datetime"), "facility_name", "city")


@query("nf_order_items")
def nf_order_items(spark, d):
    return _nf(spark, d, "order_items")


def _star(spark, d, name):
    return M.to_star(_good_lines(spark, d))[name]


@query("star_dim_date")
def star_dim_date(spark, d):
    t = _star(spark, d, "dim_date")
    return t.select(F.col("date_key").cast("long").alias("date_key"),
                    F.date_format("date", "yyyy-MM-dd").alias("date"),
                    *[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")])


@query("star_dim_city")
def star_dim_city(spark, d):
    return _star(spark, d, "dim_city")


@query("star_dim_facility")
def star_dim_facility(spark, d):
    return _star(spark, d, "dim_facility")


@query("star_dim_menu")
def star_dim_menu(spark, d):
    return _star(spark, d, "dim_menu")


@query("star_fact")
def star_fact(spark, d):
    f = _star(spark, d, "fact_sales")
    return f.select("order_id", fmt_ts("datetime").alias("datetime"),
                    F.col("date_key").cast("long").alias("date_key"), "city_key", "facility_key",
                    "menu_key", F.col("price").cast("long").alias("price"))


@query("durable_facility_keys")
def durable_facility_keys(spark, d):
    """Facility keys over three loads of orders, by ship month: a facility
    keeps the number of the load that brought it first. The facts' lines per
    key."""
    good = _good_lines(spark, d)
    held = DK.KeyDictionary(scratch(spark, "facility-keys"), ["facility_name", "city", "country"], "facility_key")
    third = F.pmod(F.col("Order_id"), F.lit(3))
    for k in range(3):
        held.load(good.filter((third == k) & ((F.col("Order_id") % 50 < 2) if k < 2 else F.lit(True))))
    lines = held.keyed(good)
    return lines.groupBy("facility_key", "facility_name", "city", "country").agg(F.count(F.lit(1)).alias("n_lines"))


@query("order_documents")
def order_documents(spark, d):
    return _documents_out(M.to_documents(_good_lines(spark, d)))


def _documents_out(docs):
    items = F.array_join(F.array_sort(F.transform(
        "items", lambda x: F.concat_ws(":", x["menu_item"], x["price"].cast("string")))), "|")
    facility = [c for c in ("city", "country", "facility_name", "lat", "lng") if c in docs.columns]
    return docs.select("_id", *facility, fmt_ts("datetime").alias("datetime"), "order_total", items.alias("items"))


# ---------------------------------------------------------------- detections


@query("frame_sample_plan")
def frame_sample_plan(spark, d):
    p = B.sample_plan(V.videos(spark, d))
    return p.select("video_file", F.col("frame_idx").cast("long").alias("frame_idx"),
                    r6("t_sec").alias("t_sec"), "step")


@query("best_detection")
def best_detection(spark, d):
    b = B.best_detection(V.detections(spark, d))
    return b.select("video_file", F.col("frame_idx").cast("long").alias("frame_idx"), "det_idx",
                    F.col("cls").cast("long").alias("cls"), r6("conf").alias("conf"),
                    r6("cx").alias("cx"), r6("cy").alias("cy"))


@query("detection_log")
def detection_log(spark, d):
    log = B.event_log(V.videos(spark, d), V.detections(spark, d))
    return log.select("video_file", F.col("frame_idx").cast("long").alias("frame_idx"), "t_sec",
                      "target_type", "x_rel", "y_rel", "state", "conf")


@query("bbox_labels")
def bbox_labels(spark, d):
    lb = B.box_labels(V.clicks(spark, d))
    parts = F.split("label_line", " ")
    return lb.select("name", "label_line",
                     *[parts[i + 1].cast("double").alias(c) for i, c in enumerate(("cx_n", "cy_n", "w_n", "h_n"))])


# ---------------------------------------------------------------- messages

_USER_COLS = ["id", "name", "email", "country", "created_at"]


def _messages(spark, d):
    return MS.to_messages(V.user_events(spark, d).select(*_USER_COLS, "seq"), "country",
                          value_cols=_USER_COLS)


@query("keyed_messages")
def keyed_messages(spark, d):
    m = _messages(spark, d)
    return m.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("decode_messages")
def decode_messages(spark, d):
    dec = MS.decode_messages(_messages(spark, d))["good"]
    return dec.select("msg_key", *_USER_COLS)


@query("latest_by_key")
def latest_by_key(spark, d):
    ue = V.user_events(spark, d)
    lt = MS.latest_by_key(ue, ["country", "id"], ["created_at", "seq"])
    return lt.select("country", "id", "name", "email", "created_at", "seq")


@query("minute_batches")
def minute_batches(spark, d):
    mb = MS.minute_batches(V.user_events(spark, d), "created_at")
    return mb.select(fmt_ts("batch_start").alias("batch_start"), fmt_ts("batch_end").alias("batch_end"),
                     "file_name", "n_records", fmt_ts("first_ts").alias("first_ts"),
                     fmt_ts("last_ts").alias("last_ts"))


@query("unique_append")
def unique_append(spark, d):
    res = MS.admission(V.users_existing(spark, d), V.users_incoming(spark, d))
    status = F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    return res.select("seq", "name", "email", "country", status.alias("status"), "reason")


@query("unique_append_indexed")
def unique_append_indexed(spark, d):
    """The sign-up batch against the stored users, by way of the table's
    Bloom index; the users were appended in two loads."""
    table = UX.UniqueTable(scratch(spark, "unique-users"), buckets=16, bits_per_bucket=1 << 16)
    old = V.users_existing(spark, d).withColumn("seq", F.col("id").cast("long")).select("seq", "name", "email", "country")
    for k in (0, 1):
        table.append(old.filter(F.col("seq") % 2 == k))
    res = table.admit(V.users_incoming(spark, d))
    status = F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    return res.select("seq", "name", "email", "country", status.alias("status"), "reason")


@query("user_lookup")
def user_lookup(spark, d):
    req = (V._t(spark, d, "events").filter(F.col("event_type") == "signup")
           .select(F.col("event_id").alias("request_id"), F.col("user_id").cast("string").alias("user_id")))
    res = MS.lookup(req, V.users_existing(spark, d), "user_id", "id")
    return res.select("request_id", "user_id", "name", "email", "country", "status")


# ------------------------------------------------------- categories / sorting
@query("category_counts")
def category_counts(spark, d):
    return A.category_counts(V.used_cars(spark, d), "Body Type", "Fuel Type") \
        .withColumnRenamed("Body Type", "body_type").withColumnRenamed("Fuel Type", "fuel_type")


@query("topk_category_filter")
def topk_category_filter(spark, d):
    cars = V.used_cars(spark, d)
    kept = A.filter_top_categories(cars, "Body Type", 5)
    return kept.select("row_id", F.col("Body Type").alias("body_type"), r6("Price").alias("price"))


@query("heavy_hitters")
def heavy_hitters(spark, d):
    """The 20 parts with the most lines, exact, most values ruled out by counters."""
    return HH.top_values(load_table(spark, d, "lineitem"), "l_partkey", 20)


@query("sorted_groups")
def sorted_groups(spark, d):
    prof = A.group_profile(V.used_cars(spark, d), "Condition", ["Price"])
    out = A.ordered(prof, ["-avg_Price", "Condition"])
    return out.select(F.col("Condition").alias("condition"), r6("avg_Price").alias("avg_price"),
                      "count", "pos")


# ---------------------------------------------------------------- ML features


_IRIS = V.MEASURES


@query("string_index")
def string_index(spark, d):
    cars = V.used_cars(spark, d)
    m = FE.string_indexer("Body Type", "label").fit(cars)
    return (m.transform(cars).select(F.col("Body Type").alias("body_type"),
                                     F.col("label").cast("long").alias("label")).distinct())


@query("standardize")
def standardize(spark, d):
    cars = V.used_cars(spark, d).withColumn("Year", F.col("Year").cast("double"))
    stages = [FE.assembler(["Price", "Mileage", "Year"], "raw_features"), FE.scaler("raw_features", "features")]
    out = ML.fit_stages(stages, cars).transform(cars)
    arr = vector_to_array_col("features")
    return out.select("row_id", *[F.round(arr[i], 6).alias(n)
                                  for i, n in enumerate(["z_price", "z_mileage", "z_year"])])


def vector_to_array_col(c):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(c))


@query("assembled_features")
def assembled_features(spark, d):
    iris = V.iris(spark, d)
    out = FE.assembler(_IRIS).transform(iris)
    arr = vector_to_array_col("features")
    return out.select("row_id", *[F.round(arr[i], 6).alias(f"f{i}") for i in range(len(_IRIS))])


def _jobs_clean(spark, d):
    return V.job_postings(spark, d).withColumn("clean_title", FE.clean_title(F.col("title")))


@query("clean_title")
def clean_title(spark, d):
    return _jobs_clean(spark, d).select("doc_id", "clean_title")


@query("keyword_flags")
def keyword_flags(spark, d):
    flagged = FE.keyword_flags(_jobs_clean(spark, d))
    return flagged.select("doc_id", *[f"has_{k}" for k in FE.SKILL_KEYWORDS])


def _words(spark, d):
    jobs = V.job_postings(spark, d)
    w = Tokenizer(inputCol="title", outputCol="words").transform(jobs)
    return StopWordsRemover(inputCol="words", outputCol="filtered_words").transform(w)


@query("tokens")
def tokens(spark, d):
    w = _words(spark, d)
    return w.select("doc_id", F.size("words").cast("long").alias("n_tokens"),
                    F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
                    F.array_join("words", "|").alias("words"))


@query("stopword_filter")
def stopword_filter(spark, d):
    w = _words(spark, d)
    return w.select("doc_id", F.size("filtered_words").cast("long").alias("n_kept"),
                    F.size(F.array_distinct("filtered_words")).cast("long").alias("n_kept_distinct"),
                    F.array_join("filtered_words", "|").alias("kept"))


@query("tfidf_terms")
def tfidf_terms(spark, d):
    t = FE.tfidf(_words(spark, d), "doc_id", "filtered_words")
    return t.select("doc_id", "term", "tf", "df", r6("idf").alias("idf"), r6("tfidf").alias("tfidf"))


@query("hashed_tf")
def hashed_tf(spark, d):
    from pyspark.ml.feature import HashingTF
    h = HashingTF(inputCol="filtered_words", outputCol="tf", numFeatures=1000).transform(_words(spark, d))
    arr = vector_to_array_col("tf")
    return h.select("doc_id", F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).cast("long").alias("total_tf"))


@query("hash_split")
def hash_split(spark, d):
    cars = V.used_cars(spark, d)
    parts = FE.hash_split(cars, F.col("row_id"))
    return (parts["train"].select("row_id", F.lit("train").alias("side"))
            .unionByName(parts["test"].select("row_id", F.lit("test").alias("side"))))


@query("center_distance")
def center_distance(spark, d):
    b = V.bike_stations(spark, d)
    return b.select("row_id", r6(FE.distance_from(F.col("latitude"), F.col("longitude"))).alias("distance_from_center"))


# ---------------------------------------------------------------- evaluators
def _iris_rule(spark, d):
    """Threshold baseline on one feature: the prediction source whose
    metrics the evaluators are checked on."""
    iris = V.iris(spark, d)
    pred = F.least(F.lit(9), F.greatest(F.lit(0), F.floor((F.col("m0") + 0.4) * 12.5)))
    lab = F.regexp_extract("Species", r"(\d+)$", 1).cast("double")
    return iris.select("row_id", lab.alias("label"), pred.cast("double").alias("prediction"), *_IRIS)


@query("eval_accuracy_f1")
def eval_accuracy_f1(spark, d):
    m = EV.accuracy_f1(_iris_rule(spark, d))
    return m.select(r6("accuracy").alias("accuracy"), r6("f1").alias("f1"))


@query("eval_confusion")
def eval_confusion(spark, d):
    c = EV.confusion(_iris_rule(spark, d))
    return c.select(F.col("label").cast("long").alias("label"),
                    F.col("prediction").cast("long").alias("prediction"), "count")


def _scored_jobs(spark, d):
    j = V.job_postings(spark, d).filter(F.col("is_hourly").isNotNull())
    return j.select("doc_id", F.when(F.col("is_hourly") == "True", 1.0).otherwise(0.0).alias("label"),
                    (F.floor(F.col("budget_clean") / 100) / 100.0).alias("score"))


@query("eval_auc")
def eval_auc(spark, d):
    return EV.area_under_roc(_scored_jobs(spark, d)).select(r6("auc").alias("auc"))


@query("eval_pr")
def eval_pr(spark, d):
    return EV.area_under_pr(_scored_jobs(spark, d)).select(r6("aupr").alias("aupr"))


@query("eval_silhouette")
def eval_silhouette(spark, d):
    iris = _iris_rule(spark, d)
    feats = iris.select(F.array(*[F.col(c) for c in _IRIS]).alias("features"),
                        F.col("label").alias("prediction"))
    return EV.silhouette(feats).select(r6("silhouette").alias("silhouette"))


def _ols_pred(spark, d):
    cars = V.used_cars(spark, d)
    # fit: one aggregate, two numbers reach the driver; score: a projection
    c = cars.agg(F.regr_slope("Price", "Mileage").alias("b"), F.regr_intercept("Price", "Mileage").alias("a")).first()
    return cars.select(F.col("Price").alias("label"),
                       (F.lit(c["a"]) + F.lit(c["b"]) * F.col("Mileage")).alias("prediction"))


@query("eval_regression")
def eval_regression(spark, d):
    m = EV.regression_metrics(_ols_pred(spark, d))
    return m.select(F.round("rmse", 4).alias("rmse"), r6("r2").alias("r2"), F.round("mae", 4).alias("mae"))


@query("group_profile")
def group_profile(spark, d):
    b = V.bike_stations(spark, d)
    p = A.group_profile(b, "status", ["latitude", "longitude"], "station_count")
    return p.select("status", r6("avg_latitude").alias("avg_latitude"),
                    r6("avg_longitude").alias("avg_longitude"), "station_count")


# ---------------------------------------------------------------- estimators
@query("linreg_fit")
def linreg_fit(spark, d):
    cars = V.used_cars(spark, d)
    model = ML.fit_stages([FE.assembler(["Mileage"]), ML.linear_regression(label="Price")], cars)
    lr = model.stages[-1]
    rows = [(float(lr.coefficients[0]), float(lr.intercept))]
    # model parameters (two numbers) as a one-row result
    return spark.createDataFrame(rows, "slope double, intercept double").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


def _nb_data(spark, d):
    jobs = FE.keyword_flags(Q.keep_present(_jobs_clean(spark, d), "country"))
    return jobs


@query("naive_bayes_fit")
def naive_bayes_fit(spark, d):
    data = _nb_data(spark, d)
    flags = [f"has_{k}" for k in FE.SKILL_KEYWORDS]
    idx = FE.string_indexer("country", "label", "error").fit(data)
    stages = [idx, FE.assembler(flags, "skills_features", "keep"),
              ML.naive_bayes("skills_features", "label")]
    nb = ML.fit_stages(stages, data).stages[-1]
    labels = idx.labels
    pi, theta = nb.pi.toArray(), nb.theta.toArray()
    rows = [(labels[k], "__prior__", float(pi[k])) for k in range(len(labels))]
    rows += [(labels[k], flags[j], float(theta[k][j])) for k in range(len(labels)) for j in range(len(flags))]
    # model parameters (classes x features numbers) as a table
    return spark.createDataFrame(rows, "country string, feature string, log_prob double") \
        .select("country", "feature", r6("log_prob").alias("log_prob"))


def _iris_split(spark, d):
    iris = V.iris(spark, d)
    return FE.hash_split(iris, F.col("row_id"))


@query("logreg_multi")
def logreg_multi(spark, d):
    sp = _iris_split(spark, d)
    stages = [FE.string_indexer("Species", "label"), FE.assembler(_IRIS), ML.logistic()]
    _, pred = ML.fit_score(stages, sp["train"], sp["test"])
    return pred.select("row_id", F.col("prediction").cast("long").alias("prediction"))


@query("decision_tree")
def decision_tree(spark, d):
    sp = _iris_split(spark, d)
    stages = [FE.string_indexer("Species", "label"), FE.assembler(_IRIS), ML.decision_tree()]
    _, pred = ML.fit_score(stages, sp["train"], sp["test"])
    return pred.select("row_id", F.col("prediction").cast("long").alias("prediction"))


TREE = {"features": V.MEASURES[:8], "depth": 3, "bins": 16}


@query("histogram_tree")
def histogram_tree(spark, d):
    """A tree of three levels on binned components; labels of the rest."""
    sp = _iris_split(spark, d)
    tree = FT.histogram_tree(sp["train"], TREE["features"], "Species", TREE["depth"], TREE["bins"])
    return sp["test"].select("row_id", tree.node_of().cast("long").alias("node"), tree.predict().alias("prediction"))


@query("kmeans_lloyd")
def kmeans_lloyd(spark, d):
    """Centers after six Lloyd steps from hash seeds, with their rows."""
    iris, cols = V.iris(spark, d), V.MEASURES[:4]
    centers = FT.lloyd_kmeans(iris, cols, FT.hash_seeds(iris, cols, "row_id", 3), 6)
    return iris.groupBy(FT.nearest(cols, centers).cast("long").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), *[r6(F.avg(c)).alias(f"avg_{c}") for c in cols])


@query("logreg_newton")
def logreg_newton(spark, d):
    """Intercept and slope of hourly pay on the posting's length, by Newton
    steps."""
    jobs = V.job_postings(spark, d).filter(F.col("is_hourly").isNotNull()).select(
        F.when(F.col("is_hourly") == "True", 1).otherwise(0).alias("y"), (F.col("budget_clean") / 10000.0).alias("x"))
    a, b = FT.newton_logistic(jobs, ["x"], "y", 6)
    return jobs.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n_hourly"),
                    F.lit(round(a, 6)).alias("intercept"), F.lit(round(b, 6)).alias("slope"))


@query("random_forest")
def random_forest(spark, d):
    bike = V.bike_stations(spark, d)
    sp = FE.hash_split(bike, F.col("row_id"))
    stages = [FE.string_indexer("status", "label"), FE.string_indexer("location", "location_index"),
              FE.assembler(["latitude", "longitude", "location_index"]), ML.random_forest()]
    _, pred = ML.fit_score(stages, sp["train"], sp["test"])
    return pred.select("row_id", F.col("prediction").cast("long").alias("prediction"))


@query("kmeans_clusters")
def kmeans_clusters(spark, d):
    iris = V.iris(spark, d)
    model = ML.fit_stages([FE.assembler(_IRIS), ML.kmeans(3)], iris)
    return model.transform(iris).select("row_id", F.col("prediction").cast("long").alias("prediction"))


@query("gmm_clusters")
def gmm_clusters(spark, d):
    bike, model = _gmm(spark, d)
    return model.transform(bike).select("row_id", F.col("prediction").cast("long").alias("prediction"))


def _gmm(spark, d):
    bike = V.bike_stations(spark, d).withColumn(
        "distance_from_center", FE.distance_from(F.col("latitude"), F.col("longitude")))
    stages = [FE.assembler(["latitude", "longitude", "distance_from_center"], "raw_features"),
              FE.scaler("raw_features", "features"), ML.gaussian_mixture(3)]
    return bike, ML.fit_stages(stages, bike)


@query("gmm_log_likelihood")
def gmm_log_likelihood(spark, d):
    """Log-likelihood of the fitted mixture (one number)."""
    _, model = _gmm(spark, d)
    s = model.stages[-1].summary
    return spark.createDataFrame([(float(s.logLikelihood), int(s.numIter))], "log_likelihood double, iterations int")


@query("logreg_tfidf")
def logreg_tfidf(spark, d):
    jobs = V.job_postings(spark, d).filter(F.col("is_hourly").isNotNull()).withColumn(
        "is_hourly_bool", F.when(F.col("is_hourly") == "True", 1.0).otherwise(0.0))
    sp = FE.hash_split(jobs, F.col("doc_id"))
    stages = FE.text_stages("title") + [ML.logistic(label="is_hourly_bool")]
    _, pred = ML.fit_score(stages, sp["train"], sp["test"])
    return pred.select("doc_id", F.col("prediction").cast("long").alias("prediction"))


# ------------------------------------------------------------ files / streams


def scratch(spark, name: str) -> str:
    """A fresh folder under the session's (shared) checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/quarry-{name}-{uuid.uuid4().hex[:12]}"


def _user_files(spark, d, n_files: int = 8) -> str:
    """The sign-up records as NDJSON files (the web API's output)."""
    path = scratch(spark, "users-ndjson")
    V.user_events(spark, d).select(*_USER_COLS).repartition(n_files, "id").write.json(path)
    return path


@query("stream_to_messages")
def stream_to_messages(spark, d):
    src, out, ck = _user_files(spark, d), scratch(spark, "msgs"), scratch(spark, "msgs-ck")
    q = ST.start_file_to_messages(spark, src, ck, out, fmt="parquet", max_files_per_trigger=2,
                                  trigger={"availableNow": True})
    q.awaitTermination()
    m = spark.read.parquet(out)
    return m.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("stream_upsert")
def stream_upsert(spark, d):
    src, root, ck = _user_files(spark, d), scratch(spark, "users-table"), scratch(spark, "ups-ck")
    msgs = MS.to_messages(SR.read_json_stream(spark, src, MS.USER_EVENT_SCHEMA, 2), "country")
    sink = ST.KeyedUpsertSink(root, ["country", "id"], ["created_at"])
    ST.start_upsert(spark, msgs, sink, ck, trigger={"availableNow": True}).awaitTermination()
    return sink.current(spark).select("country", "id", "name", "email", "created_at")


@query("csv_round_trip")
def csv_round_trip(spark, d):
    path = scratch(spark, "orders-csv")
    SK.write_csv(V.dirty_orders(spark, d), path)
    return _orders_out(Q.parse_orders(SR.read_csv_text(spark, path)))


@query("typed_csv")
def typed_csv(spark, d):
    """Cars written as CSV and read with types inferred from every row."""
    path = scratch(spark, "cars-csv")
    SK.write_csv(V.used_cars(spark, d), path)
    cars = SR.read_csv_typed(spark, path)
    kinds = dict(cars.dtypes)
    return cars.select(F.col("row_id").cast("long").alias("row_id"), r6("Price").alias("price"), r6("Mileage").alias("mileage"),
                       F.col("Year").cast("long").alias("year"), F.col("Body Type").alias("body_type"),
                       F.lit(",".join(kinds[c] for c in ("Price", "Year", "Body Type"))).alias("kinds"))


@query("csv_folder_streaks")
def csv_folder_streaks(spark, d):
    """The event log as CSV files of one folder, read by a file pattern; the
    longest run per key."""
    path = scratch(spark, "event-csv")
    SK.write_csv(V.event_log(spark, d).withColumn("t_us", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts"), path)
    log = SR.read_csv_folder(spark, path, "part-*.csv").select(
        F.col("user_id").cast("long").alias("user_id"), F.timestamp_micros(F.col("t_us").cast("long")).alias("ts"),
        F.col("event_id").cast("long").alias("event_id"), "state")
    return _runs_out(R.longest_streaks(log, key="user_id", order="ts", hit=F.col("state") == "broken")["per_key"])


@query("file_catalog")
def file_catalog(spark, d):
    """Sign-ups flushed in four batches to files named by the flush time; the
    catalogue of these files with the records in each flush (a flush beyond
    one advisory partition size has several files)."""
    path = scratch(spark, "flushed")
    ue = V.user_events(spark, d).select(*_USER_COLS, "seq")
    for k in range(4):
        at = datetime(2024, 1, 1) + timedelta(minutes=k)
        TB.FlushFiles(path, clock=lambda at=at: at)(ue.filter(F.pmod("seq", F.lit(4)) == k), k)
    stem = F.regexp_extract("name", r"^(users_[0-9_]+)", 1).alias("flush")
    listed = SR.file_catalog(spark, path, "users_*.jsonl").groupBy(stem).agg(F.sum("length").alias("n_bytes"))
    held = (spark.read.schema("id string, seq long").option("pathGlobFilter", "users_*.jsonl").json(path)
            .select(F.col("_metadata.file_name").alias("name"), "seq").groupBy(stem)
            .agg(F.count(F.lit(1)).alias("n_records"), F.sum("seq").alias("seq_sum")))
    return listed.join(held, "flush").select("flush", (F.col("n_bytes") > 0).alias("has_bytes"), "n_records", "seq_sum")


@query("row_counts")
def row_counts(spark, d):
    parts = [load_table(spark, d, t).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("generated_orders_profile")
def generated_orders_profile(spark, d):
    """Drawn order lines for the order keys of ``lineitem``, one per row."""
    li = load_table(spark, d, "lineitem")
    gen = G.dirty_lines(li.select(F.col("l_orderkey").alias("order_id"),
                                  F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line")))
    typed = Q.parse_orders(gen.select(*[F.col(c).cast("string") for c in gen.columns]))
    tagged = typed.withColumn("_bad", Q.is_rejected(Q.order_rules()))
    return tagged.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.sum(F.col("_bad").cast("long")).alias("n_bad"),
                      F.sum(F.when(F.col("menu_item") == "Coffee", 1).otherwise(0)).alias("n_coffee"),
                      F.count("menu_item").alias("n_items_present"),
                      F.countDistinct("facility_name").alias("n_facilities"),
                      F.countDistinct("city").alias("n_cities"),
                      F.countDistinct("Order_id").alias("n_order_ids"))


# ------------------------------------------------- validation / text helpers
@query("validated_users")
def validated_users(spark, d):
    inc = V.users_incoming(spark, d)
    sp = Q.split_by_rules(inc, MS.user_rules())
    good = sp["good"].select("seq", "email", F.lit(True).alias("valid"), F.lit("").alias("reasons"))
    bad = sp["bad"].select("seq", "email", F.lit(False).alias("valid"),
                           F.array_join("reject_reason", ";").alias("reasons"))
    return good.unionByName(bad)


@query("path_stem")
def path_stem(spark, d):
    from quarry.functions.expressions import path_base, path_stem as stem
    pages = load_table(spark, d, "pages").select("page_id", "url")
    return pages.select("page_id", path_base(F.col("url")).alias("base_name"), stem(F.col("url")).alias("stem"))


@query("formatted_dates")
def formatted_dates(spark, d):
    from quarry.functions.expressions import py_isoformat
    ev = load_table(spark, d, "events").select("event_id", "ts")
    return ev.select("event_id",
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
                     py_isoformat(F.col("ts")).alias("ts_iso"),
                     F.date_format("ts", "yyyyMMdd_HHmmss").alias("ts_stamp"))


@query("tagged_rows")
def tagged_rows(spark, d):
    log = B.event_log(V.videos(spark, d), V.detections(spark, d), target_type="skeet")
    return log.select("video_file", F.col("frame_idx").cast("long").alias("frame_idx"), "target_type", "state")


# ------------------------------------------------------------ option variants
@query("streak_runs_balanced")
def streak_runs_balanced(spark, d):
    """Same runs as ``streak_runs``, slices balanced by row count."""
    log = V.event_log(spark, d)
    runs = R.streak_runs(log, "user_id", "ts", F.col("state") == "broken", balance="rows")
    return _runs_out(runs)


@query("order_documents_by_id")
def order_documents_by_id(spark, d):
    return _documents_out(M.to_documents(_good_lines(spark, d), unique_id=True))


@query("nf_order_items_dedup")
def nf_order_items_dedup(spark, d):
    return M.to_3nf(_good_lines(spark, d), dedupe_items=True)["order_items"]


@query("keyword_flags_token")
def keyword_flags_token(spark, d):
    flagged = FE.keyword_flags(_jobs_clean(spark, d), mode="token")
    return flagged.select("doc_id", *[f"has_{k}" for k in FE.SKILL_KEYWORDS])


# ------------------------------------------------ models with their evaluators
def _metrics(pred, label="label"):
    """Accuracy and weighted F1 of fitted predictions."""
    m = EV.accuracy_f1(pred.select(F.col(label).alias("label"), "prediction"))
    return m.select(r6("accuracy").alias("accuracy"), r6("f1").alias("f1"))


def _iris_scored(spark, d, estimator):
    sp = _iris_split(spark, d)
    return ML.fit_score([FE.string_indexer("Species", "label"), FE.assembler(_IRIS), estimator], sp["train"], sp["test"])[1]


@query("logreg_multi_metrics")
def logreg_multi_metrics(spark, d):
    return _metrics(_iris_scored(spark, d, ML.logistic()))


@query("decision_tree_metrics")
def decision_tree_metrics(spark, d):
    return _metrics(_iris_scored(spark, d, ML.decision_tree()))


@query("logreg_tfidf_auc")
def logreg_tfidf_auc(spark, d):
    """Areas under ROC and PR of the fitted model's probabilities."""
    jobs = V.job_postings(spark, d).filter(F.col("is_hourly").isNotNull()).withColumn(
        "is_hourly_bool", F.when(F.col("is_hourly") == "True", 1.0).otherwise(0.0))
    sp = FE.hash_split(jobs, F.col("doc_id"))
    _, pred = ML.fit_score(FE.text_stages("title") + [ML.logistic(label="is_hourly_bool")], sp["train"], sp["test"])
    scored = pred.select(F.col("is_hourly_bool").alias("label"), vector_to_array_col("probability")[1].alias("score"))
    roc = EV.area_under_roc(scored)
    return roc.select(r6("auc").alias("auc"), F.round(EV.area_under_pr(scored).scalar(), 6).alias("aupr"))


@query("naive_bayes_metrics")
def naive_bayes_metrics(spark, d):
    """Fit on the split, score the rest: accuracy and F1."""
    sp = FE.hash_split(_nb_data(spark, d), F.col("doc_id"))
    flags = [f"has_{k}" for k in FE.SKILL_KEYWORDS]
    stages = [FE.string_indexer("country", "label"), FE.assembler(flags, "skills_features", "keep"),
              ML.naive_bayes("skills_features", "label")]
    return _metrics(ML.fit_score(stages, sp["train"], sp["test"])[1])


def _random_forest_top(spark, d):
    """The five most frequent body types from price, mileage, year and the
    other categories, indexed, with 100 bins."""
    cars = A.filter_top_categories(V.used_cars(spark, d), "Body Type", 5)
    sp = FE.hash_split(cars, F.col("row_id"))
    stages = [FE.string_indexer("Body Type", "label"),
              *FE.index_strings_then_assemble(cars, ["Price", "Mileage", "Year", "Fuel Type", "Condition"]),
              ML.random_forest(max_bins=100)]
    return ML.fit_score(stages, sp["train"], sp["test"])[1]


@query("random_forest_top_categories")
def random_forest_top_categories(spark, d):
    return _random_forest_top(spark, d).select("row_id", F.col("prediction").cast("long").alias("prediction"))


@query("linreg_three_inputs")
def linreg_three_inputs(spark, d):
    """Price from mileage, year and an indexed category: RMSE, R2, MAE of
    the held-out predictions."""
    cars = V.used_cars(spark, d)
    sp = FE.hash_split(cars, F.col("row_id"))
    stages = [*FE.index_strings_then_assemble(cars, ["Mileage", "Year", "Condition"]), ML.linear_regression(label="Price")]
    _, pred = ML.fit_score(stages, sp["train"], sp["test"])
    m = EV.regression_metrics(pred.select(F.col("Price").alias("label"), "prediction"))
    return m.select(F.round("rmse", 4).alias("rmse"), r6("r2").alias("r2"), F.round("mae", 4).alias("mae"))


def _clustered(df, inputs, k, scaled=False):
    stages = FE.index_strings_then_assemble(df, inputs, "raw_features" if scaled else "features")
    if scaled:
        stages = [*stages, FE.scaler("raw_features", "features")]
    return ML.fit_stages([*stages, ML.kmeans(k)], df).transform(df)


@query("kmeans_coordinates")
def kmeans_coordinates(spark, d):
    """Five clusters on coordinates, with each cluster's profile."""
    c = _clustered(V.bike_stations(spark, d), ["latitude", "longitude"], 5)
    p = A.group_profile(c, "prediction", ["latitude", "longitude"], "station_count")
    return p.select(F.col("prediction").cast("long").alias("prediction"), r6("avg_latitude").alias("avg_latitude"),
                    r6("avg_longitude").alias("avg_longitude"), "station_count")


@query("kmeans_mixed")
def kmeans_mixed(spark, d):
    """Three clusters on text and number columns; rows per cluster and
    category."""
    jobs = V.job_postings(spark, d).select("doc_id", "payment_type", "country", "budget_clean", "hourly_rate")
    c = _clustered(jobs, ["payment_type", "budget_clean", "hourly_rate"], 3)
    return A.category_counts(c, "prediction", "country").select(
        F.col("prediction").cast("long").alias("prediction"), "country", "count")


@query("kmeans_scaled")
def kmeans_scaled(spark, d):
    """Four clusters on standardised columns and their silhouette."""
    cars = V.used_cars(spark, d).select("row_id", "Price", "Mileage", F.col("Year").cast("double").alias("Year"))
    c = _clustered(cars, ["Price", "Mileage", "Year"], 4, scaled=True)
    return EV.silhouette(c).select(r6("silhouette").alias("silhouette"))


# --------------------------------------------------- jobs and sinks read back
@query("streak_incremental")
def streak_incremental(spark, d):
    """Longest run per key from stored day summaries: the days are loaded in
    three batches, one of them twice; no load reads another's events."""
    log = V.event_log(spark, d)
    held = SG.StreakLog(scratch(spark, "segments"), "user_id", "ts", F.col("state") == "broken", F.to_date("ts"))
    batch = F.pmod(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")), F.lit(3))
    for k in (1, 0, 2, 0):
        held.add(log.filter(batch == k))
    return _runs_out(held.longest(spark))


@query("streak_merged_summaries")
def streak_merged_summaries(spark, d):
    """The same from day summaries merged into months, then into one."""
    s = SG.summarize(V.event_log(spark, d), "user_id", "ts", F.col("state") == "broken", F.to_date("ts"))
    months = SG.merge_summaries(s, "user_id", F.trunc("segment", "month"))
    return _runs_out(SG.longest_from_summaries(SG.merge_summaries(months, "user_id", F.lit("1970-01-01").cast("date")), "user_id"))


@query("cleaning_job")
def cleaning_job(spark, d):
    """The whole cleaning job: partitioned Parquet of the good lines, read
    back with partition discovery."""
    root = scratch(spark, "clean")
    Q.store_clean_orders(V.dirty_orders(spark, d), f"{root}/good", f"{root}/dead")
    with SR.listed_by_cores(spark):
        back = SR.read_parquet(spark, f"{root}/good/parquet")
    return _orders_out(back.withColumn("date", F.col("date").cast("date")))


@query("dead_letters_read_back")
def dead_letters_read_back(spark, d):
    path = scratch(spark, "dead")
    Q.store_dead_letters(V.dirty_orders(spark, d), path)
    t = SR.read_csv_text(spark, path)
    return t.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("per_key_csv")
def per_key_csv(spark, d):
    """One CSV per video, read back from the folder (keys from its name)."""
    path = scratch(spark, "per-key")
    log = detection_log(spark, d)
    SK.write_per_key_csv(log, path)
    back = SR.read_folders(spark, path, "csv", [c for c in log.columns if c != "video_file"], "video_file", {"header": "true"})
    kinds = {f.name: f.dataType for f in log.schema.fields}
    return back.select(*[F.col(c).cast(kinds[c]).alias(c) for c in log.columns])


@query("documents_read_back")
def documents_read_back(spark, d):
    path = scratch(spark, "documents")
    docs = M.to_documents(_good_lines(spark, d))
    SK.write_documents(docs, path, fmt="json")
    return _documents_out(spark.read.schema(docs.schema).json(path))


@query("label_lines_read_back")
def label_lines_read_back(spark, d):
    path = scratch(spark, "labels")
    lb = B.box_labels(V.clicks(spark, d))
    SK.write_label_lines(lb, path)
    back = SR.read_folders(spark, path, "text", ["value"], "name")
    return back.select("name", F.col("value").alias("label_line"))


@query("minute_files_read_back")
def minute_files_read_back(spark, d):
    """Records in one folder per minute batch; rows per file name."""
    path = scratch(spark, "minutes")
    ue = V.user_events(spark, d)
    w = F.window(F.try_to_timestamp("created_at"), "1 minute")
    named = ue.withColumn("file_name", F.concat(F.lit("users_"), F.date_format(w["end"], "yyyyMMdd_HHmmss"), F.lit(".jsonl")))
    SK.write_batches_as_files(named.select("id", "email", "file_name"), path)
    back = SR.read_folders(spark, path, "json", ["id", "email"], "file_name")
    return back.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_records"))


@query("decode_rejects")
def decode_rejects(spark, d):
    """Messages that do not parse: every seventh one is cut short."""
    cut = F.when(F.col("seq") % 7 == 0, F.expr("substring(value, 1, length(value) - 5)")).otherwise(F.col("value"))
    msgs = MS.to_messages(V.user_events(spark, d).select(*_USER_COLS, "seq"), "country",
                          value_cols=_USER_COLS + ["seq"])
    msgs = msgs.withColumn("value", F.col("value").cast("string"))
    msgs = msgs.withColumn("seq", F.get_json_object("value", "$.seq").cast("long")).select("key", cut.cast("binary").alias("value"))
    return MS.decode_messages(msgs)["bad"].select("msg_key", F.length("raw").cast("long").alias("n_chars"))


@query("id_check")
def id_check(spark, d):
    """Ids in the table's pattern: every customer's hash as an id, without
    its last character for every fifth."""
    h = F.md5(F.col("c_custkey").cast("string").cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    uid = F.concat_ws("-", *parts)
    uid = F.when(F.col("c_custkey") % 5 == 0, F.substring(uid, 1, 35)).otherwise(uid)
    cu = load_table(spark, d, "customer").select("c_custkey", uid.alias("id"))
    return cu.select("c_custkey", "id", MS.is_uuid(F.col("id")).alias("valid"))


@query("key_partitions")
def key_partitions(spark, d):
    """A key-partitioned topic: messages per key, and in how many
    partitions each key lies (one)."""
    p = MS.partition_by_key(_messages(spark, d), 10).withColumn("p", F.spark_partition_id())
    return p.groupBy(F.col("key").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("p").alias("n_partitions"))
