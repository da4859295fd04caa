"""Evaluators as relational aggregations (checkable in plain SQL).

Classification metrics come from the confusion table (classes² rows).
ROC/PR areas use score-level counts and distributed running totals
(``cumulative_sums``) instead of collecting scores. Silhouette uses the
closed form for squared Euclidean distance from per-cluster statistics
(count, vector sum, sum of squared norms), so it is one pass over points
after a k-row aggregate.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from quarry.operators.ordered import cumulative_sums


#: Clusters whose statistics a silhouette holds on the driver.
MOST_CLUSTERS = 10_000


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


def accuracy_f1(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and class-weighted F1 (``Σ n_k · F1_k / N``)."""
    cm = confusion(pred, label, prediction)
    per_label = cm.groupBy(F.col(label).alias("k")).agg(F.sum("count").alias("n"))
    per_pred = cm.groupBy(F.col(prediction).alias("k")).agg(F.sum("count").alias("pp"))
    tp = cm.filter(F.col(label) == F.col(prediction)).select(F.col(label).alias("k"), F.col("count").alias("tp"))
    k = per_label.join(per_pred, "k", "full").join(tp, "k", "left").fillna(0, ["n", "pp", "tp"])
    f1 = F.when(F.col("tp") == 0, F.lit(0.0)).otherwise(2.0 * F.col("tp") / (F.col("pp") + F.col("n")))
    return k.agg((F.sum("tp") / F.sum("n")).alias("accuracy"),
                 (F.sum(F.col("n") * f1) / F.sum("n")).alias("f1"))


def _score_counts(pred: DataFrame, label: str, score: str) -> DataFrame:
    return pred.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) > 0.5, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label) > 0.5, 0).otherwise(1)).cast("long").alias("neg"))


def area_under_roc(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC area (thresholds at every distinct score, ties counted
    half): ``Σ_s pos_s · (neg_below_s + neg_s / 2) / (P · N)``."""
    c = cumulative_sums(_score_counts(pred, label, score), [F.col("s").asc()], ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    return c.agg((F.sum(F.col("pos") * (below + F.col("neg") / 2.0)) /
                  (F.sum("pos") * F.sum("neg"))).alias("auc"))


def area_under_pr(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """PR area with thresholds at distinct scores (descending), the curve
    starting at (0, precision of the first threshold), trapezoid rule."""
    c = cumulative_sums(_score_counts(pred, label, score), [F.col("s").desc()], ["pos", "neg"])
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    p_cur = tp / (tp + fp)
    p_prev = F.when(tp0 + fp0 == 0, p_cur).otherwise(tp0 / (tp0 + fp0))
    parts = c.select(((tp - tp0) * (p_cur + p_prev) / 2.0).alias("area_x_P"), "pos")
    return parts.agg((F.sum("area_x_P") / F.sum("pos")).alias("aupr"))


def _as_array(df: DataFrame, col: str):
    return F.col(col) if isinstance(df.schema[col].dataType, ArrayType) else vector_to_array(F.col(col))


def silhouette(df: DataFrame, features: str = "features", cluster: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance.

    Fit: per-cluster count, vector sum and sum of squared norms — k rows
    (bounded by the number of clusters) reach the driver. Score: one
    projection; for a point x the summed squared distance to cluster C is
    ``n_C·‖x‖² − 2·x·Σy + Σ‖y‖²``. The statistics enter as ONE array
    literal, so the generated code does not change with the data."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    x = _as_array(df, features)
    pts = df.select(F.col(cluster).cast("double").alias("c"), x.cast("array<double>").alias("x"))
    pts = pts.withColumn("nn", F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v * v))
    rows = (pts.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("nn").alias("psi"),
                                 Summarizer.sum(array_to_vector("x")).alias("y"))
               .limit(MOST_CLUSTERS + 1).collect())
    if len(rows) > MOST_CLUSTERS:
        raise ValueError(f"more than {MOST_CLUSTERS} clusters: their statistics are one literal of the plan")
    stats = F.array(*[F.struct(F.lit(float(r["c"])).alias("c"), F.lit(float(r["n"])).alias("n"),
                               F.lit(float(r["psi"])).alias("psi"),
                               F.array(*[F.lit(float(v)) for v in r["y"].toArray()]).alias("y"))
                      for r in rows])

    def total(s):
        dot = F.aggregate(F.zip_with("x", s["y"], lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        return s["n"] * F.col("nn") - 2 * dot + s["psi"]

    scored = pts.select(
        F.transform(stats, lambda s: F.struct(s["c"].alias("c"), s["n"].alias("n"),
                                              total(s).alias("t"))).alias("d"), "c")
    own = F.filter("d", lambda d: d["c"] == F.col("c"))[0]
    others = F.transform(F.filter("d", lambda d: d["c"] != F.col("c")), lambda d: d["t"] / d["n"])
    a = own["t"] / F.greatest(own["n"] - 1, F.lit(1.0))
    b = F.array_min(others)
    s_x = (F.when(own["n"] == 1, F.lit(0.0))
            .when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(F.lit(0.0)))
    return scored.agg(F.avg(s_x).alias("silhouette"))


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE, R² (``1 - SSE / SST``), MAE in one aggregate."""
    err = F.col(label) - F.col(prediction)
    return pred.agg(F.sqrt(F.avg(err * err)).alias("rmse"),
                    (1 - F.sum(err * err) / (F.var_pop(label) * F.count(F.lit(1)))).alias("r2"),
                    F.avg(F.abs(err)).alias("mae"))
