"""Every registered query runs on the smallest tables; the entry point
works; no query plan evaluates Python."""

import pytest

import __spark_entry__ as E
from quarry.plans.catalog import QUERIES
from quarry.plans.inspect import python_nodes

from conftest import SF_SMALL


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["user_id", "grp", "run_id", "streak_len", "start_t", "end_t"]


def test_every_query_has_oracle_or_is_model():
    rows_only = set(QUERIES) - set(E.oracle_sql())
    assert rows_only <= {"kmeans_clusters", "gmm_clusters", "logreg_multi", "logreg_tfidf",
                         "decision_tree", "random_forest", "generated_orders_profile", "gmm_log_likelihood",
                         "logreg_multi_metrics", "decision_tree_metrics", "logreg_tfidf_auc", "naive_bayes_metrics",
                         "random_forest_top_categories", "linreg_three_inputs", "kmeans_coordinates",
                         "kmeans_mixed", "kmeans_scaled"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_without_python(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert python_nodes(df) == []
    assert df.count() >= 0
