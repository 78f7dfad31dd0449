"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.harness import compare, connect

ORACLES = oracle_sql()
MODELS = {"train_multiclass", "feature_importance", "score_multiclass", "tune_multiclass", "tune_logreg", "train_binary", "train_logreg", "score_binary"}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_only_model_queries_lack_sql():
    own = {n for n in queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own - set(ORACLES) == MODELS


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n != "pipeline" and not re.match(r"op\d+_", n)))
def test_query_matches_sql(name, spark, small, con):
    assert compare(queries()[name](spark, small), con, ORACLES[name]) is None


def test_trained_model_ranks_better_than_chance(spark, small):
    values = {(r.split, r.metric): r.value for r in queries()["train_multiclass"](spark, small).collect()}
    assert values["test", "roc_auc_macro_ovr"] > 0.8 and values["val", "roc_auc_macro_ovr"] > 0.8
