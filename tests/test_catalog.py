"""Every query with SQL against the second engine on the smallest data."""

import pytest

from oracle import compare, connect

import __spark_entry__ as entry
from vintagewise.catalog import QUERIES, layers
from vintagewise.catalog.views import VIEWS, oracle_views, view

SF = "/root/testdata/sf0.001"
# minutes of fitting; their parts are tested in test_training.py
LONG = {"random_search", "split_performance", "feature_importance", "train_score"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name].run(spark, SF), con, QUERIES[name].oracle()) == []


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql and n not in LONG])
def test_runs(spark, name):
    assert QUERIES[name].run(spark, SF).count() > 0


def test_prune_features_takes_every_number(spark):
    found = {r.feature: r.cluster for r in QUERIES["prune_features"].run(spark, SF).select("feature", "cluster").collect()}
    assert set(found) == set(layers.FEATURE_NUMBERS)


@pytest.mark.parametrize("name", list(VIEWS))
def test_views_agree(spark, con, name):
    df = view(spark, SF, name)
    head = ", ".join(f"{n} as ({text})" for n, text in oracle_views(name))
    assert compare(df, con, f"with {head} select {', '.join(df.columns)} from {name}") == []


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"loan_id", "Age_Band", "Clickstream_Mean"} <= set(entry.entry(spark).columns)
