"""Scores per order and model: dates and tests on the score are not spelled out for every pair."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vintagewise.catalog import drifting
from vintagewise.catalog.registry import Inputs
from vintagewise.operators import ordering


@pytest.fixture
def inputs(spark, tmp_path):
    days = [datetime(1996, 1, 15), datetime(1996, 2, 1), datetime(1997, 8, 31), datetime(1999, 5, 2), None]
    rows = [(101 * 103 * 107 + i, i % 7, days[i % 5]) for i in range(60)] + [(103, None, days[0]), (107, 1, days[0]), (None, 2, days[1])]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    return Inputs(spark, str(tmp_path))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_test_on_the_score_stays_off_the_pairs(inputs):
    scores = drifting.oot_scores(inputs)
    tested = ordering.value_counts(scores.where(F.col("value") != float("inf")), "value", ["model_name"])
    assert "o_orderkey" not in plan(tested)


def test_training_dates_are_taken_once_per_model(inputs):
    joins = [line for line in plan(inputs("predictions")).splitlines() if "Join Inner" in line]
    assert joins and not any("substr" in line or "date_trunc" in line for line in joins)


def test_out_of_time_scores(inputs, rows):
    got = rows(drifting.oot_scores(inputs), "model_name", "value")
    month = F.trunc("o_orderdate", "MM")
    windows = {"credit_model_1996_09_01": (0, "1996-01-01", "1996-02-01"), "credit_model_1998_03_01": (1, "1997-07-01", "1997-08-01"),
               "credit_model_2000_01_01": (2, "1999-05-01", "1999-06-01")}
    want = []
    for name, (no, first, last) in windows.items():
        for r in inputs("orders").where(month.between(F.lit(first).cast("date"), F.lit(last).cast("date"))).collect():
            key = r.o_orderkey
            if key is None or any(key % d == 0 for d in (101, 103, 107)):
                want.append((name, None))
            else:
                want.append((name, ((key * 7919 + no * 131) % 750 + 25 * (key % 9)) / 1000))
    assert got == sorted(want, key=repr) and got
