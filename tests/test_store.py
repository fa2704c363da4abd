from datetime import date

import pytest
from pyspark.sql import functions as F

from vintagewise import schemas as S
from vintagewise.operators import guards
from vintagewise.operators.guards import ContractError
from vintagewise.plans import backfill, gold
from vintagewise.sources import raw, store
from vintagewise.streaming.ingest import ingest_available


def months(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "d string").select(F.to_date("d").alias("snapshot_date"))


def test_spine_and_gaps(spark, rows):
    spine = store.month_spine(spark, "2024-01-15", "2024-04-01")
    assert spine.count() == 4
    have = months(spark, "2024-01-01", "2024-02-01", "2024-04-01")
    assert rows(store.missing_months(have, spine)) == [(date(2024, 3, 1),)]
    assert rows(store.empty_months(have, spine)) == [(date(2024, 3, 1),)]
    assert store.own_spine(have).count() == 4
    assert store.union_months(spine, store.month_spine(spark, "2024-04-01", "2024-06-01")).count() == 6


def test_latest_month(spark):
    found = store.latest_month(months(spark, "2024-01-01", "2024-02-01"), "2024-04-01").first()
    assert (found.latest, found.months_behind, found.is_stale) == (date(2024, 2, 1), 2, True)


def test_write_is_idempotent_and_replaces_only_its_months(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    both = months(spark, "2024-01-01", "2024-02-01").withColumn("x", F.lit(1))
    store.write_months(both, path)
    store.write_months(both, path)
    store.write_months(months(spark, "2024-02-01").withColumn("x", F.lit(2)), path)
    assert rows(store.read_table(spark, path), "snapshot_date", "x") == [(date(2024, 1, 1), 1), (date(2024, 2, 1), 2)]
    assert store.read_months(spark, path, "2024-01-01", "2024-02-01").count() == 2
    with pytest.raises(ContractError, match="2024-03-01"):
        store.read_months(spark, path, "2024-01-01", "2024-03-01")


def test_guards(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert rows(guards.repeated_keys(df, ["k"])) == [("a", 2)]
    assert rows(guards.key_violations(df, ["k"])) == [("a", 2), (None, 1)]
    with pytest.raises(ContractError, match="k=a"):
        guards.require_unique(df, ["k"], "table")
    with pytest.raises(ContractError):
        guards.require_rows(df.where("k = 'z'"), "nothing")


def test_snapshot_matches_text_timestamp_and_date(spark):
    for kind in ("string", "timestamp", "date"):
        df = spark.createDataFrame([("2024-01-01",), ("2024-02-01",)], "snapshot_date string").withColumn(
            "snapshot_date", F.col("snapshot_date").cast(kind))
        assert raw.at_snapshot(df, "2024-02-01").count() == 1


def write_clicks(spark, folder, *dates, name="clicks.csv"):
    lines = [",".join([*S.CLICK_COLUMNS, "Customer_ID", "snapshot_date"])]
    for d in dates:
        lines.append(",".join(["1"] * 20 + ["c1", d]))
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_backfill_equals_month_by_month(spark, tmp_path, rows):
    write_clicks(spark, tmp_path / "in", "2024-01-01", "2024-02-01", "2024-02-01")
    csv = str(tmp_path / "in")
    whole, single = str(tmp_path / "whole"), str(tmp_path / "single")
    backfill.build_bronze(spark, "clickstream", csv, whole)
    backfill.build_silver(spark, "clickstream", whole)
    for d in ("2024-01-01", "2024-02-01"):
        backfill.build_bronze(spark, "clickstream", csv, single, d)
        backfill.build_silver(spark, "clickstream", single, d, d)
    a, b = (store.read_table(spark, f"{r}/silver/clickstream") for r in (whole, single))
    assert a.count() == 3 and rows(a, *sorted(a.columns)) == rows(b, *sorted(a.columns))
    assert dict(a.dtypes)["fe_1"] == "int"
    with pytest.raises(ContractError):
        backfill.build_bronze(spark, "clickstream", csv, single, "2024-05-01")


def test_wrong_header_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        raw.read_raw(spark, str(tmp_path / "x.csv"), "attributes").collect()


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, root = tmp_path / "drop", str(tmp_path / "lake")
    write_clicks(spark, folder, "2024-01-01", name="a.csv")
    ingest_available(spark, "clickstream", str(folder), root)
    write_clicks(spark, folder, "2024-02-01", name="b.csv")
    ingest_available(spark, "clickstream", str(folder), root)
    ingest_available(spark, "clickstream", str(folder), root)
    assert backfill.read_bronze(spark, "clickstream", root).count() == 2


def clicks(spark, *data):
    return spark.createDataFrame(data, "Customer_ID string, snapshot_date string, fe_1 int").withColumn(
        "snapshot_date", F.to_date("snapshot_date"))


def test_trailing_window(spark):
    data = [("a", f"2024-0{m}-01", m) for m in range(1, 9)] + [("b", "2024-03-01", 5), ("b", "2024-03-01", 6), ("b", "2024-07-01", None)]
    out = {(r.Customer_ID, r.snapshot_date): r.fe_1 for r in gold.trailing_window(clicks(spark, *data)).collect()}
    cutoff = date(2024, 8, 1)
    assert out[("a", cutoff)] == sum(range(3, 9)) / 6
    # no row in the cutoff month, still kept; the mean is over rows, nulls aside
    assert out[("b", cutoff)] == 5.5
    assert out[("b", date(2024, 9, 1))] is None


def test_window_completeness(spark):
    data = [("a", f"2024-0{m}-01", m) for m in (1, 2, 3, 4, 6, 7)]
    out = {r.cutoff.month: (r.n_found, r.n_expected, r.complete) for r in gold.window_completeness(clicks(spark, *data)).collect()}
    assert out[1] == (1, 1, True) and out[4] == (4, 4, True)
    assert out[5] == (4, 5, False) and out[7] == (5, 6, False)
