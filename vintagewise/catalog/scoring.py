"""Queries on AUC, ROC, feature signal, cohort performance and run history."""

import uuid

from pyspark.sql import functions as F

from ..operators import history, joins, performance, profile
from ..plans import run_history
from ..session import ensure_checkpoint_dir
from ..sources import store
from . import layers
from .registry import derived, query

derived("line_scores", """
    select l_linestatus as grp, case when l_returnflag = 'R' then 1 else 0 end as y,
           l_discount as s1, (l_orderkey * 7919 % 1000) / 1000e0 as s2 from lineitem""")


def auc_sql(table: str, score: str, label: str, by: str) -> str:
    """Rank-sum form, ties sharing their mean rank."""
    return f"""
      select {by}, sum({label}) as n_bad, count(*) - sum({label}) as n_good,
             (sum(rk) filter ({label} = 1) - sum({label}) * (sum({label}) + 1) / 2)
               / nullif(cast(sum({label}) as double) * (count(*) - sum({label})), 0) as auc
      from (select {by}, {label}, rank() over (partition by {by} order by {score})
                   + (count(*) over (partition by {by}, {score}) - 1) / 2 as rk from {table}) r group by {by}"""


def _line_scores(t):
    return t("lineitem").select(
        F.col("l_linestatus").alias("grp"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_discount").alias("s1"), ((F.col("l_orderkey") * 7919 % 1000) / 1000).alias("s2"))


@query("auc_gini", needs=["line_scores"], sql=f"""
    select grp, cast(n_bad as bigint) as n_bad, cast(n_good as bigint) as n_good, round(auc, 9) as auc,
           round(2 * auc - 1, 9) as gini from ({auc_sql('line_scores', 's1', 'y', 'grp')}) a""")
def _(t):
    out = performance.auc(_line_scores(t), "s1", "y", ["grp"])
    return out.withColumns({"auc": F.round("auc", 9), "gini": F.round("gini", 9)})


@query("auc_overall", needs=["line_scores"], sql=f"""
    select cast(n_bad as bigint) as n_bad, cast(n_good as bigint) as n_good, round(auc, 9) as auc,
           round(2 * auc - 1, 9) as gini
    from ({auc_sql('(select 1 as one, * from line_scores)', 's2', 'y', 'one')}) a""")
def _(t):
    out = performance.auc(_line_scores(t), "s2", "y")
    return out.withColumns({"auc": F.round("auc", 9), "gini": F.round("gini", 9)})


derived("roc_points", """
    select grp, s as threshold, cast(sum(sum(1 - y)) over w as bigint) as false_pos,
           cast(sum(sum(y)) over w as bigint) as true_pos,
           cast(sum(sum(1 - y)) over (partition by grp) as bigint) as good_total,
           cast(sum(sum(y)) over (partition by grp) as bigint) as bad_total
    from (select grp, y, s2 as s from line_scores) t group by grp, s window w as (partition by grp order by s desc)
    union all
    select grp, null, 0, 0, sum(1 - y)::bigint, sum(y)::bigint from line_scores group by grp""", "line_scores")


@query("roc_curve", needs=["roc_points"], sql="""
    select *, false_pos / good_total as fpr, true_pos / bad_total as tpr from roc_points""")
def _(t):
    return performance.roc_points(performance.ranked_scores(_line_scores(t), "s2", "y", ["grp"]), "s2", ["grp"])


GRID_SQL = """
    with n as (select {by}, g, max({{'f': false_pos, 't': true_pos}}) filter (false_pos * 100 <= g * good_total) as l,
                      min({{'f': false_pos, 't': true_pos}}) filter (false_pos * 100 > g * good_total) as r,
                      any_value(good_total) as good, any_value(bad_total) as bad
               from {points}, (select unnest(generate_series(0, 100)) as g) s group by {by}, g)
    select {by}, cast(g as int) as cell, g / 100 as fpr,
           round(coalesce(l.t / bad + (r.t - l.t) / bad * (g / 100 - l.f / good) / ((r.f - l.f) / good), l.t / bad), 9) as tpr
    from n"""


@query("roc_grid", needs=["roc_points"], sql=GRID_SQL.format(by="grp", points="roc_points"))
def _(t):
    points = performance.roc_points(performance.ranked_scores(_line_scores(t), "s2", "y", ["grp"]), "s2", ["grp"])
    return performance.roc_grid(points, ["grp"]).withColumn("tpr", F.round("tpr", 9))


# every numeric feature of the store
SIGNALS = layers.FEATURE_NUMBERS
derived("signal_long", " union all ".join(
    f"select '{c}' as feature, cast({c} as double) as value, label from feature_store join label_store using (loan_id) "
    f"where {c} is not null" for c in SIGNALS), "feature_store", "label_store")


@query("feature_gini", needs=["signal_long"], sql=f"""
    select feature, cast(n_bad as bigint) as n_bad, cast(n_good as bigint) as n_good, round(abs(2 * auc - 1), 9) as gini
    from ({auc_sql('signal_long', 'value', 'label', 'feature')}) a""")
def _(t):
    long = profile.long_numbers(layers.labelled(t, *SIGNALS), SIGNALS, ["label"])
    return performance.feature_signal(long, "label", len(SIGNALS)).withColumn("gini", F.round("gini", 9))


derived("matched_scores", """
    select p.model_name, p.snapshot_date, l.label,
           case when not isnan(p.model_predictions) and p.model_predictions between 0 and 1 and l.label is not null
                then p.model_predictions end as score
    from predictions p left join label_store l using (loan_id)""", "predictions", "label_store")
derived("performance", f"""
    select c.model_name, c.snapshot_date,
           case when n_valid = 0 then 'no_valid_labelled_predictions' when c.n_bad in (0, n_valid) then 'single_class'
                else 'ok' end as performance_status,
           n_all as n_performance_predictions, n_matched as n_labels_matched, n_all - n_matched as n_labels_unmatched,
           n_valid as n_labelled_valid, case when c.n_bad not in (0, n_valid) then c.n_bad / n_valid end as bad_rate, a.auc
    from (select model_name, snapshot_date, count(*) as n_all, count(label) as n_matched, count(score) as n_valid,
                 count(*) filter (label = 1 and score is not null) as n_bad
          from matched_scores group by 1, 2) c
    left join ({auc_sql('(select * from matched_scores where score is not null)', 'score', 'label',
                        'model_name, snapshot_date')}) a using (model_name, snapshot_date)""", "matched_scores")


@query("cohort_performance", needs=["performance"], sql="""
    select * replace (round(auc, 9) as auc), round(2 * auc - 1, 9) as gini from performance""")
def _(t):
    joined = joins.with_match(t("predictions"), layers.labels(t).select("loan_id", "label"), ["loan_id"])
    out = performance.cohort_performance(joined, ["model_name", "snapshot_date"])
    return out.withColumns({"auc": F.round("auc", 9), "gini": F.round("gini", 9)})


derived("latest", """
    select * from drift_runs qualify row_number() over (partition by snapshot_date, feature order by inference_id desc) = 1
    """, "drift_runs")
derived("top_features", "select feature from latest group by 1 order by max(psi) desc, feature limit 3", "latest")


def _latest(t):
    return history.newest_rows(t("drift_runs"), ["snapshot_date", "feature"])


@query("latest_run", needs=["latest"], sql="select * from latest")
def _(t):
    return _latest(t)


_DAYS = ", ".join(f"max(psi) filter (day(snapshot_date) = {d}) as d{d:02}" for d in range(1, 32))


@query("pivot_drift", needs=["latest"], sql=f"""
    select feature, cast(date_trunc('month', snapshot_date) as date) as month, {_DAYS} from latest group by 1, 2""")
def _(t):
    return history.pivot_days(_latest(t), "feature", "snapshot_date", "psi")


@query("topn_features", needs=["latest", "top_features"], sql="select * from latest where feature in (from top_features)")
def _(t):
    return history.top_groups(_latest(t), "feature", "psi", 3)


@query("cum_importance", needs=[], sql="""
    with i as (select p_name || '_' || p_partkey as feature, p_retailprice as importance from part)
    select feature, importance, row_number() over (order by importance desc, feature) as place,
           round(sum(importance) over (order by importance desc, feature) / sum(importance) over (), 9) as cumulative_share
    from i""")
def _(t):
    parts = t("part").select(F.concat_ws("_", "p_name", "p_partkey").alias("feature"), F.col("p_retailprice").alias("importance"))
    out = history.cumulative_share(parts, "feature", "importance")
    return out.withColumn("cumulative_share", F.round("cumulative_share", 9))


@query("best_in_cluster", needs=[], sql="""
    select p_brand, p_partkey, p_retailprice, count(*) over (partition by p_brand) as size,
           p_retailprice = max(p_retailprice) over (partition by p_brand) as keep from part""")
def _(t):
    return history.group_figures(t("part").select("p_brand", "p_partkey", "p_retailprice"), "p_brand", "p_retailprice")


@query("metric_history", needs=["latest"], sql="""
    select snapshot_date, max(psi) as max_feature_psi, count(*) as n_features, max(inference_id) as inference_id,
           cast(null as double) as auc from latest group by 1
    union all
    select cast(o_orderdate as date), null, count(*), null, avg(case when o_orderstatus = 'F' then 1 else 0 end)
    from orders group by 1""")
def _(t):
    drift_runs = _latest(t).groupBy("snapshot_date").agg(
        F.max("psi").alias("max_feature_psi"), F.count("*").alias("n_features"), F.max("inference_id").alias("inference_id"))
    other_runs = t("orders").groupBy(F.to_date("o_orderdate").alias("snapshot_date")).agg(
        F.count("*").alias("n_features"), F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("auc"))
    return history.history(drift_runs, other_runs)


# two saved runs: run_9 over every second click, run_10 over all of them, but for the first half of each month only
derived("saved_drift", """
    with c as (select concat('model_', user_id % 2) as model_name, cast(date_trunc('day', ts) as date) as snapshot_date,
                      event_type as feature, event_id, value from events)
    select model_name, 'run_9' as inference_id, 9 as number, snapshot_date, feature, avg(value) as psi
    from c where event_id % 2 = 0 group by all
    union all
    select model_name, 'run_10', 10, snapshot_date, feature, avg(value) from c where day(snapshot_date) <= 15 group by all""")
derived("newest_drift", """
    select * from saved_drift qualify number = max(number) over (partition by model_name, snapshot_date)""", "saved_drift")


def _saved_runs(t):
    """Writes both runs as a monitoring run leaves its covariates; returns the folder."""
    clicks = t("events").select(
        F.concat(F.lit("model_"), F.col("user_id") % 2).alias("model_name"), F.to_date("ts").alias("snapshot_date"),
        F.col("event_type").alias("feature"), "event_id", "value")
    root = f"{ensure_checkpoint_dir(t.spark)}/histories/{uuid.uuid4().hex}"
    parts = {"run_9": clicks.where(F.col("event_id") % 2 == 0), "run_10": clicks.where(F.dayofmonth("snapshot_date") <= 15)}
    for run, part in parts.items():
        rows = part.groupBy("model_name", "snapshot_date", "feature").agg(F.avg("value").alias("psi"))
        store.write_months(rows.withColumn("inference_id", F.lit(run)), f"{root}/covariates", *run_history.RUN_KEYS)
    return root


@query("run_history", needs=["newest_drift"], sql="""
    select model_name, feature, inference_id, snapshot_date, round(psi, 9) as psi from newest_drift""")
def _(t):
    """Two runs saved, and the newest of every model and day read back."""
    rows = run_history.read_newest(t.spark, f"{_saved_runs(t)}/covariates")
    return rows.select("model_name", "feature", "inference_id", "snapshot_date", F.round("psi", 9).alias("psi"))


@query("run_history_top", needs=["newest_drift"], sql="""
    with b as (select model_name, feature, max(psi) as top from newest_drift group by 1, 2),
         c as (select model_name, feature from b qualify row_number() over (partition by model_name order by top desc, feature) <= 2)
    select model_name, feature, snapshot_date, round(psi, 9) as psi from newest_drift join c using (model_name, feature)""")
def _(t):
    """The saved drift of each model's two worst features."""
    return run_history.top_feature_psi(t.spark, _saved_runs(t), 2).withColumn("psi", F.round("psi", 9))
