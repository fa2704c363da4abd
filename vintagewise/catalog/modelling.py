"""Queries on windows, folds, eligibility, training, scoring and whole monitoring runs."""

from pyspark.sql import functions as F

from ..functions.calendar import training_windows
from ..operators import correlation, drift, performance, profile, redundancy, splits
from ..plans import compiled, monitoring, schedule, training
from ..session import stored
from ..sources import store
from . import layers
from .drifting import MODEL_COUNT, PSI_SUM, binned_sql, edges_sql, points_sql, round_columns, rounded_sql, score_reference
from .registry import derived, query
from .scoring import GRID_SQL, auc_sql
from .views import MODELS

derived("registry", """
    select model as model_name, coalesce(stored_date, cast(replace(substr(model, 14), '_', '-') as date)) as train_date
    from models""", "models")
derived("months", "select distinct snapshot_date from raw_loans", "raw_loans")


def registry(t):
    return t("models").select(F.col("model").alias("model_name"), schedule.train_dates("model", "stored_date").alias("train_date"))


def months(t):
    return t.once("months", lambda: store.own_spine(t("raw_loans")))


@query("training_windows", needs=["registry", "label_store"], sql="""
    select r.model_name, cast(train_date - interval 14 month as date) as train_start,
           cast(train_date - interval 2 month - interval 1 day as date) as train_end,
           cast(train_date - interval 2 month as date) as oot_start, cast(train_date - interval 1 day as date) as oot_end,
           count(l.loan_id) as n_labels
    from registry r left join label_store l
      on l.snapshot_date between train_date - interval 14 month and train_date - interval 1 day
    group by r.model_name, train_date""")
def _(t):
    windows = registry(t).withColumns(training_windows(F.col("train_date")))
    monthly = layers.labels(t).groupBy(F.col("snapshot_date").alias("label_date")).agg(F.count("*").alias("n"))
    inside = F.col("label_date").between(F.col("train_start"), F.col("oot_end"))
    out = windows.join(monthly, inside, "left").groupBy("model_name", "train_start", "train_end", "oot_start", "oot_end")
    return out.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_labels"))


@query("time_split", needs=["label_store"], sql="""
    select case when snapshot_date >= date '1998-01-01' then 'oot' else 'train_test' end as split, count(*) as n_rows,
           avg(label) as bad_rate, count(*) filter (label = 0) > 0 as has_good, count(*) filter (label = 1) > 0 as has_bad
    from label_store where snapshot_date between date '1997-01-01' and date '1998-02-28' group by 1""")
def _(t):
    return splits.split_stats(splits.time_split(layers.labels(t), MODELS[1]))


@query("group_folds")
def _(t):
    folded = splits.group_folds(layers.labels(t), "Customer_ID", "label", 5)
    return folded.groupBy("fold").agg(
        F.countDistinct("Customer_ID").alias("n_groups"), F.count("*").alias("n_rows"), F.avg("label").alias("bad_rate"))


@query("train_dates", needs=["registry"], sql="select * from registry")
def _(t):
    return registry(t)


@query("eligible_models", needs=["registry", "months"], sql="""
    select m.snapshot_date, r.model_name, r.train_date from months m join registry r on r.train_date < m.snapshot_date""")
def _(t):
    return schedule.scoring_models(registry(t), months(t))


@query("monitored_models", needs=["registry", "months"], sql="""
    select m.snapshot_date, r.model_name, r.train_date, cast(r.train_date - interval 6 month as date) as first_cohort,
           cast(date_diff('month', cast(r.train_date - interval 6 month as date), m.snapshot_date) as int)
             as months_since_first_cohort,
           case when m.snapshot_date >= r.train_date then cast(m.snapshot_date - interval 6 month as date) end
             as performance_prediction_date
    from months m join registry r on r.train_date - interval 6 month <= m.snapshot_date""")
def _(t):
    return schedule.monitored_models(registry(t), months(t))


NUMBERS, TEXTS = layers.FEATURE_NUMBERS, layers.FEATURE_TEXTS

# whole monitoring run: references per model from its own windows, then every model at every month
derived("training_part", """
    select r.model_name, f.* from registry r join label_store l
      on l.snapshot_date between r.train_date - interval 14 month and r.train_date - interval 2 month - interval 1 day
    join feature_store f using (loan_id)""", "registry", "label_store", "feature_store")
derived("num_ref_long", " union all ".join(
    f"select model_name, '{c}' as feature, cast({c} as double) as value from training_part" for c in NUMBERS), "training_part")
derived("num_ref_points", points_sql("num_ref_long", "model_name, feature"), "num_ref_long")
derived("num_ref_edges", edges_sql("num_ref_points", "model_name, feature"), "num_ref_points")
derived("num_ref_bins", binned_sql("num_ref_long", "num_ref_edges", "model_name, feature", "model_name, feature"),
        "num_ref_long", "num_ref_edges")
derived("num_ref_stats", """
    select model_name, feature, avg(value) as mean, quantile_cont(value, 0.5) as median, var_samp(value) as var,
           stddev_samp(value) as std, count(*) filter (value is null) / count(*) as missing_rate
    from num_ref_long group by 1, 2""", "num_ref_long")
derived("cat_ref_long", " union all ".join(
    f"select model_name, '{c}' as feature, {c} as value from training_part" for c in TEXTS), "training_part")
derived("cat_ref_shares", """
    with c as (select model_name, feature, coalesce(value, '__MISSING__') as name, count(*) as n from cat_ref_long group by 1, 2, 3)
    select model_name, feature, name, n / sum(n) over (partition by model_name, feature) as share from c
    qualify row_number() over (partition by model_name, feature order by n desc, name) <= 20""", "cat_ref_long")
derived("run_months", """
    select r.model_name, r.train_date, m.snapshot_date,
           exists (select 1 from predictions p where p.model_name = r.model_name and p.snapshot_date = m.snapshot_date) as has_p,
           exists (select 1 from feature_keys f where f.snapshot_date = m.snapshot_date) as has_f,
           exists (select 1 from label_store l where l.snapshot_date = m.snapshot_date) as has_l,
           exists (select 1 from predictions p where p.model_name = r.model_name
                   and p.snapshot_date = cast(m.snapshot_date - interval 6 month as date)) as has_c
    from registry r join months m on m.snapshot_date >= r.train_date - interval 6 month""",
        "registry", "months", "predictions", "feature_keys", "label_store")
derived("run_features", """
    select p.model_name, p.snapshot_date, f.loan_id as matched, f.* exclude (loan_id, snapshot_date)
    from predictions p join run_months r on r.model_name = p.model_name and r.snapshot_date = p.snapshot_date and r.has_f
    left join feature_store f on f.loan_id = p.loan_id""", "predictions", "run_months", "feature_store")
derived("num_act_long", " union all ".join(
    f"select model_name, snapshot_date, '{c}' as feature, cast({c} as double) as value from run_features" for c in NUMBERS),
    "run_features")
derived("num_act_bins", binned_sql("num_act_long", "num_ref_edges", "model_name, snapshot_date, feature", "model_name, feature"),
        "num_act_long", "num_ref_edges")
derived("run_numeric", f"""
    select a.model_name, a.snapshot_date, a.feature, a.n, case when a.n = 0 then 10.0 else p.psi end as psi,
           r.mean as mean_ref, a.mean as mean_act, r.median as median_ref, a.median as median_act, r.var as var_ref,
           a.var as var_act, (a.mean - r.mean) / r.std as smd_mean, (a.median - r.median) / r.std as smd_median,
           a.var / r.var as var_ratio, r.missing_rate as missing_rate_ref, a.missing_rate as missing_rate_act,
           case when a.n = 0 then 'all_values_missing' else 'ok' end as status
    from (select model_name, snapshot_date, feature, count(value) as n, avg(value) as mean,
                 quantile_cont(value, 0.5) as median, var_samp(value) as var,
                 count(*) filter (value is null) / count(*) as missing_rate from num_act_long group by 1, 2, 3) a
    join num_ref_stats r using (model_name, feature)
    left join (select n.model_name, n.snapshot_date, n.feature, {PSI_SUM.format(a='n.share', e='o.share')} as psi
               from num_act_bins n join num_ref_bins o using (model_name, feature, bin) group by 1, 2, 3) p
      using (model_name, snapshot_date, feature)""", "num_act_long", "num_ref_stats", "num_act_bins", "num_ref_bins")
derived("cat_act_long", " union all ".join(
    f"select model_name, snapshot_date, '{c}' as feature, {c} as value from run_features" for c in TEXTS), "run_features")
derived("run_categorical", f"""
    with e as (select model_name, feature, name, share from cat_ref_shares
               union all select model_name, feature, '__OTHER__', greatest(0, 1 - sum(share)) from cat_ref_shares group by 1, 2),
         w as (select model_name, feature, name, share / sum(share) over (partition by model_name, feature) as share from e),
         r as (select l.model_name, l.snapshot_date, l.feature, l.value,
                      case when c.name is null then '__OTHER__' else c.name end as name
               from cat_act_long l left join cat_ref_shares c on c.model_name = l.model_name and c.feature = l.feature
                 and c.name = coalesce(l.value, '__MISSING__')),
         a as (select model_name, snapshot_date, feature, name,
                      count(*) / sum(count(*)) over (partition by model_name, snapshot_date, feature) as share
               from r group by 1, 2, 3, 4),
         s as (select model_name, snapshot_date, feature, count(value) as n,
                      count(*) filter (value is null) / count(*) as missing_rate_act from r group by 1, 2, 3),
         m as (select model_name, feature, count(*) filter (value is null) / count(*) as missing_rate_ref
               from cat_ref_long group by 1, 2)
    select s.model_name, s.snapshot_date, s.feature, any_value(s.n) as n,
           {PSI_SUM.format(a='coalesce(a.share, 0)', e='w.share')} as psi, any_value(m.missing_rate_ref) as missing_rate_ref,
           any_value(s.missing_rate_act) as missing_rate_act, 'ok' as status
    from s join w using (model_name, feature) join m using (model_name, feature)
    left join a using (model_name, snapshot_date, feature, name) group by 1, 2, 3""", "cat_ref_shares", "cat_act_long", "cat_ref_long")
derived("run_covariates", """
    select * from run_numeric union all by name select * from run_categorical""", "run_numeric", "run_categorical")

COVARIATE_PLACES = {"psi": 8, "mean_ref": 5, "mean_act": 5, "median_ref": 6, "median_act": 6, "var_ref": 2, "var_act": 2,
                    "smd_mean": 8, "smd_median": 8, "var_ratio": 8, "missing_rate_ref": 9, "missing_rate_act": 9}


def training_parts(t):
    """Every model's training rows. Windows are spelled out as months and met by equality, not by a date range."""
    windows = registry(t).withColumns(training_windows(F.col("train_date")))
    due = windows.select("model_name", "train_start", "train_end", F.explode(F.sequence(
        F.trunc("train_start", "MM"), F.trunc("train_end", "MM"), F.expr("interval 1 month"))).alias("month"))
    dated = layers.stored_labels(t).select("loan_id", "label", "snapshot_date", F.trunc("snapshot_date", "MM").alias("month"))
    rows = dated.join(due, "month").where(F.col("snapshot_date").between(F.col("train_start"), F.col("train_end")))
    rows = rows.select("model_name", "loan_id", "label")
    return stored(rows.join(layers.stored_features(t).select("loan_id", *NUMBERS, *TEXTS), "loan_id"), "part")


def references(t) -> monitoring.References:
    """Each model's feature distributions over its own training window, and its out-of-time scores."""
    part = training_parts(t)
    numeric = drift.numeric_reference(
        profile.long_numbers(part, NUMBERS, ["model_name"]), ["model_name"], groups=MODEL_COUNT * len(NUMBERS))
    categorical = drift.categorical_reference(profile.long_texts(part, TEXTS, ["model_name"]), ["model_name"])
    # kept as tables, the way training leaves them
    return monitoring.References(stored(numeric, "numeric"), stored(categorical, "categorical"),
                                 stored(score_reference(t), "scores"), NUMBERS, TEXTS, MODEL_COUNT)


def _monitor(t) -> monitoring.Monitoring:
    models = registry(t).withColumn("auc_oot", F.lit(None).cast("double"))
    return monitoring.monitor(models, months(t), layers.stored_predictions(t), layers.stored_features(t), layers.stored_labels(t), references(t),
                              inference_id="run_1", check=False)


@query("monitoring_covariates", needs=["run_covariates"], sql=f"""
    select model_name, snapshot_date, {rounded_sql(['feature', 'n', *COVARIATE_PLACES, 'status'], COVARIATE_PLACES)},
           'run_1' as inference_id from run_covariates""")
def _(t):
    return round_columns(_monitor(t).covariates, COVARIATE_PLACES)


derived("cohort_scores", """
    select p.model_name, cast(p.snapshot_date + interval 6 month as date) as snapshot_date, p.snapshot_date as cohort, l.label,
           l.loan_id is not null as found,
           case when not isnan(p.model_predictions) and p.model_predictions between 0 and 1 and l.label is not null
                then p.model_predictions end as score
    from predictions p
    join run_months r on r.model_name = p.model_name and r.snapshot_date = cast(p.snapshot_date + interval 6 month as date)
      and r.snapshot_date >= r.train_date and r.has_l
    left join label_store l on l.loan_id = p.loan_id and l.snapshot_date = r.snapshot_date""",
        "predictions", "run_months", "label_store")
derived("run_performance", f"""
    select c.*, a.auc from (
      select model_name, snapshot_date, count(*) as n_all, count(*) filter (found) as n_matched, count(score) as n_valid,
             count(*) filter (label = 1 and score is not null) as bad from cohort_scores group by 1, 2) c
    left join ({auc_sql('(select * from cohort_scores where score is not null)', 'score', 'label', 'model_name, snapshot_date')}) a
      using (model_name, snapshot_date)""", "cohort_scores")
derived("run_score_psi", f"""
    select m.model_name, m.snapshot_date, {PSI_SUM.format(a='m.share', e='o.share')} as psi
    from month_bins m join oot_bins o using (model_name, bin) group by 1, 2""", "month_bins", "oot_bins")
derived("run_prev_psi", f"""
    select m.model_name, m.snapshot_date, {PSI_SUM.format(a='m.share', e='o.share')} as psi
    from month_bins m join month_bins o on o.model_name = m.model_name and o.bin = m.bin
      and o.snapshot_date = m.snapshot_date - interval 1 month group by 1, 2""", "month_bins")

METRIC_PLACES = {"score_psi": 8, "score_psi_vs_prev_month": 8, "max_feature_psi": 8, "max_missing_rate_delta": 9,
                 "bad_rate": 9, "auc": 9, "gini": 9}


@query("monitoring_metrics",
       needs=["run_months", "run_features", "run_covariates", "run_performance", "run_score_psi", "run_prev_psi", "predictions"],
       sql="""
    select r.snapshot_date, 'run_1' as inference_id, r.model_name, r.train_date as model_train_date,
           cast(r.train_date - interval 6 month as date) as model_date,
           cast(date_diff('month', cast(r.train_date - interval 6 month as date), r.snapshot_date) as int)
             as months_since_first_cohort,
           case when not has_p then 'predictions_missing' when not has_f then 'features_missing' else 'ok' end as drift_status,
           case when has_p and has_f then n.n else 0 end as n_predictions,
           case when has_p and has_f then n.valid else 0 end as n_valid_scores,
           coalesce(f.matched, 0) as n_features_matched, coalesce(f.missed, 0) as n_features_unmatched,
           case when has_f then round(sp.psi, 8) end as score_psi,
           case when has_f then round(pp.psi, 8) end as score_psi_vs_prev_month,
           coalesce(c.monitored, 0) as n_features_monitored, round(c.top, 8) as max_feature_psi,
           coalesce(c.high, 0) as n_features_psi_high, coalesce(c.empty, 0) as n_features_all_missing,
           round(c.delta, 9) as max_missing_rate_delta, coalesce(c.shift, 0) as n_features_missing_shift,
           case when c.shift is null then 'not_evaluated' when c.shift > 0 then 'feature_availability_failure' else 'ok' end
             as data_quality_status,
           6 as label_horizon_months,
           case when r.snapshot_date >= r.train_date then cast(r.snapshot_date - interval 6 month as date) end
             as performance_prediction_date,
           r.snapshot_date as label_observation_date,
           case when r.snapshot_date < r.train_date then 'cohort_in_training' when not has_l then 'labels_missing'
                when not has_c then 'cohort_predictions_missing' when p.n_valid = 0 then 'no_valid_labelled_predictions'
                when p.bad in (0, p.n_valid) then 'single_class' else 'ok' end as performance_status,
           coalesce(p.n_all, 0) as n_performance_predictions, coalesce(p.n_matched, 0) as n_labels_matched,
           coalesce(p.n_all - p.n_matched, 0) as n_labels_unmatched, coalesce(p.n_valid, 0) as n_labelled_valid,
           case when p.bad not in (0, p.n_valid) then round(p.bad / p.n_valid, 9) end as bad_rate,
           round(p.auc, 9) as auc, round(2 * p.auc - 1, 9) as gini, cast(null as double) as auc_oot_ref
    from run_months r
    left join (select model_name, snapshot_date, count(*) as n,
                      count(*) filter (not isnan(model_predictions) and model_predictions between 0 and 1) as valid
               from predictions group by 1, 2) n using (model_name, snapshot_date)
    left join (select model_name, snapshot_date, count(matched) as matched, count(*) - count(matched) as missed
               from run_features group by 1, 2) f using (model_name, snapshot_date)
    left join (select model_name, snapshot_date, count(*) as monitored, max(psi) as top, count(*) filter (psi > 0.25) as high,
                      count(*) filter (status = 'all_values_missing') as empty, max(missing_rate_act - missing_rate_ref) as delta,
                      count(*) filter (missing_rate_act - missing_rate_ref > 0.5) as shift
               from run_covariates group by 1, 2) c using (model_name, snapshot_date)
    left join run_score_psi sp using (model_name, snapshot_date)
    left join run_prev_psi pp using (model_name, snapshot_date)
    left join run_performance p using (model_name, snapshot_date)""")
def _(t):
    return round_columns(_monitor(t).metrics, METRIC_PLACES)


derived("run_roc_points", """
    select model_name, snapshot_date, s, cast(sum(sum(1 - label)) over w as bigint) as false_pos,
           cast(sum(sum(label)) over w as bigint) as true_pos,
           cast(sum(sum(1 - label)) over (partition by model_name, snapshot_date) as bigint) as good_total,
           cast(sum(sum(label)) over (partition by model_name, snapshot_date) as bigint) as bad_total
    from (select model_name, snapshot_date, label, score as s from cohort_scores where score is not null) t
    group by model_name, snapshot_date, s window w as (partition by model_name, snapshot_date order by s desc)
    union all
    select model_name, snapshot_date, null, 0, 0, sum(1 - label)::bigint, sum(label)::bigint
    from cohort_scores where score is not null group by 1, 2""", "cohort_scores")
derived("run_roc_valid", "select * from run_roc_points where good_total > 0 and bad_total > 0", "run_roc_points")


@query("monitoring_roc", needs=["run_roc_valid"], sql=f"""
    select model_name, snapshot_date as label_observation_date, cast(snapshot_date - interval 6 month as date)
             as performance_prediction_date, fpr, tpr, 'run_1' as inference_id
    from ({GRID_SQL.format(by='model_name, snapshot_date', points='run_roc_valid')}) g""")
def _(t):
    return _monitor(t).roc.withColumn("tpr", F.round("tpr", 9))


@query("training_reference", needs=["num_ref_stats", "num_ref_edges", "num_ref_bins"], sql="""
    select b.model_name, b.feature, cast(b.bin as int) as bin, round(e.edges[b.bin + 1], 6) as bin_low,
           round(e.edges[b.bin + 2], 6) as bin_high, round(b.share, 9) as share, round(s.mean, 5) as mean,
           round(s.median, 6) as median, round(s.missing_rate, 9) as missing_rate
    from num_ref_bins b join num_ref_edges e using (model_name, feature) join num_ref_stats s using (model_name, feature)""")
def _(t):
    ref = references(t).numeric
    bins = ref.select("model_name", "feature", "mean", "median", "missing_rate", "edges", F.posexplode("pct").alias("bin", "share"))
    return bins.select(
        "model_name", "feature", "bin", F.round(F.get("edges", F.col("bin")), 6).alias("bin_low"),
        F.round(F.get("edges", F.col("bin") + 1), 6).alias("bin_high"), F.round("share", 9).alias("share"),
        F.round("mean", 5).alias("mean"), F.round("median", 6).alias("median"), F.round("missing_rate", 9).alias("missing_rate"))


derived("stump_part", """
    select r.model_name, l.label, f.* from registry r join label_store l
      on l.snapshot_date between r.train_date - interval 14 month and r.train_date - interval 2 month - interval 1 day
    join feature_store f using (loan_id)""", "registry", "label_store", "feature_store")
derived("stump_long", " union all ".join(
    f"select model_name, label, '{c}' as feature, cast({c} as double) as value from stump_part" for c in NUMBERS), "stump_part")
_LEAF = "ln((count(*) filter (label = 1 and {0}) + 0.5) / (count(*) filter (label = 0 and {0}) + 0.5)) / " + str(2 * len(NUMBERS))
derived("stumps", f"""
    select model_name, feature, any_value(threshold) as threshold, {_LEAF.format('value <= threshold')} as low,
           {_LEAF.format('value > threshold')} as high, {_LEAF.format('value is null')} as missing
    from stump_long join (select model_name, feature, quantile_cont(value, 0.5) as threshold from stump_long group by 1, 2) m
      using (model_name, feature) group by 1, 2""", "stump_long")
derived("cohort_long", " union all ".join(
    f"select loan_id, snapshot_date, '{c}' as feature, cast({c} as double) as value from feature_store" for c in NUMBERS),
    "feature_store")


@query("score_cohort", needs=["registry", "stumps", "cohort_long"], sql="""
    select loan_id, snapshot_date, model_name, round(1 / (1 + exp(-2 * sum(
             case when value is null then missing when value <= threshold then low else high end))), 9) as model_predictions
    from cohort_long join registry on snapshot_date > train_date join stumps using (model_name, feature) group by 1, 2, 3""")
def _(t):
    """Every loan scored by all models trained before its month, in one scan of the feature store."""
    stumps = compiled.fit_stumps(training_parts(t), NUMBERS, "model_name", "label", MODEL_COUNT * len(NUMBERS))
    found = {}
    for row in stumps.collect():  # one row per model and feature
        found.setdefault(row.model_name, []).append(row)
    models = [compiled.from_stumps(r.model_name, r.train_date, found[r.model_name]) for r in registry(t).collect() if r.model_name in found]
    scored = compiled.score_models(layers.stored_features(t), models, ["loan_id", "snapshot_date"])
    return scored.withColumn("model_predictions", F.round("model_predictions", 9))


derived("number_rows", "select row_number() over () as rid, label, f.* from feature_store f join label_store using (loan_id)",
        "feature_store", "label_store")
derived("number_long", " union all ".join(
    f"select rid, label, '{c}' as feature, cast({c} as double) as value from number_rows where {c} is not null" for c in NUMBERS),
    "number_rows")
_MEAN_RANK = """rank() over (partition by p.feature, q.feature order by {0}.value)
                + (count(*) over (partition by p.feature, q.feature, {0}.value) - 1) / 2"""
derived("rank_links", f"""
    select f, g from (select p.feature as f, q.feature as g, {_MEAN_RANK.format("p")} as x, {_MEAN_RANK.format("q")} as y
                      from number_long p join number_long q on p.rid = q.rid and p.feature < q.feature) r
    group by 1, 2 having stddev_pop(x) > 0 and stddev_pop(y) > 0 and abs(corr(x, y)) >= 0.95""", "number_long")


@query("prune_features", needs=["rank_links"], sql=f"""
    select feature, gini, cluster, count(*) over (partition by cluster) as size,
           gini = max(gini) over (partition by cluster) as keep
    from (select feature, round(abs(2 * auc - 1), 9) as gini from ({auc_sql('number_long', 'value', 'label', 'feature')}) a) s
    join (with recursive reach as (
            select distinct feature, feature as other from number_long
            union
            select r.feature, l.b from reach r
            join (select f as a, g as b from rank_links union all select g, f from rank_links) l on l.a = r.other)
          select feature, min(other) as cluster from reach group by 1) c using (feature)""")
def _(t):
    """Which of the features that rank the loans alike is kept: the one with the strongest signal."""
    rows = layers.labelled(t, *NUMBERS)
    signal = performance.feature_signal(profile.long_numbers(rows, NUMBERS, ["label"]), "label", len(NUMBERS))
    correlations = correlation.spearman_matrix(rows, NUMBERS)
    return redundancy.prune_features(correlations, signal.select("feature", F.round("gini", 9).alias("gini")), 0.95)


# a fixed setting of the search space; the search itself is its own query
SETTINGS = {"maxIter": 25, "maxDepth": 2, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
            "minInfoGain": 0.0, "minInstancesPerNode": 1}


def _trained(t, settings=SETTINGS, **search):
    return training.train(layers.stored_labels(t), layers.stored_features(t), MODELS[1], settings, check=False, **search)


def _trained_alone(t, settings=SETTINGS, **search):
    """For queries that read nothing but the model's own rows: no month outside its windows is cleaned, joined and written."""
    labels, features = training.window_inputs(layers.labels(t), layers.features(t), MODELS[1])
    return training.train(stored(labels, "window_labels"), stored(features, "window_features"), MODELS[1], settings, check=False, **search)


@query("train_score")
def _(t):
    model = _trained(t)
    later = layers.stored_features(t).where(F.col("snapshot_date") > F.lit(MODELS[1]).cast("date"))
    return training.score(later, model.pipeline, model.name)


@query("split_performance")
def _(t):
    return training.split_performance(_trained_alone(t))


@query("feature_importance")
def _(t):
    return training.importance(_trained_alone(t))


@query("random_search")
def _(t):
    return training.split_performance(_trained_alone(t, None))


