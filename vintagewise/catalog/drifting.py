"""Queries on drift: PSI of numbers, categories and scores, and the drift table."""

from pyspark.sql import functions as F

from ..functions.calendar import date_lit
from ..functions.clean import valid_score
from ..operators import drift, profile
from ..schemas import REFERENCE_CATEGORIES
from ..session import stored
from . import layers
from .registry import derived, query, rounded

NUMBERS = ["l_quantity", "l_extendedprice"]
SPLIT = "1998-01-01"


def _melt(table, columns, keep=""):
    return " union all ".join(f"select {keep}'{c}' as feature, cast({c} as double) as value from {table}" for c in columns)


def points_sql(table: str, by: str) -> str:
    """Eleven quantiles per group by rank and linear interpolation."""
    return f"""
      select {by}, i, max(case when rk = lo then value end) + (max(case when rk = hi then value end)
               - max(case when rk = lo then value end)) * (any_value(i * (n - 1) % 10) / 10) as point
      from (select {by}, value, i, n, rk, (i * (n - 1)) // 10 as lo, least((i * (n - 1)) // 10 + 1, n - 1) as hi
            from (select {by}, value, row_number() over (partition by {by} order by value) - 1 as rk,
                         count(*) over (partition by {by}) as n from {table} where value is not null) r,
                 (select unnest(generate_series(0, 10)) as i) s) p
      where rk in (lo, hi) group by {by}, i"""


def edges_sql(points: str, by: str) -> str:
    return f"""
      select {by}, case when len(list_distinct(list(point))) = 1 then [min(point), min(point)]
                        else list_sort(list_distinct(list(point))) end as edges from {points} group by {by}"""


def binned_sql(table: str, edges: str, by: str, on: str) -> str:
    """Rows per bin of the clipped values, empty bins included, for each `by` group of `table`."""
    return f"""
      select g.*, b.bin, coalesce(c.n, 0) as n, coalesce(c.n, 0) / sum(coalesce(c.n, 0)) over (partition by {by}) as share
      from (select distinct {by} from {table} where value is not null) g
      join (select {on}, unnest(generate_series(0, len(edges) - 2)) as bin from {edges}) b using ({on})
      left join (select {', '.join('t.' + k.strip() for k in by.split(','))},
                        greatest(0, least(len(list_filter(edges, lambda e: e <= t.value)), len(edges) - 1) - 1) as bin, count(*) as n
                 from {table} t join {edges} using ({on}) where t.value is not null group by {by}, bin) c using ({by}, bin)"""


PSI_SUM = "sum((greatest({a}, 1e-6) - greatest({e}, 1e-6)) * ln(greatest({a}, 1e-6) / greatest({e}, 1e-6)))"

derived("old_lines", _melt(f"(select * from lineitem where l_shipdate < timestamp '{SPLIT}')", NUMBERS))
derived("new_lines", _melt(f"(select * from lineitem where l_shipdate >= timestamp '{SPLIT}')", NUMBERS))
derived("old_points", points_sql("old_lines", "feature"), "old_lines")
derived("old_edges", edges_sql("old_points", "feature"), "old_points")
derived("old_bins", binned_sql("old_lines", "old_edges", "feature", "feature"), "old_lines", "old_edges")
derived("new_bins", binned_sql("new_lines", "old_edges", "feature", "feature"), "new_lines", "old_edges")


@query("psi_numeric", needs=["old_bins", "new_bins"], sql=f"""
    select feature, round({PSI_SUM.format(a='n.share', e='o.share')}, 9) as psi
    from old_bins o join new_bins n using (feature, bin) group by 1""")
def _(t):
    lines, k = t("lineitem"), len(NUMBERS)
    old = profile.long_numbers(lines.where(F.col("l_shipdate") < date_lit(SPLIT)), NUMBERS)
    new = profile.long_numbers(lines.where(F.col("l_shipdate") >= date_lit(SPLIT)), NUMBERS)
    reference = drift.score_reference(old, ["feature"], groups=k)
    totals = drift.score_shares(new, reference, ["feature"], ["feature"], k)
    return drift.score_psi(totals, ["feature"]).withColumn("psi", F.round("psi", 9))


@query("psi_categorical", needs=[], sql=f"""
    with y as (select cast(year(o_orderdate) as int) as year, o_orderpriority as p, count(*) as n from orders group by 1, 2),
         s as (select year, p, n / sum(n) over (partition by year) as share from y),
         b as (select p, share from s where year = 1995)
    select year, round({PSI_SUM.format(a='coalesce(s.share, 0)', e='b.share')}, 9) as psi
    from (select distinct year from y) g cross join b left join s using (year, p) group by 1""")
def _(t):
    shares = profile.shares(t("orders").withColumn("year", F.year("o_orderdate")), "o_orderpriority", ["year"])
    base = shares.where("year = 1995").drop("year")
    return drift.psi_against_base(base, shares, ["o_orderpriority"], ["year"]).withColumn("psi", F.round("psi", 9))


# every number of the cleaned financials; the last one is missing from the later years
FEATURES = ["Annual_Income", "Monthly_Inhand_Salary", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
            "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries",
            "Outstanding_Debt", "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly",
            "Monthly_Balance", "Credit_History_Years", "Credit_History_Months_part", "Credit_History_Age_Months",
            "Num_Bank_Accounts"]
CATEGORIES = ["Credit_Mix", "Type_of_Loan", "Payment_of_Min_Amount", "Payment_Behaviour"]
BASE_END = "1997-01-01"

derived("fin_years", """
    select year(snapshot_date)::int as year, * replace (case when year(snapshot_date) = 1999 then null else Num_of_Loan end
           as Num_of_Loan) from silver_financials""", "silver_financials")
derived("ref_long", _melt(f"(select * from fin_years where snapshot_date < date '{BASE_END}')", FEATURES), "fin_years")
derived("act_long", _melt(f"(select * from fin_years where snapshot_date >= date '{BASE_END}')", FEATURES[:-1], "year, "),
        "fin_years")
derived("ref_points", points_sql("ref_long", "feature"), "ref_long")
derived("ref_edges", edges_sql("ref_points", "feature"), "ref_points")
derived("ref_bins", binned_sql("ref_long", "ref_edges", "feature", "feature"), "ref_long", "ref_edges")
derived("act_bins", binned_sql("act_long", "ref_edges", "year, feature", "feature"), "act_long", "ref_edges")
derived("ref_stats", """
    select feature, avg(value) as mean, quantile_cont(value, 0.5) as median, var_samp(value) as var,
           stddev_samp(value) as std, count(*) filter (value is null) / count(*) as missing_rate from ref_long group by 1""",
        "ref_long")
derived("numeric_rows", f"""
    select y.year, r.feature, coalesce(a.n, 0) as n,
           case when a.n is null or a.n = 0 then 10.0 else p.psi end as psi,
           r.mean as mean_ref, case when a.n > 0 then a.mean end as mean_act,
           r.median as median_ref, a.median as median_act, r.var as var_ref, a.var as var_act,
           (a.mean - r.mean) / r.std as smd_mean, (a.median - r.median) / r.std as smd_median, a.var / r.var as var_ratio,
           r.missing_rate as missing_rate_ref, a.missing_rate as missing_rate_act,
           case when a.n is null then 'feature_not_in_feature_store' when a.n = 0 then 'all_values_missing' else 'ok' end as status
    from (select distinct year from act_long) y cross join ref_stats r
    left join (select year, feature, count(value) as n, avg(value) as mean, quantile_cont(value, 0.5) as median,
                      var_samp(value) as var, count(*) filter (value is null) / count(*) as missing_rate
               from act_long group by 1, 2) a using (year, feature)
    left join (select year, feature, {PSI_SUM.format(a='n.share', e='o.share')} as psi
               from act_bins n join ref_bins o using (feature, bin) group by 1, 2) p using (year, feature)
    """, "act_long", "ref_stats", "act_bins", "ref_bins")

ROUNDED = {"psi": 9, "mean_ref": 6, "mean_act": 6, "median_ref": 6, "median_act": 6, "var_ref": 3, "var_act": 3,
           "smd_mean": 9, "smd_median": 9, "var_ratio": 9, "missing_rate_ref": 12, "missing_rate_act": 12}


def round_columns(df, places):
    """Coarse figures are rounded twice: the first step drops summation noise, so that ties fall alike in both engines."""
    def settled(c, p):
        return F.round(F.round(c, 9), p) if p <= 6 else F.round(c, p)

    return df.withColumns({c: settled(c, p) for c, p in places.items() if c in df.columns})


def rounded_sql(columns, places) -> str:
    def settled(c):
        return rounded(f"round({c}, 9)", places[c]) if places[c] <= 6 else f"round({c}, {places[c]})"

    return ", ".join(f"{settled(c)} as {c}" if c in places else c for c in columns)


DRIFT_COLUMNS = ["year", "feature", "n", *ROUNDED, "status"]


def _years(t):
    rows = layers.silver_financials(t).withColumn("year", F.year("snapshot_date"))
    return rows.withColumn("Num_of_Loan", F.when(F.col("year") != 1999, F.col("Num_of_Loan")))


def _numeric_rows(t):
    rows = _years(t)
    reference = drift.numeric_reference(
        profile.long_numbers(rows.where(F.col("snapshot_date") < date_lit(BASE_END)), FEATURES), groups=len(FEATURES))
    recent = rows.where(F.col("snapshot_date") >= date_lit(BASE_END))
    # the last feature is not in the later store
    long = profile.long_numbers(recent, FEATURES[:-1], ["year"])
    return drift.numeric_drift(long, reference, recent.select("year").distinct(), ["year"], references=len(FEATURES))


@query("drift_rows", needs=["numeric_rows"], sql=f"select {rounded_sql(DRIFT_COLUMNS, ROUNDED)} from numeric_rows")
def _(t):
    return round_columns(_numeric_rows(t), ROUNDED)


derived("cat_long", " union all ".join(
    f"select year, snapshot_date, '{c}' as feature, {c} as value from fin_years" for c in CATEGORIES), "fin_years")
derived("cat_ref", f"""
    with m as (select feature, coalesce(value, '__MISSING__') as name from cat_long where snapshot_date < date '{BASE_END}'),
         c as (select feature, name, count(*) as n from m group by 1, 2)
    select feature, name, n / sum(n) over (partition by feature) as share from c
    qualify row_number() over (partition by feature order by n desc, name) <= {REFERENCE_CATEGORIES}""", "cat_long")
derived("cat_rows", f"""
    with e as (select feature, name, share from cat_ref
               union all select feature, '__OTHER__', greatest(0, 1 - sum(share)) from cat_ref group by 1),
         w as (select feature, name, share / sum(share) over (partition by feature) as share from e),
         r as (select l.year, l.feature, l.value, case when c.name is null then '__OTHER__' else c.name end as name
               from cat_long l left join cat_ref c on c.feature = l.feature and c.name = coalesce(l.value, '__MISSING__')
               where l.snapshot_date >= date '{BASE_END}'),
         a as (select year, feature, name, count(*) / sum(count(*)) over (partition by year, feature) as share
               from r group by 1, 2, 3),
         s as (select year, feature, count(value) as n, count(*) filter (value is null) / count(*) as missing_rate_act
               from r group by 1, 2)
    select s.year, s.feature, any_value(s.n) as n, {PSI_SUM.format(a='coalesce(a.share, 0)', e='w.share')} as psi,
           (select count(*) filter (value is null) / count(*) from cat_long c
            where c.feature = s.feature and c.snapshot_date < date '{BASE_END}') as missing_rate_ref,
           any_value(s.missing_rate_act) as missing_rate_act, 'ok' as status
    from s join w using (feature) left join a using (year, feature, name) group by 1, 2""", "cat_long", "cat_ref")


def _category_rows(t):
    rows = _years(t)
    reference = drift.categorical_reference(
        profile.long_texts(rows.where(F.col("snapshot_date") < date_lit(BASE_END)), CATEGORIES), k=REFERENCE_CATEGORIES)
    recent = rows.where(F.col("snapshot_date") >= date_lit(BASE_END))
    long = profile.long_texts(recent, CATEGORIES, ["year"])
    return drift.categorical_drift(long, reference, recent.select("year").distinct(), ["year"], references=len(CATEGORIES))


@query("drift_rows_categorical", needs=["cat_rows"], sql="""
    select year, feature, n, round(psi, 9) as psi, round(missing_rate_ref, 12) as missing_rate_ref,
           round(missing_rate_act, 12) as missing_rate_act, status from cat_rows""")
def _(t):
    columns = ["year", "feature", "n", "psi", "missing_rate_ref", "missing_rate_act", "status"]
    return round_columns(_category_rows(t).select(*columns), ROUNDED)


@query("drift_summary", needs=["numeric_rows", "cat_rows"], sql="""
    select year, count(*) as n_features_monitored, round(max(psi), 9) as max_feature_psi,
           count(*) filter (psi > 0.25) as n_features_psi_high,
           count(*) filter (status = 'all_values_missing') as n_features_all_missing,
           round(max(missing_rate_act - missing_rate_ref), 9) as max_missing_rate_delta,
           count(*) filter (missing_rate_act - missing_rate_ref > 0.5) as n_features_missing_shift,
           case when count(*) filter (missing_rate_act - missing_rate_ref > 0.5
                  or status = 'feature_not_in_feature_store') > 0
                then 'feature_availability_failure' else 'ok' end as data_quality_status
    from (select year, psi, missing_rate_ref, missing_rate_act, status from numeric_rows
          union all select year, psi, missing_rate_ref, missing_rate_act, status from cat_rows) u group by 1""")
def _(t):
    rows = _numeric_rows(t).unionByName(_category_rows(t))
    return round_columns(drift.drift_summary(rows, ["year"]), {"max_feature_psi": 9, "max_missing_rate_delta": 9})


# scores: reference bins from each model's out-of-time cohorts
derived("oot_scores", """
    select model_name, model_predictions as value from model_scores
    where snapshot_date between train_date - interval 8 month and train_date - interval 7 month
      and not isnan(model_predictions) and model_predictions between 0 and 1""", "model_scores")
derived("valid_scores", """
    select model_name, snapshot_date, model_predictions as value from predictions
    where not isnan(model_predictions) and model_predictions between 0 and 1""", "predictions")
derived("score_points", points_sql("oot_scores", "model_name"), "oot_scores")
derived("score_edges", edges_sql("score_points", "model_name"), "score_points")
derived("oot_bins", binned_sql("oot_scores", "score_edges", "model_name", "model_name"), "oot_scores", "score_edges")
derived("month_bins", binned_sql("valid_scores", "score_edges", "model_name, snapshot_date", "model_name"),
        "valid_scores", "score_edges")

MODEL_COUNT = 3


def oot_scores(t):
    """Valid scores of the cohorts whose labels fell in the last two months before training.

    Written once: a test on the value is otherwise spelled out down to the order's own columns and made for every pair
    of order and model, in a method too long for the JVM to compile.
    """
    window = F.col("snapshot_date").between(F.add_months("train_date", -8), F.add_months("train_date", -7))
    scores = t("model_scores").where(window).select("model_name", valid_score("model_predictions").alias("value"))
    return t.once("oot_scores", lambda: stored(scores, "oot_scores"))


def score_reference(t):
    return drift.score_reference(oot_scores(t), ["model_name"], groups=MODEL_COUNT)


def _score_shares(t, reference):
    scores = t("predictions").select("model_name", "snapshot_date", valid_score("model_predictions").alias("value"))
    return drift.score_shares(scores, reference, ["model_name", "snapshot_date"], ["model_name"], MODEL_COUNT)


@query("score_psi", needs=["month_bins", "oot_bins"], sql=f"""
    select m.model_name, m.snapshot_date, round({PSI_SUM.format(a='m.share', e='o.share')}, 9) as psi
    from month_bins m join oot_bins o using (model_name, bin) group by 1, 2""")
def _(t):
    out = drift.score_psi(_score_shares(t, score_reference(t)), ["model_name", "snapshot_date"])
    return out.withColumn("psi", F.round("psi", 9))


@query("psi_prev_period", needs=["month_bins"], sql=f"""
    select m.model_name, m.snapshot_date, round({PSI_SUM.format(a='m.share', e='o.share')}, 9) as psi
    from month_bins m join month_bins o on o.model_name = m.model_name and o.bin = m.bin
      and o.snapshot_date = m.snapshot_date - interval 1 month group by 1, 2""")
def _(t):
    out = drift.previous_month_psi(_score_shares(t, score_reference(t)), ["model_name", "snapshot_date"])
    return out.withColumn("psi", F.round("psi", 9))
