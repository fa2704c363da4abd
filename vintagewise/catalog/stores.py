"""Queries on ingest, cleaning, labels and features."""

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import derive as D
from ..functions.calendar import date_lit, origination_month
from ..functions.loans import delinquency_flag
from ..operators.profile import frequencies, in_order, rate_by
from ..plans import gold, schedule
from ..schemas import AGE_BANDS, HISTORY_BANDS, LABEL_MOB, UTILIZATION_BANDS
from ..sources import raw, store
from . import checks  # noqa: F401  registers the derived tables
from . import layers
from .registry import query, rounded


@query("snapshot_extract", needs=["raw_loans"], sql="""
    select loan_id, Customer_ID, installment_num, loan_amt, snapshot_date from raw_loans
    where snapshot_date = date '1998-03-01'""")
def _(t):
    rows = raw.at_snapshot(t("raw_loans"), "1998-03-01")
    return rows.select("loan_id", "Customer_ID", "installment_num", "loan_amt", "snapshot_date")


@query("month_spine_gaps", needs=["raw_loans", "raw_clicks"], sql="""
    select cast(unnest(generate_series(min(snapshot_date), max(snapshot_date), interval 1 month)) as date) as snapshot_date
    from raw_loans
    except select snapshot_date from raw_clicks""")
def _(t):
    return store.missing_months(t("raw_clicks"), store.own_spine(t("raw_loans")))


@query("source_extent", needs=["raw_loans", "raw_financials", "raw_attributes", "raw_clicks"], sql=" union all ".join(
    f"""select '{name}' as source, min(snapshot_date) as first_snapshot, max(snapshot_date) as last_snapshot,
        'date' as column_type from raw_{name}""" for name in ("loans", "financials", "attributes", "clicks")))
def _(t):
    names = ["loans", "financials", "attributes", "clicks"]
    tables = [raw.source_extent(t(f"raw_{name}"), name) for name in names]
    return tables[0].union(tables[1]).union(tables[2]).union(tables[3])


@query("empty_months", needs=["raw_loans", "raw_clicks"], sql="""
    select m.snapshot_date from
      (select cast(unnest(generate_series(min(snapshot_date), max(snapshot_date), interval 1 month)) as date) as snapshot_date
       from raw_loans) m
    where (select count(*) from raw_clicks c where c.snapshot_date = m.snapshot_date) = 0""")
def _(t):
    return store.empty_months(t("raw_clicks"), store.own_spine(t("raw_loans")))


@query("month_row_counts", needs=["raw_loans", "raw_clicks"], sql="""
    select m.snapshot_date, coalesce(n, 0) as n_rows from
      (select distinct snapshot_date from raw_loans) m
      left join (select snapshot_date, count(*) as n from raw_clicks group by 1) c using (snapshot_date)""")
def _(t):
    return store.month_counts(t("raw_clicks"), store.own_spine(t("raw_loans")))


@query("spine_union", needs=["label_store", "raw_clicks"], sql="""
    select distinct snapshot_date from
      (select snapshot_date from label_store union all select snapshot_date from raw_clicks) u""")
def _(t):
    return store.union_months(store.own_spine(layers.labels(t)), store.own_spine(t("raw_clicks")))


@query("latest_partition", needs=["raw_clicks"], sql="""
    select date '2001-12-01' as cutoff, max(snapshot_date) as latest,
           cast(date_diff('month', max(snapshot_date), date '2001-12-01') as int) as months_behind,
           max(snapshot_date) < date '2001-12-01' as is_stale
    from raw_clicks where snapshot_date <= date '2001-12-01'""")
def _(t):
    return store.latest_month(t("raw_clicks"), "2001-12-01")


@query("month_eligibility", needs=["raw_loans", "raw_clicks", "models"], sql="""
    select m.snapshot_date, m.snapshot_date <= e.feature_end as has_features,
           m.snapshot_date >= f.first_model and m.snapshot_date <= e.feature_end + interval 7 month as can_train,
           m.snapshot_date > f.first_model as can_score,
           cast(e.feature_end + interval 6 month as date) as last_usable_label
    from (select distinct snapshot_date from raw_loans) m,
         (select max(snapshot_date) as feature_end from raw_clicks) e,
         (select min(cast(replace(substr(model, 14), '_', '-') as date)) as first_model from models) f""")
def _(t):
    first_model = t("models").select(schedule.train_dates("model", "stored_date").alias("d"))
    return schedule.month_eligibility(
        store.own_spine(t("raw_loans")),
        feature_end=t("raw_clicks").agg(F.max("snapshot_date")).scalar(),
        first_model=first_model.agg(F.min("d")).scalar(), mob=LABEL_MOB)


@query("store_round_trip", needs=["raw_clicks"], sql="""
    select snapshot_date, count(*) as n_rows, cast(sum(fe_1) as bigint) as sum_fe_1, count(fe_20) as n_fe_20,
           count(distinct Customer_ID) as n_customers
    from raw_clicks group by 1""")
def _(t):
    from ..plans.backfill import click_round_trip

    table = click_round_trip(t("raw_clicks"), "1995-01-01", "2001-08-01")
    return table.groupBy("snapshot_date").agg(
        F.count("*").alias("n_rows"), F.sum("fe_1").alias("sum_fe_1"), F.count("fe_20").alias("n_fe_20"),
        F.countDistinct("Customer_ID").alias("n_customers"))


@query("clean_loans", needs=["silver_loans"], sql="select * from silver_loans")
def _(t):
    return layers.silver_loans(t)


@query("clean_financials", needs=["silver_financials"], sql="select * from silver_financials")
def _(t):
    return layers.silver_financials(t)


@query("clean_attributes", needs=["silver_attributes"], sql="select * from silver_attributes")
def _(t):
    return layers.silver_attributes(t)


@query("clean_clickstream", needs=["raw_clicks"], sql="select * from raw_clicks")
def _(t):
    return layers.silver_clicks(t)


@query("duration_months", needs=["raw_financials", "silver_financials"], sql="""
    select Credit_History_Age, Credit_History_Age_Months as months, count(*) as n_rows
    from silver_financials group by 1, 2""")
def _(t):
    rows = t("raw_financials").withColumn("months", C.duration_months("Credit_History_Age"))
    return frequencies(rows, ["Credit_History_Age", "months"])


@query("loan_id_parts", needs=["raw_loans"], sql="""
    select cast(replace(right(loan_id, 10), '_', '-') as date) as id_date,
           count(*) as n_rows, count(distinct Customer_ID) as n_customers,
           count(*) filter (contains(loan_id, Customer_ID || '_')) as n_same_customer
    from raw_loans group by 1""")
def _(t):
    parts = t("raw_loans").select(
        "Customer_ID", D.loan_customer("loan_id").alias("id_customer"), D.loan_date("loan_id").alias("id_date"))
    return parts.groupBy("id_date").agg(
        F.count("*").alias("n_rows"), F.countDistinct("id_customer").alias("n_customers"),
        F.count_if(F.col("id_customer") == F.col("Customer_ID")).alias("n_same_customer"))


@query("score_validity", needs=["predictions"], sql="""
    select model_name, count(*) as n_predictions,
           count(*) filter (not isnan(model_predictions) and model_predictions between 0 and 1) as n_valid_scores
    from predictions group by 1""")
def _(t):
    return t("predictions").groupBy("model_name").agg(
        F.count("*").alias("n_predictions"), F.count(C.valid_score("model_predictions")).alias("n_valid_scores"))


@query("loan_dpd", needs=["silver_loans"], sql="""
    select mob, installments_missed, dpd, count(*) as n_rows from silver_loans group by 1, 2, 3""")
def _(t):
    return frequencies(layers.silver_loans(t), ["mob", "installments_missed", "dpd"])


@query("label_store", needs=["label_store"], sql="select * from label_store")
def _(t):
    return layers.labels(t)


@query("bad_rate_by_month", needs=["label_store"], sql="""
    select snapshot_date, count(*) as n_rows, avg(label) as rate from label_store group by 1 order by 1""")
def _(t):
    return rate_by(layers.labels(t), "label", ["snapshot_date"]).orderBy("snapshot_date")


@query("bad_rate_overall", needs=["label_store"], sql="select count(*) as n_rows, avg(label) as rate from label_store")
def _(t):
    return rate_by(layers.labels(t), "label")


@query("dpd_flag_by_mob", needs=["silver_loans"], sql="""
    select mob, count(*) as n_rows, avg(case when dpd >= 30 then 1 else 0 end) as rate
    from silver_loans where loan_start_date < date '2000-01-01' group by 1""")
def _(t):
    started = layers.silver_loans(t).where(F.col("loan_start_date") < date_lit("2000-01-01"))
    return rate_by(started.withColumn("dpd_flag", delinquency_flag("dpd", 30)), "dpd_flag", ["mob"])


@query("final_installment_bads", needs=["silver_loans"], sql="""
    select loan_start_date, count(*) as n_rows, count(*) filter (dpd >= 30) as n_bad
    from silver_loans where installment_num = 10 group by 1""")
def _(t):
    final = layers.silver_loans(t).where("installment_num = 10")
    return final.groupBy("loan_start_date").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("dpd") >= 30).alias("n_bad"))


@query("origination_months", needs=["label_store"], sql="""
    select strftime(snapshot_date - interval 6 month, '%Y-%m') as origination_month, count(*) as n_rows
    from label_store group by 1""")
def _(t):
    months = layers.labels(t).withColumn("origination_month", origination_month("snapshot_date", LABEL_MOB))
    return frequencies(months, ["origination_month"])


@query("trailing_window_agg", needs=["click_window"], sql="select * from click_window")
def _(t):
    return gold.trailing_window(layers.silver_clicks(t))


@query("window_completeness", needs=["raw_clicks"], sql="""
    select m.cutoff, cast((select count(distinct c.snapshot_date) from raw_clicks c where c.snapshot_date <= m.cutoff
              and c.snapshot_date > m.cutoff - interval 6 month) as bigint) as n_found,
           cast(least(6, date_diff('month', m.lo, m.cutoff) + 1) as int) as n_expected,
           exists (select 1 from raw_clicks c where c.snapshot_date = m.cutoff) as has_cutoff,
           (select count(distinct c.snapshot_date) from raw_clicks c where c.snapshot_date <= m.cutoff
              and c.snapshot_date > m.cutoff - interval 6 month) = least(6, date_diff('month', m.lo, m.cutoff) + 1)
             as complete
    from (select min(snapshot_date) as lo, cast(unnest(generate_series(min(snapshot_date), max(snapshot_date),
                 interval 1 month)) as date) as cutoff from raw_clicks) m""")
def _(t):
    return gold.window_completeness(layers.silver_clicks(t))


@query("feature_store", needs=["feature_store"], sql="select * from feature_store")
def _(t):
    return layers.features(t)


@query("list_diversity", needs=["joined_sources"], sql=f"""
    select loan_id,
           {rounded('Monthly_Inhand_Salary - Total_EMI_per_month - Scheduled_Installment_Amt', 2)} as Post_EMI_Slack,
           case when Type_of_Loan = 'No Loan' then 0
                when Type_of_Loan is not null then
                cast(len(list_distinct(list_filter(list_transform(string_split(replace(Type_of_Loan, ' and ', ''), ','),
                     lambda x: trim(x)), lambda x: x <> ''))) as int) end as Loan_Type_Diversity
    from joined_sources""")
def _(t):
    return gold.side_features(layers.joined(t))


def _band_sql(column: str, names: list[str]) -> str:
    order = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"""select '{column}' as band_column, cast(v.place as int) as place, v.name as band, g.n_rows, g.rate
      from (values {order}) v(place, name)
      left join (select {column} as name, count(*) as n_rows, avg(label) as rate
                 from feature_store join label_store using (loan_id) group by 1) g using (name)"""


def _names(bands) -> list[str]:
    return [name for _, name in bands[0]] + [bands[1]]


_BANDS = {
    "Credit_Utilization_Band": _names(UTILIZATION_BANDS),
    "Credit_History_Band": _names(HISTORY_BANDS),
    "Age_Band": _names(AGE_BANDS),
}


@query("bad_rate_by_band", needs=["feature_store", "label_store"],
       sql=" union all ".join(_band_sql(c, n) for c, n in _BANDS.items()))
def _(t):
    # one join and one pass for all band columns
    rows = layers.features(t).select("loan_id", *_BANDS).join(layers.labels(t).select("loan_id", "label"), "loan_id")
    long = rows.unpivot(["label"], list(_BANDS), "band_column", "band")
    rates = rate_by(long, "label", ["band_column", "band"])
    parts = [in_order(rates.where(F.col("band_column") == c).drop("band_column"), "band", names)
             .select(F.lit(c).alias("band_column"), "place", "band", "n_rows", "rate") for c, names in _BANDS.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query("bad_rate_by_occupation", needs=["feature_store", "label_store"], sql="""
    select Occupation_Group, count(*) as n_rows, avg(label) as rate
    from feature_store join label_store using (loan_id) group by 1 order by rate desc""")
def _(t):
    rows = layers.features(t).select("loan_id", "Occupation_Group").join(layers.labels(t).select("loan_id", "label"), "loan_id")
    return rate_by(rows, "label", ["Occupation_Group"]).orderBy(F.desc("rate"))


