"""Queries on joins, guards, coverage and key sets."""

from pyspark.sql import functions as F

from ..operators import guards, joins
from ..schemas import LABEL_MOB, MIN_COVERAGE
from ..sources import store
from . import layers
from .registry import derived, query


@query("fanout_violations", needs=[], sql="""
    select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1""")
def _(t):
    return guards.repeated_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_keys", needs=["silver_attributes"], sql="""
    select SSN, count(*) as n_rows from silver_attributes group by 1 having count(*) > 1 or SSN is null""")
def _(t):
    return guards.key_violations(layers.silver_attributes(t), ["SSN"])


@query("match_indicator", needs=["predictions", "label_store"], sql="""
    select p.model_name, p.snapshot_date, count(l.loan_id) as n_matched, count(*) - count(l.loan_id) as n_unmatched
    from predictions p left join label_store l using (loan_id) group by 1, 2""")
def _(t):
    labels = layers.labels(t).select("loan_id", "label")
    return joins.match_counts(joins.with_match(t("predictions"), labels, ["loan_id"]), ["model_name", "snapshot_date"])


@query("label_feature_join", needs=["label_store", "feature_keys"], sql="""
    select count(*) as n_labels, count(*) filter (f.loan_id is null) as n_unmatched,
           min(l.snapshot_date) filter (f.loan_id is null) as first_unmatched,
           max(l.snapshot_date) filter (f.loan_id is null) as last_unmatched
    from label_store l left join feature_keys f on f.loan_id = l.loan_id""")
def _(t):
    return joins.unmatched_labels(joins.attach_features(layers.labels(t), layers.features(t)))


@query("label_feature_inner", needs=["feature_store", "label_store"], sql="""
    select loan_id, f.snapshot_date, Credit_Utilization_Band, EMI_to_Income_Ratio, label
    from feature_store f join label_store l using (loan_id)""")
def _(t):
    features = layers.features(t).select("loan_id", "snapshot_date", "Credit_Utilization_Band", "EMI_to_Income_Ratio")
    return features.join(layers.labels(t).select("loan_id", "label"), "loan_id")


# loans whose customer clicked in the months looked at; the other loans are the gaps in the data
derived("clicked_keys", "select loan_id, snapshot_date from feature_store where Clickstream_Mean is not null", "feature_store")
derived("coverage", """
    select strftime(l.snapshot_date - interval 6 month, '%Y-%m') as origination_month, count(*) as n_labels,
           count(f.loan_id) as n_with_features,
           round(count(f.loan_id) / count(*), 4) as coverage
    from (select distinct loan_id, snapshot_date from label_store) l
    left join (select distinct loan_id from clicked_keys) f using (loan_id) group by 1""", "label_store", "clicked_keys")


def _clicked(t):
    return layers.features(t).where("Clickstream_Mean is not null")


def _coverage(t):
    return joins.label_coverage(layers.labels(t), _clicked(t), LABEL_MOB)


@query("label_coverage", needs=["coverage"], sql="select * from coverage")
def _(t):
    return _coverage(t)


@query("coverage_violations", needs=["coverage", "raw_clicks"], sql="""
    select * from coverage where coverage < 0.95 and origination_month in
      (select strftime(snapshot_date, '%Y-%m') from raw_clicks)""")
def _(t):
    return joins.coverage_violations(_coverage(t), store.own_spine(t("raw_clicks")), MIN_COVERAGE)


@query("coverage_outside", needs=["coverage", "clicked_keys"], sql="""
    select * from coverage where origination_month not between
      (select strftime(min(snapshot_date), '%Y-%m') from clicked_keys) and (select strftime(max(snapshot_date), '%Y-%m') from clicked_keys)""")
def _(t):
    return joins.coverage_outside(_coverage(t), store.own_spine(_clicked(t)))


@query("key_membership", needs=["silver_loans", "raw_clicks"], sql="""
    select b.snapshot_date, count(*) as n_keys, count(c.Customer_ID) as n_found,
           count(c.Customer_ID) / count(*) as share_found
    from (select distinct Customer_ID, snapshot_date from silver_loans where mob = 0) b
    left join (select distinct Customer_ID, snapshot_date from raw_clicks) c using (Customer_ID, snapshot_date)
    group by 1""")
def _(t):
    cohort = layers.silver_loans(t).where("mob = 0")
    keys = ["Customer_ID", "snapshot_date"]
    return joins.membership_rate(cohort, t("raw_clicks"), keys, ["snapshot_date"])


@query("key_set_diff", needs=["raw_clicks"], sql="""
    select p.snapshot_date, count(*) as n_keys, count(o.Customer_ID) as n_shared, any_value(b.n) as n_base,
           count(*) = count(o.Customer_ID) and count(o.Customer_ID) = any_value(b.n) as same_pool
    from (select distinct snapshot_date, Customer_ID from raw_clicks) p
    left join (select distinct Customer_ID from raw_clicks where snapshot_date = date '1995-01-01') o using (Customer_ID),
         (select count(distinct Customer_ID) as n from raw_clicks where snapshot_date = date '1995-01-01') b
    group by 1""")
def _(t):
    clicks = t("raw_clicks")
    return joins.pool_changes(clicks, "Customer_ID", "snapshot_date", clicks.agg(F.min("snapshot_date")).scalar())


@query("key_set_operations", needs=["raw_clicks", "raw_loans"], sql="""
    with a as (select distinct Customer_ID from raw_loans), b as (select distinct Customer_ID from raw_clicks)
    select 'union' as operation, count(*) as n_keys from (select * from a union select * from b)
    union all select 'intersection', count(*) from (select * from a intersect select * from b)
    union all select 'left_only', count(*) from (select * from a except select * from b)
    union all select 'right_only', count(*) from (select * from b except select * from a)""")
def _(t):
    left, right = t("raw_loans").select("Customer_ID"), t("raw_clicks").select("Customer_ID")
    sets = {
        "union": left.union(right).distinct(), "intersection": left.intersect(right),
        "left_only": left.subtract(right), "right_only": right.subtract(left),
    }
    rows = [d.agg(F.count("*").alias("n_keys")).select(F.lit(k).alias("operation"), "n_keys") for k, d in sets.items()]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])
