"""Queries on profiles, shares, histograms, quantiles and correlations."""

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import correlation, distribution, drift, ordering, profile
from ..schemas import REFERENCE_CATEGORIES
from . import layers
from .registry import derived, query

# every number of the cleaned financials, and their other columns
FINANCIAL_NUMBERS = ["Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
                     "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
                     "Num_Credit_Inquiries", "Outstanding_Debt", "Credit_Utilization_Ratio", "Total_EMI_per_month",
                     "Amount_invested_monthly", "Monthly_Balance", "Credit_History_Years", "Credit_History_Months_part",
                     "Credit_History_Age_Months"]
FINANCIAL_OTHERS = ["Customer_ID", "Type_of_Loan", "Credit_Mix", "Credit_History_Age", "Payment_of_Min_Amount",
                    "Payment_Behaviour", "snapshot_date"]
ATTRIBUTES = ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _melt(table: str, columns: list[str], keep: str = "") -> str:
    return " union all ".join(
        f"select {keep}'{c}' as feature, cast({c} as double) as value from {table}" for c in columns)


derived("fin_long", _melt("silver_financials", FINANCIAL_NUMBERS), "silver_financials")
derived("line_long", _melt("lineitem", LINE_NUMBERS))
# quantiles by rank, the long way round: position, its two neighbours, and the straight line between them
for _name in ("fin_long", "line_long"):
    derived(f"{_name}_points", f"""
      select feature, i, max(case when rk = lo then value end) + (max(case when rk = hi then value end)
               - max(case when rk = lo then value end)) * (any_value(i * (n - 1) % 10) / 10) as point
      from (select feature, value, i, n, rk, (i * (n - 1)) // 10 as lo, least((i * (n - 1)) // 10 + 1, n - 1) as hi
            from (select feature, value, row_number() over (partition by feature order by value) - 1 as rk,
                         count(*) over (partition by feature) as n from {_name} where value is not null) r,
                 (select unnest(generate_series(0, 10)) as i) s) p
      where rk in (lo, hi) group by feature, i""", _name)
    derived(f"{_name}_edges", f"""
      select feature, case when len(list_distinct(list(point))) = 1 then [min(point), min(point)]
                           else list_sort(list_distinct(list(point))) end as edges
      from {_name}_points group by feature""", f"{_name}_points")
    derived(f"{_name}_hist", f"""
      select b.feature, b.bin, b.edges[b.bin + 1] as bin_low, b.edges[b.bin + 2] as bin_high,
             count(v.value) as n_rows
      from (select feature, edges, unnest(generate_series(0, len(edges) - 2)) as bin from {_name}_edges) b
      left join {_name} v on v.feature = b.feature
        and v.value >= b.edges[b.bin + 1]
        and (v.value < b.edges[b.bin + 2] or (b.bin = len(b.edges) - 2 and v.value <= b.edges[b.bin + 2]))
      group by 1, 2, 3, 4""", f"{_name}_edges", _name)


@query("null_profile", needs=["silver_financials"], sql=" union all ".join(
    f"""select '{c}' as column_name, count(*) filter ({c} is null) as null_count,
        100 * count(*) filter ({c} is null) / count(*) as null_pct from silver_financials"""
    for c in FINANCIAL_NUMBERS + FINANCIAL_OTHERS))
def _(t):
    return profile.null_profile(layers.silver_financials(t)).orderBy(F.desc("null_pct"), "column_name")


@query("null_counts", needs=["silver_attributes"], sql="select " + ", ".join(
    f"count(*) filter ({c} is null) as {c}" for c in ATTRIBUTES) + " from silver_attributes")
def _(t):
    return profile.null_counts(layers.silver_attributes(t))


@query("value_frequency", needs=["silver_attributes"], sql="""
    select Occupation, count(*) as n_rows from silver_attributes group by 1""")
def _(t):
    return profile.frequencies(layers.silver_attributes(t), ["Occupation"])


@query("value_shares", needs=["label_store"], sql="""
    select label, count(*) as n_rows, count(*) / (select count(*) from label_store) as share
    from label_store group by 1""")
def _(t):
    return profile.shares(layers.labels(t), "label")


@query("value_shares_by_month", needs=["silver_financials"], sql="""
    select f.snapshot_date, Credit_Mix, count(*) as n_rows, count(*) / any_value(n) as share
    from silver_financials f join (select snapshot_date, count(*) as n from silver_financials group by 1) m
      using (snapshot_date) group by 1, 2""")
def _(t):
    return profile.shares(layers.silver_financials(t), "Credit_Mix", ["snapshot_date"])


@query("topk_other", needs=[], sql=f"""
    select lang, source, n_rows, n_rows / total as share, cast(place as int) as place,
           round(greatest(0, 1 - (sum(n_rows) over (partition by lang) / total)), 9) as rest_share
    from (select lang, source, n_rows, sum(n_rows) over (partition by lang) as total,
                 row_number() over (partition by lang order by n_rows desc, source) as place
          from (select lang, source, count(*) as n_rows from documents group by 1, 2)) r
    where place <= 5""")
def _(t):
    top = profile.top_and_rest(t("documents"), "source", 5, ["lang"])
    return top.withColumn("rest_share", F.round("rest_share", 9))


@query("describe_columns", needs=["fin_long"], sql="""
    select feature, count(value) as n, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as stddev,
           min(value) as low, max(value) as high from fin_long group by 1""")
def _(t):
    out = profile.describe_columns(layers.silver_financials(t), FINANCIAL_NUMBERS)
    return out.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query("numeric_profile", needs=["fin_long", "fin_long_points"], sql="""
    select feature, count(value) as n, round(avg(value), 6) as mean, any_value(point) as median,
           round(var_samp(value), 3) as var, round(stddev_samp(value), 6) as std,
           count(*) filter (value is null) / count(*) as missing_rate
    from fin_long join (select feature, point from fin_long_points where i = 5) p using (feature) group by 1""")
def _(t):
    long = profile.long_numbers(layers.silver_financials(t), FINANCIAL_NUMBERS)
    out = drift.numeric_reference(long, groups=len(FINANCIAL_NUMBERS)).drop("edges", "pct")
    return out.withColumns({"mean": F.round("mean", 6), "var": F.round("var", 3), "std": F.round("std", 6)})


def _line_counts(t):
    return ordering.value_counts(profile.long_numbers(t("lineitem"), LINE_NUMBERS), "value", ["feature"])


@query("quantile_edges", needs=["line_long_edges"], sql="""
    select feature, cast(unnest(generate_series(0, len(edges) - 1)) as int) as place, round(unnest(edges), 6) as edge
    from line_long_edges""")
def _(t):
    edges = distribution.quantile_edges(_line_counts(t), ["feature"], groups=len(LINE_NUMBERS))
    return edges.select("feature", F.posexplode("edges").alias("place", "edge")).withColumn("edge", F.round("edge", 6))


@query("hist_shares", needs=["line_long_hist"], sql="""
    select feature, cast(bin as int) as bin, round(bin_low, 6) as bin_low, round(bin_high, 6) as bin_high, n_rows,
           n_rows / cast(sum(n_rows) over (partition by feature) as bigint) as share
    from line_long_hist""")
def _(t):
    counts = _line_counts(t)
    edges = distribution.quantile_edges(counts, ["feature"], groups=len(LINE_NUMBERS))
    totals = distribution.bin_totals(counts, edges, ["feature"], ["feature"], groups=len(LINE_NUMBERS))
    out = distribution.bin_shares(totals, ["feature"])
    return out.withColumns({"bin_low": F.round("bin_low", 6), "bin_high": F.round("bin_high", 6)})


@query("decile_bad_rate", needs=["feature_store", "label_store"], sql="""
    with x as (select EMI_to_Income_Ratio as v, label from feature_store join label_store using (loan_id)
               where EMI_to_Income_Ratio is not null),
         r as (select v, label, row_number() over (order by v) - 1 as rk, count(*) over () as n from x),
         p as (select i, max(case when rk = lo then v end) + (max(case when rk = hi then v end)
                 - max(case when rk = lo then v end)) * (any_value(i * (n - 1) % 10) / 10) as point
               from (select v, rk, n, i, (i * (n - 1)) // 10 as lo, least((i * (n - 1)) // 10 + 1, n - 1) as hi
                     from r, (select unnest(generate_series(0, 10)) as i) s) q where rk in (lo, hi) group by i),
         e as (select list_sort(list_distinct(list(point))) as edges from p)
    select cast(b.bin as int) as bin, round(edges[b.bin + 1], 6) as bin_low, round(edges[b.bin + 2], 6) as bin_high,
           count(*) as n_rows, avg(label) as rate
    from (select edges, unnest(generate_series(0, len(edges) - 2)) as bin from e) b
    join x on (v > edges[b.bin + 1] or (b.bin = 0 and v = edges[1])) and v <= edges[b.bin + 2]
    group by 1, 2, 3""")
def _(t):
    rows = layers.labelled(t, "EMI_to_Income_Ratio")
    out = distribution.quantile_bin_rates(rows, "EMI_to_Income_Ratio", "label")
    return out.withColumns({"bin_low": F.round("bin_low", 6), "bin_high": F.round("bin_high", 6)})


@query("equal_width_hist", needs=["fin_long"], sql="""
    select e.feature, cast(b as int) as bin, round(lo + b * (hi - lo) / 50, 6) as bin_low,
           round(lo + (b + 1) * (hi - lo) / 50, 6) as bin_high, count(v.value) as n_rows
    from (select feature, min(value) as lo, max(value) as hi from fin_long group by 1) e,
         (select unnest(generate_series(0, 49)) as b) s
    left join fin_long v on v.feature = e.feature and least(floor((v.value - lo) / (hi - lo) * 50), 49) = b
    group by 1, 2, 3, 4""")
def _(t):
    long = profile.long_numbers(layers.silver_financials(t), FINANCIAL_NUMBERS)
    out = profile.equal_width_histogram(long, 50, len(FINANCIAL_NUMBERS))
    return out.withColumns({"bin_low": F.round("bin_low", 6), "bin_high": F.round("bin_high", 6)})


@query("pearson_matrix", needs=["silver_financials"], sql=" union all ".join(
    f"""select '{a}' as "left", '{b}' as "right", round(corr({a}, {b}), 6) as rho from silver_financials"""
    for a, b in combinations(FINANCIAL_NUMBERS, 2)))
def _(t):
    out = correlation.pearson_matrix(layers.silver_financials(t), FINANCIAL_NUMBERS)
    return out.withColumn("rho", F.round("rho", 6))


RANKED = FINANCIAL_NUMBERS


@query("spearman_matrix", needs=["silver_financials"], sql=" union all ".join(
    f"""select '{a}' as "left", '{b}' as "right", round(corr(x, y), 6) as rho from (
          select rank() over (order by {a}) + (count(*) over (partition by {a}) - 1) / 2 as x,
                 rank() over (order by {b}) + (count(*) over (partition by {b}) - 1) / 2 as y
          from silver_financials where {a} is not null and {b} is not null) r"""
    for a, b in combinations(RANKED, 2)))
def _(t):
    out = correlation.spearman_matrix(layers.silver_financials(t), RANKED)
    return out.withColumn("rho", F.round("rho", 6))


@query("month_null_rate", needs=["feature_store"], sql="""
    select snapshot_date, count(*) as n_rows, count(*) filter (fe_1 is null) / count(*) as null_rate
    from feature_store group by 1""")
def _(t):
    return profile.month_null_rate(layers.features(t), "fe_1")


@query("categorical_reference", needs=["silver_financials"], sql=f"""
    with m as (select 'Credit_Mix' as feature, coalesce(Credit_Mix, '__MISSING__') as value from silver_financials
               union all select 'Type_of_Loan', coalesce(Type_of_Loan, '__MISSING__') from silver_financials
               union all select 'Customer_ID', Customer_ID from silver_financials),
         c as (select feature, value, count(*) as n from m group by 1, 2),
         s as (select feature, value, n / sum(n) over (partition by feature) as share,
                      row_number() over (partition by feature order by n desc, value) as place from c)
    select feature, cast(place - 1 as int) as place, value as category, share,
           round(greatest(0, 1 - sum(share) over (partition by feature)), 9) as other_pct
    from s where place <= {REFERENCE_CATEGORIES}""")
def _(t):
    long = profile.long_texts(layers.silver_financials(t), ["Credit_Mix", "Type_of_Loan", "Customer_ID"])
    ref = drift.categorical_reference(long)
    listed = ref.select("feature", "other_pct", F.posexplode(F.arrays_zip("categories", "pct")).alias("place", "e"))
    return listed.select("feature", "place", F.col("e.categories").alias("category"), F.col("e.pct").alias("share"),
                         F.round("other_pct", 9).alias("other_pct"))
