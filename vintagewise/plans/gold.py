"""Label store and origination-time feature store, for all months in one plan."""

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions import derive as D
from ..functions import loans as L
from ..operators.joins import left_join_unique
from ..operators.profile import prefixed_columns

KEYS = ["Customer_ID", "snapshot_date"]


def label_store(loans: DataFrame, dpd: int = S.LABEL_DPD, mob: int = S.LABEL_MOB) -> DataFrame:
    """One label per loan seen at `mob` months on book."""
    return loans.where(F.col("mob") == mob).select(
        "loan_id", "Customer_ID", L.delinquency_flag("dpd", dpd).alias("label"),
        F.lit(L.label_name(dpd, mob)).alias("label_def"), "snapshot_date",
    )


def trailing_window(clicks: DataFrame, months: int = S.CLICK_WINDOW_MONTHS, places: int = 2) -> DataFrame:
    """Mean of every fe_ column per customer over (cutoff - months, cutoff], for every cutoff month.

    Clicks are summed per customer and month first; each sum is then handed to the `months` cutoffs it
    counts for. So a customer without clicks in the cutoff month is kept, no range join is needed, and
    a customer with very many clicks has shrunk to one row per month before anything is spread.
    """
    columns = prefixed_columns(clicks, "fe_")
    sums = [F.sum(c).alias(f"s_{c}") for c in columns] + [F.count(c).alias(f"n_{c}") for c in columns]
    monthly = clicks.groupBy(*KEYS).agg(*sums)
    cutoffs = F.sequence("snapshot_date", F.add_months("snapshot_date", months - 1), F.expr("interval 1 month"))
    spread = monthly.withColumn("snapshot_date", F.explode(cutoffs))
    means = [F.round(F.try_divide(F.sum(f"s_{c}"), F.sum(f"n_{c}")), places).alias(c) for c in columns]
    return spread.groupBy(*KEYS).agg(*means)


def window_completeness(clicks: DataFrame, months: int = S.CLICK_WINDOW_MONTHS) -> DataFrame:
    """Per cutoff month of the click extent: months found in its window, months expected, months behind.

    Early cutoffs expect only the months since the first one. A cutoff is fine when all expected months
    are there and its own month is one of them.
    """
    present = clicks.select("snapshot_date").distinct()
    extent = present.agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))
    spine = extent.select("first", F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("cutoff"))
    spread = present.select(
        F.col("snapshot_date").alias("month"),
        F.explode(F.sequence("snapshot_date", F.add_months("snapshot_date", months - 1),
                             F.expr("interval 1 month"))).alias("cutoff"),
    )
    found = spread.groupBy("cutoff").agg(
        F.count("*").alias("n_found"), F.max(F.col("month") == F.col("cutoff")).alias("has_cutoff"))
    since = F.months_between("cutoff", "first").cast("int") + 1
    out = spine.join(found, "cutoff", "left").select(
        "cutoff", F.coalesce("n_found", F.lit(0)).alias("n_found"),
        F.least(F.lit(months), since).alias("n_expected"), F.coalesce("has_cutoff", F.lit(False)).alias("has_cutoff"),
    )
    return out.withColumn("complete", (F.col("n_found") == F.col("n_expected")) & F.col("has_cutoff"))


def originations(loans: DataFrame) -> DataFrame:
    """Loans in the month they start."""
    return loans.where(F.col("mob") == 0).select(
        "loan_id", "Customer_ID", "loan_start_date", "tenure", "loan_amt",
        F.col("due_amt").alias("Scheduled_Installment_Amt"), "snapshot_date",
    )


def derived_features(joined: DataFrame) -> DataFrame:
    """Ratios, bands, groups and flags, and the columns that leave the table."""
    salary, clicks = "Monthly_Inhand_Salary", prefixed_columns(joined, "fe_")
    new = {
        "EMI_to_Income_Ratio": D.ratio("Total_EMI_per_month", salary),
        "Debt_to_Income_Ratio": D.ratio("Outstanding_Debt", "Annual_Income"),
        "Investment_to_Income_Ratio": D.ratio("Amount_invested_monthly", salary),
        "Balance_to_Income_Ratio": D.ratio("Monthly_Balance", salary),
        "Delayed_Payment_Rate": D.ratio("Num_of_Delayed_Payment", "Num_of_Loan"),
        "Credit_Utilization_Band": D.band("Credit_Utilization_Ratio", *S.UTILIZATION_BANDS),
        "Credit_History_Band": D.band("Credit_History_Age_Months", *S.HISTORY_BANDS),
        "Recent_Credit_Expansion_Flag": D.positive_flag("Changed_Credit_Limit"),
        "Age_Band": D.band("Age", *S.AGE_BANDS),
        "Occupation_Group": D.grouped("Occupation", S.OCCUPATION_GROUPS, S.UNKNOWN_OCCUPATION),
    }
    if clicks:
        new["Clickstream_Mean"] = D.row_mean(clicks)
        new["Clickstream_Vector_Norm"] = D.row_norm(clicks)
    dropped = ["Credit_History_Age", "Credit_History_Years", "Credit_History_Months_part", "Name", "SSN", salary]
    return joined.withColumns(new).drop(*dropped)


def side_features(joined: DataFrame) -> DataFrame:
    """Two figures that are computed from the joined row but not kept in the store."""
    return joined.select(
        "loan_id",
        D.residual("Monthly_Inhand_Salary", "Total_EMI_per_month", "Scheduled_Installment_Amt").alias("Post_EMI_Slack"),
        D.distinct_items("Type_of_Loan", S.NO_LOAN).alias("Loan_Type_Diversity"),
    )


def joined_sources(loans: DataFrame, financials: DataFrame, attributes: DataFrame, clicks: DataFrame,
                   check: bool = True) -> DataFrame:
    """Originations with the customer's finances, attributes and trailing clicks of the same month.

    All joins share the keys (customer, month), so the plan shuffles the loans once for the three of them.
    """
    out = originations(loans)
    out = left_join_unique(out, financials, KEYS, "financials", check)
    out = left_join_unique(out, attributes, KEYS, "attributes", check)
    # one row per customer and cutoff by construction, so there is nothing to check
    return left_join_unique(out, trailing_window(clicks), KEYS, "clickstream", check=False)


def feature_store(loans: DataFrame, financials: DataFrame, attributes: DataFrame, clicks: DataFrame,
                  check: bool = True) -> DataFrame:
    return derived_features(joined_sources(loans, financials, attributes, clicks, check))
