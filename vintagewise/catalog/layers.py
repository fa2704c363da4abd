"""The silver and gold layers over the reshaped inputs."""

from pyspark.sql import DataFrame

from ..plans import gold, silver
from ..session import stored
from .registry import Inputs

# the model inputs of the feature store: every column that is not excluded, as `training.feature_columns` finds them
FEATURE_NUMBERS = [
    "tenure", "loan_amt", "Scheduled_Installment_Amt", "Annual_Income", "Num_Bank_Accounts", "Num_Credit_Card",
    "Interest_Rate", "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
    "Num_Credit_Inquiries", "Outstanding_Debt", "Credit_Utilization_Ratio", "Total_EMI_per_month",
    "Amount_invested_monthly", "Monthly_Balance", "Credit_History_Age_Months", "Age", *[f"fe_{i}" for i in range(1, 21)],
    "EMI_to_Income_Ratio", "Debt_to_Income_Ratio", "Investment_to_Income_Ratio", "Balance_to_Income_Ratio",
    "Delayed_Payment_Rate", "Recent_Credit_Expansion_Flag", "Clickstream_Mean", "Clickstream_Vector_Norm"]
FEATURE_TEXTS = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Credit_Utilization_Band",
                 "Credit_History_Band", "Age_Band", "Occupation_Group"]


def silver_loans(t: Inputs) -> DataFrame:
    return t.once("silver.loans", lambda: silver.loans(t("raw_loans")))


def silver_financials(t: Inputs) -> DataFrame:
    return t.once("silver.financials", lambda: silver.financials(t("raw_financials")))


def silver_attributes(t: Inputs) -> DataFrame:
    return t.once("silver.attributes", lambda: silver.attributes(t("raw_attributes")))


def silver_clicks(t: Inputs) -> DataFrame:
    return t.once("silver.clicks", lambda: silver.clickstream(t("raw_clicks")))


def labels(t: Inputs) -> DataFrame:
    return t.once("gold.labels", lambda: gold.label_store(silver_loans(t)))


def joined(t: Inputs) -> DataFrame:
    return t.once("gold.joined", lambda: gold.joined_sources(
        silver_loans(t), silver_financials(t), silver_attributes(t), silver_clicks(t), check=False))


def features(t: Inputs) -> DataFrame:
    return t.once("gold.features", lambda: gold.derived_features(joined(t)))


def stored_labels(t: Inputs) -> DataFrame:
    """The label store as a table, for queries that read it several times."""
    return t.once("stored.labels", lambda: stored(labels(t), "label_store"))


def stored_features(t: Inputs) -> DataFrame:
    return t.once("stored.features", lambda: stored(features(t), "feature_store"))


def stored_predictions(t: Inputs) -> DataFrame:
    return t.once("stored.predictions", lambda: stored(t("predictions"), "predictions"))


def labelled(t: Inputs, *columns: str) -> DataFrame:
    """Feature columns with the label, written once: ordering operators read their input several times."""
    rows = features(t).select("loan_id", *columns).join(labels(t).select("loan_id", "label"), "loan_id")
    return t.once("stored.labelled." + ",".join(columns), lambda: stored(rows, "labelled"))
