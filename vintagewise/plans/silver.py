"""Typed and cleaned tables from raw text, for any number of months at once."""

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions import clean as C
from ..functions import loans as L
from ..operators.profile import numeric_columns


def loans(raw: DataFrame, amount_type: str = "double") -> DataFrame:
    """Loan snapshots with months on book and days past due.

    Every numeric column's nulls become 0 before the arrears are dated. `amount_type="float"` narrows the
    amounts to 32 bits first.
    """
    types = {name: amount_type if kind == "double" else kind for name, kind in S.LOAN_TYPES.items()}
    typed = C.enforce_types(raw, types).withColumn("mob", F.col("installment_num"))
    counted = typed.withColumn("installments_missed", L.installments_missed("overdue_amt", "due_amt"))
    filled = C.zero_fill(counted, numeric_columns(counted))
    dated = filled.withColumn("first_missed_date", L.first_missed_date("snapshot_date", "installments_missed"))
    return dated.withColumn("dpd", L.days_past_due("snapshot_date", "first_missed_date", "overdue_amt"))


def _rounded(c):
    return F.round(c, 2)


def financials(raw: DataFrame) -> DataFrame:
    """Customer finances: text is parsed in one projection and limited in the next, so each value is parsed once."""
    history = F.col("Credit_History_Age")
    parsed = raw.withColumns({
        "Annual_Income": _rounded(C.to_double(C.strip_all("Annual_Income"))),
        "Monthly_Inhand_Salary": _rounded(C.to_double("Monthly_Inhand_Salary")),
        "Num_Bank_Accounts": C.to_int("Num_Bank_Accounts"),
        "Num_Credit_Card": C.to_int("Num_Credit_Card"),
        "Interest_Rate": C.to_int("Interest_Rate"),
        "Num_of_Loan": C.to_int(C.strip_all("Num_of_Loan")),
        "Type_of_Loan": C.null_default("Type_of_Loan", S.NO_LOAN),
        "Delay_from_due_date": C.to_int("Delay_from_due_date"),
        "Num_of_Delayed_Payment": C.to_int(C.strip_all("Num_of_Delayed_Payment")),
        "Changed_Credit_Limit": _rounded(C.to_double(C.null_sentinels("Changed_Credit_Limit", S.BLANK))),
        "Num_Credit_Inquiries": C.to_double("Num_Credit_Inquiries"),
        "Credit_Mix": C.null_sentinels("Credit_Mix", S.BLANK),
        "Outstanding_Debt": C.to_double(C.strip_all("Outstanding_Debt")),
        "Credit_Utilization_Ratio": _rounded(C.to_double("Credit_Utilization_Ratio")),
        "Payment_of_Min_Amount": C.keep_listed("Payment_of_Min_Amount", "Yes", "No"),
        "Total_EMI_per_month": C.to_double("Total_EMI_per_month"),
        "Amount_invested_monthly": _rounded(C.to_double(C.strip_edges(
            C.null_sentinels(F.trim("Amount_invested_monthly"), S.INVESTED_PLACEHOLDER)))),
        "Payment_Behaviour": C.null_sentinels(F.trim("Payment_Behaviour"), S.BEHAVIOUR_PLACEHOLDER),
        "Monthly_Balance": _rounded(C.to_double(C.strip_edges(
            C.null_sentinels(F.trim("Monthly_Balance"), S.BALANCE_PLACEHOLDER)))),
        "snapshot_date": F.col("snapshot_date").cast("date"),
        "Credit_History_Years": C.years_part(history),
        "Credit_History_Months_part": C.months_part(history),
    })
    return parsed.withColumns({
        "Annual_Income": C.keep_between("Annual_Income", *S.INCOME_LIMITS),
        "Num_Bank_Accounts": C.keep_between("Num_Bank_Accounts", *S.ACCOUNT_LIMITS),
        "Num_Credit_Card": C.keep_between("Num_Credit_Card", *S.CARD_LIMITS),
        "Interest_Rate": C.keep_between("Interest_Rate", *S.INTEREST_LIMITS),
        "Num_of_Loan": C.keep_between("Num_of_Loan", *S.LOAN_COUNT_LIMITS),
        "Delay_from_due_date": C.keep_between("Delay_from_due_date", *S.DELAY_DAYS_LIMITS),
        "Num_of_Delayed_Payment": C.keep_between("Num_of_Delayed_Payment", *S.DELAYED_LIMITS),
        "Num_Credit_Inquiries": C.keep_between("Num_Credit_Inquiries", *S.INQUIRY_LIMITS),
        "Total_EMI_per_month": _rounded(C.keep_between("Total_EMI_per_month", *S.EMI_LIMITS)),
        "Credit_History_Age_Months": F.col("Credit_History_Years") * 12 + F.col("Credit_History_Months_part"),
    })


def attributes(raw: DataFrame) -> DataFrame:
    rules = {
        "Age": C.keep_between(C.leading_digits("Age"), *S.AGE_LIMITS),
        "Occupation": C.null_sentinels("Occupation", S.OCCUPATION_PLACEHOLDER),
        "SSN": C.keep_matching("SSN", S.SSN_PATTERN),
        "snapshot_date": F.col("snapshot_date").cast("date"),
    }
    return raw.select([rules[c].alias(c) if c in rules else F.col(c) for c in raw.columns])


def clickstream(raw: DataFrame) -> DataFrame:
    types = {c: "int" for c in raw.columns if c.startswith("fe_")}
    return C.enforce_types(raw, {**types, "Customer_ID": "string", "snapshot_date": "date"})
