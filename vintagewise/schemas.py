"""Column types of the four monthly sources and the fixed values of the credit preset."""

from pyspark.sql.types import StringType, StructField, StructType

# ---- fixed values: names, types, limits, placeholders and word lists of the credit data ----

CLICK_COLUMNS = [f"fe_{i}" for i in range(1, 21)]

LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

FINANCIAL_COLUMNS = [
    "Customer_ID",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Type_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Mix",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Credit_History_Age",
    "Payment_of_Min_Amount",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Payment_Behaviour",
    "Monthly_Balance",
    "snapshot_date",
]

ATTRIBUTE_COLUMNS = ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]

# value limits, inclusive; None leaves the side open
INCOME_LIMITS = (0, 200000)
ACCOUNT_LIMITS = (0, 10)
CARD_LIMITS = (None, 10)
INTEREST_LIMITS = (None, 34)
LOAN_COUNT_LIMITS = (0, 10)
DELAYED_LIMITS = (0, 28)
INQUIRY_LIMITS = (0, 20)
DELAY_DAYS_LIMITS = (0, None)
EMI_LIMITS = (0, 2000)
AGE_LIMITS = (None, 100)

# placeholders that stand for "missing"
BLANK = "_"
INVESTED_PLACEHOLDER = "__10000__"
BEHAVIOUR_PLACEHOLDER = "!@9#%8"
BALANCE_PLACEHOLDER = "__-333333333333333333333333333__"
OCCUPATION_PLACEHOLDER = "_______"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
NO_LOAN = "No Loan"

# band limits (value below the limit takes the name) and the name beyond the last one
UTILIZATION_BANDS = ([(30, "Low"), (40, "Medium")], "High")
HISTORY_BANDS = ([(60, "New"), (180, "Established")], "Long_Tenure")
AGE_BANDS = ([(25, "Under25"), (40, "25to39"), (60, "40to59")], "60plus")

OCCUPATION_GROUPS = {
    "Professional": ["Accountant", "Architect", "Doctor", "Engineer", "Lawyer", "Scientist", "Developer"],
    "Creative": ["Journalist", "Musician", "Writer", "Media_Manager"],
    "Business": ["Manager", "Entrepreneur"],
    "Trade": ["Mechanic"],
    "Education": ["Teacher"],
}
UNKNOWN_OCCUPATION = "Unknown"

# columns that never feed a model
NOT_FEATURES = [
    "loan_id", "snapshot_date", "label", "feature_snapshot_date", "Customer_ID",
    "label_def", "loan_start_date", "Occupation", "Type_of_Loan",
]

# label definition, windows and monitoring levels
LABEL_DPD = 30
LABEL_MOB = 6
CLICK_WINDOW_MONTHS = 6
TRAIN_MONTHS = 12
OOT_MONTHS = 2
TRAIN_RATIO = 0.8
MIN_COVERAGE = 0.95
REFERENCE_BINS = 10
REFERENCE_CATEGORIES = 20
ROC_STEPS = 100
PSI_FLOOR = 1e-6
PSI_WARN = 0.10
PSI_ALERT = 0.25
MISSING_FEATURE_PSI = 10.0
MISSING_RATE_ALERT = 0.5
MISSING_NAME = "__MISSING__"
OTHER_NAME = "__OTHER__"

# search space of the boosted trees, and how many draws and folds
SEARCH_SPACE = {
    "maxIter": [25, 50],
    "maxDepth": [2, 3],
    "stepSize": [0.01, 0.1],
    "subsamplingRate": [0.6, 0.8],
    "featureSubsetStrategy": ["0.6", "0.8"],
    "minInfoGain": [0.0, 0.1],
    "minInstancesPerNode": [1, 3, 5],
}
SEARCH_DRAWS = 10
SEARCH_FOLDS = 3
SEARCH_SEED = 42
SPLIT_SEED = 88

# ---- end of fixed values ----


def text_schema(columns) -> StructType:
    """Raw files are read as text, so that no inference pass is needed."""
    return StructType([StructField(name, StringType()) for name in columns])


RAW_COLUMNS = {
    "loans": list(LOAN_TYPES),
    "financials": FINANCIAL_COLUMNS,
    "attributes": ATTRIBUTE_COLUMNS,
    "clickstream": [*CLICK_COLUMNS, "Customer_ID", "snapshot_date"],
}
