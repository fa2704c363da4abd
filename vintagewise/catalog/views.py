"""The given tables reshaped into the four raw sources, predictions and runs.

Each view is one SELECT whose text both engines understand; only date arithmetic and row generators differ.
Nothing here cleans or computes results: values are built from keys by whole-number arithmetic so that both
engines see the same input, including its dirt.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@dataclass(frozen=True)
class Dialect:
    add_months: Callable[[str, str], str]
    installments: str
    nan: str
    # where scores come from, the month of an order there and the training date of a model
    scored: str
    month: str
    trained: str


CUSTOMER = "concat('CUS_0x', lower(hex({})))"
MONTH = "cast(date_trunc('month', {}) as date)"
TRAINED = "cast(replace(substr(model, 14), '_', '-') as date)"

SPARK = Dialect(
    add_months=lambda d, n: f"add_months({d}, cast({n} as int))",
    installments="explode(sequence(0, 10))",
    nan="cast('NaN' as double)",
    # dates are taken once per order and once per model: in the condition of a join they cost as much per pair
    scored=f"""(select o_orderkey, o_custkey, {MONTH.format('o_orderdate')} as month from orders) as dated
      join (select model, model_no, {TRAINED} as trained from models) as due""",
    month="month",
    trained="trained",
)
DUCKDB = Dialect(
    add_months=lambda d, n: f"cast({d} + to_months(cast({n} as int)) as date)",
    installments="cast(unnest(generate_series(0, 10)) as int)",
    nan="cast('NaN' as double)",
    scored="orders join models",
    month=MONTH.format("o_orderdate"),
    trained=TRAINED,
)


def _amount(cents: str) -> str:
    """Text like '123.45' from whole cents, without formatting a floating number."""
    return f"concat(cast(cast(floor(({cents}) / 100) as bigint) as string), '.', lpad(cast(({cents}) % 100 as string), 2, '0'))"


def _pick(seed: str, names: list[str]) -> str:
    whens = " ".join(f"when {i} then '{name}'" for i, name in enumerate(names))
    return f"case {seed} % {len(names)} {whens} end"


def loan_rows(d: Dialect) -> str:
    return f"""
      select o_orderkey, o_custkey, o_totalprice, {MONTH.format('o_orderdate')} as start, {d.installments} as k
      from orders"""


def raw_loans(d: Dialect) -> str:
    """Every order is a loan of ten installments, seen at months 0 to 10."""
    missed = "least(k, greatest(0, o_orderkey % 9 - 5))"
    return f"""
      select concat(cast(o_orderkey as string), '_', {CUSTOMER.format('o_custkey')}, '_',
                    replace(cast(start as string), '-', '_')) as loan_id,
             {CUSTOMER.format('o_custkey')} as Customer_ID,
             cast(start as string) as loan_start_date, '10' as tenure, cast(k as string) as installment_num,
             o_totalprice as loan_amt,
             case when o_orderkey % 97 = 0 then cast(0 as double) when o_orderkey % 89 = 0 then cast(null as double)
                  else o_totalprice / 10 end as due_amt,
             o_totalprice / 10 * cast(k - {missed} as double) as paid_amt,
             case when {missed} > 0 then o_totalprice / 10 * (cast({missed} as double) - 0.5e0)
                  else cast(0 as double) end as overdue_amt,
             o_totalprice - o_totalprice / 10 * cast(k - {missed} as double) as balance,
             {d.add_months('start', 'k')} as snapshot_date
      from loan_rows"""


def customer_months(d: Dialect) -> str:
    """Months in which a customer ordered, with a seed for the made-up values."""
    return f"""
      select o_custkey, {MONTH.format('o_orderdate')} as snapshot_date, max(o_orderkey) as s
      from orders group by 1, 2"""


def raw_financials(d: Dialect) -> str:
    loans = ["Auto Loan", "Auto Loan, Personal Loan, and Auto Loan", "Student Loan, and Home Loan",
             "Payday Loan, Not Specified, Payday Loan, and Not Specified", "Home Loan"]
    return f"""
      select {CUSTOMER.format('o_custkey')} as Customer_ID,
             concat(case when s % 53 = 0 then '-' else '' end, {_amount('(s * 3701) % 23000000')},
                    case when s % 7 = 0 then '_' else '' end) as Annual_Income,
             case when s % 17 = 0 then null when s % 29 = 0 then cast(0 as double)
                  else ((s * 1301) % 1200000) / 100e0 end as Monthly_Inhand_Salary,
             cast(s % 14 - 2 as string) as Num_Bank_Accounts,
             cast(s % 15 as string) as Num_Credit_Card,
             cast((s * 3) % 45 as string) as Interest_Rate,
             concat(cast(s % 13 - 1 as string), case when s % 5 = 0 then '_' else '' end) as Num_of_Loan,
             case when s % 9 = 0 then null else {_pick('s', loans)} end as Type_of_Loan,
             cast(s % 60 - 5 as string) as Delay_from_due_date,
             concat(cast(s % 33 - 2 as string), case when s % 4 = 0 then '_' else '' end) as Num_of_Delayed_Payment,
             case when s % 11 = 0 then '_' else concat(case when s % 3 = 0 then '-' else '' end,
                  {_amount('(s * 701) % 3000')}) end as Changed_Credit_Limit,
             cast(s % 24 - 1 as double) as Num_Credit_Inquiries,
             {_pick('s', ['Good', '_', 'Standard', 'Bad'])} as Credit_Mix,
             concat(case when s % 10 = 0 then '_' else '' end, {_amount('(s * 907) % 500000')}) as Outstanding_Debt,
             case when s % 31 = 0 then null else 20 + (s % 3000) / 100e0 end as Credit_Utilization_Ratio,
             case when s % 19 = 0 then null when s % 23 = 0 then 'NA'
                  else concat(cast(s % 34 as string), ' Years and ', cast(s % 12 as string), ' Months') end as Credit_History_Age,
             {_pick('s', ['Yes', 'No', 'NM'])} as Payment_of_Min_Amount,
             ((s * 1103) % 250000) / 100e0 as Total_EMI_per_month,
             case when s % 12 = 0 then ' __10000__ ' else concat(case when s % 6 = 0 then '__' else '' end,
                  {_amount('(s * 419) % 100000')}, case when s % 8 = 0 then '_' else '' end) end as Amount_invested_monthly,
             {_pick('s', ['High_spent_Small_value_payments', '!@9#%8', ' Low_spent_Large_value_payments '])} as Payment_Behaviour,
             case when s % 37 = 0 then '__-333333333333333333333333333__' else {_amount('(s * 613) % 150000')} end as Monthly_Balance,
             snapshot_date
      from customer_months"""


def raw_attributes(d: Dialect) -> str:
    jobs = ["Accountant", "Architect", "Doctor", "Engineer", "Lawyer", "Scientist", "Developer", "Journalist",
            "Musician", "Writer", "Media_Manager", "Manager", "Entrepreneur", "Mechanic", "Teacher", "_______", "Pilot"]
    return f"""
      select {CUSTOMER.format('o_custkey')} as Customer_ID, c_name as Name,
             case when s % 41 = 0 then '-500' when s % 43 = 0 then null
                  else concat(cast(14 + s % 60 as string), case when s % 6 = 0 then '_' else '' end) end as Age,
             case when s % 21 = 0 then '#F%$D@*&8' else concat(lpad(cast(s % 1000 as string), 3, '0'), '-',
                  lpad(cast(s % 100 as string), 2, '0'), '-', lpad(cast(s % 10000 as string), 4, '0')) end as SSN,
             case when s % 59 = 0 then null else {_pick('s', jobs)} end as Occupation,
             snapshot_date
      from customer_months join customer on c_custkey = o_custkey"""


def raw_clicks(d: Dialect) -> str:
    """Every event is a click row; events are laid over 80 months, since the table spans one month only."""
    fe = ", ".join(
        f"cast((event_id * {i * i + 7} + user_id * {i}) % 200 - 100 as int) as fe_{i}" for i in range(2, 20))
    return f"""
      select cast(floor(value) as int) as fe_1, {fe},
             case when event_type = 'error' then null else cast(event_id % 50 as int) end as fe_20,
             {CUSTOMER.format('user_id')} as Customer_ID,
             {d.add_months("date '1995-01-01'", 'event_id % 80')} as snapshot_date
      from events"""


MODELS = ["1996-09-01", "1998-03-01", "2000-01-01"]


def models(d: Dialect) -> str:
    """The registry: three training dates; one is not stored and must be read from the name."""
    rows = " union all ".join(
        f"select {i} as model_no, 'credit_model_{t.replace('-', '_')}' as model, "
        + ("cast(null as date)" if i == 1 else f"date '{t}'") + " as stored_date"
        for i, t in enumerate(MODELS))
    return rows


def model_scores(d: Dialect) -> str:
    """A score per loan and model, from the cohorts whose labels closed the training onwards; some scores are
    no probabilities."""
    return f"""
      select concat(cast(o_orderkey as string), '_', {CUSTOMER.format('o_custkey')}, '_',
                    replace(cast({d.month} as string), '-', '_')) as loan_id,
             {CUSTOMER.format('o_custkey')} as Customer_ID, {d.month} as snapshot_date,
             model as model_name, {d.trained} as train_date,
             case when o_orderkey % 101 = 0 then null when o_orderkey % 103 = 0 then {d.nan}
                  when o_orderkey % 107 = 0 then 1.5e0
                  else ((o_orderkey * 7919 + model_no * 131) % 750 + 25 * (o_orderkey % 9)) / 1000e0 end as model_predictions
      from {d.scored} on {d.month} >= {d.add_months(d.trained, '-8')}"""


def predictions(d: Dialect) -> str:
    """Scores of loans that started at or after the training date."""
    return """
      select loan_id, Customer_ID, snapshot_date, model_name, model_predictions
      from model_scores where snapshot_date >= train_date"""


def drift_runs(d: Dialect) -> str:
    """Each event is one drift figure: day, feature, run id and value."""
    return """
      select cast(date_trunc('day', ts) as date) as snapshot_date, event_type as feature,
             concat('run_', lpad(cast(event_id as string), 12, '0')) as inference_id, value as psi
      from events"""


# view -> (builder, views and tables it reads)
VIEWS = {
    "loan_rows": (loan_rows, ["orders"]),
    "raw_loans": (raw_loans, ["loan_rows"]),
    "customer_months": (customer_months, ["orders"]),
    "raw_financials": (raw_financials, ["customer_months"]),
    "raw_attributes": (raw_attributes, ["customer_months", "customer"]),
    "raw_clicks": (raw_clicks, ["events"]),
    "models": (models, []),
    "model_scores": (model_scores, ["orders", "models"]),
    "predictions": (predictions, ["model_scores"]),
    "drift_runs": (drift_runs, ["events"]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or one of the views above, as a DataFrame."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    builder, sources = VIEWS[name]
    text = builder(SPARK)
    frames = {}
    for source in sources:
        frames[source] = view(spark, sf_dir, source)
        for word in ("from", "join"):
            text = text.replace(f"{word} {source}", f"{word} {{{source}}} as {source}")
    return spark.sql(text, **frames)


def oracle_views(*names: str) -> list[tuple[str, str]]:
    """(name, select) of the views and what they need, in order, for a WITH clause."""
    out: dict[str, str] = {}

    def add(name):
        if name in VIEWS and name not in out:
            builder, sources = VIEWS[name]
            for source in sources:
                add(source)
            out[name] = builder(DUCKDB)

    for name in names:
        add(name)
    return list(out.items())
