"""Derived tables of the checking SQL: silver and gold layers, written for the second engine."""

from ..schemas import CLICK_COLUMNS
from .registry import derived, rounded as r

derived("silver_loans", f"""
  select loan_id, Customer_ID, cast(loan_start_date as date) as loan_start_date, tenure, installment_num,
         loan_amt, due_amt, paid_amt, overdue_amt, balance, snapshot_date, installment_num as mob,
         installments_missed,
         case when installments_missed > 0 then cast(snapshot_date - to_months(installments_missed) as date) end
           as first_missed_date,
         case when overdue_amt > 0 then
              case when installments_missed > 0 then
                   cast(date_diff('day', cast(snapshot_date - to_months(installments_missed) as date), snapshot_date) as int) end
              else 0 end as dpd
  from (select loan_id, Customer_ID, loan_start_date, cast(tenure as int) as tenure,
               cast(installment_num as int) as installment_num, loan_amt, coalesce(due_amt, 0) as due_amt, paid_amt,
               overdue_amt, balance, snapshot_date,
               case when due_amt > 0 then cast(ceil(overdue_amt / due_amt) as int) else 0 end as installments_missed
        from raw_loans) t""", "raw_loans")

_num = "try_cast({} as double)"
_strip = "replace({}, '_', '')"


def _edge(c: str) -> str:
    return _num.format(f"regexp_replace(trim({c}), '^_+|_+$', '', 'g')")


def _within(e: str, lo, hi) -> str:
    tests = ([f"{e} >= {lo}"] if lo is not None else []) + ([f"{e} <= {hi}"] if hi is not None else [])
    return f"case when {' and '.join(tests)} then {e} end"


def _whole(c: str) -> str:
    return f"cast(trunc({_num.format(c)}) as int)"


_years = "try_cast(nullif(regexp_extract(Credit_History_Age, '([0-9]+) Years', 1), '') as int)"
_months = "try_cast(nullif(regexp_extract(Credit_History_Age, 'and ([0-9]+) Months', 1), '') as int)"

derived("silver_financials", f"""
  select Customer_ID,
         {_within(r(_num.format(_strip.format('Annual_Income')), 2), 0, 200000)} as Annual_Income,
         {r('Monthly_Inhand_Salary', 2)} as Monthly_Inhand_Salary,
         {_within(_whole('Num_Bank_Accounts'), 0, 10)} as Num_Bank_Accounts,
         {_within(_whole('Num_Credit_Card'), None, 10)} as Num_Credit_Card,
         {_within(_whole('Interest_Rate'), None, 34)} as Interest_Rate,
         {_within(_whole(_strip.format('Num_of_Loan')), 0, 10)} as Num_of_Loan,
         coalesce(Type_of_Loan, 'No Loan') as Type_of_Loan,
         {_within(_whole('Delay_from_due_date'), 0, None)} as Delay_from_due_date,
         {_within(_whole(_strip.format('Num_of_Delayed_Payment')), 0, 28)} as Num_of_Delayed_Payment,
         {r(_num.format("nullif(Changed_Credit_Limit, '_')"), 2)} as Changed_Credit_Limit,
         {_within('Num_Credit_Inquiries', 0, 20)} as Num_Credit_Inquiries,
         nullif(Credit_Mix, '_') as Credit_Mix,
         {_num.format(_strip.format('Outstanding_Debt'))} as Outstanding_Debt,
         {r('Credit_Utilization_Ratio', 2)} as Credit_Utilization_Ratio,
         Credit_History_Age,
         case when Payment_of_Min_Amount in ('Yes', 'No') then Payment_of_Min_Amount end as Payment_of_Min_Amount,
         {r(_within('Total_EMI_per_month', 0, 2000), 2)} as Total_EMI_per_month,
         case when trim(Amount_invested_monthly) <> '__10000__' then {r(_edge('Amount_invested_monthly'), 2)} end
           as Amount_invested_monthly,
         nullif(trim(Payment_Behaviour), '!@9#%8') as Payment_Behaviour,
         case when trim(Monthly_Balance) <> '__-333333333333333333333333333__' then
              {r(_edge("nullif(trim(Monthly_Balance), '__-333333333333333333333333333__')"), 2)} end as Monthly_Balance,
         snapshot_date,
         {_years} as Credit_History_Years, {_months} as Credit_History_Months_part,
         {_years} * 12 + {_months} as Credit_History_Age_Months
  from raw_financials""", "raw_financials")

derived("silver_attributes", """
  select Customer_ID, Name,
         try_cast(nullif(substr(regexp_replace(Age, '[^0-9]', '', 'g'), 1, 2), '') as int) as Age,
         case when regexp_full_match(SSN, '[0-9]{3}-[0-9]{2}-[0-9]{4}') then SSN end as SSN,
         nullif(Occupation, '_______') as Occupation, snapshot_date
  from raw_attributes""", "raw_attributes")

derived("label_store", """
  select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_6mob' as label_def, snapshot_date
  from silver_loans where mob = 6""", "silver_loans")

# the window is checked the direct way: every cutoff joined to the rows of its six months
derived("click_window", f"""
  select c.Customer_ID, m.snapshot_date,
         {', '.join(f"{r(f'avg(c.{fe})', 2)} as {fe}" for fe in CLICK_COLUMNS)}
  from raw_clicks c join (select distinct cast(snapshot_date + to_months(k) as date) as snapshot_date
                          from raw_clicks, (select unnest(generate_series(0, 5)) as k)) m
    on c.snapshot_date <= m.snapshot_date and c.snapshot_date > m.snapshot_date - interval 6 month
  group by 1, 2""", "raw_clicks")


def _ratio(n: str, d: str) -> str:
    return f"case when {d} > 0 then {r(f'{n} / {d}', 4)} end"


derived("joined_sources", f"""
  select l.loan_id, l.Customer_ID, l.loan_start_date, l.tenure, l.loan_amt, l.due_amt as Scheduled_Installment_Amt,
         l.snapshot_date, f.* exclude (Customer_ID, snapshot_date), a.* exclude (Customer_ID, snapshot_date),
         t.* exclude (Customer_ID, snapshot_date)
  from silver_loans l
  left join silver_financials f on f.Customer_ID = l.Customer_ID and f.snapshot_date = l.snapshot_date
  left join silver_attributes a on a.Customer_ID = l.Customer_ID and a.snapshot_date = l.snapshot_date
  left join click_window t on t.Customer_ID = l.Customer_ID and t.snapshot_date = l.snapshot_date
  where l.mob = 0""", "silver_loans", "silver_financials", "silver_attributes", "click_window")

derived("feature_store", f"""
  select * exclude (Credit_History_Age, Credit_History_Years, Credit_History_Months_part, Name, SSN, Monthly_Inhand_Salary),
         {_ratio('Total_EMI_per_month', 'Monthly_Inhand_Salary')} as EMI_to_Income_Ratio,
         {_ratio('Outstanding_Debt', 'Annual_Income')} as Debt_to_Income_Ratio,
         {_ratio('Amount_invested_monthly', 'Monthly_Inhand_Salary')} as Investment_to_Income_Ratio,
         {_ratio('Monthly_Balance', 'Monthly_Inhand_Salary')} as Balance_to_Income_Ratio,
         {_ratio('Num_of_Delayed_Payment', 'Num_of_Loan')} as Delayed_Payment_Rate,
         case when Credit_Utilization_Ratio < 30 then 'Low' when Credit_Utilization_Ratio < 40 then 'Medium'
              when Credit_Utilization_Ratio >= 40 then 'High' end as Credit_Utilization_Band,
         case when Credit_History_Age_Months < 60 then 'New' when Credit_History_Age_Months < 180 then 'Established'
              when Credit_History_Age_Months >= 180 then 'Long_Tenure' end as Credit_History_Band,
         case when Changed_Credit_Limit > 0 then 1 else 0 end as Recent_Credit_Expansion_Flag,
         case when Age < 25 then 'Under25' when Age < 40 then '25to39' when Age < 60 then '40to59'
              when Age >= 60 then '60plus' end as Age_Band,
         case when Occupation in ('Accountant', 'Architect', 'Doctor', 'Engineer', 'Lawyer', 'Scientist', 'Developer')
                then 'Professional'
              when Occupation in ('Journalist', 'Musician', 'Writer', 'Media_Manager') then 'Creative'
              when Occupation in ('Manager', 'Entrepreneur') then 'Business'
              when Occupation = 'Mechanic' then 'Trade' when Occupation = 'Teacher' then 'Education'
              else 'Unknown' end as Occupation_Group,
         {r(f"({' + '.join(CLICK_COLUMNS)}) / 20", 2)} as Clickstream_Mean,
         {r(f"sqrt({' + '.join(f'{c} * {c}' for c in CLICK_COLUMNS)})", 2)} as Clickstream_Vector_Norm
  from joined_sources""", "joined_sources")

derived("feature_keys", "select loan_id, snapshot_date from silver_loans where mob = 0", "silver_loans")
