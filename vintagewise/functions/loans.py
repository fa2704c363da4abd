"""Arrears arithmetic on one loan snapshot row."""

from pyspark.sql import Column, functions as F

from .calendar import col

MOST_INSTALLMENTS = 12 * 1900  # months back from now to the first year
MOST_INT = 2**31 - 1


def installments_missed(overdue, due) -> Column:
    """Installments behind, begun ones counting whole; 0 when nothing can be divided.

    Division noise (0.21 / 0.07 is a little over 3) does not count as a begun installment.
    """
    behind = F.ceil(F.round(F.try_divide(col(overdue), col(due)), 9))
    return F.least(F.greatest(F.coalesce(behind, F.lit(0)), F.lit(-MOST_INT)), F.lit(MOST_INT)).cast("int")


def first_missed_date(snapshot, missed) -> Column:
    """Month of the first missed installment, at most MOST_INSTALLMENTS back: arrears that no calendar reaches get that
    date, so that they stay the worst loans."""
    return F.when(col(missed) > 0, F.add_months(col(snapshot), -F.least(col(missed), F.lit(MOST_INSTALLMENTS))))


def days_past_due(snapshot, first_missed, overdue) -> Column:
    """Null when money is overdue but no missed installment could be dated."""
    return F.when(col(overdue) > 0, F.date_diff(col(snapshot), col(first_missed))).otherwise(0)


def delinquency_flag(dpd, threshold: int) -> Column:
    """1 at or beyond the threshold, else 0; an unknown dpd counts as 0."""
    return F.when(col(dpd) >= threshold, 1).otherwise(0)


def label_name(dpd: int, mob: int) -> str:
    return f"{dpd}dpd_{mob}mob"
