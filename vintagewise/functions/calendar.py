"""Month arithmetic as Column expressions."""

from pyspark.sql import Column, functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(value) -> Column:
    """A date literal from 'YYYY-MM-DD' or a date; columns pass through."""
    return value if isinstance(value, Column) else F.to_date(F.lit(str(value)))


def month_start(c) -> Column:
    return F.trunc(col(c), "MM")


def month_number(c) -> Column:
    """Months since year 0, so that differences count calendar months."""
    return F.year(col(c)) * 12 + F.month(col(c))


def calendar_months(later, earlier) -> Column:
    """Difference of the (year, month) parts, days ignored."""
    return month_number(later) - month_number(earlier)


def full_months(later, earlier) -> Column:
    """Completed months between two dates."""
    return F.floor(F.months_between(col(later), col(earlier))).cast("int")


def origination_month(snapshot, mob: int) -> Column:
    """'yyyy-MM' of the month a loan seen at `snapshot` with `mob` months on book started."""
    return F.date_format(F.add_months(col(snapshot), -mob), "yyyy-MM")


def training_windows(train_date, train_months: int = 12, oot_months: int = 2) -> dict[str, Column]:
    """Label-date windows implied by a training date, all bounds inclusive."""
    trained = date_lit(train_date)
    oot_start = F.add_months(trained, -oot_months)
    return {
        "train_start": F.add_months(oot_start, -train_months),
        "train_end": F.date_sub(oot_start, 1),
        "oot_start": oot_start,
        "oot_end": F.date_sub(trained, 1),
    }


def window_split(label_date, train_date, train_months: int = 12, oot_months: int = 2) -> Column:
    """'train_test', 'oot' or null by the label date."""
    w = training_windows(train_date, train_months, oot_months)
    seen = col(label_date)
    return F.when(seen.between(w["oot_start"], w["oot_end"]), "oot").when(
        seen.between(w["train_start"], w["train_end"]), "train_test"
    )


def first_unseen_cohort(train_date, horizon: int = 6) -> Column:
    """Earliest origination month whose labels were not yet known at training."""
    return F.add_months(date_lit(train_date), -horizon)


def performance_cohort(snapshot, train_date, horizon: int = 6, override=None) -> Column:
    """Origination month whose labels mature at `snapshot`; null when training had seen it."""
    cohort = F.add_months(date_lit(snapshot), -horizon) if override is None else date_lit(override)
    return F.when(cohort >= first_unseen_cohort(train_date, horizon), cohort)


def train_date_of(name, stored=None, fallback=None) -> Column:
    """Training date: the stored one, else the date written in the model name, else `fallback`."""
    in_name = F.regexp_extract(col(name), r"(\d{4}_\d{2}_\d{2})", 1)
    parsed = F.to_date(F.when(in_name != "", in_name), "yyyy_MM_dd")
    choices = [c for c in (stored, parsed, fallback) if c is not None]
    return F.coalesce(*[col(c) for c in choices])
