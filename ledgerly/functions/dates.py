"""Calendar helpers (CA-3, CA-8, N8, N16, N17, N21, CL-17).

All of them take an explicit date or month; no operator reads the clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month as DATE (text ``yyyy-MM`` keys become dates)."""
    return F.trunc(F.to_date(_c(c)), "MM")


def month_end(c) -> Column:
    return F.last_day(F.to_date(_c(c)))


def next_month(c) -> Column:
    """Start of the following month, computed on dates."""
    return F.add_months(month_start(c), 1)


def prev_month(c) -> Column:
    return F.add_months(month_start(c), -1)


def month_offset_end(c, n: int) -> Column:
    """Last day n months after the month of ``c`` (N17, no roll-over)."""
    return F.last_day(F.add_months(month_start(c), n))


def days_back(d, n: int = 30) -> Column:
    """CA-7: the date ``n`` days before ``d``."""
    return F.date_sub(F.to_date(_c(d)), n)


def in_month(d, month) -> Column:
    """Half-open month test on the raw date column so pushdown survives."""
    m = month_start(month)
    d = _c(d)
    return (d >= m) & (d < F.add_months(m, 1))


def isodow(d) -> Column:
    """ISO day of week, Monday=1 .. Sunday=7."""
    return F.weekday(F.to_date(_c(d))) + 1


def js_dow(d) -> Column:
    """JavaScript ``getDay``: Sunday=0 .. Saturday=6."""
    return F.dayofweek(F.to_date(_c(d))) - 1


def period_of(d, cut: int = 20) -> Column:
    """CL-17: half-month period, day <= cut is period 1, else 2."""
    return F.when(F.dayofmonth(_c(d)) <= cut, F.lit(1)).otherwise(F.lit(2))


def month_key(d) -> Column:
    """``yyyy-MM`` text for output only."""
    return F.date_format(_c(d), "yyyy-MM")


# Portuguese month names used in labels and in sale descriptions.
MONTH_NAMES_PT = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho",
                  "agosto", "setembro", "outubro", "novembro", "dezembro"]
MONTH_ABBR_PT = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out",
                 "Nov", "Dez"]


def month_label(d) -> Column:
    """CA-8: ``Mmm/yyyy`` label with Portuguese abbreviations."""
    d = _c(d)
    arr = F.array(*[F.lit(x) for x in MONTH_ABBR_PT])
    return F.concat(F.element_at(arr, F.month(d)), F.lit("/"), F.year(d).cast("string"))


def date_text_br(d) -> Column:
    """``dd/MM/yyyy`` text of a date."""
    return F.date_format(_c(d), "dd/MM/yyyy")


def month_sequence(start, end) -> Column:
    """Array of month starts from ``start`` to ``end`` inclusive (CA-4)."""
    return F.sequence(month_start(start), month_start(end), F.expr("interval 1 month"))


def open_days(month, as_of) -> Column:
    """CA-6: the days of a month that are still to come on ``as_of``: all of a
    later month, from that day on within the month, none of an earlier one."""
    first, last = month_start(month), F.last_day(month_start(month))
    start = F.greatest(first, F.to_date(_c(as_of)))
    return F.when(start <= last, F.sequence(start, last, F.expr("interval 1 day"))).otherwise(F.array().cast("array<date>"))


def day_sequence(start, end) -> Column:
    return F.sequence(F.to_date(_c(start)), F.to_date(_c(end)), F.expr("interval 1 day"))
