"""Filters and predicates (FL-1 .. FL-12). Each returns a DataFrame whose
``where`` Catalyst can push into the parquet scan when it names raw columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions import text as T


def active(df: DataFrame, status_col: str, active_value: str, type_col: str, types: Sequence[str],
           text_col: str, deny: Sequence[str]) -> DataFrame:
    """FL-1: active rows of the given types whose text has none of the deny
    patterns. Like ``NOT ILIKE``, a null text drops the row (N3)."""
    ok = (F.col(status_col) == active_value) & F.col(type_col).isin(list(types))
    for p in deny:
        ok = ok & ~F.contains(F.lower(F.col(text_col)), F.lit(p.lower()))
    return df.where(ok)


def valid_items(df: DataFrame, item_cancel: str, sale_cancel: str, sale_type: str, value: str,
                category: str, categories: Sequence[str], sub: str | None = None,
                excluded_sub: str | None = None) -> DataFrame:
    """FL-2: not cancelled, not refund (null type passes, N2), positive,
    in the categories, subcategory null or not the excluded one."""
    ok = (F.col(item_cancel) == F.lit(False)) & (F.col(sale_cancel) == F.lit(False)) & \
         (F.coalesce(F.col(sale_type), F.lit("")) != "refund") & (F.col(value) > 0) & \
         F.col(category).isin(list(categories))
    if sub and excluded_sub:
        ok = ok & (F.col(sub).isNull() | (F.col(sub) != excluded_sub))
    return df.where(ok)


def in_month_any(df: DataFrame, month, cols: Sequence[str]) -> DataFrame:
    """FL-3: rows whose date in any of ``cols`` falls in the month (half-open)."""
    cond = None
    for c in cols:
        t = D.in_month(c, F.lit(month).cast("date"))
        cond = t if cond is None else (cond | t)
    return df.where(cond)


def open_items(df: DataFrame, due: str, paid: str, lo, hi) -> DataFrame:
    """FL-4: due inside [lo, hi], or unpaid and due before lo."""
    d = F.col(due)
    lo_c, hi_c = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    return df.where(((d >= lo_c) & (d <= hi_c)) | ((~F.coalesce(F.col(paid), F.lit(False))) & (d < lo_c)))


def paid_pending(df: DataFrame, month, paid: str, pay_date: str, event_date: str) -> DataFrame:
    """FL-5: ``status`` = 'paid' when paid with pay date in the month,
    'pending' when unpaid with event date in the month, else null."""
    m = F.lit(month).cast("date")
    is_paid = F.coalesce(F.col(paid), F.lit(False))
    return df.withColumn("status",
                         F.when(is_paid & D.in_month(pay_date, m), F.lit("paid"))
                          .when(~is_paid & D.in_month(event_date, m), F.lit("pending")))


# The voucher pattern (teacher name after "INTENSIV.. - n aulas - ").
VOUCHER_RE = r"(?i)INTENSIV\S*\s*-\s*\d+\s*aulas?\s*-\s*(.+)$"


def valid_vouchers(df: DataFrame, desc: str, total: str, canceled_text: str | None = None) -> DataFrame:
    """FL-6: vouchers with a captured name, positive total and not voided."""
    name = T.group_or_null(desc, VOUCHER_RE, 1)
    out = df.withColumn("voucher_name", name).where(F.col("voucher_name").isNotNull() & (F.col(total) > 0))
    if canceled_text:
        out = out.where(~F.coalesce(F.col(canceled_text).rlike("(?i)anula"), F.lit(False)))
    return out


def investment_moves(df: DataFrame, type_col: str, type_value: str, text_cols: Sequence[str],
                     words: Sequence[str]) -> DataFrame:
    """FL-7: movement flagged by type or by any keyword, taken as it is written, in the text columns."""
    txt = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    return df.where(F.coalesce(F.col(type_col) == type_value, F.lit(False)) | T.ilike_any(txt, words))


def productive(df: DataFrame, kind: str, pattern: str = "(?i)manuten|bloqueio") -> DataFrame:
    """FL-8: drop maintenance rows."""
    return df.where(~F.coalesce(F.col(kind).rlike(pattern), F.lit(False)))


def expense_lines(df: DataFrame, rules: Sequence[tuple], text_columns: Sequence[str] = ()) -> DataFrame:
    """FL-9: statement exclusions. ``rules`` = ``[(column, value, from_date|None, date_col|None)]``;
    a row matching any rule (on or after its date) is excluded. A rule without
    a column (None) holds where any of ``text_columns`` has the value as a part
    of its text, case folded; with a column and a value in a one-element list,
    where that column has it."""
    drop = F.lit(False)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in text_columns if c in df.columns]
    for col, value, since, dcol in rules:
        if col is None:
            c = T.ilike_any(F.concat_ws(" ", *texts), [value])
        elif isinstance(value, (list, tuple)):
            c = F.coalesce(T.ilike_any(F.col(col), list(value)), F.lit(False))
        else:
            c = F.coalesce(F.col(col) == value, F.lit(False))
        if since is not None:
            c = c & (F.col(dcol) >= F.lit(since).cast("date"))
        drop = drop | c
    return df.where(~drop)


def due_buckets(df: DataFrame, due: str, paid: str, as_of, month) -> DataFrame:
    """FL-10: 'overdue' (unpaid, due before ``as_of``) and 'upcoming' (unpaid,
    due from ``as_of`` to the end of ``month``); others are dropped."""
    a = F.lit(as_of).cast("date")
    m = F.lit(month).cast("date")
    unpaid = ~F.coalesce(F.col(paid), F.lit(False))
    b = F.when(unpaid & (F.col(due) < a), F.lit("overdue")) \
         .when(unpaid & (F.col(due) >= a) & (F.col(due) <= F.last_day(m)), F.lit("upcoming"))
    return df.withColumn("bucket", b).where(F.col("bucket").isNotNull())


def future_plan(df: DataFrame, ref_col: str, text_col: str, month_words: Sequence[str]) -> DataFrame:
    """FL-11: plan lines with no booking reference that name a month."""
    return df.where(F.col(ref_col).isNull() & F.coalesce(T.ilike_any(F.col(text_col), month_words), F.lit(False)))


def members(col: str, values: Sequence) -> Column:
    """FL-12: constant membership."""
    return F.col(col).isin(list(values))
