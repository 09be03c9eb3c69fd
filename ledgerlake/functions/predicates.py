"""Row predicates of the reference's filters (Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import cleaning as C

_CN_DAY = "yyyy'年'MM'月'dd'日'"


def is_distinct_from(x, value) -> Column:
    """Null-safe ``x IS DISTINCT FROM value`` (keeps null rows)."""
    return ~C._c(x).eqNullSafe(F.lit(value))


def not_cancelled_or_refunded(status, refund) -> Column:
    """``NOT (status = cancelled OR refund = fully refunded)`` on cleaned text,
    three-valued: a normal row with a null refund status evaluates to null and
    is dropped by ``where`` — deliberately not rewritten null-safe."""
    return ~((C.clean_text(status) == F.lit(C.CANCELLED))
             | (C.clean_text(refund) == F.lit(C.FULL_REFUND)))


def dual_format_day(x) -> Column:
    """Business day of a placed-time text: ``YYYY年MM月DD日...`` or an ISO
    ``YYYY-MM-DD HH:MM:SS`` timestamp; anything else null."""
    t = C._c(x)
    cn = F.try_to_timestamp(F.substring(t, 1, 11), F.lit(_CN_DAY))
    iso = F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss"))
    return (F.when(t.rlike(r"^\d{4}年\d{2}月\d{2}日"), cn)
            .when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), iso)).cast("date")


def half_open(day: Column, start, end) -> Column:
    """``start <= day < end``."""
    return (day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date"))


def lookback(day: Column, start, days: int) -> Column:
    """``day >= start - days`` with no upper bound (partition-prunable)."""
    return day >= F.date_sub(F.lit(start).cast("date"), days)


def in_list(x, values) -> Column:
    """``x IN (...)``; a null ``x`` is excluded."""
    return C._c(x).isin(*values)


def not_in_list(x, values) -> Column:
    """``x NOT IN (...)``; a null ``x`` is excluded as well (three-valued)."""
    return ~C._c(x).isin(*values)


def regex_gate(x, pattern: str) -> Column:
    return C._c(x).rlike(pattern)


def contains(x, text: str) -> Column:
    """``x LIKE '%text%'`` with literal text."""
    return C._c(x).contains(text)
