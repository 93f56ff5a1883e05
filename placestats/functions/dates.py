"""Calendar expressions. The clock is always an `as_of` argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placestats.constants import MONTH_NAMES, UNKNOWN


def month_of(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def fmt_ts(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(ts, pattern)


def shift_months(day: Column, n: int) -> Column:
    return F.add_months(day, n)


def year_month_key(year: Column, month: Column, default: str = UNKNOWN) -> Column:
    key = F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
    return F.coalesce(key, F.lit(default))


def month_name(month: Column, default: str = UNKNOWN) -> Column:
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.coalesce(F.get(names, month - 1), F.lit(default))
