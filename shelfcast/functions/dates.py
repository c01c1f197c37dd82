"""Dates are stored as yyyymmdd integers; these expressions move between both forms."""

import datetime as dt

from pyspark.sql import functions as F


def to_day(column):
    """yyyymmdd integer -> DATE. Arithmetic only, so it stays inside generated code."""
    c = F.col(column) if isinstance(column, str) else column
    return F.make_date(
        (c / 10000).cast("int"), (c / 100 % 100).cast("int"), (c % 100).cast("int")
    )


def to_int(day):
    """DATE or TIMESTAMP -> yyyymmdd integer."""
    c = F.col(day) if isinstance(day, str) else day
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def weekday(column):
    """Day of the week with Monday = 0."""
    return F.weekday(to_day(column))


def weekday_name(column):
    return F.concat(F.lit("week"), weekday(column).cast("string"))


def add_days(column, days):
    return to_int(F.date_add(to_day(column), days))


def distance(end, start, mode="calendar"):
    """Days from `start` to `end`; mode="int" subtracts the integers, wrong across months."""
    if mode == "int":
        return (end - start).cast("bigint")
    return F.datediff(to_day(end), to_day(start)).cast("bigint")


def parse(value):
    """yyyymmdd integer -> datetime.date, on the driver."""
    return dt.date(value // 10000, value // 100 % 100, value % 100)


def shift(value, days):
    """yyyymmdd integer plus days, on the driver."""
    return int((parse(value) + dt.timedelta(days=days)).strftime("%Y%m%d"))


def days_between(lo, hi):
    """Number of calendar days of the inclusive range [lo, hi]."""
    return (parse(hi) - parse(lo)).days + 1
