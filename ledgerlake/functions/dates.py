"""Calendar expressions. All are plain Columns, evaluated inside whole-stage codegen."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def date_key(d) -> Column:
    """yyyymmdd as int; null stays null."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_date(k) -> Column:
    """The date of a yyyymmdd key."""
    k = _col(k)
    return F.make_date(F.floor(k / 10000).cast("int"),
                       (F.floor(k / 100) % 100).cast("int"), (k % 100).cast("int"))


def month_end(d, months=0) -> Column:
    """Last day of the month `months` after the month of d (an int or an int column)."""
    d = _col(d)
    if isinstance(months, int) and months == 0:
        return F.last_day(d)
    return F.last_day(F.add_months(d, months))


def month_start(d) -> Column:
    return F.trunc(_col(d), "MM")


def days_between(start, end) -> Column:
    """Whole calendar days, also for timestamps."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def months_crossed(start, end) -> Column:
    """Number of month boundaries between two dates (not elapsed whole months)."""
    start, end = _col(start), _col(end)
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def minutes_crossed(start, end) -> Column:
    """Number of minute boundaries between two timestamps."""
    def minute(c):
        return F.unix_seconds(F.date_trunc("minute", _col(c)).cast("timestamp"))
    return ((minute(end) - minute(start)) / 60).cast("bigint")


def weekday_number(d) -> Column:
    """1 = Monday ... 7 = Sunday, whatever the locale."""
    return F.weekday(_col(d)) + 1


def quarter_label(d) -> Column:
    """'2024 Q1'."""
    d = _col(d)
    return F.when(d.isNotNull(), F.concat(F.year(d).cast("string"), F.lit(" Q"), F.quarter(d).cast("string")))


def quarter_period(d) -> Column:
    """'2020Q2'."""
    d = _col(d)
    return F.when(d.isNotNull(), F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")))


def quarter_label_of_key(k) -> Column:
    """'2024 Q1' from a yyyymmdd key, by integer division."""
    k = _col(k).cast("bigint")
    year = F.floor(k / 10000)
    quarter = F.floor((F.floor(k / 100) % 100 + 2) / 3)
    return F.concat(year.cast("string"), F.lit(" Q"), quarter.cast("string"))


def parse_date(text) -> Column:
    """Tolerant date parse: '02 Jan 2020', ISO, ISO in the first ten characters, then a plain cast."""
    text = _col(text)
    return F.coalesce(
        F.try_to_date(text, "dd MMM yyyy"),
        F.try_to_date(text, "yyyy-MM-dd"),
        F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"),
        text.try_cast("date"),
    )


def file_month(path) -> Column:
    """First day of the month named by .../year=YYYY/month=MM/... in a file path, else null."""
    path = _col(path)
    pattern = r"year=(\d{4})/month=(\d{2})"
    return F.make_date(
        F.regexp_extract(path, pattern, 1).try_cast("int"),
        F.regexp_extract(path, pattern, 2).try_cast("int"),
        F.lit(1),
    )


def month_label(d) -> Column:
    """'Jan 2020'."""
    return F.date_format(_col(d), "MMM yyyy")
