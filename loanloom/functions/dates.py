"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(text: Column, dayfirst: bool = False) -> Column:
    """ISO text (a time part is ignored) or day-first text to a date; unreadable text becomes null."""
    if dayfirst:
        return F.try_to_date(text, "d/M/yyyy")
    return F.substring(text.cast("string"), 1, 10).try_cast("date")


def completed_years(start: Column, end: Column) -> Column:
    """Whole years from ``start`` to ``end``; 29 February counts as the last day of February."""
    return (F.months_between(end, start) / 12).cast("int")


def quarter_name(month: Column) -> Column:
    return F.concat(F.lit("Q"), F.ceil(month / 3).cast("string"))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def weeks_from_days(days: Column) -> Column:
    """Whole weeks, floored, so day −1 belongs to week −1."""
    return F.floor(days / 7).cast("int")


def month_key(date_or_text: Column) -> Column:
    """``yyyy-MM`` of a date or of ISO text."""
    return F.substring(date_or_text.cast("string"), 1, 7)
