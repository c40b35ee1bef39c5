"""Readings of numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digits_as_int(text: Column) -> Column:
    """The digits of a text as an int; NULL where there are none."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("int")


def months_to_years(text: Column) -> Column:
    """Whole years of a text such as `36 months`."""
    months = F.trim(F.regexp_replace(text, " months", "")).try_cast("int")
    return (months / F.lit(12)).cast("int")


def year_of(text: Column) -> Column:
    """The year that ends a date such as `Jan-2015`; NULL where none does."""
    return F.regexp_extract(text, "([0-9]{4})$", 1).try_cast("int")


def whole(number: Column) -> Column:
    """A count stored with decimals as an int, truncated."""
    return number.cast("int")
