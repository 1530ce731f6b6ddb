"""Tolerant typing of raw text: bad input becomes NULL, never an exception."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake.settings import RAW_DATE_FORMAT, VALUE_TYPE


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(raw: str | Column, fmt: str = RAW_DATE_FORMAT) -> Column:
    """``try_to_date`` with an explicit pattern; unparsable -> NULL."""
    return F.try_to_date(_c(raw), fmt)


def parse_decimal(raw: str | Column, type_: str = VALUE_TYPE) -> Column:
    """``try_cast`` to the stored decimal type; unparsable/overflow -> NULL."""
    return _c(raw).try_cast(type_)


def year_month(date: str | Column) -> Column:
    """``yyyy-MM`` period key of a date."""
    return F.date_format(_c(date), "yyyy-MM")


def month_start(ym: str | Column) -> Column:
    """First day of the month of a ``yyyy-MM`` key."""
    return F.to_date(F.concat_ws("-", _c(ym), F.lit("01")))
