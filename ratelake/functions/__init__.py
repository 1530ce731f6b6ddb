"""Column-expression builders (JVM-side, inside whole-stage codegen)."""

from ratelake.functions.rates import (
    compound,
    compound_rate,
    factor,
    log_factor,
    to_percent,
)
from ratelake.functions.parsing import month_start, parse_date, parse_decimal, year_month
from ratelake.functions.series import series_attribute

__all__ = [
    "compound",
    "compound_rate",
    "factor",
    "log_factor",
    "to_percent",
    "month_start",
    "parse_date",
    "parse_decimal",
    "year_month",
    "series_attribute",
]
