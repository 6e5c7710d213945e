"""Reading typed values out of ingestion text.

`try_*` forms throughout: malformed text becomes NULL under any ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billbook.schema import MONEY

ISO_DATE = "yyyy-MM-dd"


def integer(text: Column) -> Column:
    return text.try_cast("bigint")


def money(text: Column) -> Column:
    """decimal(15,2), half-up; NULL when it does not fit."""
    return text.try_cast(MONEY)


def day(text: Column, pattern: str = ISO_DATE) -> Column:
    return F.try_to_date(text, pattern)


def without_hyphens(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def number_after_hyphen(text: Column) -> Column:
    """The number between the first and second hyphen: `F-123` gives 123."""
    return integer(F.get(F.split(text, "-"), 1))


def month_of(text: Column) -> Column:
    """`yyyyMM` cut from an ISO date in text, as int; NULL if that is no month."""
    digits = F.substring(without_hyphens(text), 1, 6)
    return F.when(digits.rlike(r"^\d{4}(0[1-9]|1[0-2])$"), digits.try_cast("int"))
