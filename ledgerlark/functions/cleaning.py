"""Value repairs. Casts of dirty text use ``try_cast`` so they hold with ANSI mode on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlark.schema import LOAN_PURPOSES


def emp_length_years(text: Column) -> Column:
    """``'10+ years'`` -> 10, ``'< 1 year'`` -> 1; text without a digit -> NULL."""
    return F.regexp_replace(text, r"\D", "").try_cast("int")


def state_code(code: Column) -> Column:
    """Anything longer than a two-letter code becomes ``'NA'``; NULL stays NULL."""
    return F.when(F.length(code) > 2, F.lit("NA")).otherwise(code)


def term_years(text: Column) -> Column:
    """``'36 months'`` -> 3. Part years are cut off."""
    months = F.trim(F.regexp_replace(text, " months", "")).try_cast("int")
    return (months / F.lit(12)).cast("int")


def known_purpose(purpose: Column, known: Iterable[str] = LOAN_PURPOSES) -> Column:
    return F.when(purpose.isin(*known), purpose).otherwise(F.lit("other"))


def repaired_payment(total: Column, principal: Column, interest: Column, late_fee: Column) -> Column:
    """A zero total beside a principal that is not zero is replaced by the sum of its parts."""
    return F.when(
        inconsistent_zero(total, principal), principal + interest + late_fee
    ).otherwise(total)


def inconsistent_zero(total: Column, principal: Column) -> Column:
    return (total == F.lit(0.0)) & (principal != F.lit(0.0))


def is_zero_text(text: Column) -> Column:
    """True when the text reads as the number zero; NULL for text that is no number."""
    return text.try_cast("double") == F.lit(0.0)


def null_if_zero_text(text: Column) -> Column:
    return F.when(is_zero_text(text), F.lit(None)).otherwise(text)


def count_or_zero(value: Column) -> Column:
    """Whole number (fraction cut off), with NULL taken as zero."""
    return F.coalesce(value.try_cast("int"), F.lit(0))


def month_start(text: Column) -> Column:
    """``'Dec-2018'`` -> 2018-12-01; text of another form -> NULL."""
    return F.try_to_date(text, "MMM-yyyy")
