"""Column helpers: exact rounding, guarded ratios, month arithmetic, labels.

All are built-in expressions (JVM side, whole-stage codegen); none is a UDF.

Rounding rule.  Money and ratios stay DECIMAL until output.  A rounded value is
``ROUND(CAST(x AS DECIMAL(38,6)), n)``: the six-digit step makes Spark's exact
decimal quotients and engines that divide in DOUBLE land on the same digits,
and differs from a single exact ROUND only for a value less than 5e-7 below a
tie.  Output columns are then DOUBLE (``money``).  A ratio of two exact sums is rounded
once, by integer division (``ratio_round``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def DEC(value) -> Column:
    """Exact decimal literal (a Python float would become DOUBLE)."""
    return F.lit(Decimal(str(value)))


def dec_round(c: Column, digits: int = 2) -> Column:
    """Half-up rounding through DECIMAL(38,6); stays DECIMAL."""
    return F.round(c.cast("decimal(38,6)"), digits)


def money(c: Column, digits: int = 2) -> Column:
    """``dec_round`` then DOUBLE, for output columns."""
    return dec_round(c, digits).cast("double")


def to_cents(c: Column) -> Column:
    """DECIMAL(p,2) money -> exact BIGINT cents."""
    return (c * 100).cast("long")


def from_cents(c: Column) -> Column:
    """BIGINT cents -> exact DECIMAL(21,2)."""
    return c.cast("decimal(19,0)") * DEC("0.01")


def safe_div(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of a divide-by-zero error."""
    return num / F.nullif(den, F.lit(0))


def safe_pct(num: Column, den: Column) -> Column:
    """``num * 100.0 / NULLIF(den, 0)``, multiplying first as numeric."""
    return safe_div(num * DEC("100.0"), den)


def ratio_round(num: Column, den: Column, digits: int = 2, times: int = 1) -> Column:
    """``num * times / den`` rounded once, half away from zero, in integer division: DECIMAL,
    exact at any size.  NULL for a zero or NULL denominator."""
    twice = F.abs(F.nullif(den, F.lit(0))) * DEC(2)
    whole = F.call_function("div", F.abs(num) * DEC(2 * times * 10 ** digits) + F.abs(den), twice)
    sign = F.when((num < 0) != (den < 0), DEC(-1)).otherwise(DEC(1))
    return whole.cast("decimal(19,0)") * sign * DEC(Decimal(1).scaleb(-digits))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """Exactly rounded percentage, DOUBLE for output columns."""
    return ratio_round(num, den, digits, 100).cast("double")


def month_start(c: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(c, "month")


def month_diff(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two first-of-month dates."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("int")


def month_label(c: Column) -> Column:
    """``YYYY-MM`` label of a date."""
    return F.date_format(c, "yyyy-MM")


def lakh_label(c: Column) -> Column:
    """Amount in lakh (1 L = 100,000) with one decimal and an ``L`` suffix (NULL stays NULL)."""
    return F.when(c.isNotNull(), F.format_string("%.1fL", c.cast("double") / F.lit(100000.0)))


def signed_pct_label(c: Column) -> Column:
    """Signed one-decimal percentage, e.g. ``+18.3%`` / ``-19.2%`` (NULL stays NULL)."""
    return F.when(c.isNotNull(), F.format_string("%+.1f%%", c.cast("double")))


def growth_class(c: Column) -> Column:
    """``Growth`` for values >= 0, ``Decline`` below, NULL for NULL."""
    return F.when(c >= 0, F.lit("Growth")).when(c < 0, F.lit("Decline"))
