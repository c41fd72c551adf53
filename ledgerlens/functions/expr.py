"""Column → Column helpers shared by every operator.

All of them are plain Catalyst expressions (no Python UDF), so they stay inside
whole-stage codegen. Money is summed as DECIMAL(18,2) — exact and independent
of partitioning — and turned into DOUBLE only at the edge of each result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: ColumnOrName) -> Column:
    """Exact decimal (a sum of 2-dp amounts) → DOUBLE for the result schema."""
    return _c(c).cast("double")


def r2(c: ColumnOrName) -> Column:
    """ROUND(x, 2), half away from zero, in one rounding of the double's shortest decimal
    form, so that 1.005 gives 1.01 and 12.3449996 gives 12.34."""
    return F.round(_c(c).cast("double"), 2)


def r2_even(c: ColumnOrName) -> Column:
    """Half-to-even rounding to 2 dp as numpy's ``round`` does it: rint(100 x) / 100."""
    return F.rint(_c(c).cast("double") * F.lit(100.0)) / F.lit(100.0)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL (never raises under ANSI)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    """ROUND(num / NULLIF(den, 0) * 100, 2)."""
    return r2(ratio(num, den) * F.lit(100.0))


def month_key(d: ColumnOrName) -> Column:
    """YYYY-MM of a date."""
    return F.date_format(_c(d), "yyyy-MM")


def leading_int(c: ColumnOrName) -> Column:
    """The whole number a text begins with (blanks and a sign may lead), 0 where there is none, NULL of
    NULL: the lenient reading of a text as a number. For texts of up to nine digits."""
    digits = F.regexp_extract(_c(c), r"^[ \t\n\f\r\x0B]*([+-]?[0-9]+)", 1)
    return F.when(digits == "", F.lit(0)).otherwise(F.nullif(digits, F.lit("")).cast("int"))


def month_offset(d: ColumnOrName, cohort_month: ColumnOrName) -> Column:
    """Whole calendar months from a YYYY-MM cohort to the month of ``d``; a malformed cohort month
    counts with the numbers it begins with, so its rows stay."""
    cm = _c(cohort_month)
    return ((F.year(_c(d)) - leading_int(F.substring(cm, 1, 4))) * F.lit(12)
            + (F.month(_c(d)) - leading_int(F.substring(cm, 6, 2))))


def count_where(cond: Column) -> Column:
    """COUNT(*) FILTER (WHERE cond) — NULL conditions are not counted."""
    return F.count_if(cond)


def sum_where(value: ColumnOrName, cond: Column, otherwise=0) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE otherwise END)."""
    return F.sum(F.when(cond, _c(value)).otherwise(F.lit(otherwise)))


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole days from ``earlier`` to ``later`` (dates)."""
    return F.datediff(_c(later), _c(earlier))


def py_str_2dp(c: ColumnOrName) -> Column:
    """Text of a value already rounded to 2 dp, written the way ``str(float)``
    writes it: no trailing zeros but at least one decimal (24.0, 18.1, 17090.33).
    """
    s = _c(c).cast("decimal(38,2)").cast("string")
    return F.regexp_replace(F.regexp_replace(s, "0+$", ""), r"\.$", ".0")


def py_repr(c: ColumnOrName) -> Column:
    """``str(float)`` of a value of magnitude 0 or below 1e7: plain down to 1e-4, then ``5e-05``.
    (Spark's cast writes everything below 1e-3 with an exponent.)"""
    s = _c(c).cast("double").cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(s, r"^-?([0-9.]+)E", 1), r"\.0$", "")
    sign = F.regexp_extract(s, "^(-?)", 1)
    exponent = F.regexp_extract(s, r"E-([0-9]+)$", 1)
    return (F.when(s.endswith("E-4"), F.concat(sign, F.lit("0.000"), F.replace(mantissa, F.lit("."), F.lit(""))))
            .when(exponent != "", F.concat(sign, mantissa, F.lit("e-"), F.when(F.length(exponent) < 2, F.lpad(exponent, 2, "0")).otherwise(exponent)))
            .otherwise(s))
