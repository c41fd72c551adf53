"""Display formats as column expressions (no per-row Python)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.expr import ColumnOrName, _c

# Fixed values that must equal the reference's display formats:
# one crore = 1,00,00,000 (1e7) → "₹x.xx Cr"; one lakh = 1,00,000 (1e5) → "₹x.xx L";
# below a lakh "₹x,xxx" (thousands separators, no decimals); percent "x.x%";
# a missing retention cell is shown as an em dash.
CRORE = 10_000_000.0
LAKH = 100_000.0
RUPEE = "₹"
DASH = "—"


SPLIT = 134217729.0  # 2^27 + 1 cuts a double into two halves whose small multiples are exact


def _bound(value: str, name: str, use: str) -> str:
    """SQL text of ``use`` with ``value`` computed once as ``name``."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def _units(digits: int) -> str:
    """x * 10^digits rounded half-even on the exact binary value of x, as a whole double.

    The product p of doubles may be off by a part of its last bit. Where p is exactly
    half-way the sign of that error e, computed without error, says which side x is on.
    """
    scale, cut = f"{float(10 ** digits)}D", f"{SPLIT}D * x"
    error = f"(((h * {scale}) - (x * {scale})) + ((x - h) * {scale}))"
    tie = f"CASE WHEN e < 0 THEN CAST(floor(p) AS DOUBLE) WHEN e > 0 THEN CAST(floor(p) AS DOUBLE) + 1.0D ELSE rint(p) END"
    rounded = f"IF(p - CAST(floor(p) AS DOUBLE) = 0.5D, {_bound(_bound(f'({cut}) - (({cut}) - x)', 'h', error), 'e', tie)}, rint(p))"
    return _bound(f"x * {scale}", "p", rounded)


def _text(digits: int, commas: bool) -> str:
    """SQL text of the format of the double ``x``."""
    step = f"{Decimal(1).scaleb(-digits):f}BD"
    plain = f"CAST(CAST(k AS DECIMAL(20,0)) * {step} AS DECIMAL({20 + digits},{digits}))"
    text = f"format_number({plain}, {digits})" if commas else f"CAST({plain} AS STRING)"
    return _bound(_units(digits), "k", f"IF((x < 0) AND (k = 0), concat('-', {text}), {text})")


def _formatted(c: ColumnOrName, digits: int, commas: bool) -> Column:
    # The format is one SQL text, parsed at once: as nested Column calls it took the driver longer than the query.
    lines = F.call_function("transform", F.array(_c(c).cast("double")), F.expr(f"x -> {_text(digits, commas)}"))
    return F.get(lines, 0)


def fixed(c: ColumnOrName, digits: int) -> Column:
    """``{x:.Nf}`` text as Python writes it: the exact binary value, ties to even."""
    return _formatted(c, digits, False)


def fixed_commas(c: ColumnOrName, digits: int) -> Column:
    """``{x:,.Nf}`` text (thousands separators)."""
    return _formatted(c, digits, True)


def fmt_inr(c: ColumnOrName) -> Column:
    v = _c(c).cast("double")
    return (F.when(v >= F.lit(CRORE), F.concat(F.lit(RUPEE), fixed(v / F.lit(CRORE), 2), F.lit(" Cr")))
            .when(v >= F.lit(LAKH), F.concat(F.lit(RUPEE), fixed(v / F.lit(LAKH), 2), F.lit(" L")))
            .otherwise(F.concat(F.lit(RUPEE), fixed_commas(v, 0))))


def fmt_pct(c: ColumnOrName) -> Column:
    return F.concat(fixed(c, 1), F.lit("%"))


def pct_or_dash(c: ColumnOrName) -> Column:
    """x.x% or an em dash for a missing value (format_string would print "null")."""
    return F.when(_c(c).isNull(), F.lit(DASH)).otherwise(fmt_pct(c))


def text_or_dash(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(DASH))
