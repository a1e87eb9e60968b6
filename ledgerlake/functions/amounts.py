"""Money types and arithmetic in which a blank (null) acts as zero in sums."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .dates import _col

MONEY = "decimal(18,2)"
RATE4 = "decimal(7,4)"
FTP4 = "decimal(9,4)"
PROB6 = "decimal(9,6)"
# Mart totals get more digits than a row amount, so that a group of any size fits.
TOTAL = "decimal(28,2)"
TOTAL4 = "decimal(34,4)"


def money(c) -> Column:
    return _col(c).cast(MONEY)


def ratio(num, den) -> Column:
    """num / den as double; a blank or zero denominator gives blank."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def plus(*terms) -> Column:
    """Sum in which blanks count as zero; blank only if every term is blank."""
    cols = [_col(t) for t in terms]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])
    return F.when(F.coalesce(*cols).isNotNull(), total)


def minus(first, *rest) -> Column:
    """first - rest..., blanks as zero; blank only if every operand is blank."""
    return plus(first, *[-_col(r) for r in rest])


def smaller(a, b) -> Column:
    """Minimum of two scalars with blank as zero; blank if both are."""
    a, b = _col(a), _col(b)
    both = F.least(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0)))
    return F.when(F.coalesce(a, b).isNotNull(), both)


def larger(a, b) -> Column:
    a, b = _col(a), _col(b)
    both = F.greatest(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0)))
    return F.when(F.coalesce(a, b).isNotNull(), both)


def repair_sign(amount, product, products) -> Column:
    """Absolute value for a negative amount of one of the listed products."""
    amount = _col(amount)
    return F.when((amount < 0) & _col(product).isin(*products), -amount).otherwise(amount)


def impute_stage(stage, bucket, days_past_due) -> Column:
    """A missing stage follows from arrears: 90+ is 3, thirty days or more is 2, else 1."""
    return F.coalesce(
        _col(stage).cast("int"),
        F.when(_col(bucket) == "90+", 3).when(_col(days_past_due) >= 30, 2).otherwise(1),
    )


def spread_point(lat, lon, key) -> tuple[Column, Column]:
    """Deterministic small offsets, so that points of one town do not cover each other."""
    key = _col(key).cast("bigint")
    dlat = (F.pmod(key, F.lit(7)) - 3) * F.lit(0.035)
    dlon = (F.pmod(F.floor(key / 7), F.lit(7)) - 3) * F.lit(0.055)
    return _col(lat).cast("double") + dlat, _col(lon).cast("double") + dlon


def fixed(c, digits: int) -> Column:
    """Number as text with `digits` decimals and no grouping, halves away from zero."""
    return F.round(_col(c).cast("double"), digits).cast(f"decimal(30,{digits})").cast("string")


def number_text(c, fmt: str) -> Column:
    """Text of a number in one of the report formats: '0', '0.0', '0.00', '0.0%', '#,0'."""
    c = _col(c)
    if fmt.endswith("%"):
        return F.concat(fixed(c * 100, fmt[:-1].count("0") - 1), F.lit("%"))
    if fmt.startswith("#,"):
        return F.format_number(F.round(c.cast("double"), 0), 0)
    return fixed(c, fmt.count("0") - 1)
