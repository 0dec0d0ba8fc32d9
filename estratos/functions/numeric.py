"""Number parsing, rounding and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estratos.functions.text import _col

# Plain decimal or scientific notation. `try_cast` alone would also take Java forms such as '1d'.
_NUMBER = r"^\s*[-+]?[0-9.][0-9.]*([eE][-+]?[0-9]+)?\s*$"


def _parsed(c: Column | str, is_text: bool) -> Column:
    c = _col(c)
    if is_text:
        c = F.when(c.rlike(_NUMBER), c).try_cast("double")
    else:
        c = c.cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def lenient_double(c: Column | str, default: float | None, is_text: bool = True) -> Column:
    """PF3. Unparseable, missing or NaN values become `default`."""
    value = _parsed(c, is_text)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def lenient_int(c: Column | str, default: int | None, is_text: bool = True, kind: str = "int") -> Column:
    """PF3. As `lenient_double`, then cut towards zero; values outside the integer type become `default`."""
    value = _parsed(c, is_text).try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(int(default)).cast(kind))


def rounded_int(c: Column | str, kind: str = "int") -> Column:
    """PF10. Cast to an integer rounding halves to the even neighbour, from a number or a numeric text."""
    return F.rint(_col(c).cast("double")).cast(kind)


def clamp(c: Column | str, low: float, high: float, preserve_null: bool = False) -> Column:
    """PF6. Force into [low, high]. By default a null becomes `low`, because `greatest` skips nulls."""
    c = _col(c)
    forced = F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high)))
    return F.when(c.isNotNull(), forced) if preserve_null else forced


def guarded_pct(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    """PF15. 100 * num / den rounded, and 0 where `den` is not positive or null."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, F.round(num.cast("double") / den * 100, digits)).otherwise(F.lit(0.0))


def exact_sum(c: Column | str, digits: int) -> Column:
    """Sum of a double column whose values are rounded to `digits`, as a double.

    It is taken in decimals, so it does not depend on the order in which partitions are added up; a sum of
    doubles does in its last bits, which a later rounding can turn into a different number.
    """
    return F.sum(_col(c).cast(f"decimal(18, {digits})")).cast("double")


def exact_avg(c: Column | str, digits: int) -> Column:
    """Average of a double column whose values are rounded to `digits`, independent of the order."""
    return exact_sum(c, digits) / F.count(_col(c))


def settled_avg(c: Column | str, digits: int = 6) -> Column:
    """Average of unrounded doubles from their sum settled to `digits`, which drops the noise of addition."""
    return F.round(F.sum(_col(c)), digits) / F.count(_col(c))


def scaled(c: Column | str, unit: float, digits: int = 1) -> Column:
    """PF20. Value in multiples of `unit`, rounded."""
    return F.round(_col(c) / F.lit(float(unit)), digits)
