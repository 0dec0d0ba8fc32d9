"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estratos.fixed_values import SPACES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: Column | str) -> Column:
    """Trim every Unicode space separator, not only U+0020.

    The slower trim by a set of characters is left to texts that are not plain ASCII.
    """
    trimmed = F.trim(_col(c))
    wide = F.octet_length(trimmed) > F.length(trimmed)
    return F.when(wide, F.btrim(trimmed, F.lit(SPACES))).otherwise(trimmed)


def title_case(c: Column | str) -> Column:
    """PF10. Null becomes '', outer spaces go, each space-separated word gets one capital and lower case."""
    return F.initcap(trim_spaces(F.coalesce(_col(c), F.lit(""))))


def blank(c: Column | str) -> Column:
    """True for null and for text of spaces only."""
    return F.coalesce(trim_spaces(c), F.lit("")) == ""
