"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estratos.fixed_values import KEY_NULL
from estratos.functions.text import _col


def surrogate_key(*cols: Column | str) -> Column:
    """PF16. MD5 of the columns' texts joined by '-', nulls replaced by a fixed word.

    For integers, dates and text only: the text of a double depends on the engine.
    """
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in cols]))
