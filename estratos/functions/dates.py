"""Period and calendar expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from estratos.fixed_values import DATE_FORMATS, DAY_NAMES, MID_MONTH_DAY, MONTH_NAMES, MONTH_SHORT_NAMES
from estratos.functions.text import _col


def _word(words: list[str], position: Column) -> Column:
    """The word at a 0-based position, null outside the list."""
    return F.get(F.array(*[F.lit(w) for w in words]), position)


def first_of_month(year: Column | str, month: Column | str) -> Column:
    """PF18. First day of the month; null for a month outside 1..12."""
    return F.try_make_timestamp(
        _col(year), _col(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")


def mid_month(year: Column | str, month: Column | str) -> Column:
    """PF5. Day 15 of the month; null for an impossible month."""
    return F.try_make_timestamp(
        _col(year), _col(month), F.lit(MID_MONTH_DAY), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")


def _swapped(pattern: str) -> str:
    """The same format with day and month in the other order, or itself where the text settles their order."""
    for one, other in (("M/d/", "d/M/"), ("M-d-", "d-M-"), ("d/M/", "M/d/"), ("d-M-", "M-d-")):
        if pattern.startswith(one):
            return other + pattern[len(one):]
    return pattern


_PARTS = {
    "yyyy": "[-+]?[0-9]{4,}", "MMMM": "[^0-9]+", "MMM": "[^0-9]+", "MM": "(?:0[1-9]|1[0-2])", "M": "0*(?:[1-9]|1[0-2])",
    "dd": "(?:0[1-9]|[12][0-9]|3[01])", "d": "0*(?:[1-9]|[12][0-9]|3[01])", "H": "0*(?:1?[0-9]|2[0-3])",
    "mm": "[0-5][0-9]", "ss": "[0-5][0-9]",
}


def _shape(pattern: str) -> str:
    """A regular expression that every text in a date format fits, and few others."""
    pieces = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z]+)", pattern)
    return r"\A" + "".join(re.escape(other) if other else _PARTS[one + more] for one, more, other in pieces) + r"\z"


def _in_format(text: Column, pattern: str) -> Column:
    """The timestamp of a text in a date format, or null.

    A text that does not fit costs an exception, many times what a date costs, so only texts of its shape are tried.
    """
    return F.when(text.rlike(_shape(pattern)), F.try_to_timestamp(text, F.lit(pattern)))


def parse_date(
    c: Column | str, formats: Sequence[str] = DATE_FORMATS, day_first: Column | None = None
) -> Column:
    """PF4. Date of a text in ISO form, or else in the first of `formats` that fits; null when none does.

    A text that fits two formats, such as 03/04/2022, is read by the earlier one, which has the month first, or with the
    day first where `day_first` is true.
    """
    text = F.trim(_col(c).cast("string"))

    def first_that_fits(patterns: Sequence[str]) -> Column:
        return F.coalesce(*[_in_format(text, p).cast("date") for p in patterns])

    others = first_that_fits(formats)
    if day_first is not None:
        others = F.when(day_first, first_that_fits([_swapped(p) for p in formats])).otherwise(others)
    return F.coalesce(_col(c).try_cast("date"), others)


def fits_one_order(c: Column | str, day_first: bool, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """PF4. True for a text that is a date in number form with the day (or the month) first and none the other way."""
    text = F.trim(_col(c).cast("string"))
    starts = ("d/M/", "d-M-"), ("M/d/", "M-d-")

    def fits(prefixes: Sequence[str]) -> Column:
        own = [p for p in formats if p.startswith(prefixes)]
        return F.coalesce(*[_in_format(text, p) for p in own]).isNotNull()

    wanted, other = starts if day_first else starts[::-1]
    return fits(wanted) & ~fits(other)


def period_label(year: Column | str, quarter: Column | str) -> Column:
    """PF19. '2024-Q3'."""
    return F.concat(_col(year).cast("string"), F.lit("-Q"), _col(quarter).cast("string"))


def period_text_date(year: Column | str, month: Column | str) -> Column:
    """PF19. First of month through its text form 'YYYY-MM-01'."""
    text = F.concat_ws(
        "-", F.lpad(_col(year).cast("string"), 4, "0"), F.lpad(_col(month).cast("string"), 2, "0"), F.lit("01")
    )
    return text.try_cast("date")


def month_name(month: Column | str) -> Column:
    """GR2. Full name of a month."""
    return _word(MONTH_NAMES, _col(month) - 1)


def month_short_name(month: Column | str) -> Column:
    """J3. Three-letter name of a month; a look-up by position, so no join is needed."""
    return _word(MONTH_SHORT_NAMES, _col(month) - 1)


def day_name(day_of_week: Column | str) -> Column:
    """GR2. Name of a day numbered from Sunday = 0."""
    return _word(DAY_NAMES, _col(day_of_week))


def season_quarter(month: Column | str) -> Column:
    """GR1. Season label: Q1 is December to February of the same calendar year, Q2 March to May, and so on."""
    return F.concat(F.lit("Q"), ((_col(month) % 12) / 3 + 1).cast("int").cast("string"))
