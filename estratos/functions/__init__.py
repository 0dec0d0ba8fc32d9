"""Column functions: each takes Columns (or names) and returns a Column, all inside code generation."""

from estratos.functions.dates import (  # noqa: F401
    day_name, first_of_month, fits_one_order, mid_month, month_name, month_short_name, parse_date, period_label,
    period_text_date, season_quarter,
)
from estratos.functions.keys import surrogate_key  # noqa: F401
from estratos.functions.numeric import (  # noqa: F401
    clamp, exact_avg, exact_sum, guarded_pct, lenient_double, lenient_int, rounded_int, scaled, settled_avg,
)
from estratos.functions.text import blank, title_case, trim_spaces  # noqa: F401
