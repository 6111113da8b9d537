"""Column expressions shared by the operators. All are built-in Catalyst expressions."""

from tempolake.functions.cohort import CONTROL_USERS, cohort
from tempolake.functions.numeric import (
    duration_sums,
    mean_minutes,
    percent,
    round_div,
    total_hours,
    total_minutes,
)
from tempolake.functions.text import clean_text, trim_all
from tempolake.functions.time import (
    day_of_week,
    event_time,
    quarter_label,
    quarter_ranges,
    quarter_start,
    utc_date,
    utc_hour,
    valid_ms,
    week_of_year,
)

__all__ = [
    "CONTROL_USERS",
    "clean_text",
    "cohort",
    "day_of_week",
    "duration_sums",
    "event_time",
    "mean_minutes",
    "percent",
    "quarter_label",
    "quarter_ranges",
    "quarter_start",
    "round_div",
    "total_hours",
    "total_minutes",
    "trim_all",
    "utc_date",
    "utc_hour",
    "valid_ms",
    "week_of_year",
]
