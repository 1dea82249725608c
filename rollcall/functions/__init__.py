from rollcall.functions.bands import age_band, risk_band, salary_band
from rollcall.functions.dates import active_at, month_key, months_between_calendar, parse_date
from rollcall.functions.numbers import clamp, exact_mean, is_missing, literal_table, lookup, percent

__all__ = [
    "active_at", "age_band", "clamp", "exact_mean", "is_missing", "literal_table", "lookup", "month_key",
    "months_between_calendar", "parse_date", "percent", "risk_band", "salary_band",
]
