from patronlens.functions.dates import is_month_day, month_day_to_date
from patronlens.functions.numbers import average_span, ratio
from patronlens.functions.profile import fill_profile

__all__ = ["average_span", "fill_profile", "is_month_day", "month_day_to_date", "ratio"]
