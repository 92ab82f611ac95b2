from tidemark.functions.paths import last_path_part, month_of_path
from tidemark.functions.times import floor_second, in_month, month_text, seconds_between, year_text

__all__ = [
    "floor_second",
    "in_month",
    "last_path_part",
    "month_of_path",
    "month_text",
    "seconds_between",
    "year_text",
]
