"""Scalar expressions: calendar/clock keys, text cleaning, numbers."""

from .calendar import (band_order, date_key, day_name, is_weekend, iso_weekday,
                       month_name, parse_date, time_band, time_key, time_text)
from .numbers import coerce_int, exact_ratio, format_int, parse_key, parse_number, parse_whole
from .text import clean_text, normalize_header, strip_unicode

__all__ = [
    "band_order", "date_key", "day_name", "is_weekend", "iso_weekday", "month_name",
    "parse_date", "time_band", "time_key", "time_text", "coerce_int", "exact_ratio",
    "format_int", "parse_key", "parse_number", "parse_whole", "clean_text", "normalize_header",
    "strip_unicode",
]
