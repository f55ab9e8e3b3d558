"""Calendar and clock expressions (F1-F10): all built-in, codegen friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (BAND_ORDER, DAY_NAMES, MONTH_NAMES, TIME_BANDS, UNKNOWN_TIME_KEY,
                         WEEKEND_DAYS)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _labels(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def date_key(d: Column | str) -> Column:
    """date -> smart integer key YYYYMMDD."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(d: Column | str) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return F.weekday(_c(d)) + 1


def month_name(month: Column | str) -> Column:
    """month number 1..12 -> name; anything else -> NULL."""
    return F.try_element_at(_labels(MONTH_NAMES), _c(month).cast("int"))


def day_name(iso_dow: Column | str) -> Column:
    """ISO weekday 1..7 -> name; anything else -> NULL."""
    return F.try_element_at(_labels(DAY_NAMES), _c(iso_dow).cast("int"))


def is_weekend(iso_dow: Column | str) -> Column:
    """membership test on the weekend days."""
    return _c(iso_dow).isin(*WEEKEND_DAYS)


def time_key(hour: Column | str, minute: Column | str) -> Column:
    """HHMM key when both parts are in range, else the unknown key.

    The inputs are expected already coerced (missing -> 0), which is why a
    missing hour lands on midnight and only a present out-of-range value maps
    to the unknown member.
    """
    h, m = _c(hour), _c(minute)
    valid = h.between(0, 23) & m.between(0, 59)
    return F.when(valid, h * 100 + m).otherwise(F.lit(UNKNOWN_TIME_KEY))


def time_text(hour: Column | str, minute: Column | str) -> Column:
    """F8: zero-padded ``HH:MM``."""
    return F.concat(F.lpad(_c(hour).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(_c(minute).cast("string"), 2, "0"))


def time_band(hour: Column | str) -> Column:
    """hour -> band label; the last band takes every remaining hour."""
    h = _c(hour)
    expr = None
    for label, lo, hi in TIME_BANDS[:-1]:
        expr = (F.when(h.between(lo, hi), F.lit(label)) if expr is None
                else expr.when(h.between(lo, hi), F.lit(label)))
    return expr.otherwise(F.lit(TIME_BANDS[-1][0]))


def band_order(band: Column | str) -> Column:
    """Presentation ordinal of a band label; unlisted labels sort last."""
    pos = F.array_position(_labels(BAND_ORDER[:-1]), _c(band))
    return F.when(pos > 0, pos).otherwise(F.lit(len(BAND_ORDER))).cast("int")


def parse_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """calendar date from integer parts; an impossible date gives NULL.

    Year 0, month 0 and 2023-02-29 all come back NULL instead of raising, so
    the invalid-date gate can count them in one pass.
    """
    y, m, d = _c(year), _c(month), _c(day)
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), m.cast("string"), d.cast("string"))
    ok = (y >= 1) & (y <= 9999) & (m >= 1) & (d >= 1)
    return F.when(ok, F.try_to_date(text, "yyyy-M-d"))


__all__ = [
    "date_key", "iso_weekday", "month_name", "day_name", "is_weekend", "time_key",
    "time_text", "time_band", "band_order", "parse_date",
]
