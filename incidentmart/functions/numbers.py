"""Numeric coercion, exact rounding and display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A number in decimal notation, with optional sign, fraction and exponent.
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c: Column | str) -> Column:
    """Text -> DOUBLE, NULL when it is not in decimal notation (``'3.7'`` -> 3.7).

    Java's suffixed and hexadecimal forms (``3d``, ``0x1p3``) are not numbers.
    """
    text = F.trim(_c(c).cast("string"))
    return F.when(text.rlike(DECIMAL), text).try_cast("double")


def parse_whole(c: Column | str) -> Column:
    """Text -> BIGINT, truncated toward zero, NULL when it is not a number.

    A whole number is parsed as one, exactly; only a number with a fraction or
    an exponent goes through DOUBLE.
    """
    text = F.trim(_c(c).cast("string"))
    whole = F.when(text.rlike(r"^[+-]?\d+$"), text).try_cast("bigint")
    return F.coalesce(whole, parse_number(text).try_cast("bigint"))


def coerce_int(c: Column | str) -> Column:
    """Parse, NULL -> 0, truncate toward zero.

    ``try_cast('3.7' AS INT)`` is NULL, but the coercion rule keeps the integer
    part (3).
    """
    return F.coalesce(parse_whole(c), F.lit(0).cast("bigint"))


def parse_key(c: Column | str) -> Column:
    """Catalog / join key parse: like ``coerce_int`` but NULL stays NULL."""
    return parse_whole(c)


def exact_ratio(num: Column | str, den: Column | str, scale: int,
                multiplier: int = 1) -> Column:
    """``round(multiplier * num / nullif(den, 0), scale)``.

    Computed in DECIMAL so the result rounds half away from zero exactly,
    like NUMERIC division: the quotient keeps at least 14 fractional digits,
    more than needed to decide the rounding of integer counts.  A zero denominator yields NULL, never an error.
    """
    n = _c(num).cast("decimal(18,0)")
    if multiplier != 1:
        n = n * F.lit(multiplier).cast("decimal(5,0)")
    d = F.nullif(_c(den).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(n / d, scale)


def format_int(c: Column | str) -> Column:
    """F16: integer with thousands separator; NULL -> ``'0'``."""
    return F.coalesce(F.format_number(_c(c).cast("bigint"), 0), F.lit("0"))
