"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import NULL_TOKENS, UNKNOWN_TEXT

# The cleaning rule strips what Python's ``str.strip()`` strips: every code
# point for which ``str.isspace()`` holds (TAB, NBSP, the Unicode spaces ...).
# Spark's ``trim`` only removes ASCII spaces, so the set is built from that
# rule and handed to ``btrim`` -- a plain character-set trim, no regex.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip_unicode(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column | str, missing: str = UNKNOWN_TEXT,
               null_tokens: list[str] | None = None) -> Column:
    """Null or null-token -> label, then strip, then empty -> label.

    Null tokens are matched on the raw value before trimming, the way a CSV
    reader recognises them; everything stays a built-in expression.
    """
    c = F.col(c) if isinstance(c, str) else c
    raw = c.cast("string")
    tokens = NULL_TOKENS if null_tokens is None else null_tokens
    is_missing = raw.isNull() | raw.isin(*tokens) if tokens else raw.isNull()
    stripped = strip_unicode(raw)
    return (F.when(is_missing, F.lit(missing))
            .when(stripped == "", F.lit(missing))
            .otherwise(stripped))


def normalize_header(name: str) -> str:
    """header cell -> column name (strip, lower-case).

    A UTF-8 byte-order mark in front of the first header cell is dropped too;
    it is not white space, so stripping alone would keep it in the name.
    """
    return name.lstrip("\ufeff").strip().lower()
