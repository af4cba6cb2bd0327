"""Value conforming as column expressions.

All conversions use the ``try_`` forms so that a bad value becomes NULL (and can be
counted or quarantined) instead of failing the task under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the legacy pre-processing.
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_TEXT_FORMAT = "yyyy-MM-dd"
DATE_TEXT_PATTERN = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}"
PREVIEW_LIMIT = 50      # longer text is shortened ...
PREVIEW_KEEP = 47       # ... to this many characters plus "..."


def _n(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def guid_text(c) -> Column:
    """P10: a uniqueidentifier as its 36-character lower-case text; NULL stays NULL."""
    return F.lower(_n(c).cast("string"))


def nan_to_null(c) -> Column:
    """NaN -> NULL on floating columns."""
    x = _n(c)
    return F.when(~F.isnan(x), x)


def timestamp_text(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (the sub-second part is cut)."""
    return F.date_format(_n(c), TIMESTAMP_TEXT_FORMAT)


def parse_date_text(c) -> Column:
    """Date-like text -> ``yyyy-MM-dd``; unparseable -> NULL.

    Decided per value (quirk Q17), both separators; trailing text is rejected."""
    v = F.trim(_n(c))
    parsed = F.coalesce(
        F.try_to_timestamp(v, F.lit("yyyy-M-d")),
        F.try_to_timestamp(v, F.lit("yyyy/M/d")),
    )
    return F.date_format(parsed, DATE_TEXT_FORMAT)


def looks_like_date(c) -> Column:
    return F.coalesce(F.regexp_like(_n(c), F.lit(DATE_TEXT_PATTERN)), F.lit(False))


def preview_text(c) -> Column:
    """Text over 50 characters -> first 47 + ``...``."""
    s = _n(c).cast("string")
    return F.when(
        F.length(s) > PREVIEW_LIMIT, F.concat(F.substring(s, 1, PREVIEW_KEEP), F.lit("..."))
    ).otherwise(s)


def bad_datetime_text(c) -> Column:
    """D4 predicate: a non-null text value that parses as neither a date nor a timestamp."""
    v = _n(c).cast("string")
    parsed = F.coalesce(
        F.try_to_timestamp(v, F.lit("yyyy-M-d H:m:s")),
        F.try_to_timestamp(v, F.lit("yyyy-M-d H:m:s.SSSSSS")),
        F.try_to_timestamp(v, F.lit("yyyy-M-d")),
        F.try_to_timestamp(v, F.lit("yyyy/M/d")),
    )
    return v.isNotNull() & parsed.isNull()
