"""Table-name conversion as column expressions (P4-P8, X3 helper).

Source names are ``schema.table`` (optionally bracket-quoted); the target has no schema
level, so the name is flattened to ``schema_table``. Blank input never raises: it yields
NULL (or ``valid = false``) so that one bad name cannot abort a whole run (quirk Q4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a valid target name is letters, decimal digits and underscore.
VALID_NAME_PATTERN = r"^[\p{L}\p{Nd}_]+\z"


def _n(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def is_blank(name) -> Column:
    n = _n(name)
    return n.isNull() | F.regexp_like(n, F.lit(r"^\s*$"))


def strip_brackets(name) -> Column:
    return F.regexp_replace(_n(name), r"[\[\]]", "")


def is_valid_target_name(name) -> Column:
    """Non-empty and every character a letter, digit or ``_``."""
    n = _n(name)
    return F.coalesce(F.regexp_like(n, F.lit(VALID_NAME_PATTERN)), F.lit(False))


def target_table_name(name) -> Column:
    """Strip brackets, ``.`` -> ``_``; NULL when blank or when the result is invalid."""
    converted = F.replace(strip_brackets(name), F.lit("."), F.lit("_"))
    return F.when(~is_blank(name) & is_valid_target_name(converted), converted)


def target_name_error(name) -> Column:
    """Why :func:`target_table_name` returned NULL (NULL when it did not)."""
    converted = F.replace(strip_brackets(name), F.lit("."), F.lit("_"))
    return (
        F.when(is_blank(name), F.lit("blank table name"))
        .when(~is_valid_target_name(converted), F.concat(F.lit("invalid target name: "), converted))
    )


def source_table_name(name) -> Column:
    """P5: every ``_`` back to ``.`` (lossy); NULL when blank."""
    return F.when(~is_blank(name), F.replace(_n(name), F.lit("_"), F.lit(".")))


def _last_dot(s: Column) -> Column:
    """0-based index of the last ``.``; -1 when absent."""
    pos_from_end = F.instr(F.reverse(s), ".")
    return F.when(pos_from_end > 0, F.length(s) - pos_from_end).otherwise(F.lit(-1))


def schema_part(name) -> Column:
    """Text before the last dot when that dot is not the first character, else NULL."""
    s = strip_brackets(name)
    i = _last_dot(s)
    return F.when(~is_blank(name) & (i > 0), F.substring(s, F.lit(1), i))


def table_part(name) -> Column:
    """Text after the last dot unless the dot is last; else the whole (unbracketed) name."""
    s = strip_brackets(name)
    i = _last_dot(s)
    after = F.substring(s, i + 2, F.length(s))
    return F.when(is_blank(name), F.lit(None).cast("string")).when(
        (i >= 0) & (i < F.length(s) - 1), after
    ).otherwise(s)
