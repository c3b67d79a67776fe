"""Text-to-number cleaning that is safe under ANSI mode.

Published education tables store counts as text: thousands commas ('1,234'),
suppression markers ('s'), blanks, decimals in counts ('12.7'). A plain
``CAST`` raises ``CAST_INVALID_INPUT`` under ANSI, so every parse goes through
``try_cast`` and yields NULL for anything that is not a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Decimal numbers; a cast alone would also take 'NaN', 'Infinity', '5d' and '5f'.
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _numeric_text(c) -> Column:
    """trim, drop thousands commas; anything but a decimal number -> NULL."""
    text = F.replace(F.trim(_col(c)), F.lit(","), F.lit(""))
    return F.when(text.rlike(_DECIMAL), text)


def clean_real(c) -> Column:
    """Text to double: ``'1,234'`` -> 1234.0, ``'s'``/``''`` -> NULL."""
    return _numeric_text(c).try_cast("double")


def clean_int(c) -> Column:
    """Text to integer count, truncating decimals: ``'12.7'`` -> 12."""
    return clean_real(c).try_cast("bigint")


def to_number(df: DataFrame, name: str, integral: bool = False) -> Column:
    """Clean ``name`` according to its type in ``df``: text goes through the
    comma/suppression cleaning, numeric columns are only cast."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, StringType):
        return clean_int(name) if integral else clean_real(name)
    if isinstance(dtype, NumericType):
        out = F.col(name).try_cast("double")
        return out.try_cast("bigint") if integral else out
    return F.col(name).cast("string").try_cast("bigint" if integral else "double")


def is_digit_text(c) -> Column:
    """True when the text is digits with optional ``_`` or ``,`` separators."""
    s = F.trim(F.regexp_replace(_col(c).cast("string"), "[_,]", ""))
    return s.rlike("^[0-9]+$")


def clean_digit_text(c) -> Column:
    """Digit text with ``_`` or ``,`` separators to bigint; anything else NULL."""
    s = F.trim(F.regexp_replace(_col(c).cast("string"), "[_,]", ""))
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("bigint"))


def year_int(c) -> Column:
    """Normalize a year stored as 2024.0, 2024 or '2024' to int."""
    return _col(c).cast("string").try_cast("double").try_cast("int")


def year_of(df: DataFrame, name: str) -> Column:
    """:func:`year_int` for column ``name`` of ``df``, without the text round
    trip when the column is already numeric."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, NumericType):
        return F.col(name).try_cast("int")
    return year_int(name)


def year_equals(df: DataFrame, name: str, year: int | Column) -> Column:
    """``year_of(df, name) = year`` (a number or a scalar subquery). For a numeric column the equivalent range
    ``year <= col < year + 1`` is added, a predicate Parquet can use to skip
    row groups (the truncating cast alone cannot be pushed to the scan)."""
    year = year if isinstance(year, Column) else F.lit(int(year))
    eq = year_of(df, name) == year
    if isinstance(df.schema[name].dataType, NumericType):
        return (F.col(name) >= year) & (F.col(name) < year + 1) & eq
    return eq


def norm_label(c) -> Column:
    """Upper-case, trimmed label for prefix/contains matching."""
    return F.upper(F.trim(_col(c)))
