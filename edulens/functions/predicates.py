"""Row predicates used by the analyses. NULL inputs evaluate to NULL, so the
row is dropped by ``filter`` exactly as in SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from edulens.functions.cleaning import _col, norm_label


def label_startswith(c, prefix: str) -> Column:
    """``TRIM(UPPER(x)) LIKE 'PREFIX%'``."""
    return norm_label(c).startswith(prefix.upper())


def label_contains(c, word: str) -> Column:
    """``UPPER(x) LIKE '%WORD%'``."""
    return F.upper(_col(c)).contains(word.upper())


def not_like_ci(c, pattern: str) -> Column:
    """Case-insensitive ``x NOT LIKE pattern`` (drops e.g. '... SD' districts
    whatever their case); NULL stays NULL and is dropped."""
    return ~_col(c).ilike(pattern)


def in_values(c, values: Iterable) -> Column:
    return _col(c).isin(list(values))


def positive(c) -> Column:
    """``x IS NOT NULL AND x > 0``; NaN, which sorts above all numbers, is not positive."""
    return (_col(c) > 0) & ~F.isnan(_col(c))


def flag_is(c, value: str = "Y") -> Column:
    return _col(c) == F.lit(value)
