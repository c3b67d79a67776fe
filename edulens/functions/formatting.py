"""Output formatting and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from edulens.functions.cleaning import _col

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def fixed6(c) -> Column:
    """Six decimals, blank for NULL/NaN (``format_string`` alone prints 'null')."""
    x = _col(c).cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x), F.format_string("%.6f", x)).otherwise(F.lit(""))


def now_text() -> Column:
    """Current time as 'yyyy-MM-dd HH:mm:ss' text (second resolution)."""
    return F.date_format(F.current_timestamp(), TS_FORMAT)


def parse_ts(c) -> Column:
    """Text timestamp to timestamp; unparsable text gives NULL."""
    return F.try_to_timestamp(_col(c).cast("string"))
