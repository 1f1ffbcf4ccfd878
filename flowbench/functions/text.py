"""Text columns used in reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Steps of the byte units.
BYTE_UNITS = [(1e3, "KB"), (1e6, "MB"), (1e9, "GB")]


def format_bytes(c: str | Column, digits: int = 1) -> Column:
    """A number of bytes with a unit: 1.23 MB, 45.6 KB; below 1000 whole bytes."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    out = F.concat(F.format_string("%.0f", x), F.lit(" B"))
    for size, unit in BYTE_UNITS:
        y = x / size
        shown = F.when(y < 10, F.format_string(f"%.{digits + 1}f", y)).otherwise(F.format_string(f"%.{digits}f", y))
        out = F.when(x >= size, F.concat(shown, F.lit(" " + unit))).otherwise(out)
    return out


def format_percent(c: str | Column, digits: int = 0) -> Column:
    """A share as percent; a dash for missing values."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit("\u2013")).otherwise(F.concat(F.format_string(f"%.{digits}f", 100 * x), F.lit("%")))


def display_label(c: str | Column, special: dict[str, str] | None = None) -> Column:
    """A class name for people: given spellings first, else capitalised."""
    x = F.col(c) if isinstance(c, str) else c
    out = F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))
    for raw, shown in (special or {}).items():
        out = F.when(x == raw, F.lit(shown)).otherwise(out)
    return out


def log_numbers(c: str | Column, pattern: str) -> Column:
    """All matches of a pattern with one group in a log text."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(x, F.lit(pattern), 1)


def round_or_null(c: str | Column, digits: int = 4) -> Column:
    """Rounded value; NaN and infinity become null."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x) & ~x.isin(float("inf"), float("-inf")), F.round(x, digits))
