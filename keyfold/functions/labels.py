"""Readable labels for byte counts and durations, as column expressions.

Exact integer arithmetic (div/mod on whole decimals), units with a zero left out,
plural ``s`` above 1, largest unit first, the last unit unbounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names and radices, smallest unit first; None = unbounded.
BYTE_UNITS = (("byte", 1024), ("kilobyte", 1024), ("megabyte", 1024), ("gigabyte", None))
TIME_UNITS = (("millisecond", 1000), ("second", 60), ("minute", 60), ("hour", 24), ("day", None))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unit_label(value, units: Sequence[tuple[str, int | None]]) -> Column:
    """Mixed-radix label of a non-negative whole number."""
    v = _c(value).cast("decimal(38,0)")
    parts, scale = [], 1
    for name, radix in units:
        # exact integer division: v - (v mod scale) is a multiple of scale
        q = ((v - F.pmod(v, F.lit(scale))) / F.lit(scale)).cast("decimal(38,0)") if scale > 1 else v
        if radix is not None:
            q = F.pmod(q, F.lit(radix))
        q = q.cast("decimal(38,0)")
        parts.append(F.when(q > 0, F.concat(q.cast("string"), F.lit(" " + name),
                                           F.when(q > 1, F.lit("s")).otherwise(F.lit("")))))
        if radix is not None:
            scale *= radix
    return F.concat_ws(" ", *reversed(parts))


def bytes_label(value) -> Column:
    return unit_label(value, BYTE_UNITS)


def time_label(seconds) -> Column:
    """Label of a duration in seconds, on whole milliseconds."""
    return unit_label(F.round(_c(seconds) * 1000), TIME_UNITS)


def duration_seconds(start, end) -> Column:
    """Seconds between two timestamps, microsecond-exact, as a double."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)
