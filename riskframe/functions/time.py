"""Time-zone independent epoch arithmetic on TIMESTAMP_NTZ columns.

``timestampdiff`` on NTZ values never consults the session zone, so these
agree with DuckDB ``epoch_us`` / ``date_diff`` whatever the cluster's zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970-01-01 (floor for instants after the epoch)."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), _ntz(c))


def epoch_micros(c: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _ntz(c))


def hours_between(start: Column, end: Column) -> Column:
    """FUN-13: fractional hours from ``start`` to ``end`` (microsecond exact)."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(3.6e9)


def iso_text(c: Column) -> Column:
    """FUN-18: ISO-8601 text of a timestamp (microseconds kept)."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
