"""Time-zone-independent conversions between wall-clock ``timestamp_ntz``
values and UTC instants (``timestamp``). Watermarks need ``timestamp``;
these keep window boundaries aligned to UTC whatever the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
_EPOCH_UTC = "timestamp'1970-01-01 00:00:00 UTC'"


def ntz_as_utc(col: str | Column) -> Column:
    """Read a wall-clock value as a UTC instant."""
    c = F.col(col) if isinstance(col, str) else col
    return F.expr(_EPOCH_UTC) + (c - F.expr(_EPOCH_NTZ))


def utc_as_ntz(col: str | Column) -> Column:
    """UTC wall clock of an instant, as ``timestamp_ntz``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.expr(_EPOCH_NTZ) + (c - F.expr(_EPOCH_UTC))


def utc_text(col: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of an instant in UTC."""
    return F.date_format(utc_as_ntz(col), "yyyy-MM-dd HH:mm:ss")
