"""Which names tables and columns may have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that no table name has, and no column name.
_TABLE = r"\x00-\x0f\x7f?,'\"\\\\/:)(+*%~"
_COLUMN = _TABLE + r".\-"
MAX_BYTES = 127


def table_name_ok(name: Column, max_bytes: int = MAX_BYTES) -> Column:
    """Not empty or too long, no forbidden character, no dot at either end."""
    return F.coalesce((F.octet_length(name) <= max_bytes) & name.rlike(f"^[^{_TABLE}]+$") & ~name.rlike(r"^\.|\.$"), F.lit(False))


def column_name_ok(name: Column, max_bytes: int = MAX_BYTES) -> Column:
    return F.coalesce((F.octet_length(name) <= max_bytes) & name.rlike(f"^[^{_COLUMN}]+$"), F.lit(False))


def allowed(kind: Column, version: Column) -> Column:
    """Whether a line of this protocol version can carry a type: arrays from 2, decimals from 3 on."""
    return F.when(kind.startswith("array"), version >= 2).when(kind.startswith("decimal"), version >= 3).otherwise(version >= 1)
