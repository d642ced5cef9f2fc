"""Time axis helpers: offsets are whole minutes from unit admission."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# sorts before every 32-bit offset
BEFORE_ALL_MINUTES = -(2**40)


def hour_of(offset: Column) -> Column:
    """Hour ``h`` holds the minutes ``60(h-1) < m <= 60h``."""
    return F.ceil(offset / F.lit(60)).cast("int")


def minute_key(offset: Column) -> Column:
    """Offset as a join and sort key; an unknown offset sorts first and equals itself."""
    return F.coalesce(offset.cast("long"), F.lit(BEFORE_ALL_MINUTES))
