"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steady_round(c: Column, digits: int) -> Column:
    """Round half up on a 9-digit decimal, so that half-way cases do not hang on the last bit of a double."""
    return F.round(c.cast("decimal(38,9)"), digits).cast("double")
