"""Delimited-list handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_trim(c: Column | str, sep: str = ",") -> Column:
    """Split text on a literal separator and trim spaces off each item.

    NULL stays NULL (an ``explode`` then yields no row); the empty string gives one empty item.
    """
    col = F.col(c) if isinstance(c, str) else c
    pattern = "\\Q" + sep + "\\E"
    return F.transform(F.split(col, pattern), lambda x: F.trim(x))
