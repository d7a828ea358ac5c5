"""Join helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_with_defaults(
    left: DataFrame, right: DataFrame, on: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left join; unmatched rows get ``defaults`` (a literal, or the name of a left column).

    ``right`` is expected to be unique on ``on`` (e.g. an aggregate), so the join never
    multiplies left rows.
    """
    joined = left.join(right, list(on), "left")
    for col, default in defaults.items():
        d = F.col(default) if isinstance(default, str) and default in left.columns else F.lit(default)
        joined = joined.withColumn(col, F.coalesce(F.col(col), d))
    return joined
