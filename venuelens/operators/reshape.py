"""Reshaping of query results: pivot matrix, bubble scaling, group means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_matrix(
    df: DataFrame,
    row: str,
    column: str,
    value: str,
    column_values: Sequence[int],
    weight: str,
    top_rows: int | None = 20,
    prefix: str = "tier_",
) -> DataFrame:
    """Row x column matrix of mean ``value``; columns are ``column`` cast to int.

    One aggregation: a conditional mean per listed column value (an explicit list, so no
    distinct job) and the row's total ``weight`` side by side. Text that is not an integer
    becomes NULL and falls out. Rows are limited to the ``top_rows`` rows with the largest total
    ``weight`` (ties broken by row key) and returned sorted by row key.
    """
    cells = df.withColumn("__col", F.col(column).try_cast("int")).filter(F.col("__col").isNotNull())
    aggs = [F.avg(F.when(F.col("__col") == v, F.col(value))).alias(f"{prefix}{v}") for v in column_values]
    mat = cells.groupBy(row).agg(*aggs, F.sum(weight).alias("__w"))
    if top_rows is not None:
        mat = mat.orderBy(F.col("__w").desc(), F.col(row).asc()).limit(top_rows)
    return mat.drop("__w").orderBy(row)


def bubble_scale(
    df: DataFrame, measure: str, out: str = "bubble_size", span: float = 800.0, base: float = 50.0
) -> DataFrame:
    """``measure / max(measure) * span + base``.

    The maximum is one aggregated value, put in as a literal, so the frame is never gathered.
    """
    m = F.lit(df.agg(F.max(measure)).first()[0])
    return df.withColumn(out, F.try_divide(F.col(measure).cast("double"), m) * span + base)


def group_means(df: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Mean of each measure per group (``<measure>_mean``)."""
    return df.groupBy(*group).agg(*[F.avg(m).alias(f"{m}_mean") for m in measures])
