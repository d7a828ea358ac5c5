"""Source switch: the same named frames from files, a database or a document store.

A spec is a format + options (+ path / schema) + an optional normaliser applied after loading,
so every query runs unchanged whichever source is active.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass
class SourceSpec:
    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    normalize: Callable[[DataFrame], DataFrame] | None = None
    read: Callable[[SparkSession], DataFrame] | None = None  # in place of format and options


def load_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.read is not None:
        df = spec.read(spark)
    else:
        reader = spark.read.format(spec.format).options(**spec.options)
        if spec.schema is not None:
            reader = reader.schema(spec.schema)
        df = reader.load(spec.path) if spec.path is not None else reader.load()
    return spec.normalize(df) if spec.normalize is not None else df


def load_views(
    spark: SparkSession, specs: Mapping[str, SourceSpec], register: bool = False
) -> dict[str, DataFrame]:
    """Load every named spec lazily; optionally register each as a temp view of that name."""
    frames = {name: load_source(spark, spec) for name, spec in specs.items()}
    if register:
        for name, df in frames.items():
            df.createOrReplaceTempView(name)
    return frames
