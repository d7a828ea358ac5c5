"""Layer and step reports, computed by Spark from the written layers themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .loads import _path_exists


def layer_report(spark: SparkSession, layers: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Per layer: records, files and MB (10^6 bytes) from the files' metadata, plus a TOTAL row.

    Missing layers are skipped. Rows are counted per file with map-side partial counts (JSON-lines
    layers are read as text lines, not parsed); sizes come from ``_metadata.file_size`` once per
    file.
    """
    parts = []
    for name, path in layers.items():
        if not _path_exists(spark, path):
            continue
        # JSON lines: one record per line, so count lines as text (no JSON parsing)
        reader = spark.read.format("text") if fmt == "json" else spark.read.format(fmt)
        df = reader.load(path).select(
            F.lit(name).alias("layer"),
            F.col("_metadata.file_path").alias("__f"),
            F.col("_metadata.file_size").alias("__sz"),
        )
        per_file = df.groupBy("layer", "__f").agg(
            F.count(F.lit(1)).alias("__rows"), F.max("__sz").alias("__sz")
        )
        parts.append(per_file)
        # an existing layer without rows is reported too
        parts.append(spark.createDataFrame([(name, None, 0, 0)], "layer string, __f string, __rows bigint, __sz bigint"))
    if not parts:
        return spark.createDataFrame([], "layer string, records bigint, files bigint, mb double")
    allf = parts[0]
    for p in parts[1:]:
        allf = allf.unionByName(p)
    rolled = allf.rollup("layer").agg(
        F.sum("__rows").cast("bigint").alias("records"),
        F.count("__f").cast("bigint").alias("files"),
        F.round(F.sum("__sz") / F.lit(1e6), 3).alias("mb"),
    )
    return rolled.select(F.coalesce("layer", F.lit("TOTAL")).alias("layer"), "records", "files", "mb")


def size_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """MB before and after per layer (e.g. raw vs trimmed) with the % change; a layer on one side only
    has NULL on the other."""
    b = before.select("layer", F.col("mb").alias("mb_before"))
    a = after.select("layer", F.col("mb").alias("mb_after"))
    return b.join(a, "layer", "full").withColumn(
        "pct_change", F.round(F.try_divide(F.col("mb_after") - F.col("mb_before"), F.col("mb_before")) * 100, 1)
    )


class StepCounter:
    """Counts rows entering and leaving a step inside the job that writes its output."""

    def __init__(self, step: str):
        self.step = step
        self._in = Observation(f"{step}_in")
        self._out = Observation(f"{step}_out")

    def input(self, df: DataFrame) -> DataFrame:
        return df.observe(self._in, F.count(F.lit(1)).alias("rows"))

    def output(self, df: DataFrame) -> DataFrame:
        return df.observe(self._out, F.count(F.lit(1)).alias("rows"))

    def row(self) -> tuple[str, int, int]:
        return (self.step, int(self._in.get["rows"]), int(self._out.get["rows"]))


def step_summary(spark: SparkSession, counters: Sequence[StepCounter]) -> DataFrame:
    """One row per step: rows read and rows written (read after the writing jobs ran)."""
    return spark.createDataFrame(
        [c.row() for c in counters], "step string, rows_read bigint, rows_written bigint"
    ).withColumn("rows_dropped", F.col("rows_read") - F.col("rows_written"))
