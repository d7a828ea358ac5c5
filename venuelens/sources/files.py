"""File sources and layer writes."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    corrupt_column: str | None = None,
    carry_column: str | None = None,
) -> DataFrame:
    """JSON lines with a declared schema (no inference pass over large files).

    PERMISSIVE mode: a malformed line becomes a row of NULLs; with ``corrupt_column`` its raw
    text is kept in that column for inspection. With ``carry_column`` the fields that the schema
    does not name are kept as well (see :func:`parse_lines`).
    """
    if carry_column is not None:
        return parse_lines(spark.read.text(list(path) if not isinstance(path, str) else path), schema, corrupt_column, carry_column)
    if corrupt_column is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if corrupt_column is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(list(path) if not isinstance(path, str) else path)


def parse_lines(lines: DataFrame, schema: T.StructType, corrupt_column: str | None, carry_column: str) -> DataFrame:
    """Text lines (column ``value``, batch or stream) as declared columns plus ``carry_column``.

    ``carry_column`` maps the name of every field outside ``schema`` to its value as text (nested
    values as JSON); NULL where a record has none. Blank lines are no records.
    """
    options = {"mode": "PERMISSIVE"}
    fields = list(schema.fields)
    if corrupt_column is not None:
        fields.append(T.StructField(corrupt_column, T.StringType(), True))
        options["columnNameOfCorruptRecord"] = corrupt_column
    every = F.from_json("value", T.MapType(T.StringType(), T.StringType()), options)
    other = F.map_filter(every, lambda name, _: ~name.isin(schema.fieldNames()))
    return (
        lines.filter(F.btrim("value", F.lit(" \t\r\n")) != "")
        .select(F.from_json("value", T.StructType(fields), options).alias("__record"), other.alias("__other"))
        .select("__record.*", F.when(F.size("__other") > 0, F.col("__other")).alias(carry_column))
    )


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_layer(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> str:
    """Write a layer (one record per line for JSON; UTF-8 text is written as is)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int, fmt: str = "parquet") -> str:
    """Write a catalog table bucketed and sorted by ``key``, its files at ``path``.

    Rows are laid out by bucket first, so a bucket is one file however many tasks made the rows. Meant
    for frames with few rows a key: a bucketed scan reads each bucket in one task.
    """
    (
        df.repartition(buckets, key).write.format(fmt).mode("overwrite")
        .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    )
    return table


def replace_layer(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Replace the layer kept at ``path`` without a half-written state, and return the new version.

    The rows go to a fresh folder under ``path``; only when all are written does the pointer file
    ``CURRENT`` change, by one rename. A failed write leaves the earlier version in place, and a
    reader always sees one whole version. The version replaced last stays for its readers, older
    ones are removed. The rename goes through the JVM's file system API: classic sessions only.
    """
    spark = df.sparkSession
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).save(f"{path}/{version}")
    before = current_version(spark, path)
    fs, folder = _folder(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(folder, f".CURRENT-{version}")
    out = fs.create(new)
    out.write(bytearray(version.encode()))
    out.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    options[0] = jvm.Options.Rename.OVERWRITE
    context = jvm.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(new, jvm.Path(folder, "CURRENT"), options)
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("v-") and name < version and name != before:
            fs.delete(entry.getPath(), True)
    return version


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version that ``CURRENT`` points at; None where there is none yet."""
    fs, folder = _folder(spark, path)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(folder, "CURRENT")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_replaced(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a layer written by :func:`replace_layer`."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version of the layer at {path}")
    return spark.read.format(fmt).load(f"{path}/{version}")


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder
