"""Document-store source (MongoDB Spark connector, format ``mongodb``).

The connector jar comes from the caller's classpath; this module only maps a source spec to
the connector's options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def docstore_options(uri: str, database: str, collection: str, **extra: str) -> dict[str, str]:
    opts = {"connection.uri": uri, "database": database, "collection": collection}
    opts.update(extra)
    return opts


def read_docstore(spark: SparkSession, uri: str, database: str, collection: str, schema=None, **extra) -> DataFrame:
    reader = spark.read.format("mongodb").options(**docstore_options(uri, database, collection, **extra))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def write_docstore(df: DataFrame, uri: str, database: str, collection: str, mode: str = "append", **extra) -> None:
    df.write.format("mongodb").options(**docstore_options(uri, database, collection, **extra)).mode(mode).save()
