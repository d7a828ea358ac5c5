"""Structured Streaming form of the curation.

Every curation step is row-local or a semi join against an entity set, so it runs unchanged
on a file stream: new JSON-lines files of one entity are read with the declared schema,
curated, and appended to the curated layer. The sampled-entity set is a static frame (a
stream-static left semi join); the file source and the parquet sink together with the
checkpoint in the shared folder give exactly-once output across restarts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.curate import CurationParams, curate
from ..session import materialize, shared_path
from ..sources.files import parse_lines, replace_layer
from ..sources.schemas import CARRIED, ENTITY_SCHEMAS


def stream_files(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
    carry_column: str | None = None,
) -> DataFrame:
    """``transform`` applied to a file stream read with a declared schema (no inference).

    JSON lines that do not parse are dropped before the transform (never passed on as rows of
    NULLs). With ``carry_column`` (JSON only) the fields the schema does not name are kept in it.
    """
    corrupt = "_corrupt_record"
    carry = carry_column is not None and fmt == "json"
    if fmt == "json" and not carry:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType(), True)])
    reader = spark.readStream.format("text" if carry else fmt)
    if not carry:
        reader = reader.schema(schema)
        if fmt == "json":
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_dir)
    if carry:
        stream = parse_lines(stream, schema, corrupt, carry_column)
    if fmt == "json":
        stream = stream.filter(F.col(corrupt).isNull()).drop(corrupt)
    return transform(stream)


def append_to_layer(
    spark: SparkSession,
    df: DataFrame,
    out_dir: str,
    checkpoint: str | None = None,
    name: str = "stream",
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Append a streaming frame to a parquet layer; checkpoint under ``spark.checkpoint.dir``."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint or shared_path(spark, "stream", name))
        .outputMode("append")
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def curate_stream(
    spark: SparkSession,
    entity: str,
    source_dir: str,
    users: DataFrame | None = None,
    p: CurationParams = CurationParams(),
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming frame of curated ``entity`` rows from files landing in ``source_dir``.

    ``users`` is the raw user frame (static) for the referential filter of reviews and tips. Its
    sampled keys are written once when the stream is defined, so each micro-batch joins against
    that small table instead of re-reading and re-sampling all users (sampling again inside the
    curation is idempotent: the same key-hash predicate).
    """
    keys = None
    if users is not None and entity != "user":
        keys = materialize(curate({"user": users}, p)["user"].select("user_id"))

    def transform(stream: DataFrame) -> DataFrame:
        raw = {entity: stream}
        if keys is not None:
            raw["user"] = keys
        return curate(raw, p)[entity]

    return stream_files(spark, source_dir, ENTITY_SCHEMAS[entity], transform, "json", max_files_per_trigger, CARRIED)


def start_curation_stream(
    spark: SparkSession,
    entity: str,
    source_dir: str,
    out_dir: str,
    users: DataFrame | None = None,
    p: CurationParams = CurationParams(),
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start appending curated rows to ``out_dir`` (parquet). The query's checkpoint defaults to
    a folder under ``spark.checkpoint.dir``."""
    df = curate_stream(spark, entity, source_dir, users, p)
    return append_to_layer(spark, df, out_dir, checkpoint, entity, available_now, processing_time)


def start_visit_cube_stream(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    p: CurationParams = CurationParams(),
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Keep the visit cube (visits per venue and day part) current as packed visit files arrive.

    Each file is curated (packed-stamp filter), expanded and counted into streaming state keyed
    by (venue, day part) - state is bounded by the venue dimension, not by the visits. Every
    micro-batch replaces the cube kept at ``out_dir`` by a whole new version, so a replayed batch
    writes the same result again and a reader (``read_replaced``) never meets an empty folder; the
    questions read it through their ``visits_by_part`` argument.
    """
    from ..operators.curation import expand_visits
    from ..plans.venue_queries import visit_cube

    def transform(stream: DataFrame) -> DataFrame:
        return visit_cube(expand_visits(curate({"checkin": stream}, p)["checkin"]))

    cube = stream_files(spark, source_dir, ENTITY_SCHEMAS["checkin"], transform, "json")

    def write(batch: DataFrame, epoch_id: int) -> None:
        replace_layer(batch, out_dir)

    writer = (
        cube.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint or shared_path(spark, "stream", "visit_cube"))
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
