"""Loads into a target: replace, replace with a unique key, insert-if-absent, reconcile.

Targets are file layers (parquet/JSON) or JDBC tables. Each load is one Spark job over the
batch; counts come from an ``Observation`` on the written plan, not from a second scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import write_layer
from ..sources.jdbc import JdbcSpec, read_jdbc, write_jdbc
from ..sources.snapshots import SnapshotStore
from .curation import free_name


class DuplicateKeyError(ValueError):
    """A batch meant for a unique-key target holds the same key more than once."""


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def conform_columns(df: DataFrame, target: T.StructType) -> DataFrame:
    """Project onto the target's column list and types; absent fields load as NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (_q(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present more than once (map-side partial counts, so hot keys stay cheap)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order_by`` (ascending, NULLs first).

    ``row_number() = 1`` over the key: Catalyst plans it with a partial ``WindowGroupLimit``
    before the shuffle, so a key holding a large share of the batch ships at most one row per
    map partition and is never collected whole into one task.
    """
    w = Window.partitionBy(*[_q(k) for k in keys]).orderBy(*[_q(c).asc_nulls_first() for c in order_by])
    number = free_name(df, "number")
    return df.withColumn(number, F.row_number().over(w)).filter(_q(number) == 1).drop(number)


def rows_to_insert(
    batch: DataFrame, target_keys: DataFrame | None, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Insert-if-absent: a key already in the target, or seen earlier in the batch, is ignored.

    Rows with a NULL key are not insertable under a primary key and are left out.
    """
    cond = None
    for k in keys:
        c = _q(k).isNotNull()
        cond = c if cond is None else cond & c
    winners = first_per_key(batch.filter(cond), keys, order_by)
    if target_keys is None:
        return winners
    # duplicate keys on the right cannot change an anti join, so the target keys are not deduplicated
    return winners.join(target_keys.select(*keys), list(keys), "left_anti")


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _null_key(keys: Sequence[str]) -> Column:
    """Whether any part of the key is NULL (such a row cannot be inserted)."""
    null = F.lit(False)
    for k in keys:
        null = null | _q(k).isNull()
    return null


def _path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there. A store that cannot be reached raises: it must not look empty."""
    try:
        context = spark.sparkContext
    except Exception:  # Spark Connect has none: probe by reading
        try:
            spark.read.format("binaryFile").load(path).limit(1).schema  # noqa: B018
            return True
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
    hpath = context._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(context._jsc.hadoopConfiguration()).exists(hpath))


# SQL states and wordings by which databases say that a table is not there.
_NO_TABLE = re.compile(r"\b(42P01|42S02|42X05|3F000)\b|relation .* does not exist|table .* (not found|does(n't| not) exist)", re.I)


def _table_missing(error: Exception) -> bool:
    return bool(_NO_TABLE.search(str(error)))


def _drop_present(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in drop if c in df.columns])


def load_replace(
    df: DataFrame, path: str, fmt: str = "parquet", skip: bool = False, drop: Sequence[str] = ("_id",)
) -> dict:
    """Replace the target with the batch (no uniqueness requirement).

    Columns in ``drop`` (by default a stale document id ``_id``) are removed when present.
    """
    if skip:
        return {"status": "skipped", "rows_written": 0}
    out, obs = _observed(_drop_present(df, drop), "load_replace")
    write_layer(out, path, fmt=fmt, mode="overwrite")
    return {"status": "loaded", "rows_written": obs.get["rows"]}


def load_replace_unique(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    skip: bool = False,
    drop: Sequence[str] = ("_id",),
) -> dict:
    """Replace the target, requiring unique keys; duplicates raise before anything is written."""
    if skip:
        return {"status": "skipped", "rows_written": 0}
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key in batch: {dup[0].asDict()}")
    return load_replace(df, path, fmt, drop=drop)


def load_insert_absent(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    fmt: str = "parquet",
    skip: bool = False,
) -> dict:
    """Append the batch rows whose key is absent from the target file layer (first wins)."""
    if skip:
        return {"status": "skipped", "rows_written": 0}
    spark = batch.sparkSession
    target = spark.read.format(fmt).load(path) if _path_exists(spark, path) else None
    new, obs = _observed(rows_to_insert(batch, target, keys, order_by), "insert_absent")
    write_layer(new, path, fmt=fmt, mode="append")
    return {"status": "loaded", "rows_written": obs.get["rows"]}


def load_insert_absent_jdbc(
    batch: DataFrame, spec: JdbcSpec, keys: Sequence[str], order_by: Sequence[str], skip: bool = False
) -> dict:
    """JDBC form: anti-join against the table's keys, then append.

    Check-then-append is not atomic: concurrent writers can still collide on the key, in which
    case the database's own key constraint rejects the batch.

    The result tells rows read, written and now in the table, and whether the table holds exactly its
    earlier rows plus the written ones with no NULL key left out (``reconciled``).
    """
    if skip:
        return {"status": "skipped", "rows_written": 0}
    spark = batch.sparkSession
    try:
        target = read_jdbc(spark, spec)
        target.schema  # noqa: B018 - resolve now: a missing table raises here
    except Exception as e:  # any other failure (host, password, right) must not look like an empty table
        if not _table_missing(e):
            raise
        target = None
    before = target.count() if target is not None else 0
    obs_in = Observation("insert_absent_jdbc_read")
    src = batch.observe(obs_in, F.count(F.lit(1)).alias("rows"), F.count_if(_null_key(keys)).alias("rejected"))
    new, obs = _observed(rows_to_insert(src, target, keys, order_by), "insert_absent_jdbc")
    write_jdbc(new, spec, mode="append")
    written, in_target = obs.get["rows"], read_jdbc(spark, spec).count()
    return {
        "status": "loaded",
        "rows_read": obs_in.get["rows"],
        "rows_written": written,
        "rows_in_target": in_target,
        "reconciled": before + written == in_target and not obs_in.get["rejected"],
    }


def reconcile_committed(
    batch: DataFrame, store: SnapshotStore, layer: str, keys: Sequence[str] = (), order_by: Sequence[str] = (), batch_id: str | None = None
) -> dict:
    """Load into a layer of ``store`` (replace without ``keys``, insert-if-absent with) and report rows
    read, written and now in the layer; ``reconciled`` as in :func:`load_reconcile`."""
    obs = Observation("reconcile_committed")
    src = batch.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(_null_key(keys)).alias("rejected"))
    before = 0
    if keys:
        target = store.read(layer)
        before = target.count() if target is not None else 0
        res = load_insert_absent_committed(src, store, layer, keys, order_by, batch_id)
    else:
        res = load_replace_committed(src, store, layer)
    seen = obs.get if res["status"] == "loaded" else {"rows": 0, "rejected": 0}
    now = store.read(layer).count()
    good = before + res["rows_written"] == now and not seen["rejected"]
    return {"rows_read": seen["rows"], "rows_written": res["rows_written"], "rows_in_target": now, "reconciled": good}


def load_reconcile(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "replace",
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Load and report rows read, rows written and rows now in the target.

    ``mode="replace"`` overwrites the target; ``mode="insert_absent"`` appends the rows whose
    key is absent (``keys``, first by ``order_by``). Read and written counts are observed on the
    one write job; the target count is taken from the written layer afterwards. ``reconciled``
    says whether the target holds exactly what it should: the batch for a replace, the earlier
    rows plus the written ones for an insert. Rows with a NULL key cannot be inserted; a batch that
    has any is not reconciled. ``rows_read`` is observed below a shuffle and may count rows of a
    rerun stage twice; the other two are not.
    """
    null_key = _null_key(keys if mode == "insert_absent" else ())
    obs_in = Observation("reconcile_read")
    src = batch.observe(obs_in, F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("rejected"))
    before = 0
    if mode == "replace":
        out, obs_out = _observed(src, "reconcile_written")
        write_layer(out, path, fmt=fmt, mode="overwrite")
    elif mode == "insert_absent":
        target = spark.read.format(fmt).load(path) if _path_exists(spark, path) else None
        before = target.count() if target is not None else 0
        out, obs_out = _observed(rows_to_insert(src, target, keys, order_by), "reconcile_written")
        write_layer(out, path, fmt=fmt, mode="append")
    else:
        raise ValueError(f"unknown load mode: {mode}")
    read_n, written_n = obs_in.get["rows"], obs_out.get["rows"]
    in_target = spark.read.format(fmt).load(path).count()
    return spark.createDataFrame(
        [(read_n, written_n, in_target, before + written_n == in_target and not obs_in.get["rejected"])],
        "rows_read bigint, rows_written bigint, rows_in_target bigint, reconciled boolean",
    )


def load_replace_committed(df: DataFrame, store: SnapshotStore, layer: str, drop: Sequence[str] = ("_id",)) -> dict:
    """Replace a layer of ``store`` by one commit: readers see the earlier rows until all are written."""
    out, obs = _observed(_drop_present(df, drop), "load_replace_committed")
    store.replace({layer: store.write(out, layer)})
    return {"status": "loaded", "rows_written": obs.get["rows"]}


def load_insert_absent_committed(
    batch: DataFrame, store: SnapshotStore, layer: str, keys: Sequence[str], order_by: Sequence[str], batch_id: str | None = None
) -> dict:
    """Insert-if-absent that can be repeated and run beside others without a key coming in twice.

    The new rows are written aside and become part of the layer by one commit. A batch whose id the
    layer has taken in before is left alone, so a load that failed halfway or lost its answer is
    simply run again. When another commit came first, the rows written aside are held against what
    that one added (or against the whole layer, if it was replaced) before the next try.
    """
    def present(state) -> bool:
        return batch_id is not None and batch_id in state.batches.get(layer, ())

    spark, state = batch.sparkSession, store.current()
    if present(state):
        return {"status": "present", "rows_written": 0}
    new, obs = _observed(rows_to_insert(batch, store.read(layer, state), keys, order_by), "insert_committed")
    folder = store.write(new, layer)
    rows = obs.get["rows"]
    while not store.claim(state.appended(layer, folder, batch_id)):
        later = store.current()
        if present(later):
            return {"status": "present", "rows_written": 0}
        had, has = state.layers.get(layer, ()), later.layers.get(layer, ())
        added = [f for f in has if f not in had]
        state = later
        if added:
            others = spark.read.format(store.fmt).load(added)
            rest = spark.read.format(store.fmt).load(folder).join(others.select(*keys), list(keys), "left_anti")
            rest, obs = _observed(rest, "insert_committed_again")
            folder = store.write(rest, layer)
            rows = obs.get["rows"]
    return {"status": "loaded", "rows_written": rows}


BUCKET_BYTES = 256 << 20


def buckets_for(batch: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` for a batch, by the bytes of the sources it reads. A batch of
    rows whose size nobody knows (not read from files) needs a stated number: ValueError."""
    leaves = batch._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    if any(s >= 2**62 for s in sizes):
        raise ValueError("the batch's size is not known: say how many buckets the table shall have")
    return max(1, -(-sum(sizes) // bucket_bytes))


def table_buckets(spark: SparkSession, table: str) -> int:
    """The number of buckets of a bucketed catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{table} is not bucketed")
    return int(rows[0]["data_type"])


def load_insert_absent_bucketed(
    batch: DataFrame,
    table: str,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    buckets: int | None = None,
    skip: bool = False,
) -> dict:
    """Insert-if-absent into a catalog table bucketed (and sorted) by the key.

    The target is stored at ``path`` (a shared location) as ``buckets`` hash buckets of the key,
    so the anti join reads it without a shuffle - only the batch is exchanged, into the same
    buckets - and repeated loads into a very large target never re-shuffle it. Appends keep the
    bucketing. Keys are unique, so no bucket is hot; the new rows are laid out by bucket before they
    are written, so each load adds at most one file to a bucket. A table keeps the number of buckets it
    was made with; a new one gets ``buckets``, or as many as the batch's bytes need.
    """
    if skip:
        return {"status": "skipped", "rows_written": 0}
    spark = batch.sparkSession
    exists = spark.catalog.tableExists(table)
    target = spark.table(table) if exists else None
    buckets = table_buckets(spark, table) if exists else buckets or buckets_for(batch)
    new, obs = _observed(rows_to_insert(batch, target, keys, order_by), "insert_absent_bucketed")
    new = new.repartition(buckets, *[_q(k) for k in keys])
    writer = new.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.mode("append" if exists else "errorifexists").saveAsTable(table)
    return {"status": "loaded", "rows_written": obs.get["rows"]}
