"""Load the curated layers into their targets, as the curation's final step.

* business -> replace, unique ``business_id`` (a stale ``_id`` is dropped)
* checkin, tip -> replace
* user, review -> insert-if-absent on their key, projected to the target column list
  (absent fields load as NULL); the first row per key wins by the given order

Every load is reconciled (rows read, written, now in the target). Targets are file layers
under ``target_dir``; users and reviews can go to JDBC tables, the others to document collections.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import loads
from ..operators.curation import MONTH, YEAR
from ..sources.docstore import read_docstore, write_docstore
from ..sources.jdbc import JdbcSpec
from ..sources.schemas import REVIEW_TARGET, USER_TARGET
from ..sources.snapshots import SnapshotStore, read_layer

REPORT = ("rows_read", "rows_written", "rows_in_target", "reconciled")


def _total_order(first: list[str], target: T.StructType) -> list[str]:
    """``first``, then all other target columns: rows that tie on all of them are equal."""
    return [*first, *(f.name for f in target.fields if f.name not in first)]


# insert-if-absent settings per entity: key, order deciding the first row, target columns
INSERT_ENTITIES = {
    "user": (["user_id"], _total_order(["yelping_since", "name"], USER_TARGET), USER_TARGET),
    "review": (["review_id"], _total_order(["date", "user_id"], REVIEW_TARGET), REVIEW_TARGET),
}


def load_curated(
    spark: SparkSession,
    curated_dir: str,
    target_dir: str,
    fmt: str = "parquet",
    jdbc: Mapping[str, JdbcSpec] | None = None,
    skip: Sequence[str] = (),
    docstore: Mapping[str, Mapping[str, str]] | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Run the five loads; returns one row per entity with its reconciliation.

    File targets are layers of one store under ``target_dir``: each load is one commit, a replaced
    target keeps its earlier rows until then, and an insert can be repeated without a second row per
    key. ``batch_id`` names the run: an entity that has taken it in before is left alone.

    ``docstore`` maps business, checkin or tip to its collection (``uri``, ``database``, ``collection``):
    that entity replaces the collection instead of a file layer.
    """
    store = SnapshotStore(spark, target_dir, fmt)

    def load(name: str) -> tuple:
        if name in skip:
            return (name, "skipped", 0, 0, None, None)
        src = read_layer(spark, curated_dir, name, fmt).drop(YEAR, MONTH)
        if docstore and name in docstore:
            out, counted = loads._observed(loads._drop_present(src, ["_id"]), f"docstore_{name}")
            write_docstore(out, mode="overwrite", **docstore[name])
            written, in_target = counted.get["rows"], read_docstore(spark, **docstore[name]).count()
            return (name, "replace", written, written, in_target, written == in_target)
        if name in ("business", "checkin", "tip"):
            res = loads.reconcile_committed(loads._drop_present(src, ["_id"]), store, name)
            return (name, "replace", *[res[c] for c in REPORT])
        keys, order, target = INSERT_ENTITIES[name]
        batch = loads.conform_columns(src, target)
        if jdbc and name in jdbc:
            res = loads.load_insert_absent_jdbc(batch, jdbc[name], keys, order)
            return (name, "insert_absent", *[res[c] for c in REPORT])
        res = loads.reconcile_committed(batch, store, name, keys, order, batch_id)
        return (name, "insert_absent", *[res[c] for c in REPORT])

    names = ("business", "checkin", "tip", "user", "review")
    if "business" not in skip:  # a unique-key target: reject duplicates before any load starts
        src = read_layer(spark, curated_dir, "business", fmt)
        dup = loads.duplicate_keys(src, ["business_id"]).limit(1).collect()
        if dup:
            raise loads.DuplicateKeyError(f"duplicate key in batch: {dup[0].asDict()}")
    # the five targets are independent: their jobs are submitted together and overlap
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        rows = list(pool.map(load, names))
    store.expire(2 * len(names))  # the commits of this run and of the one before stay readable
    return spark.createDataFrame(
        rows,
        "entity string, mode string, rows_read bigint, rows_written bigint, rows_in_target bigint, reconciled boolean",
    ).withColumn("rows_ignored", F.col("rows_read") - F.col("rows_written"))
