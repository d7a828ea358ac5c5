"""Session helpers.

Library code never builds a session; it only reads settings from the one it is given.
``local_session`` is for tests, the benchmark and the driver contract.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the context), if any."""
    try:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            return d
    except Exception:  # pragma: no cover - no SparkContext on a Spark Connect session
        pass
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # pragma: no cover - conf not readable on some deployments
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only when none is configured.

    A folder of this machine serves a ``local`` master only; on a cluster a missing setting raises.
    """
    d = checkpoint_root(spark)
    if d is None:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        local = tempfile.mkdtemp(prefix="venuelens-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(local)
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - Spark Connect: record it in the session conf
            spark.conf.set("spark.checkpoint.dir", local)
            d = local
    return d


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint folder (never a machine-local temp dir)."""
    root = checkpoint_root(spark)
    if root is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for written tables"
        )
    tail = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    return os.path.join(root, "venuelens", *tail)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of written tables, on whatever file system it lies (classic sessions)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def local_session(cores: int | str = 8, app: str = "venuelens", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks: UI off, AQE on, UTC, partitions ~ cores."""
    parts = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.default.parallelism", parts)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture for DataFrame error messages costs py4j round trips on every
        # DataFrame/Column call; non-interactive runs do not need it
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def materialize(df: DataFrame, count: bool = False):
    """Write ``df`` once as a parquet table under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage where a derived frame feeds several branches of one plan, so the facts behind
    it are scanned once instead of once per branch; the written table survives executor loss.
    The read-back relation carries its real on-disk size for the planner. With ``count=True``
    the row count is observed during the write (no second job) and returned as well.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    if checkpoint_root(spark) is None:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder to write into")
    path = shared_path(spark, "materialized")
    obs = Observation("materialize")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # known schema: no footer inference
    return (out, int(obs.get["rows"])) if count else out


def scale_conf(input_bytes: int, executor_cores_total: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input, sized instead of hard-coded.

    Shuffles start from enough partitions for ~``partition_bytes`` each (at least 3 per core) and
    AQE coalesces small ones at runtime; scans split files at the same size; skewed join
    partitions are split by AQE. Pass the result to ``SparkSession.builder.config(map=...)`` or
    ``spark-submit --conf``; the library itself never sets them.
    """
    parts = max(3 * executor_cores_total, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }
