"""Relational sources and sinks over JDBC.

Reads are split by key range into ``num_partitions`` parallel queries (one task per slice)
instead of one task reading a whole table. What is not given is asked of the database: the bounds of a
number key by one ``min/max`` query, even cuts of a text key by one query for its quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession


def tls_url(base_url: str, ca_path: str | None = None, full_check: bool = False) -> str:
    """Append the TLS mode: certificate check when a CA file is given, encryption only otherwise.

    ``full_check`` also verifies the host name (requires ``ca_path``).
    """
    sep = "&" if "?" in base_url else "?"
    if full_check and not ca_path:
        raise ValueError("a full certificate check needs the path of a CA file")
    if ca_path:
        mode = "verify-full" if full_check else "verify-ca"
        return f"{base_url}{sep}sslmode={mode}&sslrootcert={ca_path}"
    return f"{base_url}{sep}sslmode=require"


@dataclass
class JdbcSpec:
    url: str
    table: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    partition_column: str | None = None
    num_partitions: int | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    predicates: tuple[str, ...] = ()
    sample_clause: str = ""  # the database's own sampling clause for quantiles, like TABLESAMPLE SYSTEM (1)
    fetchsize: int = 10_000
    batchsize: int = 10_000
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "fetchsize": str(self.fetchsize), "batchsize": str(self.batchsize)}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver is not None:
            opts["driver"] = self.driver
        opts.update(self.extra)
        return opts


def text_key_predicates(column: str, cuts: Sequence[str]) -> tuple[str, ...]:
    """One predicate per slice of a text key: the ranges between the sorted ``cuts``, NULL keys in the
    first. Every row matches exactly one."""
    quoted = ["'" + c.replace("'", "''") + "'" for c in sorted(set(cuts))]
    if not quoted:
        return ()
    first = f"{column} < {quoted[0]} OR {column} IS NULL"
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:], strict=False)]
    return (first, *inner, f"{column} >= {quoted[-1]}")


def _asked(spark: SparkSession, spec: JdbcSpec, sql: str) -> DataFrame:
    """The answer of the database to a query of its own."""
    return spark.read.format("jdbc").options(**spec.options()).option("dbtable", f"({sql}) q").load()


def cut_query(spec: JdbcSpec) -> str:
    """The least key of each of ``num_partitions`` equal parts of the (sampled) keys, in the database's
    own order of the key, in which its comparisons are made as well."""
    col = spec.partition_column
    part = f"NTILE({spec.num_partitions}) OVER (ORDER BY {col}) AS part"
    keys = f"SELECT {col} AS k, {part} FROM {spec.table} {spec.sample_clause}".rstrip() + f" WHERE {col} IS NOT NULL"
    return f"SELECT MIN(k) AS cut FROM ({keys}) s GROUP BY part"


def key_cuts(spark: SparkSession, spec: JdbcSpec) -> list[str]:
    """Where to cut a text key so that the slices hold about the same number of rows: at most
    ``num_partitions`` - 1 keys, one row each back from the database."""
    return sorted({r["cut"] for r in _asked(spark, spec, cut_query(spec)).collect()})[1:]


def key_bounds(spark: SparkSession, spec: JdbcSpec) -> tuple | None:
    """Min and max of the partition column, computed by the database (one row back)."""
    col = spec.partition_column
    row = _asked(spark, spec, f"SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {spec.table}").first()
    if row is None or row["lo"] is None:
        return None
    return row["lo"], row["hi"]


def read_options(spec: JdbcSpec) -> dict[str, str]:
    """Reader options: the connection and, with a key column and both bounds, its split into ranges."""
    opts = {**spec.options(), "dbtable": spec.table}
    if spec.partition_column and (spec.num_partitions or 0) > 1 and spec.lower_bound is not None and spec.upper_bound is not None:
        opts.update(
            partitionColumn=spec.partition_column,
            lowerBound=str(spec.lower_bound),
            upperBound=str(spec.upper_bound + 1),
            numPartitions=str(spec.num_partitions),
        )
    return opts


def planned(spark: SparkSession, spec: JdbcSpec) -> JdbcSpec:
    """``spec`` with the split that its key column allows, where none is given: predicates between even
    cuts for a text key, bounds for a number key. An empty table is read in one piece."""
    if spec.predicates or not spec.partition_column or (spec.num_partitions or 0) <= 1:
        return spec
    if spec.lower_bound is not None and spec.upper_bound is not None:
        return spec
    bounds = key_bounds(spark, spec)
    if bounds is None:
        return spec
    if isinstance(bounds[0], str):
        return replace(spec, predicates=text_key_predicates(spec.partition_column, key_cuts(spark, spec)))
    return replace(spec, lower_bound=int(bounds[0]), upper_bound=int(bounds[1]))


def read_jdbc(spark: SparkSession, spec: JdbcSpec) -> DataFrame:
    """Read a table: one query per predicate when given, else split by its key as :func:`planned`."""
    spec = planned(spark, spec)
    if spec.predicates:
        options = {k: v for k, v in spec.options().items() if k != "url"}
        return spark.read.jdbc(spec.url, spec.table, predicates=list(spec.predicates), properties=options)
    return spark.read.format("jdbc").options(**read_options(spec)).load()


def write_options(spec: JdbcSpec) -> dict[str, str]:
    """Writer options: the connection options plus, when ``num_partitions`` is set, Spark's cap on
    concurrent connections (the frame is coalesced to at most that many writing tasks)."""
    opts = {**spec.options(), "dbtable": spec.table}
    if spec.num_partitions:
        opts["numPartitions"] = str(spec.num_partitions)
    return opts


def write_jdbc(df: DataFrame, spec: JdbcSpec, mode: str = "append") -> None:
    """Write rows; each task inserts its partition in batches of ``spec.batchsize``, with at most
    ``spec.num_partitions`` tasks (connections) at once."""
    df.write.format("jdbc").options(**write_options(spec)).mode(mode).save()
