"""Bindings for sources, loads and reports. Written tables go under ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import curation as cur
from ..operators import loads
from ..operators.reports import StepCounter, layer_report, size_delta, step_summary
from ..session import materialize, shared_path
from ..sources.files import read_json_lines, write_layer, read_replaced, replace_layer
from ..sources.snapshots import SnapshotStore
from ..sources.switch import SourceSpec, load_views
from . import venue_queries as vq
from .bindings import (
    _SAMPLED_CUSTOMERS_SQL,
    BIND_PARAMS,
    ENTITY_FRACTION,
    ENTITY_SALT,
    FACT_FRACTION,
    FACT_SALT,
    ORACLE_SQL,
    _hash_sql,
    register,
    table,
)
from .curate import CurationParams, curate_facts

CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
NATION = T.StructType(
    [
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]
)


def _json_copy(spark, d, name, schema, key):
    path = shared_path(spark, "bind", key, name)
    write_layer(table(spark, d, name), path, fmt="json")
    return path, schema


@register("scan_json", "SELECT * FROM customer")
def q_scan_json(spark, d):
    path, schema = _json_copy(spark, d, "customer", CUSTOMER, "scan_json")
    return read_json_lines(spark, path, schema)


@register("write_layer", "SELECT * FROM customer")
def q_write_layer(spark, d):
    path = shared_path(spark, "bind", "write_layer")
    write_layer(table(spark, d, "customer"), path, partition_by=["c_mktsegment"])
    return spark.read.parquet(path).select(*CUSTOMER.fieldNames())


@register(
    "conform_columns",
    "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_phone, c_acctbal, "
    "CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer",
)
def q_conform_columns(spark, d):
    target = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_phone", T.StringType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_nationkey", T.LongType()),
        ]
    )
    return loads.conform_columns(table(spark, d, "customer"), target)


@register("source_switch", ORACLE_SQL["market_opportunity"])
def q_source_switch(spark, d):
    """The opportunity question over JSON-lines copies loaded through source specs."""
    specs = {}
    for name, schema in (("customer", CUSTOMER), ("orders", ORDERS), ("nation", NATION)):
        path, _ = _json_copy(spark, d, name, schema, "source_switch")
        specs[name] = SourceSpec("json", path, schema=schema)
    views = load_views(spark, specs)
    orders_per = views["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("__orders"))
    c, n = views["customer"], views["nation"]
    venues = (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(orders_per, c.c_custkey == orders_per.o_custkey, "left")
        .select(
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("state"),
            F.col("c_acctbal").alias("stars"),
            F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("is_open"),
            F.coalesce("__orders", F.lit(0)).cast("bigint").alias("review_count"),
        )
    )
    return vq.market_opportunity(venues, min_venues=10, top_k=20)


@register("load_replace", "SELECT * FROM part")
def q_load_replace(spark, d):
    path = shared_path(spark, "bind", "load_replace")
    part = table(spark, d, "part")
    loads.load_replace(part.filter(F.col("p_size") > 25), path)  # an earlier load ...
    loads.load_replace(part, path)  # ... fully replaced by the next one
    return spark.read.parquet(path)


@register("replace_layer", "SELECT * FROM part")
def q_replace_layer(spark, d):
    path = shared_path(spark, "bind", "replace_layer")
    part = table(spark, d, "part")
    replace_layer(part.filter(F.col("p_size") > 25), path)
    try:  # a load that fails in its tasks leaves the version before it in place ...
        replace_layer(part.withColumn("p_size", F.raise_error(F.lit("broken batch"))), path)
    except Exception as e:
        if "broken batch" not in str(e):
            raise
    if read_replaced(spark, path).filter(F.col("p_size") <= 25).limit(1).count():
        raise AssertionError("a failed load changed the layer")
    replace_layer(part, path)  # ... and the next one replaces it
    return read_replaced(spark, path)


@register("load_skipped", "SELECT * FROM part WHERE p_size > 25")
def q_load_skipped(spark, d):
    """Loads told to skip leave the target as the load before them wrote it, and read nothing."""
    path = shared_path(spark, "bind", "load_skipped")
    part = table(spark, d, "part")
    loads.load_replace(part.filter(F.col("p_size") > 25), path)
    loads.load_replace(part, path, skip=True)
    loads.load_replace_unique(part.unionAll(part), path, ["p_partkey"], skip=True)
    loads.load_insert_absent(part, path, ["p_partkey"], ["p_name"], skip=True)
    return spark.read.parquet(path)


@register("load_replace_unique", "SELECT * FROM part")
def q_load_replace_unique(spark, d):
    path = shared_path(spark, "bind", "load_replace_unique")
    loads.load_replace_unique(table(spark, d, "part"), path, ["p_partkey"])
    return spark.read.parquet(path)


# Insert-if-absent on lineitem keyed by (l_orderkey, l_linenumber): a first batch of the rows
# shipped before 1998, then the whole table; per key the first row by the full column order wins.
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]
_ORDER_SQL = ", ".join(LINE_ORDER)


@register(
    "load_insert_absent",
    f"""
WITH b1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS rn
    FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01') WHERE rn = 1),
b2 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS rn
    FROM lineitem) WHERE rn = 1)
SELECT * FROM b1
UNION ALL
SELECT * FROM b2 WHERE NOT EXISTS (
  SELECT 1 FROM b1 WHERE b1.l_orderkey = b2.l_orderkey AND b1.l_linenumber = b2.l_linenumber)
""",
)
def q_load_insert_absent(spark, d):
    path = shared_path(spark, "bind", "load_insert_absent")
    li = table(spark, d, "lineitem")
    loads.load_insert_absent(li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")), path, LINE_KEYS, LINE_ORDER)
    loads.load_insert_absent(li, path, LINE_KEYS, LINE_ORDER)
    return spark.read.parquet(path).select(*li.columns)


@register("load_insert_committed", ORACLE_SQL["load_insert_absent"])
def q_load_insert_committed(spark, d):
    """The same two batches into a committed layer: the first fails before its commit and is run again,
    the second is sent twice."""
    store = SnapshotStore(spark, shared_path(spark, "bind", "load_insert_committed"))
    li = table(spark, d, "lineitem")
    first = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    store.write(first, "lineitem")  # a load that never came to its commit
    for batch, name in ((first, "b1"), (li, "b2"), (li, "b2")):
        loads.load_insert_absent_committed(batch, store, "lineitem", LINE_KEYS, LINE_ORDER, name)
    return store.read("lineitem").select(*li.columns)


@register(
    "commit_layers",
    "SELECT 'part' AS layer, COUNT(*) AS n FROM part UNION ALL SELECT 'supplier', COUNT(*) FROM supplier "
    "UNION ALL SELECT 'orders', COUNT(*) FROM orders",
)
def q_commit_layers(spark, d):
    """Three layers, one commit after another: rows of the last commit that names each."""
    store = SnapshotStore(spark, shared_path(spark, "bind", "commit_layers"))
    part, supplier, orders = (table(spark, d, n) for n in ("part", "supplier", "orders"))
    store.replace({"part": store.write(part.filter("p_size > 25"), "part"), "supplier": store.write(supplier, "supplier")})
    store.write(part.filter("p_size > 40"), "part")  # written, never committed
    store.replace({"part": store.write(part, "part"), "orders": store.write(orders, "orders")})
    counts = [store.read(n).agg(F.lit(n).alias("layer"), F.count(F.lit(1)).alias("n")) for n in ("part", "supplier", "orders")]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@register(
    "load_reconcile",
    "SELECT COUNT(*) AS rows_read, COUNT(*) AS rows_written, COUNT(*) AS rows_in_target, "
    "true AS reconciled FROM orders",
)
def q_load_reconcile(spark, d):
    path = shared_path(spark, "bind", "load_reconcile")
    return loads.load_reconcile(spark, table(spark, d, "orders"), path)


def _write_curated_orders(spark, d, base):
    """Curate customers and orders into layers under ``base``; returns the step counters."""
    c_step, o_step = StepCounter("customer"), StepCounter("orders")
    customers = table(spark, d, "customer")
    sampled = cur.sample_entities(c_step.input(customers), "c_custkey", ENTITY_FRACTION, ENTITY_SALT)
    write_layer(c_step.output(sampled), f"{base}/customer")
    keys = cur.sample_entities(customers, "c_custkey", ENTITY_FRACTION, ENTITY_SALT)
    orders = curate_facts(
        o_step.input(table(spark, d, "orders")), keys, "o_custkey", "c_custkey", "o_orderdate", BIND_PARAMS, "o_orderkey"
    )
    write_layer(o_step.output(orders), f"{base}/orders")
    return [c_step, o_step]


@register(
    "step_summary",
    f"""
SELECT 'customer' AS step, (SELECT COUNT(*) FROM customer) AS rows_read,
       (SELECT COUNT(*) FROM ({_SAMPLED_CUSTOMERS_SQL})) AS rows_written,
       (SELECT COUNT(*) FROM customer) - (SELECT COUNT(*) FROM ({_SAMPLED_CUSTOMERS_SQL})) AS rows_dropped
UNION ALL
SELECT 'orders', (SELECT COUNT(*) FROM orders), w, (SELECT COUNT(*) FROM orders) - w FROM (
  SELECT COUNT(*) AS w FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM ({_SAMPLED_CUSTOMERS_SQL}))
    AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
    AND {_hash_sql('o_orderkey', FACT_SALT, FACT_FRACTION)})
""",
)
def q_step_summary(spark, d):
    base = shared_path(spark, "bind", "step_summary")
    return step_summary(spark, _write_curated_orders(spark, d, base))


def _json_bytes_sql(table_name, *columns, where="true"):
    """(records, bytes) of a table written as JSON lines: each line's bytes and its line feed."""
    members = " || ',' || ".join(
        f"""'"{c}":' || {c}""" if number else f"""'"{c}":"' || {c} || '"'""" for c, number in columns
    )
    return f"SELECT COUNT(*) AS n, COALESCE(SUM(strlen('{{' || {members} || '}}') + 1), 0) AS b FROM {table_name} WHERE {where}"


_CUSTOMER_JSON = (("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_mktsegment", False))
_NATION_JSON = (("n_nationkey", True), ("n_name", False), ("n_regionkey", True))


@register(
    "layer_report",
    f"""
WITH l AS (
  SELECT 'customer' AS layer, * FROM ({_json_bytes_sql('customer', *_CUSTOMER_JSON)})
  UNION ALL SELECT 'nation', * FROM ({_json_bytes_sql('nation', *_NATION_JSON)})
  UNION ALL SELECT 'no_rows', 0, 0)
SELECT layer, n AS records, ROUND(b / 1e6, 3) AS mb FROM l
UNION ALL SELECT 'TOTAL', SUM(n)::BIGINT, ROUND(SUM(b) / 1e6, 3) FROM l
""",
)
def q_layer_report(spark, d):
    """Records and MB of JSON-lines layers plus the total; one layer is empty, one is not there.
    (The file count follows the writing tasks and is left out here.)"""
    base = shared_path(spark, "bind", "layer_report")
    customer = table(spark, d, "customer").select(*[c for c, _ in _CUSTOMER_JSON])
    write_layer(customer, f"{base}/customer", fmt="json")
    write_layer(table(spark, d, "nation").select(*[c for c, _ in _NATION_JSON]), f"{base}/nation", fmt="json")
    write_layer(customer.filter(F.col("c_custkey").isNull()), f"{base}/no_rows", fmt="json")
    layers = {n: f"{base}/{n}" for n in ("customer", "nation", "no_rows", "absent_layer")}
    return layer_report(spark, layers, fmt="json").select("layer", "records", "mb")


_LINE_JSON = (
    ("l_orderkey", True), ("l_partkey", True), ("l_suppkey", True), ("l_linenumber", True),
    ("l_returnflag", False), ("l_linestatus", False),
)
_LINE_TRIMMED = tuple(c for c in _LINE_JSON if c[0] not in ("l_partkey", "l_returnflag"))


@register(
    "size_delta",
    f"""
WITH s AS (
  SELECT ROUND((SELECT b FROM ({_json_bytes_sql('lineitem', *_LINE_JSON)})) / 1e6, 3) AS mb_before,
         ROUND((SELECT b FROM ({_json_bytes_sql('lineitem', *_LINE_TRIMMED)})) / 1e6, 3) AS mb_after)
SELECT layer, mb_before, mb_after, ROUND((mb_after - mb_before) / mb_before * 100, 1) AS pct_change
FROM s, (VALUES ('lineitem'), ('TOTAL')) v(layer)
""",
)
def q_size_delta(spark, d):
    """Size of lineitem's keys and flags as JSON lines before and after trimming two columns."""
    base = shared_path(spark, "bind", "size_delta")
    li = table(spark, d, "lineitem").select(*[c for c, _ in _LINE_JSON])
    write_layer(li, f"{base}/raw/lineitem", fmt="json")
    write_layer(cur.trim_columns(li, ["l_partkey"], "l_return"), f"{base}/trimmed/lineitem", fmt="json")
    before = layer_report(spark, {"lineitem": f"{base}/raw/lineitem"}, fmt="json")
    after = layer_report(spark, {"lineitem": f"{base}/trimmed/lineitem"}, fmt="json")
    return size_delta(before, after)


@register("curate_stream", ORACLE_SQL["curate"])
def q_curate_stream(spark, d):
    """The order curation run incrementally over JSON-lines files arriving in two batches."""
    from ..streaming import append_to_layer, stream_files

    src = shared_path(spark, "bind", "curate_stream", "src")
    out = shared_path(spark, "bind", "curate_stream", "out")
    ckpt = shared_path(spark, "bind", "curate_stream", "ckpt")
    orders = table(spark, d, "orders")
    # the static side of the stream-static semi join is written once, not re-derived per batch
    keys = materialize(
        cur.sample_entities(table(spark, d, "customer"), "c_custkey", ENTITY_FRACTION, ENTITY_SALT).select("c_custkey")
    )

    def transform(stream):
        return curate_facts(stream, keys, "o_custkey", "c_custkey", "o_orderdate", BIND_PARAMS, "o_orderkey")

    first = F.col("o_orderstatus").eqNullSafe("F")
    for i, batch in enumerate((orders.filter(first), orders.filter(~first))):  # every order arrives once
        write_layer(batch, f"{src}/arrival={i}", fmt="json")
        q = append_to_layer(spark, stream_files(spark, f"{src}/*", ORDERS, transform), out, ckpt)
        q.awaitTermination()
    return spark.read.parquet(out)


@register(
    "load_reconcile_insert",
    """
WITH keys1 AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
keys2 AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT (SELECT COUNT(*) FROM lineitem) AS rows_read,
       (SELECT COUNT(*) FROM keys2) - (SELECT COUNT(*) FROM keys1) AS rows_written,
       (SELECT COUNT(*) FROM keys2) AS rows_in_target, true AS reconciled
""",
)
def q_load_reconcile_insert(spark, d):
    """Reconciliation of the second insert-if-absent batch of ``load_insert_absent``."""
    path = shared_path(spark, "bind", "load_reconcile_insert")
    li = table(spark, d, "lineitem")
    first = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    loads.load_insert_absent(first, path, LINE_KEYS, LINE_ORDER)
    return loads.load_reconcile(spark, li, path, mode="insert_absent", keys=LINE_KEYS, order_by=LINE_ORDER)


@register("load_insert_absent_bucketed", ORACLE_SQL["load_insert_absent"])
def q_load_insert_absent_bucketed(spark, d):
    """The same two insert-if-absent batches into a target bucketed by the key."""
    import uuid

    name = f"venuelens_lineitem_{uuid.uuid4().hex[:10]}"
    path = shared_path(spark, "bind", "load_insert_absent_bucketed")
    li = table(spark, d, "lineitem")
    first = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    loads.load_insert_absent_bucketed(first, name, path, LINE_KEYS, LINE_ORDER)  # buckets by the batch's size
    loads.load_insert_absent_bucketed(li, name, path, LINE_KEYS, LINE_ORDER)  # ... kept by the table
    return spark.table(name).select(*li.columns)


@register("visit_cube_stream", ORACLE_SQL["visit_cube"])
def q_visit_cube_stream(spark, d):
    """The visit cube kept by a stateful stream over packed visit files arriving in two batches."""
    from ..streaming import start_visit_cube_stream
    from .bindings import _packed

    src = shared_path(spark, "bind", "visit_cube_stream", "src")
    out = shared_path(spark, "bind", "visit_cube_stream", "out")
    ckpt = shared_path(spark, "bind", "visit_cube_stream", "ckpt")
    packed = _packed(spark, d).select(F.col("business_id").cast("string").alias("business_id"), "date")
    early = F.coalesce(F.col("date") < F.lit("2024-01-15"), F.lit(False))  # records starting before the 15th
    p = CurationParams(year_min=2024, year_max=2024)  # the events' own year window
    for i, batch in enumerate((packed.filter(early), packed.filter(~early))):  # every record arrives once
        write_layer(batch, f"{src}/arrival={i}", fmt="json")
        start_visit_cube_stream(spark, f"{src}/*", out, p, checkpoint=ckpt).awaitTermination()
    cube = read_replaced(spark, out)
    return cube.select(F.col("business_id").cast("bigint").alias("business_id"), "day_segment", "visits")


@register(
    "nested_member",
    """
SELECT event_type, json_extract_string(props, '$.k') AS k, COUNT(*) AS events, COUNT(DISTINCT user_id) AS users
FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY ALL
""",
)
def q_nested_member(spark, d):
    """Events by a member of their ``props`` object, read by its nested name (F7)."""
    events = table(spark, d, "events").withColumn("attributes", F.from_json("props", "map<string,string>"))
    member = F.col("attributes.k")
    return (
        events.filter(member.isNotNull()).groupBy("event_type", member.alias("k"))
        .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))
    )
