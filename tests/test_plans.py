"""Physical-plan properties of the registered queries at the smoke scale."""

import pytest

from venuelens.plans.bindings import QUERIES

SF = "/root/testdata/sf0.001"
PLAN_KEYS = [
    "market_opportunity", "daypart_leaders", "category_rating", "price_tier_rating", "category_leaders",
    "reviewer_influence", "yoy_change", "traffic_vs_rating", "rolling_gap", "curate", "packed_filter",
    "percent_rank_groups", "load_insert_absent",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLAN_KEYS)
def test_no_python_in_plan(spark, key):
    p = plan(QUERIES[key](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p


def test_rank_filters_use_group_limit(spark):
    for key in ("daypart_leaders", "category_leaders"):
        lines = plan(QUERIES[key](spark, SF)).splitlines()
        partial = next(i for i, s in enumerate(lines) if "WindowGroupLimit" in s and s.rstrip().endswith("Partial"))
        final = next(i for i, s in enumerate(lines) if "WindowGroupLimit" in s and s.rstrip().endswith("Final"))
        exchange = next(i for i in range(final, partial) if "Exchange hashpartitioning" in lines[i])
        assert final < exchange < partial, key  # limit per map task, shuffle, limit per group


def test_filters_reach_scan(spark):
    p = plan(QUERIES["curate"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    p = plan(QUERIES["daypart_leaders"](spark, SF))
    assert "In(c_mktsegment" in p


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["rolling_gap"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_first_per_key_limits_before_shuffle(spark):
    from venuelens.operators.loads import first_per_key

    li = QUERIES["trim_columns"](spark, SF)
    p = plan(first_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]))
    # partial WindowGroupLimit below the exchange: a hot key ships at most one row per map partition
    assert p.index("Exchange hashpartitioning") < p.rindex("WindowGroupLimit")


def _ancestors(plan_text, line_no):
    """Lines on the path from a plan node up to the root (the tree string lists children below)."""
    lines = plan_text.splitlines()

    def depth(s):
        return len(s) - len(s.lstrip(" :+-|"))

    out, d = [], depth(lines[line_no])
    for i in range(line_no - 1, -1, -1):
        if depth(lines[i]) < d:
            out.append(lines[i].strip(" :+-|"))
            d = depth(lines[i])
    return out


FACT_SCANS = {
    "daypart_leaders": "events.parquet",
    "category_rating": "lineitem.parquet",
    "category_leaders": "lineitem.parquet",
    "reviewer_influence": "lineitem.parquet",
    "yoy_change": "orders.parquet",
    "rolling_gap": "lineitem.parquet",
}


@pytest.mark.parametrize("key", sorted(FACT_SCANS))
def test_facts_combine_map_side_before_shuffle(spark, key):
    p = plan(QUERIES[key](spark, SF))
    lines = p.splitlines()
    scans = [i for i, s in enumerate(lines) if "FileScan" in s and FACT_SCANS[key] in s]
    assert scans
    for i in scans:
        up = _ancestors(p, i)
        first_exchange = next(j for j, s in enumerate(up) if s.startswith("Exchange"))
        below = up[:first_exchange]
        assert any(s.startswith("HashAggregate") and "partial_" in s for s in below), (key, below)


def test_bucketed_target_is_not_shuffled(spark):
    import uuid

    from venuelens.operators import loads
    from venuelens.session import shared_path

    li = QUERIES["trim_columns"](spark, SF).select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]
    name = f"t_{uuid.uuid4().hex[:8]}"
    loads.load_insert_absent_bucketed(li, name, shared_path(spark, "test", "bucketed"), keys, order, 8)
    p = plan(loads.rows_to_insert(li, spark.table(name), keys, order))
    target_scan = next(i for i, s in enumerate(p.splitlines()) if "FileScan" in s and name in s)
    up = _ancestors(p, target_scan)
    join = next(j for j, s in enumerate(up) if "Join" in s)
    assert not any(s.startswith("Exchange") for s in up[:join]), up[:join]


CODEGEN_KEYS = ["daypart_leaders", "category_rating", "reviewer_influence", "yoy_change", "rolling_gap",
                "curate", "review_cube", "visit_cube", "sample_facts", "cascade_semi"]


@pytest.mark.parametrize("key", CODEGEN_KEYS)
def test_fact_operators_are_code_generated(spark, key):
    df = QUERIES[key](spark, SF)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    final = p.split("== Final Plan ==")[1].split("== Initial Plan ==")[0] if "== Final Plan ==" in p else p
    row_ops = ("Filter", "Project", "HashAggregate", "BroadcastHashJoin", "SortMergeJoin")
    outside = [s.strip(" :+-") for s in final.splitlines() if s.strip(" :+-").split("(")[0].split(" ")[0] in row_ops]
    assert not outside, outside  # every such operator line starts with a "*(n)" codegen marker
