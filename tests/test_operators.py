"""Edge rows of the operators (FIXTURES.md) and rewritten-vs-direct equivalence."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.operators import curation as cur
from venuelens.operators import loads
from venuelens.operators.ranking import percent_rank_by_histogram, top_per_group
from venuelens.operators.segments import standardize
from venuelens.session import shared_path


def test_packed_filter_edges(spark):
    rows = [
        (1, "2017-05-01 10:00:00, 2018-03-01 22:12:01,2021-01-01 00:00:00"),
        (2, "2017-01-01 00:00:00, 2022-05-05 10:00:00"),
        (3, None),
    ]
    df = spark.createDataFrame(rows, "business_id int, date string")
    got = {r.business_id: r.date for r in cur.packed_filter(df, "date", 2018, 2021).collect()}
    assert got == {1: "2018-03-01 22:12:01, 2021-01-01 00:00:00"}


def test_trim_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, p_x int, p_y int")
    assert cur.trim_columns(df, ["a", "zz"], "p_").columns == ["b"]


def test_semi_filter_edges(spark):
    facts = spark.createDataFrame([(None, 1), ("u9", 2), ("u1", 3), ("u1", 4)], "user_id string, v int")
    keys = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    got = sorted(r.v for r in cur.cascade_semi(facts, keys, "user_id").collect())
    assert got == [3, 4]


def test_year_window_pushdown(spark, tmp_path):
    path = str(tmp_path / "o")
    spark.createDataFrame([("2019-02-03 00:00:00",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("d")
    ).write.parquet(path)
    plan = cur.year_window(spark.read.parquet(path), "d", 2018, 2021)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d," in plan


def test_expand_visits(spark):
    df = spark.createDataFrame([(1, "2018-03-01 22:12:01, bad"), (2, None)], "business_id int, date string")
    got = [(r.business_id, r.checkin_ts) for r in cur.expand_visits(df).collect()]
    assert len(got) == 2 and got[1] == (1, None) and str(got[0][1]) == "2018-03-01 22:12:01"


def _ranks(spark, method, k):
    df = spark.createDataFrame([("g", n, i) for i, n in enumerate([9, 9, 8, 7])], "g string, n int, i int")
    out = top_per_group(df, ["g"], [F.col("n").desc()], k, method, "r")
    return sorted(r.r for r in out.collect())


def test_rank_vs_dense_rank(spark):
    assert _ranks(spark, "rank", 3) == [1, 1, 3]
    assert _ranks(spark, "dense_rank", 3) == [1, 1, 2, 3]


def test_rank_filter_becomes_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("g"), F.col("id").alias("n"))
    out = top_per_group(df, ["g"], [F.col("n").desc()], 3)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_percent_rank_edges(spark):
    df = spark.createDataFrame([("a", v) for v in [1, 1, 2, 3, 3]] + [("b", 7)], "g string, v int")
    got = sorted((r.g, r.v, r.pr) for r in percent_rank_by_histogram(df, ["g"], "v", "pr").collect())
    assert [x[2] for x in got] == [0.0, 0.0, 0.5, 0.75, 0.75, 0.0]


def test_percent_rank_matches_builtin(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), rnd.choice([None, *range(12)]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    hist = percent_rank_by_histogram(df, ["g"], "v", "pr").select("i", "pr")
    direct = df.select("i", F.percent_rank().over(Window.partitionBy("g").orderBy("v")).alias("pr"))
    assert sorted(hist.collect()) == sorted(direct.collect())


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new", 1), (2, "first", 1), (2, "second", 2), (None, "x", 0)], "k int, v string, o int")
    got = loads.rows_to_insert(batch, target, ["k"], ["o"]).collect()
    assert [(r.k, r.v) for r in got] == [(2, "first")]


def test_insert_absent_into_layer(spark):
    path = shared_path(spark, "test", "insert_absent")
    b1 = spark.createDataFrame([(1, "a")], "k int, v string")
    loads.load_insert_absent(b1, path, ["k"], ["v"])
    b2 = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], "k int, v string")
    res = loads.load_insert_absent(b2, path, ["k"], ["v"])
    assert res["rows_written"] == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]


def test_replace_unique_rejects_duplicates(spark):
    path = shared_path(spark, "test", "replace_unique")
    batch = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(loads.DuplicateKeyError):
        loads.load_replace_unique(batch, path, ["k"])
    assert loads.load_replace_unique(batch, path, ["k"], skip=True)["status"] == "skipped"


def test_conform_columns(spark):
    df = spark.createDataFrame([(1, "x", 5)], "a int, b string, extra int")
    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    out = loads.conform_columns(df, target)
    assert out.schema == target and out.collect()[0].asDict() == {"a": 1, "c": None}


def test_standardize_population_and_constant(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "x double, c double")
    out = standardize(df, ["x", "c"]).collect()
    assert [r.x_z for r in out] == [-1.0, 1.0]  # population deviation of (1, 2) is 0.5
    assert [r.c_z for r in out] == [0.0, 0.0]


def test_reconcile_modes(spark):
    path = shared_path(spark, "test", "reconcile")
    b1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    r = loads.load_reconcile(spark, b1, path).collect()[0]
    assert (r.rows_read, r.rows_written, r.rows_in_target, r.reconciled) == (2, 2, 2, True)
    b2 = spark.createDataFrame([(2, "x"), (3, "c"), (3, "d")], "k int, v string")
    r = loads.load_reconcile(spark, b2, path, mode="insert_absent", keys=["k"], order_by=["v"]).collect()[0]
    assert (r.rows_read, r.rows_written, r.rows_in_target, r.reconciled) == (3, 1, 3, True)
    assert sorted(tuple(x) for x in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_replace_drops_stale_document_id(spark):
    path = shared_path(spark, "test", "replace_id")
    df = spark.createDataFrame([("x", 1)], "_id string, k int")
    loads.load_replace_unique(df, path, ["k"])
    assert spark.read.parquet(path).columns == ["k"]


def test_layer_report_counts_json_lines(spark):
    from venuelens.operators.reports import layer_report, size_delta

    path = shared_path(spark, "test", "json_layer")
    spark.createDataFrame([(i, "x" * 60) for i in range(3000)], "k int, v string").repartition(2).write.json(path)
    rep = {r.layer: r for r in layer_report(spark, {"l": path, "missing": path + "_nope"}, fmt="json").collect()}
    assert set(rep) == {"l", "TOTAL"} and rep["l"].records == 3000 and rep["l"].files == 2
    assert rep["l"].mb > 0.1 and rep["TOTAL"].mb == rep["l"].mb
    delta = size_delta(layer_report(spark, {"l": path}, fmt="json"), layer_report(spark, {"l": path}, fmt="json"))
    assert {r.layer: r.pct_change for r in delta.collect()} == {"l": 0.0, "TOTAL": 0.0}


def test_price_tier_edges(spark):
    """Tier "2" -> 2, "None" -> not a number (out of the matrix), NULL -> excluded by the question."""
    from venuelens.plans import venue_queries as vq

    rows = [("v1", "A", "2", 4.0, 1), ("v2", "A", "None", 3.0, 1), ("v3", "A", None, 5.0, 1), ("v4", "A", "2", 2.0, 1)]
    venues = spark.createDataFrame(rows, "business_id string, categories string, tier string, stars double, is_open int")
    tiers = vq.price_tier_rating(venues, tier="tier", min_venues=1)
    assert sorted((r.price_tier, r.total_venues) for r in tiers.collect()) == [("2", 2), ("None", 1)]
    matrix = vq.price_tier_matrix(tiers).collect()
    assert [(r.category, r.tier_1, r.tier_2, r.tier_3, r.tier_4) for r in matrix] == [("A", None, 3.0, None, None)]


def test_moments_match_builtin_with_nulls(spark):
    from venuelens.functions.stats import mean_from_moments, merge_moments, moments, pop_stddev_from_moments

    rows = [("a", "v1", 1.0), ("a", "v1", 2.0), ("a", "v2", None), ("b", "v3", None), ("c", "v4", 5.0)]
    df = spark.createDataFrame(rows, "g string, k string, x double")
    want = {r.g: (r.n, r.m, r.sd) for r in df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.stddev_pop("x").alias("sd")).collect()}
    for few in (False, True):
        parts = merge_moments(df.groupBy("g", "k").agg(*moments("x")), ["g"], few_parts=few)
        got = {r.g: (r._rows, r.m, r.sd) for r in parts.select("g", "_rows", mean_from_moments().alias("m"), pop_stddev_from_moments().alias("sd")).collect()}
        assert got == want


def test_deviation_of_values_far_from_zero(spark):
    from venuelens.functions.stats import merge_moments, moments, pop_stddev_from_moments

    far = [(g, f"v{i % 3}", g * 1e9 + i % 2) for g in (0, 1, -7) for i in range(60)] + [(None, "v", 5e8), (None, "w", 5e8 + 1)]
    df = spark.createDataFrame(far, "g int, k string, x double")
    for few in (False, True):
        for having in (None, F.col("_rows") >= 2):
            parts = merge_moments(df.groupBy("g", "k").agg(*moments("x")), ["g"], having=having, few_parts=few)
            assert {(r.g, round(r.sd, 6)) for r in parts.select("g", pop_stddev_from_moments().alias("sd")).collect()} == {(g, 0.5) for g in (0, 1, -7, None)}
    dropped = merge_moments(df.groupBy("g", "k").agg(*moments("x")), ["g"], having=F.col("_rows") >= 3)
    assert sorted(r.g for r in dropped.collect()) == [-7, 0, 1]


def test_category_rating_of_values_far_from_zero(spark):
    """Two venues whose ratings are 1e9 and 1e9 + 1: deviation 0.5, also through the monthly cube."""
    from venuelens.plans import venue_queries as vq

    venues = spark.createDataFrame([("a", "X"), ("b", "X")], "business_id string, categories string")
    rows = [(str(i), "ab"[i % 2], 1e9 + (i // 2) % 2, f"2020-0{1 + i % 3}-05") for i in range(24)]
    reviews = spark.createDataFrame(rows, "review_id string, business_id string, stars double, date string")
    for cube in (None, vq.review_cube(reviews)):
        assert [r.stddev_stars for r in vq.category_rating(reviews, venues, min_reviews=1, cube=cube).collect()] == [0.5]


def test_year_window_on_dates_is_pushed_down(spark):
    path = shared_path(spark, "test", "dates")
    spark.createDataFrame([("2017-12-31",), ("2018-01-01",), ("2021-12-31",), ("2022-01-01",)], "s string").select(
        F.col("s").cast("date").alias("d")
    ).write.parquet(path)
    out = cur.year_window(spark.read.parquet(path), "d", 2018, 2021)
    assert sorted(str(r.d) for r in out.collect()) == ["2018-01-01", "2021-12-31"]
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,2018-01-01), LessThan(d,2022-01-01)]" in (
        out._jdf.queryExecution().executedPlan().toString()
    )


def test_packed_stamps_have_one_separator_rule(spark):
    """With or without blanks after the commas, the filter and the expansion see the same stamps."""
    stamps = "2019-01-01 10:00:00,2018-05-05 11:00:00 ,  2020-02-02 12:00:00"
    df = spark.createDataFrame([("b", stamps, "mine"), ("c", None, "x")], "business_id string, date string, kept_stamps string")
    expanded = cur.expand_visits(df).collect()
    assert sorted(str(r.checkin_ts) for r in expanded) == ["2018-05-05 11:00:00", "2019-01-01 10:00:00", "2020-02-02 12:00:00"]
    kept = cur.packed_filter(df, "date", 2018, 2019).collect()
    assert [(r.date, r.kept_stamps) for r in kept] == [("2019-01-01 10:00:00, 2018-05-05 11:00:00", "mine")]


def test_first_per_key_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, 7, 9), (1, 3, 8), (2, 5, 6)], "k int, number int, `number_` int")
    assert sorted(map(tuple, loads.first_per_key(df, ["k"], ["number"]).collect())) == [(1, 3, 8), (2, 5, 6)]


def test_bucketed_target_keeps_its_own_number_of_buckets(spark):
    import uuid

    name, path = f"bucketed_{uuid.uuid4().hex[:8]}", shared_path(spark, "test", "own_buckets")
    rows = spark.createDataFrame([(i, i) for i in range(40)], "k long, v long")
    loads.load_insert_absent_bucketed(rows.filter("k < 20"), name, path, ["k"], ["v"], buckets=3)
    loads.load_insert_absent_bucketed(rows, name, path, ["k"], ["v"], buckets=5)
    assert loads.table_buckets(spark, name) == 3 and spark.table(name).count() == 40
    known = spark.table(name)
    assert loads.buckets_for(known, 1 << 40) == 1 and loads.buckets_for(known, 64) > 1
    with pytest.raises(ValueError, match="size is not known"):
        loads.buckets_for(rows)
    spark.sql(f"DROP TABLE {name}")
