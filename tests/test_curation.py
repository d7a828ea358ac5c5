"""Entity JSON lines through the full curation, then the analytics views over the layers."""

from pyspark.sql import functions as F

from venuelens.functions import hash_keep, year_in_range
from venuelens.operators.reports import layer_report
from venuelens.plans import venue_queries as vq
from venuelens.plans.curate import CurationParams, curate, curated_specs, run_curation
from venuelens.session import shared_path
from venuelens.sources.files import write_layer
from venuelens.sources.snapshots import SnapshotStore, read_layer
from venuelens.sources.switch import load_views

from .venue_fixture import raw_frames


def layer_folder(spark, root, name):
    (folder,) = SnapshotStore(spark, root).current().layers[name]
    return folder


def _raw_json(spark):
    base = shared_path(spark, "test", "raw")
    paths = {}
    for name, df in raw_frames(spark).items():
        paths[name] = f"{base}/{name}"
        write_layer(df, paths[name], fmt="json")
    return paths


def test_curation_end_to_end(spark):
    paths = _raw_json(spark)
    out = shared_path(spark, "test", "curated")
    p = CurationParams()
    summary = {r.step: r for r in run_curation(spark, paths, out, p).collect()}
    assert set(summary) == {"business", "user", "review", "checkin", "tip", "visit"}
    assert summary["visit"].rows_read == summary["checkin"].rows_written  # expanded from the written layer
    assert summary["business"].rows_read == summary["business"].rows_written == 80

    raw = raw_frames(spark)
    users = read_layer(spark, out, "user")
    assert "friends" not in users.columns
    assert users.count() == summary["user"].rows_written
    expected_users = {r.user_id for r in raw["user"].filter(hash_keep("user_id", 0.4, 42)).collect()}
    assert {r.user_id for r in users.collect()} == expected_users

    reviews = read_layer(spark, out, "review")
    want = (
        raw["review"]
        .filter(F.col("user_id").isin(list(expected_users)))
        .filter(year_in_range("date", 2018, 2021))
        .filter(hash_keep("review_id", 0.2, 42))
    )
    assert sorted(r.review_id for r in reviews.collect()) == sorted(r.review_id for r in want.collect())
    assert summary["review"].rows_written == reviews.count()

    business = read_layer(spark, out, "business")
    assert not {"address", "postal_code", "latitude", "longitude"} & set(business.columns)

    checkins = read_layer(spark, out, "checkin").collect()
    for r in checkins:
        assert all(s[:4] in ("2018", "2020") for s in r.date.split(", "))

    views = load_views(spark, curated_specs(out))
    assert views["reviews"].schema["date"].dataType.simpleString() == "timestamp_ntz"
    assert views["checkins"].columns == ["business_id", "checkin_ts"]
    packed = load_views(spark, curated_specs(out, long_visits=False))["checkins"]
    assert sorted(packed.collect()) == sorted(views["checkins"].collect())
    assert summary["visit"].rows_written == views["checkins"].count()
    leaders = vq.daypart_leaders(views["checkins"], views["business"])
    assert leaders.count() > 0

    report = {r.layer: r for r in layer_report(spark, {**{n: layer_folder(spark, out, n) for n in ("user", "review")}, "nope": f"{out}/nope"}).collect()}
    assert set(report) == {"user", "review", "TOTAL"}
    assert report["TOTAL"].records == report["user"].records + report["review"].records
    assert report["TOTAL"].mb > 0


def test_curation_commutes(spark):
    """One composed plan equals the step-by-step order of the original pipeline."""
    raw = raw_frames(spark)
    p = CurationParams()
    composed = curate(raw, p)["review"]
    users = raw["user"].filter(hash_keep("user_id", p.user_fraction, p.seed)).select("user_id")
    stepwise = (
        raw["review"].join(users, "user_id", "left_semi")
        .filter(year_in_range("date", p.year_min, p.year_max))
        .filter(hash_keep("review_id", p.review_fraction, p.seed))
    )
    assert sorted(composed.select("review_id").collect()) == sorted(stepwise.select("review_id").collect())


def test_answer_all_over_curated_layers(spark):
    from venuelens.plans.views import answer_all, file_views

    paths = _raw_json(spark)
    out = shared_path(spark, "test", "curated_all")
    run_curation(spark, paths, out, CurationParams(user_fraction=0.9, review_fraction=0.9))
    answers = answer_all(file_views(spark, out))
    assert len(answers) == 18
    for name, df in answers.items():
        df.count()  # every question runs over the curated views
    assert answers["yoy_change"].count() > 0 and answers["entity_segments"].count() > 0


def test_remote_specs_map_options():
    from venuelens.plans.views import remote_specs
    from venuelens.sources import JdbcSpec

    specs = remote_specs(
        {"business": "mongodb://a", "tips": "mongodb://b", "checkins": "mongodb://c"},
        JdbcSpec("jdbc:postgresql://h/db", "reviews", partition_column="id", num_partitions=4, lower_bound=1, upper_bound=9),
        JdbcSpec("jdbc:postgresql://h/db", "users"),
    )
    assert specs["checkins"].options["connection.uri"] == "mongodb://c"
    assert specs["reviews"].options["numPartitions"] == "4" and specs["reviews"].options["upperBound"] == "10"
    assert "partitionColumn" not in specs["users"].options


def test_cli_curate_and_answer(spark):
    from venuelens.__main__ import main

    raw = shared_path(spark, "test", "cli_raw")
    for name, df in raw_frames(spark).items():
        write_layer(df, f"{raw}/{name}", fmt="json")
    out = shared_path(spark, "test", "cli_curated")
    res = shared_path(spark, "test", "cli_results")
    main(["curate", "--raw-dir", raw, "--out", out])
    main(["answer", "--curated", out, "--results", res, "--no-segments"])
    assert spark.read.parquet(f"{res}/yoy_change").count() > 0
    import os

    written = sorted(os.listdir(res.replace("file:", "")))
    assert len(written) == 15 and "reviewer_influence" in written and "entity_segments" not in written


def test_curation_with_xxhash_commutes(spark):
    raw = raw_frames(spark)
    p = CurationParams(hash_method="xxhash64")
    composed = curate(raw, p)["review"]
    users = raw["user"].filter(hash_keep("user_id", p.user_fraction, p.seed, "xxhash64")).select("user_id")
    stepwise = (
        raw["review"].join(users, "user_id", "left_semi")
        .filter(year_in_range("date", p.year_min, p.year_max))
        .filter(hash_keep("review_id", p.review_fraction, p.seed, "xxhash64"))
    )
    assert sorted(composed.select("review_id").collect()) == sorted(stepwise.select("review_id").collect())


def test_load_curated_layers(spark):
    from venuelens.plans.load import load_curated

    paths = _raw_json(spark)
    out = shared_path(spark, "test", "curated_for_load")
    run_curation(spark, paths, out)
    targets = shared_path(spark, "test", "targets")
    first = {r.entity: r for r in load_curated(spark, out, targets).collect()}
    assert all(r.reconciled for r in first.values())
    assert first["user"].rows_written == first["user"].rows_read
    # loading the same layers again: replaces are idempotent, inserts add nothing
    again = {r.entity: r for r in load_curated(spark, out, targets).collect()}
    assert again["review"].rows_written == 0 and again["user"].rows_written == 0
    assert again["business"].rows_in_target == first["business"].rows_in_target
    users = read_layer(spark, targets, "user")
    assert users.columns == [f.name for f in __import__("venuelens.sources.schemas", fromlist=["x"]).USER_TARGET.fields]
    skipped = {r.entity: r.mode for r in load_curated(spark, out, targets, skip=["tip"]).collect()}
    assert skipped["tip"] == "skipped"


def test_bucketed_layers_need_no_shuffle_for_venue_work(spark):
    import uuid

    from venuelens.plans.views import answer_all, file_views, table_views

    paths = _raw_json(spark)
    out = shared_path(spark, "test", "curated_bucketed")
    prefix = f"cur_{uuid.uuid4().hex[:8]}"
    run_curation(spark, paths, out, CurationParams(user_fraction=0.9, review_fraction=0.9), buckets=4, table_prefix=prefix)
    views = table_views(spark, out, prefix)
    # per-venue moments of the review cube and their join to the venues: no exchange below the join
    cube = views["review_cube"]
    plan = vq.category_rating(None, views["business"], min_reviews=1, cube=cube)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, s in enumerate(lines) if "SortMergeJoin" in s or "BroadcastHashJoin" in s)
    below = "\n".join(lines[join:])
    assert "Exchange hashpartitioning(business_id" not in below, plan
    # one file a bucket; raw facts are plain layers that split anywhere
    for name in ("business", "review_cube", "visit_cube"):
        files = spark.table(f"{prefix}_{name}").select(F.input_file_name().alias("f")).distinct().count()
        assert 0 < files <= 4, name
    assert not spark.catalog.tableExists(f"{prefix}_review")
    # same answers as over the plain layers
    plain = answer_all(file_views(spark, out), segments=False)
    bucketed = answer_all(views, segments=False)
    for k in ("category_rating", "yoy_change", "rolling_gap", "daypart_leaders", "traffic_vs_rating"):
        assert sorted(map(tuple, plain[k].collect()), key=repr) == sorted(map(tuple, bucketed[k].collect()), key=repr), k


def test_malformed_lines_are_counted_and_dropped(spark):
    base = shared_path(spark, "test", "raw_bad")
    good = '{"business_id": "b1", "name": "A", "city": "X", "state": "S", "stars": 4.0, "address": "z"}'
    spark.sparkContext.parallelize([good, "{not json", good.replace("b1", "b2")], 1).saveAsTextFile(f"{base}/business")
    out = shared_path(spark, "test", "curated_bad")
    summary = {r.step: r for r in run_curation(spark, {"business": f"{base}/business"}, out).collect()}
    assert (summary["business"].rows_read, summary["business"].rows_written) == (3, 2)
    rows = read_layer(spark, out, "business").collect()
    assert sorted(r.business_id for r in rows) == ["b1", "b2"] and "address" not in rows[0].asDict()


def test_remote_normalizers_widen_ratings(spark):
    from venuelens.plans.views import remote_specs
    from venuelens.sources import JdbcSpec

    specs = remote_specs({"business": "m", "tips": "m", "checkins": "m"}, JdbcSpec("j", "reviews"), JdbcSpec("j", "users"))
    reviews = spark.createDataFrame([("r1", 4.5, "2019-01-02 03:04:05")], "review_id string, stars float, date string")
    out = specs["reviews"].normalize(reviews)
    assert dict(out.dtypes) == {"review_id": "string", "stars": "double", "date": "timestamp_ntz"}
    users = spark.createDataFrame([("u1", 3.5)], "user_id string, average_stars float")
    assert dict(specs["users"].normalize(users).dtypes)["average_stars"] == "double"


def test_answer_all_shared_aggregates_equal_direct(spark):
    from venuelens.plans.views import answer_all, file_views

    paths = _raw_json(spark)
    out = shared_path(spark, "test", "curated_shared")
    run_curation(spark, paths, out, CurationParams(user_fraction=0.9, review_fraction=0.9))
    views = file_views(spark, out)
    shared = answer_all(views, shared_aggregates=True)
    direct = answer_all(views, shared_aggregates=False)
    assert set(shared) == set(direct)
    def rows(df, digits=None):
        out = [tuple(round(x, digits) if digits and isinstance(x, float) else x for x in r) for r in df.collect()]
        return sorted(out, key=repr)

    for k in shared:
        # k-means merges per-partition sums in no fixed order: centroids agree to ~1e-16
        digits = 9 if k == "segment_centroids" else None
        assert rows(shared[k], digits) == rows(direct[k], digits), k


def test_curation_keeps_unlisted_fields(spark):
    """Only the listed columns and prefixes go; other attributes and undeclared fields stay."""
    from venuelens.streaming.incremental import curate_stream

    base = shared_path(spark, "test", "raw_open")
    venue = (
        '{"business_id": "b1", "name": "A", "address": "z", "stars": 4.0, "verified": true, "tags": ["x", 1], '
        '"attributes": {"WiFi": "free", "RestaurantsPriceRange2": "2", "Parking": {"lot": true}}}'
    )
    plain = '{"business_id": "b2", "name": "B", "stars": 3.0}'
    spark.sparkContext.parallelize([venue, "", plain], 1).saveAsTextFile(f"{base}/business")
    users = [f'{{"user_id": "u{i}", "friends": "f", "compliment_hot": 3, "badge": {i}}}' for i in range(20)]
    spark.sparkContext.parallelize(users, 1).saveAsTextFile(f"{base}/user")
    out = shared_path(spark, "test", "curated_open")
    run_curation(spark, {n: f"{base}/{n}" for n in ("business", "user")}, out)
    rows = {r.business_id: r for r in read_layer(spark, out, "business").collect()}
    assert rows["b1"].other_fields == {"verified": "true", "tags": '["x",1]'}
    assert rows["b1"].attributes == {"WiFi": "free", "RestaurantsPriceRange2": "2", "Parking": '{"lot":true}'}
    assert rows["b2"].other_fields is None and rows["b2"].attributes is None and len(rows) == 2
    assert "address" not in rows["b1"].asDict()
    kept = read_layer(spark, out, "user")
    assert "friends" not in kept.columns and 0 < kept.count() < 20
    assert all(set(r.other_fields) == {"badge"} for r in kept.collect())
    streamed = curate_stream(spark, "business", f"{base}/business")
    assert streamed.schema["other_fields"].dataType.simpleString() == "map<string,string>"
    assert streamed.columns == read_layer(spark, out, "business").columns


def test_price_tier_reads_an_attribute_member(spark):
    """Nested member access through the attribute map equals the same rule over a flat column."""
    business = raw_frames(spark)["business"]
    flat = business.withColumn("tier", F.element_at("attributes", "RestaurantsPriceRange2"))
    got = vq.price_tier_rating(business, min_venues=2).collect()
    assert got and got == vq.price_tier_rating(flat, tier="tier", min_venues=2).collect()


def test_layers_by_year_and_month(spark):
    """The same rows as the plain layers; a year window reads the folders of its years alone."""
    from venuelens.operators.curation import MONTH, YEAR, year_window

    paths = _raw_json(spark)
    flat, parted = shared_path(spark, "test", "flat"), shared_path(spark, "test", "by_period")
    run_curation(spark, paths, flat)
    run_curation(spark, paths, parted, by_period=True)
    for name in ("review", "tip", "visit"):
        plain, layer = read_layer(spark, flat, name), read_layer(spark, parted, name)
        assert layer.columns == [*plain.columns, YEAR, MONTH]
        assert sorted(map(str, layer.drop(YEAR, MONTH).collect())) == sorted(map(str, plain.collect()))
    window = year_window(read_layer(spark, parted, "visit"), "checkin_ts", 2018, 2018)
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(layer_year" in plan
    want = year_window(read_layer(spark, flat, "visit"), "checkin_ts", 2018, 2018)
    assert window.count() == want.count() > 0
    views = load_views(spark, curated_specs(parted))
    assert views["checkins"].columns == ["business_id", "checkin_ts"] and YEAR not in views["reviews"].columns


def test_layer_report_reads_no_column(spark):
    path = shared_path(spark, "test", "report_plan")
    spark.range(50).selectExpr("id", "cast(id as string) as t").write.parquet(path)
    report = layer_report(spark, {"x": path})
    assert "ReadSchema: struct<>" in report._jdf.queryExecution().executedPlan().toString()
    assert {r.layer: r.records for r in report.collect()} == {"x": 50, "TOTAL": 50}
