"""Segments do not depend on the input layout; profiles and centroids are consistent."""

import numpy as np
from pyspark.sql import functions as F

from venuelens.operators import segments
from venuelens.plans import bindings_ml as bm
from venuelens.plans import segmentation as seg

SF = "/root/testdata/sf0.001"


def _labels(assigned):
    return sorted((r.business_id, r.segment) for r in assigned.select("business_id", "segment").collect())


def test_segments_layout_invariant(spark):
    feats = bm._features(spark, SF)
    a, ca = seg.segment_entities(feats, k=4, seeds=(42, 43, 44))
    b, cb = seg.segment_entities(feats.repartition(5).orderBy(F.rand(3)), k=4, seeds=(42, 43, 44))
    assert _labels(a) == _labels(b)
    assert [tuple(round(x, 9) for x in r) for r in ca.collect()] == [tuple(round(x, 9) for x in r) for r in cb.collect()]


def test_segment_profile_and_centroids(spark):
    assigned, centroids = seg.segment_entities(bm._features(spark, SF), k=4, seeds=(42, 43))
    assert sorted(r.segment for r in centroids.collect()) == [0, 1, 2, 3]
    prof = {r.segment: r for r in seg.segment_profile(assigned).collect()}
    counts = {r.segment: r["count"] for r in assigned.groupBy("segment").count().collect()}
    assert set(prof) == set(counts) and sum(counts.values()) == assigned.count()
    # the centroids are numbered in sorted order
    rows = [tuple(r)[1:] for r in centroids.orderBy("segment").collect()]
    assert rows == sorted(rows)


def test_fit_is_the_same_for_any_number_of_partitions(spark):
    features = bm._features(spark, SF)
    found = set()
    for n in (1, 4, 64):
        assigned, centres = seg.segment_entities(features.repartition(n), k=4, seeds=(42, 43))
        found.add((tuple(_labels(assigned)), tuple(map(tuple, centres.collect()))))
    assert len(found) == 1


def test_fit_follows_a_changed_table(spark, tmp_path):
    """Nothing of a fit is kept by path: the same folder with more customers has more segments rows."""
    for name in ("customer", "orders", "events", "nation"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    before = bm.q_entity_segments(spark, str(tmp_path)).count()
    more = spark.read.parquet(f"{SF}/customer.parquet").withColumn("c_custkey", F.col("c_custkey") + 1_000_000)
    more.write.mode("append").parquet(str(tmp_path / "customer.parquet"))
    assert bm.q_entity_segments(spark, str(tmp_path)).count() == 2 * before


def _brute_force_step(x, centres):
    d = ((x[:, None] - np.array(centres)[None]) ** 2).sum(2)
    at = d.argmin(1)
    return {j: (int((at == j).sum()), d[at == j, j].sum(), x[at == j].mean(0)) for j in range(len(centres)) if (at == j).any()}


def test_one_step_of_all_starts_and_the_fit_against_numpy(spark):
    rng = np.random.default_rng(5)
    x = np.round(np.concatenate([rng.normal(m, 0.4, (150, 2)) for m in ((0, 0), (4, 0), (0, 5))]), 3)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double").repartition(5)
    starts = {3: [(0.0, 0.0), (1.0, 1.0)], 9: [(4.0, 0.0), (0.0, 5.0), (50.0, 50.0)]}
    blocks = segments.Blocks(df, ["a", "b"], "id")
    got = segments.lloyd_step(blocks, starts)
    blocks.close()
    for s, centres in starts.items():
        want = _brute_force_step(x, centres)
        assert {j for t, j in got if t == s} == set(want)  # a centre without rows has no row
        for j, (n, cost, mean) in want.items():
            assert got[s, j][0] == n
            assert np.allclose([got[s, j][1], *got[s, j][2]], [cost, *mean], atol=1e-3)
    fitted = segments.fit_segments(df, ["a", "b"], "id", k=3)
    assert fitted == sorted(fitted)
    assert np.allclose(fitted, [x[150 * i : 150 * i + 150].mean(0) for i in (0, 2, 1)], atol=0.05)


def test_fit_of_few_or_no_rows(spark):
    few = spark.createDataFrame([(i, float(i % 2)) for i in range(6)], "id long, a double")
    assert segments.fit_segments(few, ["a"], "id", k=4) == [(0.0,), (1.0,)]  # as many as distinct rows
    none = few.filter("id < 0")
    assert segments.fit_segments(none, ["a"], "id") == []
    assert segments.assign_nearest(none, [], ["a"]).columns == ["id", "a", "segment"]
