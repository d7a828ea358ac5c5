"""Bindings for the segmentation operators: customers as venues, (balance, orders, events)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.segments import Blocks, assign_nearest, lloyd_step, standardize
from . import segmentation as seg
from .bindings import customer_venues, register, visits_from_events

_FEATURES_SQL = """
WITH oc AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey),
ec AS (SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id),
f AS (
  SELECT c.c_custkey AS business_id, c.c_acctbal AS stars, COALESCE(oc.n, 0) AS review_count,
         COALESCE(ec.n, 0) AS total_checkins
  FROM customer c LEFT JOIN oc ON c.c_custkey = oc.o_custkey LEFT JOIN ec ON c.c_custkey = ec.user_id)
"""


def _features(spark, d):
    return seg.segment_features(customer_venues(spark, d), visits_from_events(spark, d))


@register(
    "standardize",
    _FEATURES_SQL
    + """
SELECT business_id,
       ROUND((stars - AVG(stars) OVER ()) / STDDEV_POP(stars) OVER (), 6) AS stars_z,
       ROUND((review_count - AVG(review_count) OVER ()) / STDDEV_POP(review_count) OVER (), 6) AS review_count_z,
       ROUND((total_checkins - AVG(total_checkins) OVER ()) / STDDEV_POP(total_checkins) OVER (), 6) AS total_checkins_z
FROM f
""",
)
def q_standardize(spark, d):
    z = standardize(_features(spark, d), seg.FEATURES)
    return z.select("business_id", *[F.round(f + "_z", 6).alias(f + "_z") for f in seg.FEATURES])


def _segments(spark, d):
    return seg.segment_entities(_features(spark, d), k=4)


@register("entity_segments")
def q_entity_segments(spark, d):
    assigned, _ = _segments(spark, d)
    return assigned


@register("segment_centroids")
def q_segment_centroids(spark, d):
    _, centroids = _segments(spark, d)
    return centroids


@register("segment_profile")
def q_segment_profile(spark, d):
    assigned, _ = _segments(spark, d)
    return seg.segment_profile(assigned)


# Stated centres in raw units (balance, orders, events), for the parts of the segmentation SQL can follow.
CENTRES = ((0.0, 5.0, 0.0), (0.0, 12.0, 60.0), (5000.0, 5.0, 0.0), (8000.0, 12.0, 60.0))

_NEAREST_SQL = (
    _FEATURES_SQL
    + """,
c(segment, x, y, z) AS (VALUES """
    + ", ".join(f"({i}, {x}, {y}, {z})" for i, (x, y, z) in enumerate(CENTRES))
    + """),
near AS (
  SELECT f.*, (SELECT segment FROM c ORDER BY power(f.stars - x, 2) + power(f.review_count - y, 2)
               + power(f.total_checkins - z, 2), segment LIMIT 1) AS segment
  FROM f)
"""
)


@register("segments_stated_centres", _NEAREST_SQL + "SELECT business_id, segment FROM near")
def q_segments_stated_centres(spark, d):
    near = assign_nearest(_features(spark, d), CENTRES, seg.FEATURES)
    return near.select("business_id", "segment")


@register(
    "segment_profile_stated_centres",
    _NEAREST_SQL
    + """SELECT segment, ROUND(AVG(stars), 4) AS stars_mean, ROUND(AVG(review_count), 4) AS review_count_mean,
       ROUND(AVG(total_checkins), 4) AS total_checkins_mean FROM near GROUP BY segment""",
)
def q_segment_profile_stated_centres(spark, d):
    near = assign_nearest(_features(spark, d), CENTRES, seg.FEATURES)
    return seg.segment_profile(near).select("segment", *[F.round(f"{f}_mean", 4).alias(f"{f}_mean") for f in seg.FEATURES])


@register(
    "segment_fit_check",
    """
SELECT COUNT(*) AS venues, 4 AS segments, 0::BIGINT AS misplaced, 0::BIGINT AS off_mean
FROM customer
""",
)
def q_segment_fit_check(spark, d):
    """Two things that hold for every converged fit: each venue lies nearest its own centroid, and each
    centroid is the mean of its venues (to 0.001 standard units). Both are counted by joins and
    aggregates here, apart from the assignment's own expression."""
    assigned, centroids = _segments(spark, d)
    z = standardize(assigned, seg.FEATURES)
    zcols = [f"{f}_z" for f in seg.FEATURES]
    centres = centroids.select(F.col("segment").alias("other"), *[F.col(c).alias(f"{c}_centre") for c in zcols])
    distance = sum(((F.col(c) - F.col(f"{c}_centre")) * (F.col(c) - F.col(f"{c}_centre")) for c in zcols), F.lit(0.0))
    stated = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in r.asDict().items()]) for r in centres.collect()])  # k rows
    every = z.select("*", F.inline(stated))
    own = F.min(F.when(F.col("segment") == F.col("other"), distance))
    per_venue = every.groupBy("business_id").agg((own > F.min(distance) + 1e-9).alias("misplaced"))
    means = z.groupBy("segment").agg(*[F.avg(c).alias(c) for c in zcols])
    far = sum((F.abs(F.col(c) - F.col(f"{c}_centre")) for c in zcols), F.lit(0.0)) > 1e-3
    off = means.join(centres, means.segment == centres.other, "full").agg(
        F.count("segment").cast("int").alias("segments"), F.count_if(F.coalesce(far, F.lit(True))).alias("off_mean")
    ).first()
    placed = per_venue.agg(F.count(F.lit(1)).alias("venues"), F.count_if("misplaced").alias("misplaced"))
    return placed.select(
        "venues", F.lit(off.segments).alias("segments"), "misplaced", F.lit(off.off_mean).cast("bigint").alias("off_mean")
    )


# Two starts of stated centres in raw units: one step of each, replayed by SQL.
STARTS = {0: [tuple(map(float, c)) for c in CENTRES], 7: [(-500.0, 0.0, 10.0), (4000.0, 8.0, 30.0), (9000.0, 15.0, 80.0)]}


@register(
    "lloyd_step_stated_starts",
    _FEATURES_SQL
    + """,
c(start, segment, x, y, z) AS (VALUES """
    + ", ".join(f"({s}, {i}, {x}, {y}, {z})" for s, cs in STARTS.items() for i, (x, y, z) in enumerate(cs))
    + """),
every AS (
  SELECT business_id, start, segment, stars, review_count, total_checkins,
         power(stars - x, 2) + power(review_count - y, 2) + power(total_checkins - z, 2) AS d
  FROM f, c),
own AS (
  SELECT a.* FROM every a LEFT JOIN every b ON a.business_id = b.business_id AND a.start = b.start AND (b.d, b.segment) < (a.d, a.segment)
  WHERE b.segment IS NULL)
SELECT start, segment, COUNT(*) AS n, ROUND(SUM(d) / COUNT(*), 2) AS mean_cost, ROUND(AVG(stars), 4) AS stars,
       ROUND(AVG(review_count), 4) AS review_count, ROUND(AVG(total_checkins), 4) AS total_checkins
FROM own GROUP BY start, segment
""",
)
def q_lloyd_step_stated_starts(spark, d):
    blocks = Blocks(_features(spark, d), seg.FEATURES, "business_id")
    try:
        step = lloyd_step(blocks, STARTS)
    finally:
        blocks.close()
    rows = [(s, at, n, round(cost / n, 2), *[round(m, 4) for m in means]) for (s, at), (n, cost, means) in step.items()]
    return spark.createDataFrame(rows, "start int, segment int, n long, mean_cost double, " + ", ".join(f"{f} double" for f in seg.FEATURES))
