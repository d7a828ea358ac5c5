"""Incremental curation over a file stream equals the batch curation of the same files."""

from venuelens.plans.curate import CurationParams, curate
from venuelens.session import shared_path
from venuelens.sources.files import read_replaced, write_layer
from venuelens.streaming import start_curation_stream

from .venue_fixture import raw_frames


def test_stream_curation_matches_batch(spark):
    raw = raw_frames(spark)
    src = shared_path(spark, "test", "stream_src")
    out = shared_path(spark, "test", "stream_out")
    ckpt = shared_path(spark, "test", "stream_ckpt")
    reviews = raw["review"]
    # two arrivals: the first half of the files, then the rest
    first = reviews.filter("review_id < 'r5'")
    rest = reviews.filter("review_id >= 'r5'")
    write_layer(first, f"{src}/a", fmt="json")
    q = start_curation_stream(spark, "review", f"{src}/*", out, users=raw["user"], checkpoint=ckpt)
    q.awaitTermination()
    write_layer(rest, f"{src}/b", fmt="json")
    q = start_curation_stream(spark, "review", f"{src}/*", out, users=raw["user"], checkpoint=ckpt)
    q.awaitTermination()

    got = sorted(r.review_id for r in spark.read.parquet(out).collect())
    want = sorted(r.review_id for r in curate(raw, CurationParams())["review"].collect())
    assert got == want and len(got) > 0


def test_stream_packed_filter(spark):
    raw = raw_frames(spark)
    src = shared_path(spark, "test", "stream_chk_src")
    out = shared_path(spark, "test", "stream_chk_out")
    write_layer(raw["checkin"], src, fmt="json")
    start_curation_stream(spark, "checkin", src, out).awaitTermination()
    got = sorted((r.business_id, r.date) for r in spark.read.parquet(out).collect())
    want = sorted((r.business_id, r.date) for r in curate(raw)["checkin"].collect())
    assert got == want


def test_visit_cube_stream_matches_batch(spark):
    from venuelens.operators.curation import expand_visits
    from venuelens.plans import venue_queries as vq
    from venuelens.streaming import start_visit_cube_stream

    raw = raw_frames(spark)
    src = shared_path(spark, "test", "vc_src")
    out = shared_path(spark, "test", "vc_out")
    ckpt = shared_path(spark, "test", "vc_ckpt")
    checkins = raw["checkin"]
    first = checkins.filter("business_id < 'b4'")
    rest = checkins.filter("business_id >= 'b4'")
    write_layer(first, f"{src}/a", fmt="json")
    start_visit_cube_stream(spark, f"{src}/*", out, checkpoint=ckpt).awaitTermination()
    after_first = read_replaced(spark, out).count()
    write_layer(rest, f"{src}/b", fmt="json")
    start_visit_cube_stream(spark, f"{src}/*", out, checkpoint=ckpt).awaitTermination()
    got = sorted(tuple(r) for r in read_replaced(spark, out).collect())
    want = sorted(tuple(r) for r in vq.visit_cube(expand_visits(curate(raw)["checkin"])).collect())
    assert got == want and 0 < after_first < len(want)


def test_curation_stream_with_processing_time_trigger(spark):
    raw = raw_frames(spark)
    src = shared_path(spark, "test", "pt_src")
    out = shared_path(spark, "test", "pt_out")
    write_layer(raw["checkin"], src, fmt="json")
    q = start_curation_stream(spark, "checkin", src, out, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.business_id, r.date) for r in spark.read.parquet(out).collect())
    want = sorted((r.business_id, r.date) for r in curate(raw)["checkin"].collect())
    assert got == want
