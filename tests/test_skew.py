"""A venue and a reviewer holding about a third of all reviews: results equal the direct forms."""

import random

import pytest

from venuelens.plans import venue_queries as vq
from venuelens.session import scale_conf

from .test_queries import same


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    venues = [(f"b{i}", f"n{i % 7}", "C" if i % 2 else "D", "S", "Food, Bars" if i % 3 else "Pizza", 3.0, 10, 1) for i in range(60)]
    reviews = []
    for r in range(9000):
        hot = r % 3 == 0
        reviews.append(
            (f"r{r}", "u_hot" if hot else f"u{rnd.randint(0, 300)}", "b0" if hot else f"b{rnd.randint(1, 59)}",
             float(rnd.randint(1, 5)), rnd.randint(0, 3), f"{rnd.choice([2018, 2019, 2020])}-0{rnd.randint(1, 9)}-15")
        )
    b = spark.createDataFrame(venues, "business_id string, name string, city string, state string, categories string, stars double, review_count bigint, is_open bigint")
    rv = spark.createDataFrame(reviews, "review_id string, user_id string, business_id string, stars double, useful int, date string")
    u = spark.createDataFrame([(f"u{i}", f"user{i}", 3.0) for i in range(301)] + [("u_hot", "hot", 4.0)], "user_id string, name string, average_stars double")
    b.createOrReplaceTempView("sk_business")
    rv.createOrReplaceTempView("sk_reviews")
    u.createOrReplaceTempView("sk_users")
    return b, rv, u


def test_category_rating_under_skew(spark, skewed):
    b, rv, _ = skewed
    got = vq.category_rating(rv, b, sep=", ", min_reviews=10)
    want = spark.sql("""
        WITH c AS (SELECT business_id, TRIM(x) AS category FROM sk_business
                   LATERAL VIEW explode(split(categories, ', ')) e AS x)
        SELECT category, COUNT(*), ROUND(AVG(r.stars), 2), ROUND(STDDEV_POP(r.stars), 2)
        FROM sk_reviews r JOIN c USING (business_id) GROUP BY category HAVING COUNT(*) >= 10
        ORDER BY 3 DESC, 2 DESC, category LIMIT 15""")
    assert same(got, want) == 3


def test_reviewer_influence_under_skew(spark, skewed):
    _, rv, u = skewed
    got = vq.reviewer_influence(rv, u, min_reviews=20, top_k=5)
    want = spark.sql("""
        WITH s AS (SELECT user_id, COUNT(*) AS n, COUNT(DISTINCT business_id) AS d, SUM(useful) AS x,
                          ROUND(AVG(stars), 2) AS a FROM sk_reviews GROUP BY user_id)
        SELECT u.user_id, u.name, s.n, s.d, s.x, s.a, CAST(ROUND(s.n * 0.4 + s.d * 0.3 + s.x * 0.3, 2) AS DOUBLE) AS sc
        FROM sk_users u JOIN s USING (user_id) WHERE s.n >= 20 ORDER BY sc DESC, u.user_id LIMIT 5""")
    assert same(got, want) == 5


def test_yoy_and_gap_under_skew(spark, skewed):
    b, rv, _ = skewed
    assert vq.yoy_change(rv, b).count() == 3
    gaps = vq.rolling_gap(rv, b, min_reviews=50, top_k=5).collect()
    assert len(gaps) == 5 and all(g.business_id == "b0" for g in gaps)


def test_scale_conf_sizes_partitions():
    conf = scale_conf(100 * 2**40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10 * 2**20, 8)["spark.sql.shuffle.partitions"] == "24"


def test_semi_join_hot_key_is_split_by_aqe(spark):
    """The curation's referential semi join: a user holding a third of the facts is split by AQE."""
    from pyspark.sql import functions as F

    from venuelens.operators.curation import cascade_semi

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        uid = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 5000).cast("string")))
        facts = spark.range(150000).select(uid.alias("user_id"), F.col("id").alias("review_id"))
        users = spark.range(5000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id")).union(
            spark.createDataFrame([("hot",)], "user_id string")
        )
        out = cascade_semi(facts, users, "user_id")
        assert len(out.collect()) == 150000
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_scale_conf_keys_are_spark_settings(spark):
    jconf = spark._jsparkSession.sessionState().conf()
    defined = {t._1() for t in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(jconf.getAllDefinedConfs())}
    assert set(scale_conf(10**12, 800)) <= defined
