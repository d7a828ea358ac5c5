"""Bindings of the venue operators to the driver's test tables, and their oracle SQL.

The test tables carry no venue data, so each key maps natural columns onto the canonical venue
shapes (see ``venue_queries``):

* visits   <- events            (user_id as the visited entity, ts as the visit time)
* venues   <- customer / part / supplier, depending on the question
* reviews  <- orders / lineitem (rating = an integer-valued measure where possible)

Every key reads whole tables. ``QUERIES[key](spark, sf_dir)`` returns a DataFrame and
``ORACLE_SQL[key]`` (when present) is DuckDB SQL over the same tables with the same column
names. Keys without SQL are checked on row counts and by the unit tests.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import stamp_in_window
from ..functions.sampling import hash_keep, hash_threshold
from ..operators import curation as cur
from ..operators.joins import enrich_with_defaults
from ..operators.ranking import percent_rank_by_histogram, top_groups
from ..session import shared_path
from ..sources.files import write_layer
from . import venue_queries as vq
from .curate import CurationParams, curate_facts

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql.strip()
        return fn

    return deco


_SCHEMAS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as it lies in its folder now. Its schema is kept by path, as a catalog would keep
    it, so that only the first read opens a footer for it; files are listed anew each time."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schemas = _SCHEMAS.setdefault(spark, {})
    if path not in schemas:
        schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(schemas[path]).parquet(path)


# --------------------------------------------------------------------------------------------
# canonical frames over the test tables
# --------------------------------------------------------------------------------------------
# The four market segments standing in for the four cities of the day-part question.
SEGMENT_CITIES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")


def visits_from_events(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").alias("business_id"), F.col("ts").alias("checkin_ts")
    )


def customer_venues(spark, d) -> DataFrame:
    """Customers as venues: city = nation name, state = market segment, rating = balance,
    open = positive balance, profile review count = number of orders."""
    orders_per = (
        table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("__orders"))
    )
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    c = table(spark, d, "customer")
    return (
        c.join(nation, c.c_nationkey == nation.n_nationkey)
        .join(orders_per, c.c_custkey == orders_per.o_custkey, "left")
        .select(
            F.col("c_custkey").alias("business_id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("state"),
            F.col("c_nationkey").alias("nation"),
            F.col("c_acctbal").alias("stars"),
            F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("is_open"),
            F.coalesce("__orders", F.lit(0)).cast("bigint").alias("review_count"),
        )
    )


def part_venues(spark, d) -> DataFrame:
    """Parts as venues: categories = words of the part name, name = brand, tier = type,
    rating = size, open = retail price below 950."""
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.col("p_brand").alias("name"),
        F.col("p_name").alias("categories"),
        F.col("p_type").alias("price_tier"),
        F.col("p_size").alias("stars"),
        F.when(F.col("p_retailprice") < 950, 1).otherwise(0).alias("is_open"),
    )


def lineitem_part_reviews(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("review_id"),
        F.col("l_partkey").alias("business_id"),
        F.col("l_quantity").alias("stars"),
    )


# --------------------------------------------------------------------------------------------
# Q1-Q9
# --------------------------------------------------------------------------------------------
_CUSTOMER_VENUES_SQL = """
oc AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey),
v AS (
  SELECT c.c_custkey AS business_id, c.c_name AS name, n.n_name AS city, c.c_mktsegment AS state,
         c.c_acctbal AS stars, CASE WHEN c.c_acctbal > 0 THEN 1 ELSE 0 END AS is_open,
         COALESCE(oc.n, 0) AS review_count
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN oc ON oc.o_custkey = c.c_custkey)
"""


@register(
    "market_opportunity",
    f"""
WITH {_CUSTOMER_VENUES_SQL}
SELECT city, state, COUNT(*) AS total_venues, ROUND(AVG(stars), 2) AS avg_stars,
       ROUND(SUM(is_open) / COUNT(*) * 100, 1) AS pct_open,
       CAST(SUM(review_count) AS BIGINT) AS total_reviews,
       ROUND(AVG(stars) * (SUM(is_open) / COUNT(*)) * LN(SUM(review_count) + 1), 3) AS market_score
FROM v GROUP BY city, state HAVING COUNT(*) >= 10
ORDER BY market_score DESC, city, state LIMIT 20
""",
)
def q_market_opportunity(spark, d):
    return vq.market_opportunity(customer_venues(spark, d), min_venues=10, top_k=20)


@register(
    "bubble_scale",
    f"""
WITH {_CUSTOMER_VENUES_SQL},
m AS (
  SELECT city, state, COUNT(*) AS total_venues, ROUND(AVG(stars), 2) AS avg_stars,
         ROUND(SUM(is_open) / COUNT(*) * 100, 1) AS pct_open,
         CAST(SUM(review_count) AS BIGINT) AS total_reviews,
         ROUND(AVG(stars) * (SUM(is_open) / COUNT(*)) * LN(SUM(review_count) + 1), 3) AS market_score
  FROM v GROUP BY city, state HAVING COUNT(*) >= 10
  ORDER BY market_score DESC, city, state LIMIT 20)
SELECT *, total_reviews / MAX(total_reviews) OVER () * 800 + 50 AS bubble_size FROM m
""",
)
def q_bubble_scale(spark, d):
    return vq.market_bubbles(vq.market_opportunity(customer_venues(spark, d), min_venues=10))


# Visits of a named customer per part of the day; a leader has fewer than three busier rivals.
_DAYPART_SQL = """
WITH visits AS (
  SELECT c_mktsegment AS city, c_name AS name, label AS day_segment, COUNT(*) AS checkin_count
  FROM events, customer, (VALUES (0, 'Night/Early Morning (0-6)'), (1, 'Morning (6-12)'),
                                 (2, 'Afternoon (12-18)'), (3, 'Evening (18-24)')) part(quarter, label)
  WHERE user_id = c_custkey AND quarter = hour(ts) // 6
  GROUP BY ALL),
rivals AS (
  SELECT a.city, a.day_segment, a.name, COUNT(b.name) AS busier
  FROM visits a LEFT JOIN visits b
    ON a.city = b.city AND a.day_segment = b.day_segment AND b.checkin_count > a.checkin_count
  GROUP BY ALL),
leaders AS (
  SELECT city, day_segment, name, checkin_count FROM visits NATURAL JOIN rivals
  WHERE busier < 3 AND city IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'))
"""


def _daypart(spark, d):
    venues = table(spark, d, "customer").select(
        F.col("c_custkey").alias("business_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("city"),
    )
    return vq.daypart_leaders(visits_from_events(spark, d), venues, cities=SEGMENT_CITIES, top_k=3)


@register("daypart_leaders", _DAYPART_SQL + "SELECT * FROM leaders")
def q_daypart_leaders(spark, d):
    return _daypart(spark, d)


@register(
    "daypart_profile",
    _DAYPART_SQL
    + "SELECT city, day_segment, AVG(checkin_count) AS mean_checkins FROM leaders GROUP BY city, day_segment",
)
def q_daypart_profile(spark, d):
    return vq.daypart_profile(_daypart(spark, d))


@register(
    "category_rating",
    """
SELECT word AS category, COUNT(*) AS total_reviews, ROUND(SUM(q) / COUNT(*), 2) AS avg_stars,
       ROUND(STDDEV_POP(q), 2) AS stddev_stars
FROM (SELECT l_quantity AS q, split_part(p_name, ' ', k) AS word
      FROM lineitem, part, (VALUES (1), (2)) word_no(k) WHERE p_partkey = l_partkey)
GROUP BY word HAVING COUNT(*) >= 1000
ORDER BY avg_stars DESC, total_reviews DESC, category LIMIT 15
""",
)
def q_category_rating(spark, d):
    return vq.category_rating(
        lineitem_part_reviews(spark, d), part_venues(spark, d), sep=" ", min_reviews=1000, top_k=15
    )


# Prices far from zero: a deviation from plain sums of squares would be lost in rounding.
FAR = 1e9


def _far_prices(spark, d):
    reviews = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("review_id"), F.col("o_custkey").alias("business_id"),
        (F.col("o_totalprice") + FAR).alias("stars"), F.col("o_orderdate").alias("date"),
    )
    venues = table(spark, d, "customer").select(F.col("c_custkey").alias("business_id"), F.col("c_mktsegment").alias("categories"))
    return reviews, venues


_FAR_SQL = f"""
SELECT c_mktsegment AS category, COUNT(*) AS total_reviews, ROUND(AVG(o_totalprice + {FAR}), 2) AS avg_stars,
       ROUND(STDDEV_POP(o_totalprice + {FAR}), 2) AS stddev_stars
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment
"""


@register("rating_deviation_far", _FAR_SQL)
def q_rating_deviation_far(spark, d):
    reviews, venues = _far_prices(spark, d)
    return vq.category_rating(reviews, venues, min_reviews=1)


@register("rating_deviation_far_cube", _FAR_SQL)
def q_rating_deviation_far_cube(spark, d):
    """The same through the monthly cube, whose parts are merged twice (venue, then category)."""
    reviews, venues = _far_prices(spark, d)
    return vq.category_rating(None, venues, min_reviews=1, cube=vq.review_cube(reviews))


_TIER_SQL = """
WITH e AS (
  SELECT unnest(string_split(p_name, ' ')) AS cat, p_type AS price_tier, p_size AS stars
  FROM part WHERE p_type IS NOT NULL AND (CASE WHEN p_retailprice < 950 THEN 1 ELSE 0 END) = 1),
tr AS (
  SELECT TRIM(cat) AS category, price_tier, ROUND(AVG(stars), 2) AS avg_rating, COUNT(*) AS total_venues
  FROM e GROUP BY TRIM(cat), price_tier HAVING COUNT(*) >= 30)
"""


@register("price_tier_rating", _TIER_SQL + "SELECT * FROM tr")
def q_price_tier_rating(spark, d):
    return vq.price_tier_rating(part_venues(spark, d), tier="price_tier", sep=" ", min_venues=30)


@register(
    "price_tier_matrix",
    """
WITH v AS (
  SELECT p_type AS category, CAST(p_size % 4 + 1 AS VARCHAR) AS price_tier, p_size AS stars
  FROM part WHERE p_retailprice < 950),
tr AS (
  SELECT category, price_tier, ROUND(AVG(stars), 2) AS avg_rating, COUNT(*) AS total_venues
  FROM v GROUP BY category, price_tier HAVING COUNT(*) >= 30),
c AS (SELECT category, TRY_CAST(price_tier AS INTEGER) AS t, avg_rating, total_venues FROM tr
      WHERE TRY_CAST(price_tier AS INTEGER) IS NOT NULL),
tops AS (SELECT category FROM c GROUP BY category ORDER BY SUM(total_venues) DESC, category LIMIT 20)
SELECT category,
       AVG(CASE WHEN t = 1 THEN avg_rating END) AS tier_1, AVG(CASE WHEN t = 2 THEN avg_rating END) AS tier_2,
       AVG(CASE WHEN t = 3 THEN avg_rating END) AS tier_3, AVG(CASE WHEN t = 4 THEN avg_rating END) AS tier_4
FROM c WHERE category IN (SELECT category FROM tops) GROUP BY category
""",
)
def q_price_tier_matrix(spark, d):
    venues = table(spark, d, "part").select(
        F.col("p_type").alias("categories"),
        (F.col("p_size") % 4 + 1).cast("string").alias("price_tier"),
        F.col("p_size").alias("stars"),
        F.when(F.col("p_retailprice") < 950, 1).otherwise(0).alias("is_open"),
    )
    tiers = vq.price_tier_rating(venues, tier="price_tier", sep=",", min_venues=30)
    return vq.price_tier_matrix(tiers, tiers=(1, 2, 3, 4), top_rows=20)


# Brands per word of a part's name; the rank is one more than the number of distinct better results.
_LEADERS_SQL = """
WITH brands AS (
  SELECT split_part(p_name, ' ', k) AS category_name, p_brand AS name, COUNT(*) AS total_reviews,
         SUM(l_quantity) / COUNT(*) AS mean
  FROM lineitem, part, (VALUES (1), (2)) word_no(k) WHERE p_partkey = l_partkey
  GROUP BY ALL HAVING COUNT(*) >= 20),
better AS (
  SELECT a.category_name, a.name, COUNT(DISTINCT CASE WHEN b.name IS NOT NULL THEN (b.total_reviews, b.mean) END) AS results
  FROM brands a LEFT JOIN brands b ON a.category_name = b.category_name
    AND (b.total_reviews > a.total_reviews OR (b.total_reviews = a.total_reviews AND b.mean > a.mean))
  GROUP BY ALL),
leaders AS (
  SELECT category_name, CAST(results + 1 AS INTEGER) AS market_rank, name, total_reviews,
         ROUND(mean, 2) AS avg_rating
  FROM brands NATURAL JOIN better WHERE results < 3)
"""


@register("category_leaders", _LEADERS_SQL + "SELECT * FROM leaders")
def q_category_leaders(spark, d):
    return vq.category_leaders(
        lineitem_part_reviews(spark, d), part_venues(spark, d), sep=" ", min_reviews=20, top_k=3
    )


@register(
    "review_cube",
    """
SELECT l_suppkey AS business_id, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS review_month,
       COUNT(*) AS reviews, COUNT(l_quantity) AS rated, SUM(l_quantity) AS stars_sum,
       ROUND(VAR_POP(l_quantity) * COUNT(l_quantity), 6) AS stars_m2, COUNT(l_orderkey) AS review_ids
FROM lineitem GROUP BY l_suppkey, date_trunc('month', l_shipdate)
""",
)
def q_review_cube(spark, d):
    reviews = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("review_id"),
        F.col("l_suppkey").alias("business_id"),
        F.col("l_quantity").alias("stars"),
        F.col("l_shipdate").alias("date"),
    )
    return vq.review_cube(reviews).withColumn("stars_m2", F.round("stars_m2", 6))


@register(
    "visit_cube",
    """
SELECT user_id AS business_id,
       CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'Morning (6-12)'
            WHEN hour(ts) BETWEEN 12 AND 17 THEN 'Afternoon (12-18)'
            WHEN hour(ts) BETWEEN 18 AND 23 THEN 'Evening (18-24)'
            ELSE 'Night/Early Morning (0-6)' END AS day_segment,
       COUNT(*) AS visits
FROM events GROUP BY 1, 2
""",
)
def q_visit_cube(spark, d):
    return vq.visit_cube(visits_from_events(spark, d))


@register(
    "leaders_profile",
    _LEADERS_SQL
    + """SELECT category_name, name, CAST(total_reviews AS DOUBLE) AS mean_reviews
FROM (SELECT * FROM leaders ORDER BY category_name, market_rank, total_reviews DESC, name LIMIT 30)""",
)
def q_leaders_profile(spark, d):
    leaders = vq.category_leaders(
        lineitem_part_reviews(spark, d), part_venues(spark, d), sep=" ", min_reviews=20, top_k=3
    )
    return vq.leaders_profile(leaders, head=30)


@register(
    "reviewer_influence",
    """
SELECT c_custkey AS user_id, MIN(c_name) AS name, COUNT(*) AS total_reviews,
       COUNT(DISTINCT l_partkey) AS distinct_venues, CAST(SUM(l_linenumber) AS BIGINT) AS total_useful,
       ROUND(SUM(l_quantity) / COUNT(*), 2) AS avg_stars_given,
       CAST(ROUND((4 * COUNT(*) + 3 * COUNT(DISTINCT l_partkey) + 3 * SUM(l_linenumber)) / 10, 2) AS DOUBLE) AS influence_score
FROM customer, orders, lineitem WHERE c_custkey = o_custkey AND o_orderkey = l_orderkey
GROUP BY c_custkey HAVING COUNT(*) >= 50
ORDER BY influence_score DESC, user_id LIMIT 20
""",
)
def q_reviewer_influence(spark, d):
    li = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    reviews = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("business_id"),
        F.col("l_linenumber").alias("useful"),
        F.col("l_quantity").alias("stars"),
    )
    users = table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("average_stars"),
    )
    return vq.reviewer_influence(reviews, users, min_reviews=50, top_k=20)


# Orders per nation and year; the year compared with is the largest earlier one that has any.
_YOY_SQL = """
WITH yearly AS (
  SELECT c_nationkey AS state, CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS reviews
  FROM customer, orders WHERE o_custkey = c_custkey GROUP BY ALL),
earlier AS (
  SELECT a.state, a.yr, MAX(b.yr) AS last_yr
  FROM yearly a LEFT JOIN yearly b ON b.state = a.state AND b.yr < a.yr GROUP BY ALL),
yoy AS (
  SELECT now.state, now.yr, now.reviews,
         ROUND((now.reviews - past.reviews) / past.reviews * 100, 1) AS yoy_pct_change
  FROM yearly now JOIN earlier e ON e.state = now.state AND e.yr = now.yr
  LEFT JOIN yearly past ON past.state = e.state AND past.yr = e.last_yr)
"""


def _yoy(spark, d):
    reviews = table(spark, d, "orders").select(
        F.col("o_custkey").alias("business_id"), F.col("o_orderdate").alias("date")
    )
    venues = table(spark, d, "customer").select(
        F.col("c_custkey").alias("business_id"), F.col("c_nationkey").alias("state")
    )
    return vq.yoy_change(reviews, venues)


@register("yoy_change", _YOY_SQL + "SELECT * FROM yoy")
def q_yoy_change(spark, d):
    return _yoy(spark, d)


@register(
    "yoy_top_groups",
    _YOY_SQL
    + """, tops AS (SELECT state FROM yoy GROUP BY state ORDER BY SUM(reviews) DESC, state LIMIT 5)
SELECT * FROM yoy WHERE state IN (SELECT state FROM tops)""",
)
def q_yoy_top_groups(spark, d):
    return vq.yoy_top_groups(_yoy(spark, d), k=5)


@register(
    "traffic_vs_rating",
    """
WITH live AS (
  SELECT * FROM (
    SELECT c_custkey AS business_id, c_name AS name, n_name AS city, c_mktsegment AS state,
           (SELECT COUNT(*) FROM events WHERE user_id = c_custkey) AS total_checkins,
           (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS total_reviews,
           (SELECT ROUND(AVG(o_totalprice), 2) FROM orders WHERE o_custkey = c_custkey) AS avg_review_stars
    FROM customer, nation WHERE c_nationkey = n_nationkey)
  WHERE total_checkins > 0 AND total_reviews >= 5),
smaller AS (
  SELECT a.business_id, COUNT(*) - 1 AS others,
         COUNT(*) FILTER (b.total_checkins < a.total_checkins) AS calmer,
         COUNT(*) FILTER (b.avg_review_stars < a.avg_review_stars) AS worse
  FROM live a JOIN live b ON a.state = b.state GROUP BY a.business_id)
SELECT live.*, ROUND(COALESCE(calmer / NULLIF(others, 0), 0), 4) AS traffic_pct_rank,
       ROUND(COALESCE(worse / NULLIF(others, 0), 0), 4) AS rating_pct_rank
FROM live JOIN smaller USING (business_id)
WHERE traffic_pct_rank >= 0.90 AND rating_pct_rank <= 0.25
ORDER BY total_checkins DESC, avg_review_stars, business_id LIMIT 30
""",
)
def q_traffic_vs_rating(spark, d):
    reviews = table(spark, d, "orders").select(
        F.col("o_custkey").alias("business_id"), F.col("o_totalprice").alias("stars")
    )
    return vq.traffic_vs_rating(
        visits_from_events(spark, d), reviews, customer_venues(spark, d), min_reviews=5, top_k=30
    )


# Months of a supplier are numbered by counting those up to them; the mean moves over three numbers.
_GAP_SQL = """
WITH months AS (
  SELECT l_suppkey AS business_id, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS review_month,
         SUM(l_quantity) / COUNT(*) AS mean, COUNT(*) AS n
  FROM lineitem GROUP BY ALL),
numbered AS (
  SELECT a.business_id, a.review_month, a.mean, a.n, COUNT(*) AS no
  FROM months a JOIN months b ON a.business_id = b.business_id AND b.review_month <= a.review_month
  GROUP BY ALL),
moving AS (
  SELECT a.business_id, a.review_month, a.mean, a.n, SUM(b.mean) / COUNT(*) AS moved
  FROM numbered a JOIN numbered b ON a.business_id = b.business_id AND b.no BETWEEN a.no - 2 AND a.no
  GROUP BY ALL),
gaps AS (
  SELECT business_id, s_name AS name, review_month, ROUND(mean, 2) AS current_month_rating,
         ROUND(moved, 2) AS rolling_avg_rating, ROUND(mean - moved, 2) AS performance_gap
  FROM moving JOIN supplier ON s_suppkey = business_id WHERE n >= 5
  ORDER BY performance_gap, business_id, review_month LIMIT 15)
"""


def _gaps(spark, d):
    reviews = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("review_id"),
        F.col("l_suppkey").alias("business_id"),
        F.col("l_quantity").alias("stars"),
        F.col("l_shipdate").alias("date"),
    )
    venues = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("business_id"), F.col("s_name").alias("name")
    )
    return vq.rolling_gap(reviews, venues, window_months=3, min_reviews=5, top_k=15)


@register("rolling_gap", _GAP_SQL + "SELECT * FROM gaps")
def q_rolling_gap(spark, d):
    return _gaps(spark, d)


@register(
    "gap_labels",
    _GAP_SQL + "SELECT *, name || ' (' || strftime(review_month, '%Y-%m') || ')' AS label FROM gaps",
)
def q_gap_labels(spark, d):
    return vq.gap_labels(_gaps(spark, d))


# --------------------------------------------------------------------------------------------
# curation building blocks
# --------------------------------------------------------------------------------------------

# Sample settings of the bindings: 40 % of customers (salt 42), 20 % of orders (salt 43).
ENTITY_FRACTION, ENTITY_SALT = 0.40, 42
FACT_FRACTION, FACT_SALT = 0.20, 43
BIND_PARAMS = CurationParams(
    year_min=1996, year_max=1999, user_fraction=ENTITY_FRACTION, review_fraction=FACT_FRACTION,
    seed=ENTITY_SALT, review_salt=FACT_SALT,
)


def _hash_sql(expr: str, salt: int, fraction: float) -> str:
    return f"substr(md5(concat('{salt}|', CAST({expr} AS VARCHAR))), 1, 8) < '{hash_threshold(fraction)}'"


_SAMPLED_CUSTOMERS_SQL = f"SELECT * FROM customer WHERE {_hash_sql('c_custkey', ENTITY_SALT, ENTITY_FRACTION)}"


@register("trim_columns", "SELECT * EXCLUDE (l_tax, l_returnflag) FROM lineitem")
def q_trim_columns(spark, d):
    return cur.trim_columns(table(spark, d, "lineitem"), drop=["l_tax", "no_such_column"], drop_prefix="l_return")


@register(
    "year_window",
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'",
)
def q_year_window(spark, d):
    return cur.year_window(table(spark, d, "orders"), "o_orderdate", 1996, 1999)


@register(
    "year_window_layer",
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'",
)
def q_year_window_layer(spark, d):
    """The window over a written layer in year and month folders: only those of the two years are read."""
    orders = table(spark, d, "orders")
    path = shared_path(spark, "bind", "year_window_layer")
    parted = cur.with_periods(orders, "o_orderdate")
    write_layer(parted.repartition(cur.YEAR, cur.MONTH), path, partition_by=[cur.YEAR, cur.MONTH])
    return cur.year_window(spark.read.parquet(path), "o_orderdate", 1996, 1997).select(*orders.columns)


@register(
    "year_window_text",
    """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
WHERE regexp_full_match(substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4), '[0-9]{4}')
  AND CAST(substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS INTEGER) BETWEEN 1996 AND 1999
""",
)
def q_year_window_text(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    )
    return cur.year_window(o, "o_orderdate", 1996, 1999)


@register("sample_entities", _SAMPLED_CUSTOMERS_SQL)
def q_sample_entities(spark, d):
    return cur.sample_entities(table(spark, d, "customer"), "c_custkey", ENTITY_FRACTION, ENTITY_SALT)


@register("sample_facts", f"SELECT * FROM orders WHERE {_hash_sql('o_orderkey', FACT_SALT, FACT_FRACTION)}")
def q_sample_facts(spark, d):
    return cur.sample_facts(table(spark, d, "orders"), "o_orderkey", FACT_FRACTION, FACT_SALT)


@register(
    "cascade_semi",
    f"SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM ({_SAMPLED_CUSTOMERS_SQL}))",
)
def q_cascade_semi(spark, d):
    sampled = cur.sample_entities(table(spark, d, "customer"), "c_custkey", ENTITY_FRACTION, ENTITY_SALT)
    return cur.cascade_semi(
        table(spark, d, "orders"), sampled, "o_custkey", "c_custkey",
        prefilter=hash_keep("o_custkey", ENTITY_FRACTION, ENTITY_SALT),
    )


@register(
    "curate",
    f"""
SELECT * FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM ({_SAMPLED_CUSTOMERS_SQL}))
  AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
  AND {_hash_sql('o_orderkey', FACT_SALT, FACT_FRACTION)}
""",
)
def q_curate(spark, d):
    sampled = cur.sample_entities(table(spark, d, "customer"), "c_custkey", ENTITY_FRACTION, ENTITY_SALT)
    return curate_facts(
        table(spark, d, "orders"), sampled, "o_custkey", "c_custkey", "o_orderdate", BIND_PARAMS, "o_orderkey"
    )


# Packed visits: one text per (user, block of 4096 event ids), stamps sorted, ", "-joined.
_PACKED_SQL = """
p AS (
  SELECT user_id AS business_id, CAST(floor(event_id / 4096) AS BIGINT) AS block,
         string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S'), ', ' ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S')) AS date
  FROM events GROUP BY user_id, floor(event_id / 4096))
"""


def _packed(spark, d):
    ev = table(spark, d, "events").select(F.col("user_id").alias("business_id"), "event_id", "ts")
    return cur.pack_stamps(ev, "business_id", "ts", out="date", block_col="event_id", block_size=4096)


@register(
    "packed_filter",
    "WITH "
    + _PACKED_SQL
    + """,
k AS (
  SELECT business_id, block,
         list_filter(list_transform(string_split(date, ','), lambda x: trim(x)),
                     lambda x: try_strptime(x, '%Y-%m-%d %H:%M:%S') >= TIMESTAMP '2024-01-10 00:00:00'
                           AND try_strptime(x, '%Y-%m-%d %H:%M:%S') < TIMESTAMP '2024-01-10 06:00:00') AS kept
  FROM p)
SELECT business_id, block, array_to_string(kept, ', ') AS date FROM k WHERE len(kept) > 0
""",
)
def q_packed_filter(spark, d):
    return cur.packed_filter(
        _packed(spark, d), "date", keep=lambda s: stamp_in_window(s, "2024-01-10 00:00:00", "2024-01-10 06:00:00")
    )


@register(
    "expand_visits",
    "SELECT user_id AS business_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS checkin_ts FROM events",
)
def q_expand_visits(spark, d):
    return cur.expand_visits(_packed(spark, d), "business_id", "date", "checkin_ts")


@register(
    "explode_categories",
    "SELECT business_id, TRIM(cat) AS category FROM ("
    "SELECT p_partkey AS business_id, unnest(string_split(p_name, ' ')) AS cat FROM part WHERE p_name IS NOT NULL)",
)
def q_explode_categories(spark, d):
    return vq.explode_categories(part_venues(spark, d).filter(F.col("categories").isNotNull()), sep=" ")


@register(
    "enrich_defaults",
    """
WITH ec AS (SELECT user_id, COUNT(*) AS total_checkins FROM events GROUP BY user_id)
SELECT c.c_custkey AS user_id, c.c_name AS name, COALESCE(ec.total_checkins, 0) AS total_checkins
FROM customer c LEFT JOIN ec ON c.c_custkey = ec.user_id
""",
)
def q_enrich_defaults(spark, d):
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    counts = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("total_checkins"))
    return enrich_with_defaults(users, counts, ["user_id"], {"total_checkins": 0})


@register(
    "percent_rank_groups",
    """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
       PERCENT_RANK() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS quantity_pct_rank
FROM lineitem
""",
)
def q_percent_rank_groups(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return percent_rank_by_histogram(li, ["l_suppkey"], "l_quantity", "quantity_pct_rank")


@register(
    "percent_rank_near_unique",
    """
SELECT o_orderkey, o_custkey % 3 AS part, o_totalprice,
       PERCENT_RANK() OVER (PARTITION BY o_custkey % 3 ORDER BY o_totalprice) AS price_pct_rank
FROM orders
""",
)
def q_percent_rank_near_unique(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 3).alias("part"), "o_totalprice")
    return percent_rank_by_histogram(orders, ["part"], "o_totalprice", "price_pct_rank")


@register(
    "percent_rank_hot_group",
    """
SELECT o_orderkey, o_custkey >= 10 AS usual, o_totalprice,
       PERCENT_RANK() OVER (PARTITION BY o_custkey >= 10 ORDER BY o_totalprice) AS price_pct_rank
FROM orders
""",
)
def q_percent_rank_hot_group(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") >= 10).alias("usual"), "o_totalprice")
    return percent_rank_by_histogram(orders, ["usual"], "o_totalprice", "price_pct_rank")


@register(
    "top_groups",
    """
SELECT c.c_nationkey AS nation, COUNT(*) AS total FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_nationkey ORDER BY total DESC, nation LIMIT 5
""",
)
def q_top_groups(spark, d):
    o = table(spark, d, "orders").select("o_custkey")
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    per_nation = o.join(c, o.o_custkey == c.c_custkey).select("nation", F.lit(1).alias("one"))
    return top_groups(per_nation, "nation", "one", 5).withColumn("total", F.col("total").cast("bigint"))


# Keys of the I/O, report and segmentation bindings register themselves on import.
from . import bindings_io, bindings_ml  # noqa: E402,F401
