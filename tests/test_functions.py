"""Edge rows of the column functions (FIXTURES.md)."""

from pyspark.sql import functions as F

from venuelens.functions import day_part, hash_keep, split_trim, stamp_in_window, year_in_range
from venuelens.functions.dayparts import AFTERNOON, EVENING, MORNING, NIGHT


def test_year_predicate_edges(spark):
    keep = ["2018-01-01 00:00:00", "2021-12-31 23:59:59"]
    drop = ["2017-12-31 23:59:59", "2022-01-01", "20225", "201", "abcd", "", None]
    df = spark.createDataFrame([(s,) for s in keep + drop], "d string")
    got = [r.k for r in df.select(year_in_range("d", 2018, 2021).alias("k")).collect()]
    assert got == [True] * len(keep) + [False] * len(drop)


def test_stamp_window(spark):
    df = spark.createDataFrame([("2024-01-10 05:59:59",), ("2024-01-10 06:00:00",), ("junk",), (None,)], "d string")
    got = [r.k for r in df.select(stamp_in_window("d", "2024-01-10", "2024-01-10 06:00:00").alias("k")).collect()]
    assert got == [True, False, False, False]


def test_day_part_edges(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, None]
    rows = [(None if h is None else f"2020-01-01 {h:02d}:30:00",) for h in hours]
    df = spark.createDataFrame(rows, "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    got = [r.p for r in df.select(day_part("ts").alias("p")).collect()]
    assert got == [NIGHT, NIGHT, MORNING, MORNING, AFTERNOON, AFTERNOON, EVENING, EVENING, NIGHT]


def test_category_split(spark):
    df = spark.createDataFrame([("A, B",), ("A,B",), (None,), ("",)], "c string")
    got = [r.a for r in df.select(split_trim("c", ",").alias("a")).collect()]
    assert got == [["A", "B"], ["A", "B"], None, [""]]
    exploded = df.select(F.explode(split_trim("c", ",")).alias("x")).collect()
    assert [r.x for r in exploded] == ["A", "B", "A", "B", ""]
    # the ", " separator leaves "A,B" whole
    assert [r.a for r in df.select(split_trim("c", ", ").alias("a")).collect()][:2] == [["A", "B"], ["A,B"]]


def test_hash_sample_is_layout_independent(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = {r.k for r in df.repartition(3).filter(hash_keep("k", 0.4, 42)).collect()}
    b = {r.k for r in df.repartition(7, "k").filter(hash_keep("k", 0.4, 42)).collect()}
    assert a == b
    assert 1800 < len(a) < 2200
    assert df.filter(hash_keep("k", 1.0, 1)).count() == 5000
    assert df.filter(hash_keep("k", 0.0, 1)).count() == 0
    nulls = spark.createDataFrame([(None,)], "k bigint")
    assert nulls.filter(hash_keep("k", 0.99, 1)).count() == 0


def test_xxhash_sample_is_layout_independent(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = {r.k for r in df.repartition(3).filter(hash_keep("k", 0.3, 7, method="xxhash64")).collect()}
    b = {r.k for r in df.repartition(11, "k").filter(hash_keep("k", 0.3, 7, method="xxhash64")).collect()}
    assert a == b and 1300 < len(a) < 1700
    nulls = spark.createDataFrame([(None,)], "k bigint")
    assert nulls.filter(hash_keep("k", 0.99, 1, method="xxhash64")).count() == 0
