"""Sources: JSON lines with a declared schema, JDBC / document-store option mapping, switch."""

from venuelens.session import shared_path
from venuelens.sources import JdbcSpec, SourceSpec, load_views, read_json_lines, tls_url
from venuelens.sources.docstore import docstore_options
from venuelens.sources.schemas import BUSINESS_RAW, CHECKIN, REVIEW


def test_json_lines_declared_schema_and_corrupt_rows(spark):
    path = shared_path(spark, "test", "json_in")
    lines = [
        '{"business_id": "b1", "name": "Caf\\u00e9", "stars": 4.5, "attributes": {"RestaurantsPriceRange2": "2", "Other": "x"}, "categories": "A, B"}',
        "not json at all",
        '{"business_id": "b2", "extra_field": 1}',
    ]
    spark.sparkContext.parallelize(lines, 1).saveAsTextFile(path)
    df = read_json_lines(spark, path, BUSINESS_RAW, corrupt_column="_corrupt")
    rows = {r.business_id: r for r in df.collect() if r.business_id}
    assert rows["b1"].name == "Café" and rows["b1"].attributes == {"RestaurantsPriceRange2": "2", "Other": "x"}
    assert rows["b2"].stars is None
    bad = [r for r in df.collect() if r._corrupt is not None]
    assert len(bad) == 1 and bad[0]._corrupt == "not json at all"
    assert "_corrupt" not in BUSINESS_RAW.fieldNames()  # the shared schema is not mutated


def test_tls_url_modes():
    base = "jdbc:postgresql://h:5432/db"
    assert tls_url(base) == base + "?sslmode=require"
    assert tls_url(base, "/ca.pem") == base + "?sslmode=verify-ca&sslrootcert=/ca.pem"
    assert tls_url(base, "/ca.pem", full_check=True) == base + "?sslmode=verify-full&sslrootcert=/ca.pem"
    assert tls_url(base + "?a=1") == base + "?a=1&sslmode=require"


def test_jdbc_spec_options():
    spec = JdbcSpec("jdbc:x", "reviews", user="u", password="p", driver="D", partition_column="id", num_partitions=4)
    opts = spec.options()
    assert opts["url"] == "jdbc:x" and opts["user"] == "u" and opts["driver"] == "D"
    assert "dbtable" not in opts  # the table (or a bounds subquery) is set per read


def test_docstore_options():
    assert docstore_options("mongodb://h", "db", "business") == {
        "connection.uri": "mongodb://h", "database": "db", "collection": "business",
    }


def test_source_switch_same_frames(spark):
    base = shared_path(spark, "test", "switch")
    df = spark.createDataFrame([("b1", "2018-03-01 22:12:01, 2019-01-01 10:00:00")], CHECKIN)
    df.write.json(f"{base}/json")
    df.write.parquet(f"{base}/parquet")
    from venuelens.operators.curation import expand_visits

    a = load_views(spark, {"checkins": SourceSpec("json", f"{base}/json", schema=CHECKIN, normalize=expand_visits)})
    b = load_views(spark, {"checkins": SourceSpec("parquet", f"{base}/parquet", normalize=expand_visits)}, register=True)
    assert sorted(a["checkins"].collect()) == sorted(b["checkins"].collect())
    assert spark.table("checkins").count() == 2
    assert REVIEW.fieldNames()[0] == "review_id"


def test_json_layer_keeps_utf8(spark):
    import glob
    import os

    from venuelens.sources.files import write_layer

    path = shared_path(spark, "test", "utf8")
    write_layer(spark.createDataFrame([("b1", "Café Zürich")], "business_id string, name string"), path, fmt="json")
    local = path.replace("file:", "")
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(os.path.join(local, "part-*")))
    assert "Café Zürich" in text and "\\u00e9" not in text
    assert text.count("\n") == 1  # one record per line


def test_jdbc_write_caps_connections():
    from venuelens.sources.jdbc import write_options

    opts = write_options(JdbcSpec("jdbc:x", "users", num_partitions=16, batchsize=500))
    assert opts["numPartitions"] == "16" and opts["batchsize"] == "500" and opts["dbtable"] == "users"
    assert "numPartitions" not in write_options(JdbcSpec("jdbc:x", "users"))


class _Recorder:
    """Stands in for a session: each ``read`` is a fresh reader (as in Spark) that records its
    options on ``load``; loads return canned bound rows."""

    def __init__(self, bounds=(3, 98)):
        self.calls, self.bounds = [], bounds

    @property
    def read(self):
        return _Reader(self)


class _Reader:
    def __init__(self, rec):
        self.rec, self.opts = rec, {}

    def format(self, f):
        self.opts["__format"] = f
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        self.rec.calls.append(("load", dict(self.opts)))
        rec = self.rec

        class _DF:
            def first(self):
                return {"lo": rec.bounds[0], "hi": rec.bounds[1]}

        return _DF()


def test_jdbc_read_is_range_partitioned():
    from venuelens.sources.jdbc import read_jdbc

    rec = _Recorder()
    read_jdbc(rec, JdbcSpec("jdbc:x", "reviews", partition_column="review_no", num_partitions=4))
    loads_ = [c[1] for c in rec.calls if c[0] == "load"]
    assert loads_[0]["dbtable"].startswith("(SELECT MIN(review_no) AS lo, MAX(review_no) AS hi FROM reviews)")
    final = loads_[-1]
    assert (final["dbtable"], final["partitionColumn"], final["lowerBound"], final["upperBound"], final["numPartitions"]) == (
        "reviews", "review_no", "3", "99", "4"
    )
    rec2 = _Recorder()
    read_jdbc(rec2, JdbcSpec("jdbc:x", "users", partition_column="id", num_partitions=2, lower_bound=0, upper_bound=9))
    assert len([c for c in rec2.calls if c[0] == "load"]) == 1  # bounds given: no bounds query
    rec3 = _Recorder()
    read_jdbc(rec3, JdbcSpec("jdbc:x", "users"))
    assert "partitionColumn" not in rec3.calls[-1][1]


def test_text_keys_are_cut_evenly_by_the_database(spark, monkeypatch):
    """The queries asked of a database, answered by a frame: every row in one slice, slices about even."""
    from venuelens.sources import jdbc

    keys = spark.range(1000).selectExpr("case when id % 50 = 0 then null else concat(char(65 + int(id % 7)), '\\'', id) end as review_id", "id")
    keys.createOrReplaceTempView("remote_reviews")
    asked = []

    def answer(spark, spec, sql):
        asked.append(sql)
        return spark.sql(sql)

    monkeypatch.setattr(jdbc, "_asked", answer)
    spec = jdbc.planned(spark, jdbc.JdbcSpec("jdbc:x", "remote_reviews", partition_column="review_id", num_partitions=8))
    assert len(spec.predicates) == 8 and "NTILE(8)" in asked[-1]
    sizes = [keys.filter(p).count() for p in spec.predicates]
    assert sum(sizes) == 1000 and max(sizes) <= 150  # the first slice holds the 20 rows without a key too
    sampled = jdbc.JdbcSpec("jdbc:x", "remote_reviews", partition_column="review_id", num_partitions=4, sample_clause="TABLESAMPLE (30 PERCENT)")
    rough = jdbc.planned(spark, sampled)
    assert len(rough.predicates) == 4 and sum(keys.filter(p).count() for p in rough.predicates) == 1000
    numbers = jdbc.planned(spark, jdbc.JdbcSpec("jdbc:x", "remote_reviews", partition_column="id", num_partitions=8))
    assert (numbers.lower_bound, numbers.upper_bound, numbers.predicates) == (0, 999, ())
    spark.createDataFrame([], "review_id string, id long").createOrReplaceTempView("remote_reviews")
    assert jdbc.planned(spark, spec.__class__("jdbc:x", "remote_reviews", partition_column="review_id", num_partitions=8)).predicates == ()
    given = jdbc.JdbcSpec("jdbc:x", "remote_reviews", partition_column="review_id", num_partitions=8, predicates=("a", "b"))
    assert jdbc.planned(spark, given) is given
