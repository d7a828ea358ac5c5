import pytest

from venuelens.llm.shared import on_workers

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    on_workers(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """The documents of the smallest table with hard cases: nulls, empty and odd texts, a very long
    one, repeated rows and columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame(
        [
            (None, None, None, None, None),
            (None, "a null id", "en", None, 9),
            (900001, "", "en", "src0", 0),
            (900002, None, None, "src1", 0),
            (900003, "one", "en", "src1", 3),
            (900004, "  tabs\tand  double\n\nblanks \x0b é　日本語 ", None, None, 30),
            (900005, "same row twice, MIT License", "en", "srcx", 27),
            (900005, "same row twice, MIT License", "en", "srcx", 27),
            (900005, "same id, other text", "en", "srcx", 19),
            (900006, "word " * 60_000, "en", "src2", 300_000),
            (900007, "12 34 !! ##", "fr", "src2", 11),
            (900008, "x" * 50_000, "de", "src3", 50_000),
        ],
        DOC_SCHEMA,
    )
    return real.select("doc_id", "text", "lang", "source", "n_chars").union(odd).withColumns(
        {"score": F.lit("clash"), "size": F.lit(1), "h": F.lit(2), "fp": F.lit(3), "copies": F.lit(4)}
    ).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.fixture(scope="session")
def many(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
