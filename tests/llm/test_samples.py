"""Bounded samples: the same rows whatever the layout, bounded in rows and in words."""

import numpy as np
from pyspark.sql import functions as F

from venuelens.llm import toxicity
from venuelens.llm.shared import bounded_sample
from venuelens.llm.textbytes import each_block


def test_bounded_sample_is_the_head_of_the_hash_order(spark):
    table = spark.range(20_000).select(F.col("id").alias("k"))
    order = [r.k for r in table.orderBy(F.xxhash64("k", F.lit(7)), "k").limit(50).collect()]
    for n in (0, 1, 50):
        for parts in (1, 9):
            assert sorted(r.k for r in bounded_sample(table.repartition(parts), "k", n).collect()) == sorted(order[:n])
    assert bounded_sample(table.limit(30), "k", 50).count() == 30


def test_toxicity_sample_is_bounded_in_words_and_hashed_like_the_texts(spark, docs, labels):
    whole = toxicity.hashed_sample(docs, labels, "toxic", 500, 10**9)
    ids = whole.column("doc_id").to_pylist()
    assert ids == sorted(ids) and len(ids) == len(set(ids)) > 20
    words = dict(zip(ids, whole.column("n").to_pylist(), strict=True))
    texts = {r.doc_id: r.text for r in docs.filter(F.col("doc_id").isin(ids)).select("doc_id", "text").collect()}
    import pyarrow as pa

    for i, pieces in zip(ids, whole.column("pieces").to_pylist(), strict=True):
        parts = [toxicity.tokens(data, offs)[0] for _, _, data, offs in each_block(pa.array([texts[i]]), lower=True)]
        got = np.frombuffer(pieces, "<i4").reshape(-1, parts[0].shape[1])
        assert len(got) == words[i] and (got == np.concatenate(parts)).all()
    bound = sum(words.values()) // 2
    half = toxicity.hashed_sample(docs, labels, "toxic", 500, bound).column("doc_id").to_pylist()
    place = {r.i: r.h for r in spark.createDataFrame([(i,) for i in ids], "i long").select("i", F.xxhash64("i", F.lit(7)).alias("h")).collect()}
    total, want = 0, []
    for i in sorted(ids, key=place.get):
        total += words[i]
        if total > bound:
            break
        want.append(i)
    assert half == sorted(want) and 0 < len(half) < len(ids)
    assert toxicity.hashed_sample(docs.filter("false"), labels, "toxic", 500, 10).num_rows == 0
