"""Operators across documents against brute force: groups, packing, order, mixing, pipeline."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuelens.llm import fingerprints, mixing, packing, simhash
from venuelens.llm.queries import tokenizer_path

from .test_text_operators import WORD, keyed, simhash_of


def group_ids(items, linked):
    """Smallest id reachable, by plain search over all pairs."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def test_simhash_groups_match_all_pairs(docs):
    rows = [(r.doc_id, simhash_of(r.text)) for r in docs.select("doc_id", "text").collect()]
    roots = group_ids(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 2)
    least = defaultdict(list)
    for (i, _), r in zip(rows, roots, strict=True):
        least[r].append(i)
    want = [(i, fp, min((x for x in least[r] if x is not None), default=None)) for (i, fp), r in zip(rows, roots, strict=True)]
    got = [(r.doc_id, int(r.hex, 16), r.component_id) for r in simhash.simhash_groups(docs).withColumn("hex", simhash.hex_fingerprint(F.col("fp"))).collect()]
    assert keyed(got) == keyed(want)


def test_links_hold_chains_and_dense_balls(spark):
    base = 0x0123456789ABCDEF
    chain = [base ^ ((1 << (2 * i)) - 1) for i in range(12)]  # each two bits from the one before
    star = [~base & (2**64 - 1)] + [(~base & (2**64 - 1)) ^ (1 << b) for b in range(40)]
    values = [v - 2**64 if v >> 63 else v for v in chain + star + [0, 7]]
    nodes = spark.createDataFrame([(v,) for v in values], "fp long").distinct()
    roots = {r.node: r.root for r in simhash.components(simhash.fingerprint_links(nodes)).collect()}
    got = [roots.get(v, v) for v in values]
    want = group_ids([v % 2**64 for v in values], lambda a, b: (a ^ b).bit_count() <= 2)
    assert len(set(got)) == len(set(want))
    assert {frozenset(i for i, x in enumerate(got) if x == g) for g in got} == {frozenset(i for i, x in enumerate(want) if x == g) for g in want}


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError, match="even"):
        simhash.fingerprint_links(spark.range(1).select(F.col("id").alias("fp")), 3)


def test_one_document_of_each_group_stays(docs):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, simhash_of(r.text)) for r in kept.select("doc_id", "text").collect()]
    assert all((a[1] ^ b[1]).bit_count() > 2 for i, a in enumerate(rows) for b in rows[:i])
    # one a group: as many as there are groups
    everyone = [(r.doc_id, simhash_of(r.text)) for r in docs.select("doc_id", "text").collect()]
    assert len(rows) == len(set(group_ids(everyone, lambda a, b: (a[1] ^ b[1]).bit_count() <= 2)))


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = True
    pieces = packing.pack(docs, tokenizer_path()).collect()
    stream = defaultdict(dict)
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        stream[p.sequence_id][p.offset] = p
    ids = []
    for s in range(len(stream)):
        at = 0
        for o in sorted(stream[s]):
            assert o == at
            at += stream[s][o].length
            ids += np.frombuffer(stream[s][o].ids, "<u4").tolist()
        assert at == 2048 or s == len(stream) - 1
    want = Counter(tuple(plain.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in docs.select("text").collect())
    got, part = Counter(), []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.start == len(part)
        part += np.frombuffer(p.ids, "<u4").tolist()
        if len(part) == p.doc_tokens:
            got[tuple(part)] += 1
            part = []
    assert not part and got == want


def test_sequences_are_padded(spark):
    rows = spark.createDataFrame([(i, "word " * 700) for i in range(7)], "doc_id long, text string")
    pieces = packing.pack(rows, tokenizer_path(), length=256)
    total = pieces.agg(F.sum("length")).first()[0]
    seqs = {r.sequence_id: r for r in packing.sequences(pieces, length=256).collect()}
    assert len(seqs) == -(-total // 256)
    for r in seqs.values():
        ids = np.frombuffer(r.ids, "<u4")
        power = r.n_ids & (r.n_ids - 1) == 0
        assert len(ids) == (r.n_ids if power else 256) and (ids[r.n_ids :] == 1).all()
    crc = pieces.select("ids", F.crc32("ids").alias("crc")).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.crc for r in crc)


@pytest.mark.parametrize("range_bytes", [1 << 30, 4000])
def test_neighbours_by_descending_id(docs, range_bytes):
    rows = docs.filter("doc_id is not null and doc_id <> 900005")
    got = {r.doc_id: r for r in fingerprints.neighbour_fingerprints(rows, range_bytes=range_bytes).collect()}
    own = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(rows).collect()}
    order = sorted(((r.doc_id, r.text or "") for r in rows.select("doc_id", "text").collect()), reverse=True)
    assert len(got) == len(order)
    for i, (doc_id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == own[doc_id] and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if text == edited:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    long = [r for r in got.values() if 500 < r.n_chars < 50_000]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95


def test_neighbours_with_repeated_rows(docs, spark):
    rows = fingerprints.neighbour_fingerprints(docs).collect()
    assert len(rows) == docs.count()
    single = fingerprints.neighbour_fingerprints(spark.createDataFrame([(1, "just one text")], "doc_id long, text string")).collect()
    assert single[0].near_next == 1.0


def test_syncmers_by_definition():
    codes = np.random.default_rng(5).integers(97, 105, 400).astype(np.uint32)
    at, h = fingerprints.syncmers(codes, 9, 4)
    inner = fingerprints._rolling(codes, 4)
    want = [i for i in range(400 - 9 + 1) if inner[i : i + 6].min() in (inner[i], inner[i + 5])]
    assert at.tolist() == want
    shifted = np.concatenate([np.full(7, 120, np.uint32), codes])
    at2, h2 = fingerprints.syncmers(shifted, 9, 4)
    assert set(zip((at + 7).tolist(), h.tolist(), strict=True)) <= set(zip(at2.tolist(), h2.tolist(), strict=True))


def test_shared_passages_of_long_texts_are_seen():
    rng = np.random.default_rng(11)
    text = lambda n: rng.integers(97, 123, n).astype(np.uint32)
    for n in (2_000, 20_000, 128_000):
        for _ in range(10):
            a, b, shared = text(n), text(n), text(300)
            a[n // 4 : n // 4 + 300] = shared
            b[n // 2 : n // 2 + 300] = shared
            assert fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) > 0
            edited = np.concatenate([a[: n // 2], b[: n // 2]])
            if n > 2_000:
                assert abs(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(edited)) - 1 / 3) < 0.06
    # what is kept of a passage does not depend on the rest of the text
    alone, within = fingerprints.fingerprint(shared_text := text(5_000)), fingerprints.fingerprint(np.concatenate([text(100_000), shared_text]))
    assert alone[2] and set(alone[1].tolist()) <= set(within[1].tolist())


def test_targets_stop_and_share_again():
    got = mixing.source_targets({"b": 100, "a": 10, None: 1000, "c": 400})
    # weights a 5, b 2, c 1, null 5; a stops at 30, then b (370 of 1480) at 300, the rest is 1 : 5
    assert got == pytest.approx({"a": 30.0, "b": 300.0, "c": 1180 / 6, None: 1180 * 5 / 6})
    assert sum(got.values()) == pytest.approx(1510)
    assert mixing.source_targets({}) == {} and mixing.source_targets({"a": 0}) == {"a": 0.0}


def test_mixture(docs):
    rows = mixing.mixture(docs).collect()
    sizes = [(r.doc_id, len(WORD.findall(r.text or ""))) for r in docs.select("doc_id", "text").collect()]
    assert keyed((r.doc_id, r.size) for r in rows) == keyed(sizes)
    assert all(r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0 for r in rows)
    again = mixing.mixture(docs.repartition(7)).collect()
    assert keyed(map(tuple, rows)) == keyed(map(tuple, again))


def test_mixture_meets_its_targets(many):
    joined = mixing.mixture(many).join(many.select("doc_id", "source"), "doc_id")
    for r in joined.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("all"), F.first("source_size").alias("source_size")).collect():
        assert r["all"] == r.source_size
        assert abs(r.taken - r.target) <= max(0.02 * r.target, 60)


def test_mixed_documents_carry_whole_rows(docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in mixing.mixture(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +want


def test_tilt_solves_the_dual(spark):
    """Multipliers against a plain bisection of each source's constraint; rates differ by size."""
    rng = np.random.default_rng(6)
    sizes = {s: rng.integers(0, 400, 60) for s in ("up", "down", "same", "full", "none", None)}
    rows = [(s, int(x)) for s, v in sizes.items() for x in (v if s != "none" else [0, 0])]
    histogram = spark.createDataFrame(rows, "source string, size long").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    total = {s: int(v.sum()) if s != "none" else 0 for s, v in sizes.items()}
    factor = {"up": 2.2, "down": 0.3, "same": 1.0, "full": 3.0, "none": 0.0, None: 0.01}
    targets = {s: factor[s] * total[s] for s in sizes}
    got = mixing.balance(histogram, total, targets)
    for s, v in sizes.items():
        if s == "none":
            assert got[s] == 0.0
            continue
        low, high = -20.0, np.log(3)
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if (v * np.minimum(np.exp(mid * v), 3)).sum() < targets[s] else (low, mid)
        rate = np.minimum(np.exp(got[s] * v), 3)
        assert abs((v * rate).sum() - targets[s]) <= 1e-6 * targets[s]
        if s != "full":
            assert got[s] == pytest.approx(low, rel=1e-4, abs=1e-7)
    assert len(set(np.round(np.exp(got["down"] * sizes["down"]), 6))) > 20


def test_many_sources(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3000).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 40 + 1).cast("int")).alias("text")
    )
    rows = mixing.mixture(docs).collect()
    assert len(rows) == 6000 and all(r.taken <= 3 * r.size for r in rows)
    assert abs(sum(r.taken for r in rows) - sum(r.size for r in rows)) < 0.1 * sum(r.size for r in rows)


def test_rows_come_through_whatever_their_columns_are_called(spark):
    """Names the operators use themselves, dots, blanks, back-ticks, nested fields: values unchanged."""
    from venuelens.llm import quality_classifier, quality_rules

    names = ["id", "h", "row", "no_id", "name", "size", "copies", "in_all", "alike", "own", "copy", "no_source", "__id", "__h", "__words", "__all",
             "a.b", "with blank", "tick`s", "score", "kept", "fp", "root", "label"]
    kept = quality_rules.keep_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).limit(8).collect()
    prose = kept[0].text
    rows = [(i, kept[i].text, "s" if i % 3 else None, (i, f"n{i}"), *[f"{n}-{i}" for n in names]) for i in range(8)]
    rows += [(None, prose + " again", "\u0000", (9, "n"), *[None] * len(names)), (-(2**63), prose + " once more", None, None, *["x"] * len(names))]
    kinds = "doc_id long, text string, source string, nested struct<`odd field`:long,`p.q`:string>, " + ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    docs = spark.createDataFrame(rows, kinds).repartition(3)
    model = quality_classifier.fit_quality(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    )
    want = {repr(tuple(r)) for r in docs.collect()}
    stages = {
        "good": quality_classifier.keep_good(docs, model, 0.0), "rules": quality_rules.keep_documents(docs),
        "near": simhash.drop_near_duplicates(docs), "mix": mixing.mixed_documents(docs),
    }
    for stage, out in stages.items():
        assert out.columns == docs.columns, stage
        got = [repr(tuple(r)) for r in out.collect()]
        assert got and set(got) <= want, stage
    assert sorted(map(repr, map(tuple, stages["good"].collect()))) == sorted(want)


def test_too_many_sources(many):
    with pytest.raises(ValueError, match="sources"):
        mixing.mixture(many, max_sources=3)


def test_empty_tables(empty):
    assert simhash.simhash_groups(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0
    assert packing.pack(empty, tokenizer_path()).count() == 0
    assert fingerprints.neighbour_fingerprints(empty).count() == 0
    assert mixing.mixture(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = [docs]
    for _, stage in cp.STAGES:
        frames.append(stage(spark, frames[-1], sf).cache())
    texts = [Counter((r.doc_id, r.text) for r in f.select("doc_id", "text").collect()) for f in frames[:-1]]
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert all(set(b) <= set(a) for a, b in zip(texts, texts[1:], strict=False))
    before, after = texts[2], texts[3]
    roots = group_ids([simhash_of(t) for _, t in before], lambda a, b: (a ^ b).bit_count() <= 2)
    assert sum(after.values()) == len(set(roots))
    assert max(texts[4].values()) <= 3
    packed = frames[-1].groupBy("doc_id").agg(F.sum("length").alias("n")).count()
    assert packed == len({i for i, _ in texts[4]})
    assert cp.run(spark, sf).count() == frames[-1].count()


def test_likeness_does_not_break_across_the_short_length():
    """One or two characters more never make alike texts strangers, whichever side of 64 they lie on."""
    rng = np.random.default_rng(8)
    letters = np.frombuffer("abcdefghijklmnop qrstuvw".encode("utf-32-le"), "<u4")
    for _ in range(40):
        base = rng.choice(letters, 120)
        for n in (58, 60, 62, 63, 64, 66, 80):
            a, b = fingerprints.fingerprint(base[:n]), fingerprints.fingerprint(base[: n + 2])
            assert fingerprints.likeness(a, b) == fingerprints.likeness(b, a) >= 0.7, n
        half = np.concatenate([base[:50], rng.choice(letters, 5)])  # 100 characters whose edited form shrinks to 55
        assert fingerprints.likeness(fingerprints.fingerprint(base[:100]), fingerprints.fingerprint(half)) > 0.2
        short, long = fingerprints.as_text(fingerprints.fingerprint(base[:40])), fingerprints.as_text(fingerprints.fingerprint(base))
        assert short.startswith(fingerprints.as_text(fingerprints.fingerprint(base[:40])).split(".")[0]) and "." in short and "." not in long


def test_fingerprint_of_edge_texts():
    empty, one, other = (fingerprints.fingerprint(np.array(c, np.uint32)) for c in ([], [97], [98, 99, 100, 101, 102, 103]))
    assert fingerprints.likeness(empty, empty) == 1.0 and fingerprints.likeness(empty, one) == 0.0
    assert fingerprints.likeness(one, one) == 1.0 and fingerprints.likeness(one, other) == 0.0
