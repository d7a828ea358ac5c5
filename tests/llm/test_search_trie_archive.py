"""Ranked search, the conversation trie and the archives against brute force."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from venuelens.llm import lexical_search, oracles, prefix_trie, warc
from venuelens.session import shared_path

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c in counted:
            n = sum(c.values())
            m = 10 + 90 * n * n_docs // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("settings", [{}, {"k": 3, "block_terms": 40, "shard": 50}])
def test_search_equals_brute_force(spark, docs, settings):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(12).collect()]
    items += [(500, "MIT License word"), (500, "one twice"), (None, "12 same É é"), (501, None), (502, "..."), (503, "nowhereatall"), (500, "MIT License word")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in lexical_search.search(docs.repartition(5), asked, **settings).collect()]
    assert sorted(got, key=repr) == brute_search(texts, items, settings.get("k", 10))


def test_search_of_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert lexical_search.search(empty, items).collect() == []
    assert lexical_search.search(docs, items.filter("false")).collect() == []


def test_long_texts_are_counted_in_windows(monkeypatch):
    import pyarrow as pa

    from venuelens.llm import textbytes

    rng = random.Random(3)
    texts = ["", None, " ".join(rng.choice(["aa", "b", "Ccc", "é1"]) for _ in range(5000)), "x" * 900, "aa b", "!" * 300 + " aa"]
    vocabulary = lexical_search.Vocabulary(["aa", "b", "ccc", "é1", "x" * 900])
    real = lexical_search.each_window
    monkeypatch.setattr(lexical_search, "each_window", lambda c, t, lower: real(c, t, lower, 97))
    got = {}
    for a, n, row, term, tf in lexical_search.postings(pa.array(texts), vocabulary):
        for i, x in enumerate(n.tolist()):
            got[a + i] = (x, {})
        for r, t, f in zip(row.tolist(), term.tolist(), tf.tolist(), strict=True):
            got[a + r][1][t] = f
    names = ["aa", "b", "ccc", "é1", "x" * 900]
    for i, text in enumerate(texts):
        c = Counter(terms(text))
        assert got[i] == (sum(c.values()), {names.index(t): f for t, f in c.items() if t in names})
    assert textbytes.BLOCK_BYTES > 97


def test_accumulators_stop_and_survivors_stay_exact():
    """One rare term decides; the documents that only hold the common one get no accumulator."""
    rng = np.random.default_rng(1)
    n = 4000
    common = np.arange(n)
    rare = rng.choice(n, 30, replace=False)
    row, term = np.concatenate([common, rare]), np.concatenate([np.zeros(n, np.int64), np.ones(30, np.int64)])
    order = np.lexsort((term, row))
    lists = lexical_search.Shard(
        np.arange(n), np.zeros(n, bool), rng.integers(5, 50, n), row[order], term[order], np.ones(n + 30, np.int64), 2, (n, 20 * n), np.array([3, 5000])
    )
    best = lexical_search.Ranking(10)
    assert lists.rank(np.array([1, 0]), best) == 30
    whole = lists.part[lists.first[0] : lists.first[1]].copy()
    extra = np.zeros(n, np.int64)
    extra[lists.row[lists.first[1] :]] = lists.part[lists.first[1] :]
    scores = np.zeros(n, np.int64)
    scores[lists.row[: lists.first[1]]] = whole
    scores += extra
    want = sorted((-int(s), i) for i, s in enumerate(scores))[:10]
    assert [(-int(s), int(i)) for s, i in zip(best.score, best.id, strict=True)] == want


def talks(spark):
    rng = random.Random(11)
    rows = []
    for c in range(0, 160):
        if c % 37 == 5:
            continue  # a family whose base is missing or short
        say = rng.choice(["a", "b"])
        for t in range(rng.choice([0, 1, 2, 3, 5, 9, 12])):
            rows.append((c, t if t % 4 else (None if t == 0 else t), rng.choice(["user", None, ""]) if t > 3 else "user", f"{say}{min(t, rng.choice([2, 9]))}"))
    rows += [(c, 0, "user", "hello") for c in range(1000, 1080, 5)]  # copies
    rows += [(2000, t, "user", "é" * (t % 3)) for t in range(2500)]  # one long conversation
    rows += [(2001, t, "user", "é" * (t % 3)) for t in range(0, 2500, 2)]
    rows += [(None, 1, "user", "x"), (None, None, None, None), (3001, 5, "user", "same"), (3001, 5, "user", "same"), (3001, 5, None, None), (-3, 1, "user", "neg"), (-5, 0, "u", "base")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def node_rows(frame):
    columns = sorted(frame.columns)
    return sorted([tuple(r) for r in frame.select(*columns).collect()], key=repr)


@pytest.mark.parametrize("bound", [40, prefix_trie.BOUND])
def test_trie_equals_its_sql(spark, bound):
    """Every prefix, member and subtree worked out by joined strings (DuckDB); a small bound sends the
    centroid rounds through Spark joins, a block of 64 turns the running totals through levels."""
    conversations = talks(spark).filter("conv_id is null or conv_id < 2000 or turn < 200")
    got = node_rows(prefix_trie.conversation_trie(conversations.withColumn("weight", F.lit("clash")).repartition(7), bound))
    con = duckdb.connect()
    con.register("conversations", conversations.toArrow())
    frame = con.execute(oracles.PREFIX_TRIE).df()
    frame = frame[sorted(frame.columns)].astype(object)
    want = sorted([tuple(x if isinstance(x, str) else None if pd.isna(x) else int(x) for x in r) for r in frame.itertuples(index=False)], key=repr)
    assert got == want


def test_trie_of_a_long_conversation(spark, monkeypatch):
    """A path of 2,500 nodes: running totals over blocks, components cut in halves."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    one = talks(spark).filter("conv_id = 2000")
    nodes = {r.depth: r for r in prefix_trie.conversation_trie(one, 600).collect()}
    assert sorted(nodes) == list(range(2501))
    assert all(r.n_leaves == 1 and r.saved_tokens == 0 and r.n_convs == 1 for r in nodes.values())
    assert [nodes[d].n_children for d in (0, 1, 2499, 2500)] == [1, 1, 1, 0]
    assert nodes[2500].ends_sha256 == hashlib.sha256(b"2000").hexdigest()


def test_trie_of_no_conversation(spark):
    none = talks(spark).filter("false")
    assert prefix_trie.conversation_trie(none).collect() == []


def test_local_cuts_equal_plain_sums():
    """The recursion inside a task on random trees against sums along every path."""
    rng = np.random.default_rng(4)
    n = 400
    parent = np.array([0, *[int(rng.integers(max(0, i - 12), i)) for i in range(1, n)]])
    depth = np.zeros(n, np.int64)
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    key = rng.permutation(10**6)[:n].astype(np.int64)
    v1, v2, own = rng.integers(0, 9, n), rng.integers(-5, 5, n), rng.integers(1, 6, n)
    sums, weight = [v1.copy(), v2.copy()], own.copy()
    for i in range(n - 1, 0, -1):
        for s in (*sums, weight):
            s[parent[i]] += s[i]
    c = {"x1": key, "x2": -key, "d": depth, "p1": key[parent], "p2": -key[parent], "weight": weight, "v1": v1, "v2": v2}
    c |= {"a1": np.full(n, 7), "a2": np.zeros(n, np.int64), "t1": np.full(n, key[0]), "t2": np.full(n, -key[0]), "td": np.zeros(n, np.int64)}
    got = prefix_trie.component_sums(c)
    assert (got[0] == sums[0] + 7).all() and (got[1] == sums[1]).all()


def pages(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").limit(40)
    rows = [(10_000 + i, "http://Same.Example.org:80/p?q=1#f", f"<p>{i % 3}</p>") for i in range(60)]
    rows += [(None, None, None), (None, "x y\r\nz", "<p>0</p>"), (20_000, "", ""), (20_001, None, None), (20_002, "u", "only null ids elsewhere")]
    rows += [(None, "n1", "nulls"), (None, "n2", "nulls"), (30_000, "d", "twice"), (30_000, "d", "twice"), (29_999, "d", "twice"), (5, "long", "é\r\n\r\nWARC/1.1\r\n" * 30_000)]
    return real.union(spark.createDataFrame(rows, "page_id long, url string, html string")).withColumn("digest", F.lit("clash"))


def expected_pages(rows, least=0):
    keeper = defaultdict(list)
    for r in rows:
        keeper[r.html or ""].append(r.page_id)
    out = []
    for r in rows:
        data = (r.html or "").encode()
        ids = [i for i in keeper[r.html or ""] if i is not None]
        best = max(ids, default=None) if len(data) >= least and len(keeper[r.html or ""]) > 1 else r.page_id
        revisit = best is not None and best != r.page_id
        out.append((r.page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least, broadcast_rows, file_bytes", [(0, 1000, 1 << 28), (6, 0, 2000)])
def test_archives_round_trip(spark, least, broadcast_rows, file_bytes):
    table = pages(spark).repartition(4)
    folder = shared_path(spark, "test", "warc")
    files = warc.write_archives(table, folder, least, file_bytes=file_bytes, broadcast_rows=broadcast_rows)
    rows = table.select("page_id", "url", "html").collect()
    assert sum(r.records for r in files.collect()) == len(rows)
    runs = warc.capture_runs(files, folder, run_size=9)
    index = warc.merged_index(runs, size=20, stride=2)
    got = index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == expected_pages(rows, least)

    history = sorted(warc.histories(index).collect(), key=lambda r: r.position)
    keys = [warc._key(tuple(r[c] for c in warc.ORDER)) for r in history]
    assert [r.position for r in history] == list(range(len(rows))) and keys == sorted(keys)
    seen = Counter()
    for r in history:
        assert r.capture == seen[r.urlkey]
        seen[r.urlkey] += 1
    assert seen["org,example,same)/p?q=1"] == 60
    # every entry points at its record: one gzip member of the file
    where, root = warc.opened(folder)
    for r in history[::7]:
        with where.open_input_file(f"{root}/{r.file}") as f:
            data = gzip.decompress(f.read_at(r.length, r.offset))
        fields, block = warc.parsed(data)
        assert fields["warc-type"] == r.record_type and int(fields.get("page-id", -1)) == (-1 if r.page_id is None else r.page_id)
        if r.record_type == "response":
            assert len(block.partition(b"\r\n\r\n")[2]) == r.payload_bytes
    warc.removed(folder)


def test_archives_of_an_empty_table(spark):
    table = pages(spark).filter("false")
    index = warc.archived_pages(table, shared_path(spark, "test", "warc_none"))
    assert index.collect() == [] and warc.histories(index).collect() == []


def test_a_damaged_archive_is_refused():
    import io

    good = warc._member(warc.record(1, "u", warc.FIRST_DAY, b"payload", hashlib.sha1(b"payload").hexdigest(), None), 6)
    ((offset, length, data),) = warc.members(io.BytesIO(good))
    assert (offset, length) == (0, len(good))
    fields, block = warc.parsed(data)
    assert warc.capture(fields, block, "f", 0, length)[7:10] == ("response", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), 7)
    with pytest.raises(ValueError, match="damaged"):
        warc.capture(fields, block.replace(b"payload", b"payloae"), "f", 0, length)
    with pytest.raises(EOFError):
        list(warc.members(io.BytesIO(good[:-3])))
    with pytest.raises(zlib.error):
        list(warc.members(io.BytesIO(b"not gzip at all")))


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((rng.randrange(40), r) for _ in range(rng.randrange(12))) for r in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("HTTPS://User@WWW.Example.com:8443/A?b=1#c") == "com,example,www)/A?b=1"
    assert warc.url_key("//h.org") == "org,h)/" and warc.url_key("") == "" and warc.url_key("no url") == "no url"
    long = warc.url_key("http://h.org/" + "x" * 5000)
    assert len(long) == warc.KEY_CHARS and long != warc.url_key("http://h.org/" + "x" * 5001)
