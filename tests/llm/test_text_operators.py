"""Operators on single texts against brute force, on real documents and hard cases."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from venuelens.llm import boosting, html_text, language_id, license_scan, quality_classifier, quality_rules, simhash, toxicity
from venuelens.llm.xxh64 import xxh64_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def keyed(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def rule_counts(text):
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_quality_rules_counts(docs):
    got = quality_rules.quality_rules(docs).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, chars, symbols, dup, repeat = rule_counts(r.text or "")
        want.append((r.doc_id, n, chars, symbols, dup, repeat, n < 50 or 100 * repeat > 50 * n))
    assert keyed([tuple(r)[:7] for r in got]) == keyed(want)
    assert not any(r.kept for r in got if r.base_failed)


def test_quality_rules_keep_whole_rows(docs):
    kept = quality_rules.keep_documents(docs)
    assert kept.columns == docs.columns
    good = Counter(r.doc_id for r in quality_rules.quality_rules(docs).collect() if r.kept)
    assert Counter(r.doc_id for r in kept.collect()) == good


def test_quality_rules_labels(many, labels):
    rows = quality_rules.quality_rules(many).join(labels, "doc_id").collect()
    long = [r for r in rows if not r.base_failed]
    assert np.mean([r.kept for r in long if r.quality == 1]) > 0.99
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.4


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    first = np.array([0, 1, 1, 5, 9])
    score, pair = rng.normal(size=9), rng.normal(size=(2, 2))
    got = quality_rules.viterbi(score, first, pair)
    for a, b in zip(first, first[1:], strict=False):
        def value(bits, a=a):
            y = [(bits >> t) & 1 for t in range(b - a)]
            return sum(score[a + t] * y[t] for t in range(b - a)) + sum(pair[y[t - 1], y[t]] for t in range(1, b - a))
        if b > a:
            best = max(range(1 << (b - a)), key=value)
            assert sum(int(got[a + t]) << t for t in range(b - a)) == best


def test_crf_gradient():
    rng = np.random.default_rng(2)
    x, y = [rng.normal(size=(4, 3))], [np.array([0, 1, 1, 0])]
    unary, pair = rng.normal(size=3), rng.normal(size=(2, 2))
    _, gu, gp = quality_rules.likelihood(x, y, unary, pair)
    step = np.zeros(3)
    step[1] = 1e-6
    up = quality_rules.likelihood(x, y, unary + step, pair)[0] - quality_rules.likelihood(x, y, unary - step, pair)[0]
    assert up / 2e-6 == pytest.approx(gu[1], rel=1e-4)
    turn = np.zeros((2, 2))
    turn[0, 1] = 1e-6
    up = quality_rules.likelihood(x, y, unary, pair + turn)[0] - quality_rules.likelihood(x, y, unary, pair - turn)[0]
    assert up / 2e-6 == pytest.approx(gp[0, 1], rel=1e-4)


def test_xxh64_matches_the_library():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 4000, dtype=np.uint8)
    starts = rng.integers(0, 3000, 300)
    ends = starts + rng.integers(0, 200, 300)
    ends[0] = starts[0] + 1000
    want = [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(starts, ends, strict=True)]
    assert xxh64_spans(data, starts, ends).tolist() == want


def simhash_of(text, k=3):
    w = WORD.findall(lower(text))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_match_brute_force(docs):
    got = keyed((r.doc_id, r.fp % 2**64) for r in simhash.fingerprints(docs).select("doc_id", "fp").collect())
    assert got == keyed((r.doc_id, simhash_of(r.text)) for r in docs.select("doc_id", "text").collect())


def places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    out = [(i, label) for label, p in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), out


def test_license_base_places(docs):
    got = license_scan.license_scan(docs).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, at = places(r.text)
        starts = [i for i, _ in at]
        want.append((r.doc_id, n, len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))))
    assert keyed((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == keyed(want)


def test_license_texts_with_edits(spark):
    bsd = dict(license_scan.TEXTS)["bsd"].split()
    edited = " ".join(bsd[:10] + ["EXTRA"] + bsd[10:20] + bsd[21:])
    rows = [(1, "intro " + edited + " end"), (2, " ".join(bsd[:8])), (3, "cc by cc-by CC  BY"), (4, "the gnu general public"), (5, " ".join(bsd) + " and " + " ".join(bsd))]
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[1].base_labels, got[1].n_spans) == ("bsd", "", 1)
    assert got[2].labels == "" and 0 < got[2].score < license_scan.MIN_COVERAGE
    assert (got[3].n_base, got[3].first_word, got[3].last_word, got[3].score) == (3, 0, 4, 1.0)
    assert (got[4].labels, got[4].score) == ("", 0.0)
    assert got[5].n_spans == 2


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = boosting.fit(x[:1500], y[:1500], trees=60)
    assert ((model.probability(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95
    assert boosting.fit(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]


def test_quality_classifier_held_out(many, labels):
    rows = quality_classifier.quality_classifier(many, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.toxicity(spark.read.parquet(f"{d}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.8
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.03


def test_toxicity_cutoffs_count_every_labelled_row(spark):
    # 0: many rows, best cut 0.65; 1: eight toxic rows at 0.3, clean ones at 0.1, all beyond a sample of one
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1][:1016]
    rows = [(i, 0.9 if n % 2 else 0.4, 0, n % 2) for n, i in enumerate(ids[:1000])]
    rows += [(i, 0.3 if n % 2 else 0.1, 1, n % 2) for n, i in enumerate(ids[1000:])]
    table = spark.createDataFrame(rows, "doc_id long, raw double, part int, toxic int")
    cuts = toxicity.cutoffs(table.drop("toxic"), table.select("doc_id", "toxic"), sample_rows=1)
    assert 0.3 < cuts[1] < cuts[0] and abs(cuts[0] - 0.65) < 0.02
    assert cuts[2] == cuts[3] == cuts[4]  # no labelled row: the cut-off of all languages
    # eight rows against twenty, twice: 8/28 of the way to 0.2, then again
    want = cuts[2]
    for _ in range(2):
        want = (8 * 0.2 + 20 * want) / 28
    assert abs(cuts[1] - want) < 0.01


def test_toxicity_calibrates_a_rare_language(spark):
    d = "/root/testdata/sf0.1"
    net = toxicity.fit_toxicity(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    assert len(set(net.cuts[:4].tolist())) == 4 and net.cuts[3] != net.cuts[4]  # es has 21 toxic rows


def test_toxicity_sample_is_not_cut(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(toxicity, "train", lambda *args: drawn.append(len(args[-1])))
    docs = spark.range(30_000).selectExpr("id as doc_id", "'a few words' as text")
    toxicity.fit_toxicity(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    assert drawn == [8_000]


def test_classifiers_on_hard_rows(docs, many, labels):
    model = quality_classifier.fit_quality(many, labels)
    net = toxicity.fit_toxicity(many, labels)
    for scored in (quality_classifier.quality_scores(docs, model), toxicity.toxicity_scores(docs, net)):
        rows = scored.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (900001, 900002)}) == 1  # null and empty texts alike
    assert quality_classifier.keep_good(docs, model).columns == docs.columns


def test_language_held_out(many):
    rows = language_id.language_id(many).join(many.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_language_filters_return_every_language():
    grams = np.arange(2000, dtype=np.uint32) * 7919
    lang = np.arange(2000) % 70  # more languages than one word of a mask holds
    model = language_id.build([f"l{i:02}" for i in range(70)], lang, grams, 0)
    for i in (0, 5, 69, 1999):
        counts = model.counts(grams[i : i + 1], np.array([0, 1]))
        assert counts[0, lang[i]] == 1
    assert model.false_rate.max() < 0.01


def test_language_hard_rows(docs, many):
    got = language_id.language_scores(docs, language_id.fit_language(many)).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id in (900001, 900002, 900007):
            assert (r.lang_pred, r.score) == ("und", 0.0)


def test_empty_tables(empty, labels, spark):
    assert quality_rules.quality_rules(empty).count() == 0
    assert license_scan.license_scan(empty).count() == 0
    assert quality_classifier.quality_classifier(empty, labels).count() == 0
    assert toxicity.toxicity(empty, labels).count() == 0
    assert language_id.language_id(empty).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).count() == 0


PAGES = [
    (None, ""),
    ("", ""),
    ("<p>unclosed <b>words here that stand in one long enough sentence.<br>more", "unclosed words here that stand in one long enough sentence. more"),
    ("<article><p>a &amp; b&nbsp;c &lt;d&gt;</p><!-- <p>no</p> --><script>x='</p>'</script><p>e", "a & b c <d>\ne"),
    ("<article><p>one</p><div class='comments'><p>Anna: what a very good text this is, thank you.</p></div><p>two</p></article>", "one\ntwo"),
    ("<nav><a href='/'>x</a></nav><article><h1>T</h1><p>1 < 2 and <a href='/a'>3</a></p></article><footer>f</footer>", "T\n1 < 2 and 3"),
    ("<article><p>text</p><form><input><button>Send</button> your mail</form><aside>see also</aside></article", "text"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_pages_give_their_articles(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", body)]
        want = "\n".join(x for x in parts if x)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


def test_blocks_cover_batches():
    from venuelens.llm.textbytes import blocks, text_buffer

    column = pa.array(["ab", None, "c" * 50, "", "de"])
    data, offs = text_buffer(column)
    assert offs.tolist() == [0, 2, 2, 52, 52, 54]
    spans = list(blocks(offs, 10))
    assert spans[0][0] == 0 and spans[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


RISE = "The river rose slowly through the night and covered the lower fields by morning, and people moved their cattle to the hills."
MILL = "Nobody was hurt, but the mill lost its wheel and two barns were carried away to the sea before the boats could reach them."


@pytest.mark.parametrize("page, want", [
    (f"<div><p>Rain fell.</p><p>{RISE}</p><p>Quiet night</p><p>{MILL}</p></div>", f"Rain fell.\n{RISE}\nQuiet night\n{MILL}"),
    (f'<div class="post"><div class="post-header"><h1>Flood</h1></div><p>{RISE}</p><ul><li>two barns</li><li>one mill</li></ul><p>{MILL}</p></div>',
     f"Flood\n{RISE}\ntwo barns\none mill\n{MILL}"),
    (f'<form action="/x"><div><a href="/">Home</a></div><h1>Old page</h1><p>{RISE}</p><p>{MILL}</p></form>', f"Old page\n{RISE}\n{MILL}"),
    (f'<div class="widget-area"><h2>Title here</h2><p>{RISE}</p><p>{MILL}</p></div>', f"Title here\n{RISE}\n{MILL}"),
    (f"<ul><li>Home</li><li>Shop</li></ul><h1>Flood</h1><p>{RISE}</p><p>{MILL}</p><p>Print</p><p>Top</p>", f"Flood\n{RISE}\n{MILL}"),
    (f'<div><p>{RISE}</p><p>{MILL}</p></div><div class="comments"><h3>Comments</h3><p>{MILL}</p></div>', f"{RISE}\n{MILL}"),
])
def test_main_text_without_an_article_element(page, want):
    assert html_text.main_text(page) == want


def test_the_tree_asks_for_neighbours():
    def asked(tree):
        return set() if len(tree) == 1 else {html_text.FEATURES[tree[0]]} | asked(tree[2]) | asked(tree[3])

    names = asked(html_text.fitted())
    assert names & {"longest of three before", "longest of three after"}
    assert names & {"words before", "words after", "link density before", "link density after"}
    unmarked = [b for line in html_text.LAYOUTS.split("\n") for b in html_text.layout(line)[0] if not b.furniture and not b.body]
    assert len(unmarked) > 250


def test_features_of_neighbours_by_hand():
    blocks = [html_text.Block("a", w, l, f, False, False) for w, l, f in ((1, 1, False), (30, 0, False), (5, 0, True), (2, 0, False), (8, 4, False))]
    x = html_text.features(blocks)
    assert x[3].tolist() == [2, 0, 0, 0, 8, 0.5, 30, 4, 0, 0, 0, 0]  # furniture beside it counts as nothing
    assert x[0].tolist() == [1, 1, 0, 0, 30, 0, 0, 30, 0, 0, 0, 0]
    assert x[2][8] == 1 and html_text.features([]).shape == (0, len(html_text.FEATURES))
