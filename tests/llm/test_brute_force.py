"""The trained models' arithmetic against plain loops: statistics and trees (op1), convolution and
pooling (op3), n-grams and filters (op8)."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa

from venuelens.llm import boosting, language_id, quality_classifier, toxicity
from venuelens.llm.textbytes import text_buffer

TEXTS = [
    "", "a", "Re.", "One two  three\ttwo three\nTWO #* 12|{x}!", "wieder und wieder und wieder, größer!", "x" * 20 + " y z y z y z y", " \n ",
    "Das ist gut; das ist gut. 3,5 & 7 <b>", None, "日本語 テキスト é",
]


def buffers():
    return text_buffer(pa.array(TEXTS))


def blank_words(text):
    out, word = [], ""
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + ([word] if word else [])


def test_statistics_by_plain_counting():
    got = quality_classifier.statistics(*buffers())
    for row, text in zip(got, [t or "" for t in TEXTS], strict=True):
        data, words = text.encode(), [w.encode() for w in blank_words(text)]
        count = lambda chars: sum(data.count(c.encode()) for c in chars)  # noqa: B023, E731
        n, points = max(len(words), 1), max(len(text), 1)
        upper, lower = sum(65 <= b <= 90 for b in data), sum(97 <= b <= 122 for b in data)
        wide, breaks = sum(b >= 128 for b in data), data.count(b"\n")
        letters = max(upper + lower + wide, 1)
        sizes = [len(w) for w in words]
        mean = sum(sizes) / n
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        again = lambda items: len(items) - len(set(items))
        shared = lambda items: sum(1 for x in items if items.count(x) > 1)
        symbols, bangs = count("#*$%&|<>~^=+_@\\"), count("!?")
        want = [
            math.log1p(len(text)), math.log1p(len(words)), mean, math.sqrt(max(sum(s * s for s in sizes) / n - mean**2, 0)),
            symbols / points, upper / letters, count("0123456789") / points, count(".,;:") / points, bangs / points, count("|") / points,
            count("{}[]()/\"'") / points, count(" \t\n\r") / points, wide / letters, breaks / n, len(words) / (breaks + 1),
            again(words) / n, shared(words) / n, again(grams) / max(len(grams), 1), shared(grams) / max(len(grams), 1),
            sum(s <= 1 for s in sizes) / n, sum(s >= 16 for s in sizes) / n, symbols / n, bangs / n, upper / n,
        ]
        assert np.allclose(row, want), text


def test_flat_trees_equal_a_walk_from_the_root():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = boosting.fit(x, y, trees=6, depth=3)
    for row, margin in zip(x, model.margin(x), strict=True):
        total = model.base
        for f, t, v in zip(model.feature, model.threshold, model.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += v[node - len(f)]
        assert abs(total - margin) < 1e-9


def test_first_split_is_the_best_of_all():
    """The root of the first tree against the gain of every cut of every feature."""
    rng = np.random.default_rng(9)
    x = rng.integers(0, 12, (200, 3)).astype(float)
    y = (x[:, 1] > 6).astype(float)
    y[:20] = 1 - y[:20]
    model = boosting.fit(x, y, trees=1, depth=1, shrink=1.0, min_rows=5)
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))
    gains = {}
    for j in range(3):
        for cut in np.unique(x[:, j]):
            left = x[:, j] <= cut
            if 5 <= left.sum() <= len(y) - 5:
                gains[j, cut] = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left))
    best = max(gains, key=gains.get)
    cut = model.threshold[0, 0]
    assert model.feature[0, 0] == best[0] == 1 and (x[:, 1] <= cut).sum() == (x[:, 1] <= best[1]).sum()


def test_convolution_and_pooling_by_loops():
    rng = np.random.default_rng(7)
    size = len(toxicity.WIDTHS) * toxicity.FILTERS
    filters = {w: rng.normal(0, 1, (w, toxicity.DIMENSIONS, toxicity.FILTERS)) for w in toxicity.WIDTHS}
    embed = rng.normal(0, 1, (toxicity.BUCKETS, toxicity.DIMENSIONS))
    net = toxicity.Network(embed, filters, rng.normal(0, 0.3, size), rng.normal(0, 1, size), 0.1, np.full(5, 0.5))
    data, offs = buffers()
    pieces, first, _ = toxicity.tokens(data, offs)
    vectors = toxicity.embedded(embed, pieces)
    got, _ = toxicity.pool(net, vectors, first)
    probability = toxicity.probability(net, embed, pieces, first)
    for i in range(len(TEXTS)):
        own = [sum(embed[p] for p in pieces[t]) for t in range(first[i], first[i + 1])]
        features = []
        for k, w in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                responses = [sum(own[t + j] @ filters[w][j][:, f] for j in range(w)) for t in range(len(own) - w + 1)]
                features.append(max(max(responses) + net.bias[k * toxicity.FILTERS + f], 0) if responses else 0.0)
        assert np.allclose(got[i], features, atol=1e-9)
        assert abs(probability[i] - 1 / (1 + math.exp(-(np.array(features) @ net.weight + net.offset)))) < 1e-9


def plain_grams(text):
    """Four bytes that hold at least one letter run's edge rule, by walking the words."""
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    clean = "".join(chr(b) if 97 <= b <= 122 or b >= 128 else " " for b in lowered)
    padded, out = f" {clean} ", []
    for i in range(len(padded) - 2):
        a, b, c = padded[i : i + 3]
        if b == " ":
            continue
        if c != " ":
            out.append(padded[i : i + 4].ljust(4))
        elif a == " ":
            out.append(a + b + "  ")
    return [int.from_bytes(bytes(ord(x) for x in g), "big") for g in out]


def test_grams_by_walking_the_text():
    packed, first = language_id.grams(*buffers())
    for i, text in enumerate(TEXTS):
        assert packed[first[i] : first[i + 1]].tolist() == plain_grams(text), text
    assert plain_grams("a") and plain_grams("Re.")  # words of one and two letters count


def test_filter_counts_against_sets():
    """Per-language counts are those of plain sets, and never fewer; false positives are as rare as stated."""
    rng = np.random.default_rng(3)
    grams = rng.integers(0, 2**32, 6000, dtype=np.uint64).astype(np.uint32)
    lang = rng.integers(0, 11, len(grams))
    filters = language_id.build([f"l{i}" for i in range(11)], lang, grams, 0)
    held = [Counter() for _ in range(11)]
    for g, l in zip(grams.tolist(), lang.tolist(), strict=True):
        held[l][g] += 1
    asked = np.concatenate([grams[:500], rng.integers(0, 2**32, 500, dtype=np.uint64).astype(np.uint32)])
    counts = filters.counts(asked, np.array([0, 500, 1000]))
    for l in range(11):
        exact = [sum(g in held[l] for g in part.tolist()) for part in (asked[:500], asked[500:])]
        assert all(c >= e for c, e in zip(counts[:, l], exact, strict=True))
        assert sum(counts[:, l]) - sum(exact) <= 5
    best, score = filters.decide(asked, np.array([0, 500, 1000, 1000]))
    assert best[2] == filters.default and score[2] == 0.0
