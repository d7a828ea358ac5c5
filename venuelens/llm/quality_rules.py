"""Quality rules: line sequence labelling with a linear-chain conditional random field.

Each line that holds a word is labelled content or boilerplate by Viterbi decoding over line
features (length, symbols, case, repetition, punctuation); a document is kept when enough of its
words stand in content lines and the base rules (length, repetition) hold. The field is trained
here, on the small table of labelled lines below, by gradient ascent on its exact likelihood.

Defined cases: a null or empty text has no words, fails the length rule and is not kept; a text of
one very long line is labelled like any other line; repeated rows get equal results, each its own
row; an empty table gives an empty result; other columns of the input are not read and not returned.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import filtered
from .textbytes import (
    CODE_POINT, SPACE_WORD, each_block, gram_hashes, map_rows, repeated_in_row, rows_of, span_hashes, sums, words,
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
LONG_LINE = 24  # words; the labelled lines are no longer, so length counts no further

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"
)

# Labelled lines, one document per entry: "+" content, "-" boilerplate.
LABELLED = [
    ["+The river rose slowly through the night and by morning it had covered the lower fields, as it had in other years.",
     "+Nobody in the village was surprised. They moved the animals to the hill and waited for the water to fall.",
     "+Rain."],
    ["-Home | About | Products | Contact | Login", "-Sign up | Share | Print | Email",
     "+The committee met on the second day to discuss the results of the survey and agreed to publish them in full.",
     "+Several members asked for more time. The chair refused, since the law sets a fixed date for the report.",
     "-Copyright 2020 | Terms | Privacy | Cookies"],
    ["-CLICK HERE!! BUY NOW!! FREE!! CLICK HERE!! BUY NOW!! FREE!! CLICK HERE!!", "-WIN!! WIN!! WIN!! WIN!! WIN!!",
     "-ORDER TODAY!! ORDER TODAY!! ORDER TODAY!!"],
    ["+Le conseil a examiné la proposition avec soin, et la plupart des membres ont voté pour le texte.",
     "+Il reste à savoir comment la mesure sera appliquée dans les communes les plus petites.", "+Fin.",
     "-Accueil | Boutique | Panier | Compte"],
    ["+Die Stadt hat den alten Markt wieder geöffnet, und viele Menschen sind am ersten Tag gekommen.",
     "+Der Bau hat länger gedauert als geplant, weil das Dach ersetzt werden musste.",
     "-Start | Suche | Hilfe | Impressum", "-Start | Suche | Hilfe | Impressum"],
    ["+La escuela abrió sus puertas en otoño, con más alumnos que nunca y con muy pocos maestros.",
     "+Los padres pidieron ayuda al gobierno, que prometió enviar a dos personas antes del invierno.", "+Nada más."],
    ["-fa$$$ te%%% ro&&& ki### mo*** la$$$ se%%% du&&& ne### po***", "-ta### vi%%% ol$$$ re&&& su*** be###",
     "-ge$$$ lo&&& wa%%% in### zu***", "-a$$$ en%%% il&&&"],
    ["+Vapour condenses on the cold glass and runs down in small drops. It is collected in a tray below.",
     "-menu", "-menu", "-menu", "-next page", "-next page",
     "+The tray is emptied each evening, and its contents are weighed before they are thrown away."],
    ["-1204 5530 9921 0033 1200 4411 0092", "-2210 9981 1200 3321 0041 2234 9911", "-9910 0022 1123 0094 4412",
     "-5512 0093 8821 2203"],
    ["+In 1998 the company sold 42 boats, a third more than in 1997, and hired 12 people.",
     "+Two years later it closed. The yard was empty until 2005."],
    ["-READ MORE", "-SHARE THIS", "+A short note on how the measure was chosen follows, with one example for each case.",
     "-READ MORE", "-SHARE THIS"],
    ["+Yes.", "+He opened the box, looked at the letters, and put them back without a word to anyone in the room.", "+No.",
     "+She had read them already, years before, and had never told him what was in them or who had sent them."],
    ["-item | price | item | price | item | price", "-one | two | three | four | five | six | seven | eight",
     "-red | green | blue | white | black"],
    ["-SUBSCRIBE!! SUBSCRIBE!! SUBSCRIBE!!", "+The engine turns a shaft that drives both pumps, so that neither can run while the other stands still.",
     "+This was thought to be safer. It also made repairs more difficult, and the second version has two shafts.",
     "-### *** $$$ ### *** $$$"],
    ["-buy cheap pills buy cheap pills buy cheap pills buy cheap pills buy cheap pills",
     "-best price best price best price best price best price best price", "-buy cheap pills buy cheap pills buy cheap pills"],
    ["-Ra*** lo$$$ the%%% mi.### Ta&&& no*** of$$$ li%%% se,### du&&& ka*** ro$$$ and%%% pe.", "-De%%% sul*** mit$$$ an.",
     "-Kel### und$$$ fa%%% in&&& zu.*** Por&&& sa$$$ le%%% mu."],
    ["-Lorn | mest | hila. | Rund | tove, | sime | paltra | gend | ofis. | Kan | derl.", "-This. | Oltre | manis, | pove.",
     "-Arte | und | lim. | Sol | gavet | merin, | tul | nossa | brid."],
    ["+The first part of the talk was about the sea and the ships that used to cross it",
     "+and the second about the towns from which they came and the goods they carried with them",
     "+nothing was said about the war"],
    ["+The prices of the season are given below, by kind and by place of sale.",
     "-Apples | pears, | plums | cherries. | walnuts | hazel | quince, | medlar | grapes | figs | dates. | melons |",
     "+Prices rose in the second half of the year and fell again before the winter.",
     "-North | south, | east | west. | coast | hills | market, | harbour | station | bridge.",
     "+No figures were given for the islands."],
    ["+Les noms des rues ont changé deux fois au cours du siècle", "+La place est restée la même.",
     "+On y vend encore du pain le matin, du poisson à midi et des fleurs le soir"],
]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".?!:;"]] = True


def analyse(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Per row the base counts, and per line with a word its features; ``line_first`` is the
    index of each row's first such line."""
    starts, ends, first = words(data, offsets, SPACE_WORD)
    rows, n_words = rows_of(first), np.diff(first)
    points = np.concatenate([[0], np.cumsum(CODE_POINT[data])])
    hashes = span_hashes(data, starts, ends)
    grams, gram_first = gram_hashes(hashes, first, 3)
    twice, _ = repeated_in_row(grams, rows_of(gram_first))
    repeat = np.zeros(len(starts) + 1, np.int64)
    at = first[:-1][rows_of(gram_first)[twice]] + (np.flatnonzero(twice) - gram_first[:-1][rows_of(gram_first)[twice]])
    np.add.at(repeat, at, 1)
    np.add.at(repeat, at + 3, -1)
    repeated = np.cumsum(repeat)[:-1] > 0

    # lines: a row of n newlines has n + 1 of them
    breaks = np.flatnonzero(data == 0x0A)
    per_row = np.searchsorted(breaks, offsets, "left")
    line_rows = np.repeat(np.arange(len(offsets) - 1), np.diff(per_row) + 1)
    own = np.concatenate([[0], np.cumsum(np.diff(per_row) + 1)])
    line_starts, line_ends = np.empty(len(line_rows), np.int64), np.empty(len(line_rows), np.int64)
    heads = own[:-1]
    not_head = np.ones(len(line_rows), bool)
    not_head[heads] = False
    line_starts[heads] = offsets[:-1]
    line_starts[not_head] = breaks + 1
    not_tail = np.ones(len(line_rows), bool)
    not_tail[own[1:] - 1] = False
    line_ends[own[1:] - 1] = offsets[1:]
    line_ends[not_tail] = breaks
    word_a, word_b = np.searchsorted(starts, line_starts, "left"), np.searchsorted(starts, line_ends, "left")
    full = word_b > word_a
    line_starts, line_ends, line_rows, word_a, word_b = (x[full] for x in (line_starts, line_ends, line_rows, word_a, word_b))
    _, later = repeated_in_row(span_hashes(data, line_starts, line_ends), line_rows)
    line_first = np.searchsorted(line_rows, np.arange(len(offsets)), "left")

    count = lambda table: np.concatenate([[0], np.cumsum(table[data])])
    within = lambda run, a, b: (run[b] - run[a]).astype(float)
    chars = within(points, line_starts, line_ends)
    letters = within(count(_LETTER), line_starts, line_ends)
    n = (word_b - word_a).astype(float)
    covered = np.concatenate([[0], np.cumsum(repeated)])
    bangs = np.concatenate([[0], np.cumsum(data == 0x21)])
    pipes = np.concatenate([[0], np.cumsum(data == 0x7C)])
    symbols = count(_SYMBOL)
    features = np.column_stack([
        np.ones(len(n)),
        np.log1p(np.minimum(n, LONG_LINE)),
        n <= 4,
        np.minimum(within(symbols, line_starts, line_ends) / chars, 0.5) * 4,
        within(count(_UPPER), line_starts, line_ends) / np.maximum(letters, 1),
        within(count(_DIGIT), line_starts, line_ends) / chars,
        later,
        (covered[word_b] - covered[word_a]) / n,
        _STOP[data[ends[word_b - 1] - 1]] if len(n) else np.zeros(0),
        np.minimum(within(pipes, line_starts, line_ends) / n, 1),
        np.minimum(within(bangs, line_starts, line_ends) / n, 1),
    ]).astype(float)
    word_points = (points[ends] - points[starts]).astype(np.int64)
    return {
        "n_words": n_words,
        "word_chars": sums(word_points, first),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": sums(later.astype(np.int64), line_first),
        "n_repeat_words": sums(repeated.astype(np.int64), first),
        "features": features,
        "line_words": n.astype(np.int64),
        "line_first": line_first,
    }


def likelihood(features: list[np.ndarray], labels: list[np.ndarray], unary: np.ndarray, pair: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood of label sequences (0 or 1) and its gradients, by forward and backward sums.
    ``unary``: weights of label 1 against 0; ``pair[i, j]``: score of label j after label i."""
    total, g_unary, g_pair = 0.0, np.zeros_like(unary), np.zeros_like(pair)
    for x, y in zip(features, labels, strict=True):
        score = np.column_stack([np.zeros(len(x)), x @ unary])
        fore, back = np.empty_like(score), np.zeros_like(score)
        fore[0] = score[0]
        for t in range(1, len(x)):
            fore[t] = score[t] + np.logaddexp(fore[t - 1, 0] + pair[0], fore[t - 1, 1] + pair[1])
        for t in range(len(x) - 2, -1, -1):
            step = pair + score[t + 1] + back[t + 1]
            back[t] = np.logaddexp(step[:, 0], step[:, 1])
        z = np.logaddexp(*fore[-1])
        total += score[np.arange(len(x)), y].sum() + pair[y[:-1], y[1:]].sum() - z
        g_unary += x.T @ (y - np.exp(fore[:, 1] + back[:, 1] - z))
        for t in range(1, len(x)):
            g_pair[y[t - 1], y[t]] += 1
            g_pair -= np.exp(fore[t - 1][:, None] + pair + score[t] + back[t] - z)
    return total, g_unary, g_pair


@lru_cache(maxsize=1)
def fitted(steps: int = 400, rate: float = 0.05, shrink: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights trained on LABELLED: penalised likelihood, ``steps`` of adaptive gradient ascent."""
    texts = ["\n".join(line[1:] for line in doc) for doc in LABELLED]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = analyse(data, offsets)
    x = [got["features"][a:b] for a, b in zip(got["line_first"][:-1], got["line_first"][1:], strict=True)]
    y = [np.array([line[0] == "+" for line in doc], int) for doc in LABELLED]
    weights = np.zeros(x[0].shape[1] + 4)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, steps + 1):
        _, gu, gp = likelihood(x, y, weights[:-4], weights[-4:].reshape(2, 2))
        g = np.concatenate([gu, gp.ravel()]) - shrink * weights
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        weights = weights + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return weights[:-4], weights[-4:].reshape(2, 2)


def viterbi(score: np.ndarray, first: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Best label (0 or 1) of each line; ``score``: of label 1 against 0. All rows advance together,
    one line per step, so the number of steps is that of the longest row."""
    n = np.diff(first)
    labels = np.zeros(len(score), np.int8)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    at, lengths = first[:-1][order], n[order]
    if not len(order):
        return labels
    best = np.column_stack([np.zeros(len(order)), score[at]])
    came = np.zeros((len(score), 2), np.int8)
    last = np.empty(len(order), np.int8)
    live = len(order)
    for t in range(1, int(lengths[0]) + 1):
        still = int(np.searchsorted(-lengths, -t, "left"))  # rows with more than t lines
        last[still:live] = best[still:live, 1] >= best[still:live, 0]
        live = still
        if not live:
            break
        from_0, from_1 = best[:live, 0, None] + pair[0], best[:live, 1, None] + pair[1]
        came[at[:live] + t] = from_1 >= from_0
        best = np.maximum(from_0, from_1)
        best[:, 1] += score[at[:live] + t]
    for t in range(int(lengths[0]) - 1, -1, -1):
        live = int(np.searchsorted(-lengths, -t, "left"))
        labels[at[:live] + t] = last[:live]
        if t:
            last[:live] = came[at[:live] + t, last[:live]]
    return labels


def judge(data: np.ndarray, offsets: np.ndarray, min_share: float = MIN_CONTENT_SHARE) -> dict[str, np.ndarray]:
    """Base counts, content share and verdict of each row."""
    unary, pair = fitted()
    got = analyse(data, offsets)
    labels = viterbi(got["features"] @ unary, got["line_first"], pair)
    n = got["n_words"]
    content = sums(labels * got["line_words"], got["line_first"])
    share = content / np.maximum(n, 1)
    failed = (n < MIN_WORDS) | (100 * got["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    return {k: got[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")} | {
        "base_failed": failed,
        "kept": ~failed & (share >= min_share),
        "n_lines": np.diff(got["line_first"]),
        "n_content_lines": sums(labels.astype(np.int64), got["line_first"]),
        "content_share": share,
    }


def _verdicts(column: pa.Array, min_share: float) -> dict[str, np.ndarray]:
    parts = [judge(data, offs, min_share) for _, _, data, offs in each_block(column)]
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def quality_rules(docs: DataFrame, min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """One verdict row per row of ``docs`` (doc_id, text); see SCHEMA."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = _verdicts(batch.column(1), min_share)
        ids = batch.column(0).cast(pa.int64())
        return pa.RecordBatch.from_arrays([ids, *(pa.array(v) for v in got.values())], names=["doc_id", *got])

    return docs.select("doc_id", "text").mapInArrow(map_rows(run), SCHEMA)


def keep_documents(docs: DataFrame, min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return filtered(docs, lambda column: _verdicts(column, min_share)["kept"])
