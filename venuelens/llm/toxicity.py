"""Toxicity: a small convolutional text classifier, trained here in numpy.

Words are hashed into an embedding table, each as the sum of the vectors of the whole word and of
its beginnings (inflected and compound forms of a word share those); filters of several widths
slide over the embedded words, each filter keeps its largest response in the text (max pooling),
and a logistic layer reads the maxima. One embedding dimension starts from the bucket's log-odds in
one half of the training sample and the network is trained on the other half, so the start does not
reveal its own labels.

Raw probabilities are mapped to scores so that 0.7 is the cut-off for the language of the text
(English, German, French, Spanish, or none of them), guessed from the text's own function words,
never read from a column. The training sample is bounded twice: ``sample_rows`` labelled ids in a
fixed hash order, of which the first are taken that have ``sample_words`` words together; it is hashed
on the workers, and only buckets come to the driver, 24 bytes a word. The cut-offs come from the scores of every labelled row outside the held fold, counted
by bins on Spark. A language's cut-off is drawn towards that of all languages, the more the fewer
toxic rows it has; rows the network was not trained on draw it from there to their own. Scoring reads whole texts once and shuffles ids and raw scores only.

Defined cases: a null or empty text has no responses and gets the score of the bias alone; repeated
rows get equal scores, each its own row; with no labelled rows, or with one class, all scores are 0
(nothing is known to be toxic); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bounded_sample, cut, known_labels, labelled_sample, with_fold
from .textbytes import ALNUM_WORD, SpanHasher, each_block, mix, rows_of, span_hashes, words

SAMPLE_ROWS = 8_000
SAMPLE_WORDS = 4_000_000
PARTS, HELD, THRESHOLD = 3, 1, 0.7
BUCKETS, DIMENSIONS, WIDTHS, FILTERS = 1 << 18, 8, (1, 2, 3), 8
PREFIXES = (4, 5, 6, 7, 8)  # bytes
BINS, LIMIT = 2000, 10.0  # bins of the log-odds of raw probabilities, between -LIMIT and LIMIT
EDGES = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, BINS + 1)))

# Function words by which the calibration group of a text is guessed.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on be by this are from at or an which you not",
    "de": "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an werden aus er",
    "fr": "le la les de des et un une du en que est pour qui dans par sur pas plus ne se au ce avec",
    "es": "el la los las de y que en un una del se por con para es no lo al como su mas o",
}


def _group_table() -> np.ndarray:
    """Weight of each bucket of a 16-bit word hash for each language."""
    out = np.zeros((1 << 16, len(FUNCTION_WORDS)), np.float32)
    for j, text in enumerate(FUNCTION_WORDS.values()):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = words(data, np.array([0, len(data)]), ALNUM_WORD)
        out[(span_hashes(data, starts, ends) >> np.uint64(48)).astype(np.int64), j] = 1
    return out


GROUPS = _group_table()


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pieces, first, language group) of a block of lower-cased texts. ``pieces``: buckets of each
    word and its beginnings, bucket 0 (whose vector stays zero) where the word is no longer."""
    starts, ends, first = words(data, offsets, ALNUM_WORD)
    hasher = SpanHasher(data)
    hashes = hasher(starts, ends)
    pieces = np.zeros((len(starts), 1 + len(PREFIXES)), np.int32)
    fit_in = lambda h: (1 + h % np.uint64(BUCKETS - 1)).astype(np.int32)
    pieces[:, 0] = fit_in(hashes)
    for k, size in enumerate(PREFIXES):
        longer = np.flatnonzero(ends - starts > size)
        pieces[longer, k + 1] = fit_in(mix(hasher(starts[longer], starts[longer] + size) + np.uint64(1)))
    high = (hashes >> np.uint64(48)).astype(np.int64)
    known = np.flatnonzero(GROUPS.any(axis=1)[high])
    votes = np.zeros((len(offsets) - 1, GROUPS.shape[1]))
    np.add.at(votes, rows_of(first)[known], GROUPS[high[known]])
    # no function word: a group of its own
    group = np.where(votes.sum(axis=1) > 0, votes.argmax(axis=1), GROUPS.shape[1])
    return pieces, first, group


@dataclass
class Network:
    embed: np.ndarray  # (buckets, dimensions)
    filters: dict[int, np.ndarray]  # width -> (width, dimensions, filters)
    bias: np.ndarray  # (widths * filters,)
    weight: np.ndarray
    offset: float
    cuts: np.ndarray  # best cut-off of the raw probability, per language group

    def matrix(self) -> np.ndarray:
        """All filters side by side, one column block per place: (dimensions, sum of widths * filters)."""
        return np.concatenate([f[j] for f in self.filters.values() for j in range(len(f))], axis=1)


def embedded(embed: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    out = embed[pieces[:, 0]]
    for k in range(1, pieces.shape[1]):
        out = out + embed[pieces[:, k]]
    return out


def pool(net: Network, vectors: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list]:
    """Largest response of each filter in each row after the rectifier (rows, filters), and the
    windows that gave them."""
    n, size = len(first) - 1, FILTERS
    product = vectors @ net.matrix().astype(vectors.dtype)
    out, places, column = np.zeros((n, len(WIDTHS) * size), vectors.dtype), [], 0
    for k, w in enumerate(net.filters):
        counts = np.maximum(np.diff(first) - (w - 1), 0)
        begin = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], counts)
        response = product[at, column : column + size]
        for j in range(1, w):
            response += product[at + j, column + j * size : column + (j + 1) * size]
        full = np.flatnonzero(counts)
        if len(full):  # a text shorter than the filter has no response
            best = np.maximum.reduceat(response, begin[full], axis=0) + net.bias[k * size : (k + 1) * size].astype(vectors.dtype)
            out[full, k * size : (k + 1) * size] = np.maximum(best, 0)
        places.append((at, begin, counts, response))
        column += w * size
    return out, places


def probability(net: Network, embed: np.ndarray, pieces: np.ndarray, first: np.ndarray) -> np.ndarray:
    features, _ = pool(net, embedded(embed, pieces), first)
    return 1 / (1 + np.exp(-(features.astype(float) @ net.weight + net.offset)))


def calibrated(cuts: np.ndarray) -> Column:
    """Raw probabilities stretched so that each group's cut-off lands on THRESHOLD."""
    raw, t = F.col("raw"), F.element_at(F.array(*(F.lit(float(x)) for x in cuts)), F.col("part") + 1)
    below = F.least(THRESHOLD * raw / t, F.lit(float(np.nextafter(THRESHOLD, 0))))
    above = F.lit(THRESHOLD) + (1 - THRESHOLD) * (raw - t) / (1 - t)
    return F.greatest(F.least(F.when(raw < t, below).otherwise(above), F.lit(1.0)), F.lit(0.0))


def _toward(counts: np.ndarray, base: float, prior: float) -> float:
    """Cut-off of the largest F1 over (label, bin) counts, in the middle of the gap it falls in; it
    weighs as its toxic rows do against ``prior`` rows of ``base``."""
    positive = counts[1].sum()
    if not positive:
        return base
    full = np.flatnonzero(counts.sum(axis=0))[::-1]
    f1 = 2 * np.cumsum(counts[1][full]) / (np.cumsum(counts.sum(axis=0)[full]) + positive)
    k = int(f1.argmax())
    low = EDGES[full[k + 1] + 1] if k + 1 < len(full) else 0.0
    own = np.clip((EDGES[full[k]] + low) / 2, 1e-4, 1 - 1e-4)
    return float((positive * own + prior * base) / (positive + prior))


def _in_half() -> Column:
    """Whether an id of the sample gives the starting log-odds; the others train."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0


def cutoffs(raw: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS, prior: float = 20.0) -> np.ndarray:
    """Cut-off of each language group from (doc_id, raw, part) of every labelled id outside the held
    fold; rows repeated under one id count once."""
    known = known_labels(labels, label, PARTS, HELD)
    drawn = bounded_sample(known, "doc_id", sample_rows).filter(~_in_half()).select("doc_id", F.lit(0).alias("fresh"))
    odds = F.least(F.greatest(F.col("row.raw"), F.lit(1e-9)), F.lit(1 - 1e-9))
    place = F.floor((F.log(odds / (1 - odds)) + LIMIT) / (2 * LIMIT) * BINS)
    rows = (
        raw.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.struct("raw", "part")).alias("row"))
        .join(known, "doc_id")
        .join(F.broadcast(drawn), "doc_id", "left")
        .groupBy(
            F.coalesce("fresh", F.lit(1)).alias("fresh"), F.col("row.part").alias("part"), (F.col("__label") > 0).cast("int").alias("label"),
            F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)).alias("bin"),
        )
        .count()
        .collect()
    )
    counts = np.zeros((2, len(FUNCTION_WORDS) + 1, 2, BINS))
    for r in rows:
        counts[r.fresh, r.part, r.label, r.bin] = r["count"]
    everyone = _toward(counts.sum(axis=(0, 1)), 0.5, 0)
    everyone = _toward(counts[1].sum(axis=0), everyone, prior)
    return np.array([_toward(fresh, _toward(both, everyone, prior), prior) for fresh, both in zip(counts[1], counts.sum(axis=0), strict=True)])


def train(
    pieces: np.ndarray, first: np.ndarray, y: np.ndarray, half: np.ndarray,
    epochs: int = 12, batch: int = 64, rate: float = 0.01, shrink: float = 1e-4, seed: int = 5,
) -> Network | None:
    """Adam on the logistic loss; ``half``: rows that give the starting log-odds, the others train."""
    if not len(y) or y.min() == y.max() or y[half].sum() < 1 or y[~half].sum() < 1:
        return None
    rng = np.random.default_rng(seed)
    # rows that hold a bucket, by class, counted row by row: no array over all pieces is made
    counts = np.zeros((2, BUCKETS))
    for i in np.flatnonzero(half):
        counts[int(y[i])][np.unique(pieces[first[i] : first[i + 1]])] += 1
    c0, c1 = counts
    n1, n0 = y[half].sum(), (1 - y[half]).sum()
    odds = np.log((c1 + n1 / (n0 + n1)) / (n1 + 1)) - np.log((c0 + n0 / (n0 + n1)) / (n0 + 1))
    odds *= (c1 + c0) / (c1 + c0 + 3)  # rare buckets start near zero
    embed = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS))
    embed[:, 0] = np.clip(odds, -3, 3)
    embed[0] = 0
    filters = {w: rng.normal(0, 0.1, (w, DIMENSIONS, FILTERS)) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][:, 0, : FILTERS // 2] += 1 / w
    size = len(WIDTHS) * FILTERS
    net = Network(embed, filters, np.zeros(size), rng.normal(0, 0.1, size) + 0.2, float(np.log(y.mean() / (1 - y.mean()))), np.full(len(FUNCTION_WORDS) + 1, 0.5))
    names = [("f", w) for w in WIDTHS] + ["bias", "weight", "offset", "embed"]
    moment = {k: [0.0, 0.0] for k in names}
    tuned = np.flatnonzero(~half)
    # both classes weigh the same in the loss, or the few positives would be learned last
    cost = np.where(y == 1, 0.5 / y[tuned].mean(), 0.5 / (1 - y[tuned].mean()))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(tuned)
        speed = rate * (1 - epoch / epochs)
        for a in range(0, len(order), batch):
            rows_here = order[a : a + batch]
            spans = [np.arange(first[i], first[i + 1]) for i in rows_here]
            local = pieces[np.concatenate(spans)]
            local_first = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
            vectors = embedded(net.embed, local)
            features, places = pool(net, vectors, local_first)
            prob = 1 / (1 + np.exp(-(features @ net.weight + net.offset)))
            err = (prob - y[rows_here]) * cost[rows_here] / len(rows_here)
            grad: dict = {"weight": features.T @ err + shrink * net.weight, "offset": err.sum(), "bias": np.zeros(size)}
            g_vectors = np.zeros_like(vectors)
            back = np.outer(err, net.weight) * (features > 0)
            for k, w in enumerate(WIDTHS):
                at, begin, counts, response = places[k]
                g_filter = np.zeros_like(net.filters[w])
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                grad["bias"][k * FILTERS : (k + 1) * FILTERS] = part.sum(axis=0)
                for i in np.flatnonzero(counts):
                    place = at[begin[i] + response[begin[i] : begin[i + 1]].argmax(axis=0)]
                    for j in range(w):
                        g_filter[j] += (vectors[place + j] * part[i][:, None]).T
                        np.add.at(g_vectors, place + j, part[i][:, None] * net.filters[w][j].T)
                grad["f", w] = g_filter + shrink * net.filters[w]
            step += 1
            for name in names[:-1]:
                g, m = grad[name], moment[name]
                m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.999 * m[1] + 0.001 * g * g
                move = speed * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
                if isinstance(name, tuple):
                    net.filters[name[1]] = net.filters[name[1]] - move
                else:
                    setattr(net, name, getattr(net, name) - move)
            touched = np.flatnonzero(g_vectors.any(axis=1))
            push = speed * np.sign(g_vectors[touched]) * np.minimum(np.abs(g_vectors[touched]) * 50, 1)
            for k in range(local.shape[1]):
                np.subtract.at(net.embed, local[touched, k], push)
            net.embed[0] = 0
    net.embed = net.embed.astype(np.float32)
    return net


def hashed_sample(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int, sample_words: int) -> pa.Table:
    """(doc_id, half, label, n, pieces) of the training sample in order of id: the buckets of each text,
    of the first ids in hash order whose words add up to at most ``sample_words``."""

    def hashed(batches):
        for batch in batches:
            sizes, data_ = [], []
            for _, _, data, offs in each_block(batch.column("text"), lower=True):
                pieces, first, _ = tokens(data, offs)
                sizes.append(np.diff(first))
                data_ += [pieces[a:b].astype("<i4").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            if data_:
                columns = [batch.column(c) for c in ("doc_id", "half", "label")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.concatenate(sizes)), pa.array(data_, pa.binary())], names=["doc_id", "half", "label", "n", "pieces"]
                )

    rows = cut(
        labelled_sample(docs, labels, label, PARTS, HELD, sample_rows)
        .groupBy("doc_id")
        .agg(F.min(F.struct("label", "text")).alias("row"))  # rows repeated under one id teach once
        .select("doc_id", _in_half().alias("half"), "row.*")
        .mapInArrow(hashed, "doc_id long, half boolean, label double, n long, pieces binary")
    )
    sizes = rows.select("n", F.xxhash64("doc_id", F.lit(7)).alias("place"), "doc_id").orderBy("place", "doc_id").toArrow()  # sample_rows at most
    taken = int((np.cumsum(sizes.column("n").to_numpy()) <= sample_words).sum())
    if taken < sizes.num_rows:
        ids = docs.sparkSession.createDataFrame([(i,) for i in sizes.column("doc_id").to_pylist()[:taken]], "doc_id long")
        rows = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    return rows.orderBy("doc_id").toArrow()


def fit_network(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS, sample_words: int = SAMPLE_WORDS
) -> Network | None:
    """The network, its cut-offs not yet calibrated."""
    rows = hashed_sample(docs, labels, label, sample_rows, sample_words)
    if not rows.num_rows:
        return None
    first = np.concatenate([[0], np.cumsum(rows.column("n").to_numpy())])
    pieces = np.empty((int(first[-1]), 1 + len(PREFIXES)), np.int32)
    for a, b, data in zip(first[:-1], first[1:], rows.column("pieces"), strict=True):
        pieces[a:b] = np.frombuffer(data.as_buffer(), "<i4").reshape(-1, pieces.shape[1])
    y, half = rows.column("label").to_numpy(), rows.column("half").to_numpy()
    del rows
    return train(pieces, first, y, half)


def raw_scores(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, raw probability, language group) of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        net = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            raw, part = [], []
            for a, b, data, offs in each_block(batch.column(1), lower=True):
                if net is None:
                    raw.append(np.zeros(b - a))
                    part.append(np.zeros(b - a, np.int32))
                    continue
                pieces, first, group = tokens(data, offs)
                raw.append(probability(net, net.embed, pieces, first))
                part.append(group.astype(np.int32))
            columns = [batch.column(0).cast(pa.int64()), pa.array(np.concatenate(raw).astype(np.float64)), pa.array(np.concatenate(part))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "raw", "part"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, raw double, part int")


def _scaled(raw: DataFrame, net: Network | None) -> DataFrame:
    return raw.select("doc_id", (F.lit(0.0) if net is None else calibrated(net.cuts)).alias("score"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Network | None:
    net = fit_network(docs, labels, label, sample_rows)
    if net is not None:
        net.cuts = cutoffs(raw_scores(docs, net), labels, label, sample_rows)
    return net


def toxicity_scores(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, score) of each row of ``docs``."""
    return _scaled(raw_scores(docs, net), net)


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``; the texts are scored once, for the
    cut-offs and for the result."""
    net = fit_network(docs, labels, sample_rows=sample_rows)
    raw = raw_scores(docs, net)
    if net is not None:
        raw = cut(raw)
        net.cuts = cutoffs(raw, labels, sample_rows=sample_rows)
    return with_fold(_scaled(raw, net), PARTS, HELD, THRESHOLD)
