"""Toxic spans by a linear-chain conditional random field; marginals make document scores.

Labels exist per document only, so the tokens of the training documents are labelled from a lexicon
found in them: in a toxic document every token that carries a feature (its word, its first five or
its first three bytes) much more frequent in toxic documents is TOXIC, every other token is OTHER.
The field learns feature, bias and transition weights from these sequences. A document's score is a
logistic function of its marginals (largest, expected number and share of TOXIC tokens); tokens
with a marginal of 0.5 or more form the offending spans.

Empty and null texts have no token and get the score of an empty sequence. Without labelled rows every
score is 0. Rows are scored one by one, so repeated rows get equal scores; a null label is no label, and
of several labels of one document the largest counts. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.columns import packed, unpacked
from tastegrid.llm.hashing import lower_latin, pieces, span_hashes, text_bytes, word_spans, NOT_WORD

TRAIN_ROWS = 6000     # bound of the labelled sample that the model is fitted on
VOCABULARY = 5000     # features kept
FEATURED = 1 << 17  # tokens whose features are sorted at once in training
WINDOWS = 10000       # bound of the training sequences
REACH = 8             # tokens on each side of a training sequence's middle
STEPS = 60
PIECE = 1 << 19


@dataclass
class Model:
    features: np.ndarray    # sorted hashes
    weights: np.ndarray
    bias: float
    transition: np.ndarray  # 2 x 2, in the log domain
    document: np.ndarray    # logistic weights of the marginals' features, intercept first


def token_features(data, offsets):
    """(starts, ends, first, hashes): three feature hashes per token."""
    low = lower_latin(data)
    starts, ends, first = word_spans(low, offsets, NOT_WORD)
    hashes = span_hashes(low, starts, ends, *(np.minimum(starts + size, ends) for size in (5, 3)))
    for row, salt in zip(hashes[1:], (np.uint64(0x5), np.uint64(0x3))):
        row ^= salt << np.uint64(60)
    return starts, ends, first, hashes


def lookup(features, hashes):
    """Index of each hash in the sorted features, or -1."""
    if not len(features):
        return np.full(hashes.shape, -1)
    at = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
    return np.where(features[at] == hashes, at, -1)


def emissions(model, hashes):
    return energies(model, (lookup(model.features, row) for row in hashes))


def energies(model, found):
    """Emissions from each feature's indices, one row of tokens at a time."""
    padded = np.append(model.weights, 0.0)
    return model.bias + sum(padded[row] for row in found)


def sweeps(energy, first, transition, width=256):
    """P(TOXIC) of every token; texts are independent chains that lie one after the other.

    The chain is cut into columns that advance together: first each column's product of 2 x 2
    matrices, then a short pass over the columns, then all tokens of all columns. A text's first
    token has a matrix that forgets what came before.
    """
    n = len(energy)
    if not n:
        return np.zeros(0)
    columns = -(-n // width)
    total = columns * width
    toxic = np.exp(np.clip(np.append(energy, np.zeros(total - n)), -30, 30))
    begins = np.zeros(total + 1, bool)
    begins[first] = True
    begins[n:] = True
    step = np.exp(transition)

    def sweep(emit, restart):
        """Normalised forward vectors before each token's own emission is counted again."""
        emit, restart = emit.reshape(columns, width).T, restart.reshape(columns, width).T
        a = np.where(restart, 1.0, step[0, 0]), np.where(restart, 1.0, step[0, 1]) * emit
        b = np.where(restart, 1.0, step[1, 0]), np.where(restart, 1.0, step[1, 1]) * emit
        product = np.tile(np.eye(2)[:, :, None], (1, 1, columns))
        for t in range(width):
            o, x = product[:, 0], product[:, 1]
            product = np.stack((o * a[0][t] + x * b[0][t], o * a[1][t] + x * b[1][t]), axis=1)
            product /= product.sum(axis=(0, 1))
        entry = np.empty((2, columns))
        state = np.array([0.5, 0.5])
        for c in range(columns):
            entry[:, c] = state
            state = state @ product[:, :, c]
            state /= state.sum()
        o, x = entry
        out = np.empty((width, columns))
        for t in range(width):
            o, x = o * a[0][t] + x * b[0][t], o * a[1][t] + x * b[1][t]
            norm = o + x
            o, x = o / norm, x / norm
            out[t] = x
        return out.T.reshape(-1)

    forward = sweep(toxic, begins[:-1])
    step = step.T
    backward = sweep(toxic[::-1], begins[1:][::-1])[::-1]  # it also counts the token's own emission
    up = forward * backward / toxic
    down = (1 - forward) * (1 - backward)
    return (up / (up + down))[:n], forward[:n], backward[:n]


def marginals(*args, **options) -> np.ndarray:
    """Probability of every token of being toxic."""
    return sweeps(*args, **options)[0]


def pair_marginals(forward, backward, transition, at) -> np.ndarray:
    """(4 x pairs): probabilities of the states 00, 01, 10, 11 of the tokens before ``at`` and at it.

    Forward vectors count the emissions up to a token, backward ones those from it on; the edge between them is counted once.
    """
    left, right = forward[at - 1], backward[at]
    joint = np.stack(((1 - left) * (1 - right), (1 - left) * right, left * (1 - right), left * right)) * np.exp(transition.reshape(4, 1))
    return joint / joint.sum(axis=0)


def document_features(p, first):
    counts = np.diff(first)
    sums = np.concatenate(([0.0], np.cumsum(p)))
    expected = sums[first[1:]] - sums[first[:-1]]
    largest = np.zeros(len(counts))
    some = np.flatnonzero(counts)
    if len(some):
        largest[some] = np.maximum.reduceat(p, first[:-1][some])
    share = expected / np.maximum(counts, 1)
    return np.stack((np.ones(len(counts)), largest, np.log1p(expected), np.sqrt(share)), axis=1)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_arrays(data, offsets, toxic) -> Model:
    """Fit on texts (bytes and offsets) with a 0/1 label each."""
    first, hashes = token_features(data, offsets)[2:]
    owner = np.repeat(np.arange(len(toxic)), np.diff(first))
    is_toxic = toxic[owner] == 1
    positive, negative = max(1, int(toxic.sum())), max(1, int((toxic == 0).sum()))

    # Documents with each feature, among the toxic ones and the others.
    # Some documents at a time: a pair of feature and document occurs within one part only, so parts keep counts per feature.
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i, j in pieces(first, FEATURED):
        own = slice(first[i], first[j])
        flat = np.stack((hashes[:, own].reshape(-1), np.tile(owner[own], len(hashes)).astype(np.uint64)), axis=1)
        flat = flat[np.lexsort((flat[:, 1], flat[:, 0]))]
        fresh = np.ones(len(flat), bool)
        fresh[1:] = (flat[1:] != flat[:-1]).any(axis=1)
        flat = flat[fresh]
        keys, at = np.unique(flat[:, 0], return_inverse=True)
        bad = toxic[flat[:, 1].astype(np.int64)] == 1
        parts.append((keys, *(np.bincount(at[which], minlength=len(keys)) for which in (bad, ~bad))))
    keys, *counts = (np.concatenate(column) for column in zip(*parts))
    del parts
    keys, at = np.unique(keys, return_inverse=True)
    with_bad, with_good = (np.bincount(at, column, len(keys)).astype(np.int64) for column in counts)
    odds = np.log((with_bad + 0.5) / (positive + 1)) - np.log((with_good + 0.5) / (negative + 1))
    strong = np.flatnonzero((with_bad >= 3) & (odds > 1.0))
    gain = with_bad[strong] * odds[strong]
    kept = np.sort(strong[np.argsort(-gain, kind="stable")[:VOCABULARY]])
    features, indicates = keys[kept], np.append(odds[kept] >= 1.5, False)

    found = np.stack([lookup(features, row).astype(np.int32) for row in hashes])
    del hashes
    labels = (is_toxic & indicates[found].any(axis=0)).astype(float)
    hits = np.flatnonzero((found >= 0).any(axis=0))
    rng = np.random.default_rng(7)
    middles = hits if len(hits) <= WINDOWS else np.sort(rng.choice(hits, WINDOWS, replace=False))
    if len(owner):
        middles = np.concatenate((middles, rng.integers(0, len(owner), min(WINDOWS, len(owner)))))
    window = middles[:, None] + np.arange(-REACH, REACH + 1)
    safe = np.clip(window, 0, max(0, len(owner) - 1))
    inside = (window == safe) & (owner[safe] == owner[middles][:, None]) if len(owner) else np.zeros(window.shape, bool)
    # Tokens of the sequences one after the other, each sequence a chain of its own.
    tokens = safe[inside]
    lengths = inside.sum(axis=1)
    begin = np.concatenate(([0], np.cumsum(lengths)))
    present = found[:, tokens]
    rows = np.broadcast_to(np.arange(len(tokens)), present.shape)[present >= 0]
    cols = present[present >= 0]
    truth = labels[tokens]
    follows = np.ones(len(tokens), bool)
    follows[begin[:-1][lengths > 0]] = False
    pairs = np.flatnonzero(follows)
    wanted = np.bincount((2 * truth[pairs - 1] + truth[pairs]).astype(int), minlength=4).reshape(2, 2)

    size = len(features)
    theta = np.concatenate((np.zeros(size), [-3.0], [0.5, -0.5, -0.5, 0.5]))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1 if len(tokens) else 1):
        energy = theta[size] + np.bincount(rows, theta[cols], len(tokens))
        transition = theta[size + 1:].reshape(2, 2)
        p, forward, backward = sweeps(energy, begin, transition, width=64)
        error = p - truth
        joint = pair_marginals(forward, backward, transition, pairs)
        grad = np.concatenate((
            np.bincount(cols, error[rows], size), [error.sum()], (joint.sum(axis=1) - wanted.reshape(-1))))
        grad = grad / len(tokens) * 50 + 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model = Model(features, theta[:size], float(theta[size]), theta[size + 1:].reshape(2, 2), np.zeros(4))

    x = document_features(marginals(energies(model, found), first, model.transition), first)
    w = np.array([-2.0, 0.0, 0.0, 0.0])
    for _ in range(30):  # Newton steps with a small ridge
        p = logistic(x @ w)
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.05 * np.eye(4)
        step = np.linalg.solve(hessian, x.T @ (p - toxic) + 0.05 * w)
        w = w - np.clip(step, -2, 2)
    model.document = w
    return model


def fit(docs: DataFrame, labels: DataFrame, use: Column, id_col="doc_id", text_col="text", label_col="toxic",
        train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most ``train_rows`` labelled documents (those of smallest hashed id) for which ``use`` holds.

    ``use`` is a condition on the labels' id column. The sample is bounded, so one task holds it.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).filter(
        F.col("_id").isNotNull() & F.col("_label").isNotNull()).groupBy("_id").agg(F.max("_label").alias("_label"))
    chosen = known.withColumnRenamed("_id", id_col).filter(use).withColumnRenamed(id_col, "_id").orderBy(
        F.xxhash64("_id"), "_id").limit(train_rows)
    sample = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(
        F.broadcast(chosen), "_id").groupBy("_id").agg(
        F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"), F.first("_label").alias("_label"))

    def learn(batches):
        tables = [b for b in batches if b.num_rows]
        if tables:
            table = pa.Table.from_batches(tables).sort_by("_id")
            data, offsets = text_bytes(table["_text"])
            yield pa.RecordBatch.from_pydict(
                {"model": [pickle.dumps(astuple(fit_arrays(data, offsets, table["_label"].to_numpy().astype(np.int64))))]})

    found = sample.repartition(1).mapInArrow(learn, "model binary").collect()  # one row, below a megabyte
    return Model(*pickle.loads(found[0]["model"])) if found else None


def score(docs: DataFrame, model: Model | None, text_col="text", spans: bool = False) -> DataFrame:
    """``docs`` with ``tox_score`` (0 to 1), ``tox_tokens`` (marginal of 0.5 or more) and, if asked for,
    ``tox_spans``: offsets of the offending spans in code points. They replace columns of those names.
    """
    rest = docs.select(F.col(text_col).alias("_text"), packed(docs, [text_col]))
    own = {"tox_score": "double", "tox_tokens": "bigint"} | ({"tox_spans": "array<struct<start:bigint,end:bigint>>"} if spans else {})
    fields = [*((f.name, f.dataType.simpleString()) for f in rest.schema.fields), *((f"_{n}", t) for n, t in own.items())]

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            values, counts, places = [], [], []
            for i, j in pieces(offsets, PIECE):
                if model is None:
                    values.append(np.zeros(j - i)), counts.append(np.zeros(j - i, np.int64)), places.extend([[]] * (j - i))
                    continue
                part = data[offsets[i]:offsets[j]]
                starts, ends, first, hashes = token_features(part, offsets[i:j + 1] - offsets[i])
                p = marginals(emissions(model, hashes), first, model.transition)
                values.append(logistic(document_features(p, first) @ model.document))
                hit = np.concatenate(([0], np.cumsum(p >= 0.5)))
                counts.append(hit[first[1:]] - hit[first[:-1]])
                if spans:
                    places.extend(offending(part, offsets[i:j + 1] - offsets[i], starts, ends, first, p >= 0.5))
            arrays = [*batch.columns, pa.array(np.concatenate(values or [np.zeros(0)])),
                      pa.array(np.concatenate(counts or [np.zeros(0)]).astype(np.int64))]
            if spans:
                arrays.append(pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
            yield pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])

    scored = rest.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in fields))
    return scored.select(*unpacked(docs.columns, {text_col: F.col("_text")} | {n: F.col(f"_{n}") for n in own}))


def without_toxic(docs: DataFrame, model: Model | None, text_col="text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns as they are, whose text scores below ``threshold``."""
    scored = score(docs.select(F.col(text_col).alias("_t"), packed(docs, [text_col]).alias("_row")), model, "_t").filter(
        F.col("tox_score") < threshold)
    return scored.select(*(F.col("_t").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns))


def offending(data, offsets, starts, ends, first, hit):
    """Per text the runs of neighbouring hit tokens, as offsets in code points."""
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    out = []
    for i in range(len(offsets) - 1):
        at = np.flatnonzero(hit[first[i]:first[i + 1]]) + first[i]
        runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []
        base = points[offsets[i]]
        out.append([{"start": int(points[starts[r[0]]] - base), "end": int(points[ends[r[-1]]] - base)} for r in runs])
    return out
