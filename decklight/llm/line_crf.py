"""Quality classifier (operator 11): a linear-chain conditional random field over lines.

A line is good or bad. Its score is linear in features of its own and of the lines before
and after it (shares of character classes, repeated words and lines, lengths); a 2 by 2
table scores neighbouring labels. Forward and backward passes give each line's marginal,
and the marginals, weighted by length, are added up to the document's share of good text.
A logistic curve, fitted on whole labelled documents, makes that the score.

Labels are of documents, not lines. The field is fitted in rounds: all lines of a document
first have its label; then those lines of bad documents that the field finds good are good
lines, all but the worst one.

Fitting reads at most ``MOST_DOCS`` labelled ids of each label, those of the least hash
among the distinct ones, with one row an id, and of each at most ``MOST_LINES`` lines that
follow each other, from a hashed place; the curve is fitted on the same documents' whole
texts. Rows with ``crc32(doc_id) mod 4 = 2`` are held out from both. Scoring reads every
line of every row.

Defined results: a null or empty text is one empty line; a text of any length is read
whole; equal texts get equal scores; rows that share an id are all scored, and the fit
reads the least text with the least label; rows with a null doc_id are scored, count as
not held out and are not fitted on; a score at the threshold is predicted 1; where labels
of one kind only, or none, can be fitted on, every score is the share of 1 among them, or
0; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .shared import least_ids, text_or_empty, written
from .words import gather, text_slices

MOST_DOCS = 2_000
MOST_LINES = 48
THRESHOLD = 0.7
ROUNDS = 4
STEPS = 150

# ---- features ---------------------------------------------------------------------------

_CLASSES = ("lower", "upper", "digit", "space", "sentence", "bang", "pipe", "symbol", "wide", "inner")
_CLASS_OF = np.full(256, _CLASSES.index("symbol"), np.uint8)
for _name, _bytes in {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": (32, *range(9, 14)), "sentence": b".,;:?'\"()-", "bang": b"!", "pipe": b"|",
    "wide": range(192, 256), "inner": range(128, 192),
}.items():
    _CLASS_OF[list(_bytes)] = _CLASSES.index(_name)


def _ratio(a, b):
    return a / np.maximum(b, 1)


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, and where each begins and ends."""
    strings = pa.concat_arrays([strings, pa.array([], strings.type)])  # without an offset
    wide = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    _, ends, data = strings.buffers()
    ends = np.frombuffer(ends, wide)[: len(strings) + 1].astype(np.int64) if len(strings) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[: ends[-1]] if data is not None else np.zeros(0, np.uint8), ends


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row of features a line, its length in characters, where each text's lines begin and end)."""
    lists = pc.split_pattern(texts, "\n")
    lines, ends = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    data, at = _bytes_of(lines)
    kind = _CLASS_OF[data]
    count = {n: np.diff(np.concatenate([[0], np.cumsum(kind == k, dtype=np.int64)])[at]) for k, n in enumerate(_CLASSES)}
    chars = np.diff(at) - count["inner"]
    letters = count["lower"] + count["upper"] + count["wide"]
    parts = pc.split_pattern(lines, " ")
    sizes = parts.value_lengths().to_numpy()
    word, own = parts.flatten().dictionary_encode().indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(lines)), sizes)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (own[1:] == own[:-1])
    distinct = np.bincount(np.unique(own * (word.max(initial=0) + 1) + word) // (word.max(initial=0) + 1), minlength=len(lines))
    code = lines.dictionary_encode().indices.to_numpy().astype(np.int64)
    place = np.repeat(np.arange(len(texts)), np.diff(ends)) * (code.max(initial=0) + 1) + code
    repeated = np.ones(len(lines))
    repeated[np.unique(place, return_index=True)[1]] = 0
    first, last = np.zeros(len(lines)), np.zeros(len(lines))
    filled = np.flatnonzero(np.diff(at))
    first[filled] = np.isin(kind[at[filled]], [_CLASSES.index("upper"), _CLASSES.index("wide")])
    last[filled] = np.isin(data[at[filled + 1] - 1], list(b".!?"))
    shares = [
        _ratio(count["upper"], letters), *(_ratio(count[c], chars) for c in ("digit", "symbol", "bang", "pipe", "sentence")), _ratio(np.bincount(own, again, len(lines)), sizes),
        1 - distinct / sizes,
    ]
    rest = [_ratio(count["wide"], chars), _ratio(count["space"], chars), np.log1p(chars) / 10, np.log1p(sizes) / 8, np.minimum(_ratio(chars, sizes) / 20, 1), (letters == 0).astype(float), first, last, repeated * (chars > 0)]
    return np.column_stack([*shares, *(np.minimum(8 * s, 1) for s in shares), *rest]).astype(np.float32), chars, ends


def with_neighbours(own: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after it (zero where there is none), whether there is one, and a one."""
    first, last = np.zeros(len(own), bool), np.zeros(len(own), bool)
    first[ends[:-1]] = last[ends[1:] - 1] = True
    prior, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    prior[first] = after[last] = 0
    return np.column_stack([own, prior, after, first, last, np.ones(len(own))]).astype(np.float32)


# ---- the chain --------------------------------------------------------------------------


def chain(odds: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds of every line of every text; their sum is the marginal's log odds.

    ``odds`` are the lines' own, ``table[a, b]`` scores label b after label a. Texts go side by side, a line at a time.
    """
    size = np.diff(ends)
    order = np.argsort(-size, kind="stable")
    start, size = ends[:-1][order], size[order]
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), "left")  # how many texts have more lines than that
    forward, backward = np.array(odds, float), np.zeros(len(odds))
    for t in range(1, steps):
        at = start[: active[t]] + t
        r = forward[at - 1]
        forward[at] += np.logaddexp(table[1, 1] + r, table[0, 1]) - np.logaddexp(table[1, 0] + r, table[0, 0])
    for t in range(steps - 2, -1, -1):
        at = start[: active[t + 1]] + t
        r = odds[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(table[1, 1] + r, table[1, 0]) - np.logaddexp(table[0, 1] + r, table[0, 0])
    return forward, backward


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def pair_marginals(odds, forward, backward, table, left) -> np.ndarray:
    """(pairs, 2, 2): how likely the labels of the lines ``left`` and those after them are."""
    score = np.zeros((len(left), 2, 2))
    score += table
    score[:, 1, :] += forward[left][:, None]
    score[:, :, 1] += (odds[left + 1] + backward[left + 1])[:, None]
    score = np.exp(score - score.max(axis=(1, 2), keepdims=True))
    return score / score.sum(axis=(1, 2), keepdims=True)


class LineModel:
    """Weights of the features, the table of neighbouring labels, and the curve over the share of good text."""

    def __init__(self, features: int):
        self.weights, self.table, self.curve = np.zeros(features), np.zeros((2, 2)), (1.0, 0.0)

    def marginals(self, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        forward, backward = chain(x @ self.weights, ends, self.table)
        return sigmoid(forward + backward)

    def share(self, texts: pa.Array) -> np.ndarray:
        """The length-weighted mean of the marginals of each text's lines."""
        own, chars, ends = line_features(texts)
        good = self.marginals(with_neighbours(own, ends), ends)
        return np.add.reduceat(good * (chars + 1), ends[:-1]) / np.add.reduceat(chars + 1, ends[:-1])

    def score(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.curve[0] * logit(self.share(texts)) + self.curve[1])


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_chain(model: LineModel, x: np.ndarray, y: np.ndarray, ends: np.ndarray, weight: np.ndarray, steps: int = STEPS, rate: float = 0.05, decay: float = 1e-3) -> None:
    """Conditional maximum likelihood of line labels, with a weight a line; Adam, full batches."""
    left = np.setdiff1d(np.arange(len(y)), ends[1:] - 1)
    seen = np.zeros((len(left), 2, 2))
    seen[np.arange(len(left)), y[left], y[left + 1]] = 1
    total = weight.sum()
    theta = np.concatenate([model.weights, model.table.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        model.weights, model.table = theta[:-4], theta[-4:].reshape(2, 2)
        odds = x @ model.weights
        forward, backward = chain(odds, ends, model.table)
        off = (sigmoid(forward + backward) - y) * weight
        pairs = ((pair_marginals(odds, forward, backward, model.table, left) - seen) * weight[left][:, None, None]).sum(axis=0)
        gradient = np.concatenate([off @ x, pairs.ravel()]) / total + decay * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.weights, model.table = theta[:-4], theta[-4:].reshape(2, 2)


def fit_lines(x: np.ndarray, ends: np.ndarray, good: np.ndarray) -> LineModel:
    """A field from documents' labels: lines of bad documents that it finds good become good lines, round by round."""
    model = LineModel(x.shape[1])
    own = np.repeat(np.arange(len(good)), np.diff(ends))
    y = good[own].astype(int)
    # both labels weigh the same, and a document as much as any other of its label
    per_doc = 0.5 / np.maximum(np.where(good, good.sum(), (~good).sum()), 1)
    weight = per_doc[own] / np.diff(ends)[own]
    for _ in range(ROUNDS):
        fit_chain(model, x, y, ends, weight)
        p = model.marginals(x, ends)
        y = np.where(good[own], 1, p > 0.5).astype(int)
        worst = np.lexsort((p, own))[ends[:-1]]
        y[worst[~good]] = 0
    return model


def fit_curve(share: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope, at least 0.1, and offset of the logistic curve over the share's log odds; Newton's method with a little decay."""
    z = np.column_stack([logit(share), np.ones(len(share))])
    theta, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    weight = weight / weight.mean()
    for _ in range(50):
        p = sigmoid(z @ theta)
        gradient = z.T @ (weight * (p - good)) + 1.0 * (theta - prior)
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1.0 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - np.clip(step, -2, 2)
        theta[0] = max(theta[0], 0.1)
    return float(theta[0]), float(theta[1])


# ---- Spark ------------------------------------------------------------------------------


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_docs(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[bool, int]]:
    """((doc_id, good, text), written; how many ids of each label could be fitted on)."""
    fit = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good")).where("doc_id IS NOT NULL AND good IS NOT NULL").where(~held_out())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where("doc_id IS NOT NULL")
    fit = written(fit.groupBy("doc_id").agg(F.min("good").alias("good")).join(rows.select("doc_id").distinct(), "doc_id", "left_semi"))
    counts = {r.good: r.n for r in fit.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [least_ids(fit.where(F.col("good") == good), MOST_DOCS).withColumn("good", F.lit(good)) for good in (True, False)]
    chosen = written(chosen[0].unionByName(chosen[1]))  # of bounded size, so it may be broadcast
    return written(rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))), counts


def sample_lines(sample: DataFrame) -> DataFrame:
    """(doc_id, good, lines): the features of at most ``MOST_LINES`` neighbouring lines of each document, one after the other."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                own, _, ends = line_features(part["text"])
                size = np.diff(ends)
                kept = np.minimum(size, MOST_LINES)
                spare = size - kept + 1
                start = ends[:-1] + (part["doc_id"].to_numpy() * 2_654_435_761 % 4_294_967_296) % spare
                flat = own[gather(start, kept)].ravel()
                offsets = np.concatenate([[0], np.cumsum(kept)]) * own.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.float32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["good"], lists], ["doc_id", "good", "lines"])

    return sample.mapInArrow(cut, "doc_id long, good boolean, lines array<float>")


def fit(docs: DataFrame, labels: DataFrame) -> LineModel | float:
    """The model, or the one score of all texts where there are not both labels to learn from."""
    sample, counts = training_docs(docs, labels)
    if len(counts) < 2:
        return float(next(iter(counts), False))
    rows = sample_lines(sample).orderBy("doc_id").toArrow()  # bounded: documents, lines and features
    width = line_features(pa.array(["x"]))[0].shape[1]
    lists = rows["lines"].combine_chunks()
    own = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy() // width)])
    model = fit_lines(with_neighbours(own, ends), ends, rows["good"].to_numpy())
    whole = sample.select("doc_id", "text").mapInArrow(_per_text(model.share, "share"), "doc_id long, share double").join(sample.select("doc_id", "good"), "doc_id").orderBy("doc_id").toArrow()
    good = whole["good"].to_numpy()
    taken = {g: max(1, (good == g).sum()) for g in (True, False)}
    weight = np.where(good, counts[True] / taken[True], counts[False] / taken[False])
    model.curve = fit_curve(whole["share"].to_numpy(), good.astype(float), weight)
    return model


def _per_text(score, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(score(part["text"]), pa.float64())], ["doc_id", name])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    model = fit(docs, labels)
    score = model.score if isinstance(model, LineModel) else lambda texts: np.full(len(texts), model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    scored = rows.mapInArrow(_per_text(score, "score"), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
