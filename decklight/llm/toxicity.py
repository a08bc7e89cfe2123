"""Toxicity (operator 4): non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; other text is unlabelled, not clean. The
classifiers minimise the non-negative risk of Kiryo and others (2017): with the class
prior p, ``p * R_p(+) + max(0, R_u(-) - p * R_p(-))``. Their inputs are the words of a
text that tell the two samples apart; labels, language, source and id are no inputs. How
many of these words are inputs is chosen by the same risk on a part of the fitted rows.

Fitting reads samples of at most ``MOST_POSITIVE`` and ``MOST_UNLABELLED`` ids, those of
the least hash, with one row an id; scoring reads every row. Rows with
``crc32(doc_id) mod 4 = 2`` are held out from fitting and from that choice.

Defined results: a null or empty text gets the score of a text without words; a text of
any length is read whole; equal texts get equal scores; of rows that share an id, the
fit reads the least text; rows with a null doc_id are scored and count as not held out,
but are not fitted on; without positive rows every score is 0; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import free_name, least_ids, text_or_empty, written
from .words import text_slices

MOST_POSITIVE = 4_000
MOST_UNLABELLED = 12_000
#: The least positives a word must be in.
LEAST_FOUND = 3
#: Numbers of words, the most telling ones, that the fit chooses among; the last bounds the model.
WORD_COUNTS = (24, 96, 384)
#: The least share of positives among the texts that hold a word, by the two samples.
LEAST_LIKELY = 0.5
THRESHOLD = 0.3
ENSEMBLE = 3
_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """((doc_id, positive, text) of both samples, written; the class prior among fitted labels)."""
    fit = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic"))
    fit = fit.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    prior = fit.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where("doc_id IS NOT NULL")
    positive = least_ids(fit.where("toxic"), MOST_POSITIVE).withColumn("positive", F.lit(True))
    unlabelled = least_ids(rows.where(~held_out()), MOST_UNLABELLED).withColumn("positive", F.lit(False))
    chosen = written(positive.unionByName(unlabelled))  # of bounded size, so it may be broadcast
    one = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "positive").agg(F.min("text").alias("text"))
    return written(one), prior


def sample_words(sample: DataFrame) -> DataFrame:
    """(n, positive, word) for each distinct word of each row of the sample."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words = [sorted(words_of(t)) for t in part["text"].to_pylist()]
                size = [len(w) for w in words]
                at = pa.array(np.repeat(np.arange(len(words)), size))
                columns = [part["doc_id"].take(at), part["positive"].take(at), pa.array([w for ws in words for w in ws], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "positive", "word"])

    return sample.mapInArrow(cut, "doc_id long, positive boolean, word string")


class ToxicityModel:
    """A word table and the mean of a few linear classifiers over it."""

    def __init__(self, words: list[str], weights: np.ndarray, bias: np.ndarray):
        self.words = {w: i for i, w in enumerate(words)}
        self.weights, self.bias = weights, bias

    def score(self, text: str) -> float:
        held = [self.words[w] for w in self.words.keys() & words_of(text)]
        margin = self.bias + self.weights[:, sorted(held)].sum(axis=1)
        return float(np.mean(1 / (1 + np.exp(-margin))))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.1, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """A linear classifier under the non-negative risk with logistic loss; Adam, full batches."""
    theta = np.zeros(positive.shape[1] + 1, np.float32)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    one = lambda x: np.column_stack([x, np.ones(len(x), np.float32)])
    p, u = one(positive), one(unlabelled)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        zp, zu = p @ theta, u @ theta
        sp, su = sigmoid(zp), sigmoid(zu)
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        positive_part = prior * p.T @ (sp - 1) / len(p)
        negative_part = u.T @ su / len(u) - prior * p.T @ sp / len(p)
        gradient = positive_part + negative_part if negative_risk >= 0 else -negative_part
        gradient[:-1] += decay * theta[:-1]
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], prior_bias(unlabelled @ theta[:-1], prior)


def prior_bias(margin: np.ndarray, prior: float) -> float:
    """The bias under which the mean score of the unlabelled rows is the class prior."""
    low, high = -40.0, 40.0
    for _ in range(60):
        middle = (low + high) / 2
        if np.mean(1 / (1 + np.exp(-np.clip(margin + middle, -40, 40)))) < prior:
            low = middle
        else:
            high = middle
    return middle


def pu_risk(weights: np.ndarray, bias: float, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    zp, zu = positive @ weights + bias, unlabelled @ weights + bias
    negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    return float(prior * np.logaddexp(0, -zp).mean() + max(0.0, negative))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """None if there is nothing to learn from."""
    sample, prior = training_rows(docs, labels)
    sizes = {r.positive: r.n for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_positive, n_unlabelled = sizes.get(True, 0), sizes.get(False, 0)
    if not n_positive or not n_unlabelled:
        return None
    prior = min(max(prior, 1e-3), 0.9)
    words = sample_words(sample)
    counts = words.groupBy("word").agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
    # how far the share among the positives lies from that among the unlabelled, in deviations,
    # and how likely a text with the word is positive, given the prior
    share = (F.col("p") + F.col("u")) / (n_positive + n_unlabelled)
    gap = F.col("p") / n_positive - F.col("u") / n_unlabelled
    deviation = F.sqrt(share * (1 - share) * (1 / n_positive + 1 / n_unlabelled) + 1e-9)
    likely = prior * (F.col("p") / n_positive) / ((F.col("u") + 1) / n_unlabelled)
    best = (
        counts.where((F.col("p") >= LEAST_FOUND) & (gap / deviation > 3) & (likely >= LEAST_LIKELY))
        .select("word", (gap / deviation).alias("z"))
        .orderBy(F.desc("z"), "word")
        .limit(WORD_COUNTS[-1])
    )
    table = [r.word for r in best.collect()]  # the most telling first
    if not table:
        return None
    telling = F.broadcast(sample.sparkSession.createDataFrame([(w,) for w in table], "word string"))
    vectors = words.join(telling, "word").groupBy("doc_id", "positive").agg(F.collect_set("word").alias("words")).collect()  # at most a row for each of the sample's
    place = {w: i for i, w in enumerate(table)}

    def matrix(positive: bool, rows: int) -> np.ndarray:
        out = np.zeros((rows, len(table)), np.float32)
        for i, r in enumerate(sorted((r for r in vectors if r.positive == positive), key=lambda r: r.doc_id)):
            out[i, [place[w] for w in r.words]] = 1
        return out

    rng = np.random.default_rng(17)
    p, u = (rng.permutation(matrix(positive, rows)) for positive, rows in ((True, n_positive), (False, n_unlabelled)))
    size = len(table)
    if n_positive >= 8 and n_unlabelled >= 8:  # a quarter judges how many words to take
        (p_check, p_fit), (u_check, u_fit) = (np.split(x, [len(x) // 4]) for x in (p, u))
        risks = {}
        for n in sorted({min(n, len(table)) for n in WORD_COUNTS}):
            weights, bias = fit_nnpu(p_fit[:, :n], u_fit[:, :n], prior)
            risks[n] = pu_risk(weights, bias, p_check[:, :n], u_check[:, :n], prior)
        size = min(risks, key=risks.get)
    parts = [part for part in np.array_split(u[:, :size], ENSEMBLE) if len(part)]
    fitted = [fit_nnpu(p[:, :size], part, prior) for part in parts]
    return ToxicityModel(table[:size], np.array([w for w, _ in fitted]), np.array([b for _, b in fitted]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    model = fit(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                values = [model.score(t) if model else 0.0 for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(values, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    scored = rows.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` under the threshold, with their own columns."""
    model = fit(docs, labels)
    if model is None:
        return docs

    name = free_name(docs, "__text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column=name):
                kept = pa.array([model.score(t) < threshold for t in part[name].to_pylist()], pa.bool_())
                yield part.drop_columns([name]).filter(kept)

    return docs.withColumn(name, text_or_empty()).mapInArrow(keep, docs.schema)
