import random
import zlib

import numpy as np

from decklight.llm.toxicity import MOST_POSITIVE, MOST_UNLABELLED, drop_toxic, fit_nnpu, toxicity_scores, training_rows

SCHEMA = "doc_id long, text string, toxic string, score int"


def corpus():
    random.seed(8)
    words, bad = [f"w{i}" for i in range(400)], [f"vile{i}" for i in range(8)]
    rows, labels = [(None, "w1 vile1 vile2"), (5000, None), (5001, "")], []
    for i in range(1500):
        own = random.choices(words, k=random.randint(5, 120))
        toxic = i % 8 == 0
        if toxic:
            own += random.sample(bad, random.randint(3, 6))
        rows.append((i, " ".join(random.sample(own, len(own)))))
        if i % 5 < 2:
            labels.append((i, int(toxic)))
    return rows, labels + [(None, 1), (7, None)]


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity_scores(docs, table).collect()}
    assert len(got) == len(rows)
    for i, _ in rows:
        if i is not None:
            assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    right = [got[i].predicted == (i % 8 == 0) for i in range(1500) if got[i].held_out]
    assert np.mean(right) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5000].score == got[5001].score
    kept = drop_toxic(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_nothing_to_learn_from(spark):
    rows, _ = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows[:20]], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity_scores(docs, none).collect()} == {0.0}
    assert toxicity_scores(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_sample_is_bounded_where_ids_repeat(spark):
    rows, labels = corpus()
    rows += [(3, f"w{i} copy") for i in range(3000)] + [(8, "vile1 vile2 " * 50_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    sample, _ = training_rows(docs, spark.createDataFrame(labels + [(8, 1)] * 50, "doc_id long, toxic int"))
    found = [(r.doc_id, r.positive) for r in sample.collect()]
    assert len(found) == len(set(found)) <= MOST_POSITIVE + MOST_UNLABELLED
    assert toxicity_scores(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).count() == len(rows)


def test_risk_is_corrected_for_the_prior():
    rng = np.random.default_rng(3)
    positive = (rng.random((400, 2)) < [0.9, 0.5]).astype(float)
    hidden = rng.random(4000) < 0.2
    unlabelled = np.where(hidden[:, None], rng.random((4000, 2)) < [0.9, 0.5], rng.random((4000, 2)) < [0.02, 0.5]).astype(float)
    weights, bias = fit_nnpu(positive, unlabelled, 0.2)
    score = 1 / (1 + np.exp(-(unlabelled @ weights + bias)))
    assert abs(score.mean() - 0.2) < 0.05 and weights[0] > 3


def test_a_score_at_the_threshold_is_predicted(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    some = next(r.score for r in toxicity_scores(docs, table).collect() if 0 < r.score < 1)
    tied = [r for r in toxicity_scores(docs, table, some).collect() if r.score == some]
    assert tied and all(r.predicted == 1 for r in tied)


def test_samples_are_taken_by_distinct_ids(spark):
    """Rows that repeat an id many times do not thin the sample out."""
    rows = [(i, f"w{i} copy {k}", "x", 1) for i in range(2_000) for k in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2_000)] * 3, "doc_id long, toxic int")
    sample = training_rows(docs, table)[0].collect()
    fitted = [i for i in range(2_000) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(r.doc_id for r in sample if r.positive) == [i for i in fitted if i % 4 == 0]
    assert sorted(r.doc_id for r in sample if not r.positive) == fitted
