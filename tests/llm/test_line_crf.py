import itertools
import random
import zlib

import numpy as np
import pyarrow as pa

from decklight.llm import line_crf as Q

SCHEMA = "doc_id long, text string, quality string, lines int"


def corpus(n=900):
    random.seed(5)
    words = [f"w{i}" for i in range(300)]
    line = lambda: " ".join(random.choices(words, k=random.randint(6, 14))).capitalize() + "."
    junk = [
        lambda: " | ".join(random.choices(words, k=8)), lambda: " ".join(w.upper() + "!!" for w in random.choices(words, k=9)),
        lambda: " ".join([random.choice(words)] * 15), lambda: " ".join(w + "$$$" for w in random.choices(words, k=9)),
    ]
    rows, labels = [(None, "w1 | w2"), (5000, None), (5001, ""), (5002, "w1\n" * 30_000)], []
    for i in range(n):
        bad = i % 6 == 0
        lines = [line() for _ in range(random.randint(1, 9))]
        if bad:
            kind = random.choice(junk)
            lines = [kind() for _ in range(len(lines) + 1)] + lines[: len(lines) // 3]
            random.shuffle(lines)
        rows.append((i, "\n".join(lines)))
        if i % 4 < 3:
            labels.append((i, int(not bad)))
    return rows, labels + [(None, 1), (7, None), (99_999, 0)]


def frames(spark, rows, labels):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    rows += rows[:50]
    docs, table = frames(spark, rows, labels)
    out = Q.quality_scores(docs.repartition(5), table).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    for i, _ in rows:
        assert got[i].held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
    right = [got[i].predicted == (i % 6 != 0) for i in range(900) if got[i].held_out]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out) and got[5000].score == got[5001].score
    assert len({r.score for r in out if r.doc_id == 3}) == 1


def test_labels_of_one_kind_or_none(spark):
    rows, _ = corpus(30)
    for labels, score in (([], 0.0), ([(i, 1) for i in range(30)], 1.0), ([(i, 0) for i in range(30)], 0.0), ([(77_777, 1)], 0.0)):
        assert {r.score for r in Q.quality_scores(*frames(spark, rows, labels)).collect()} == {score}
    assert Q.quality_scores(*frames(spark, [], [])).count() == 0


def test_ids_are_sampled_by_distinct_ids(spark, monkeypatch):
    monkeypatch.setattr(Q, "MOST_DOCS", 40)
    rows = [(i, f"text {k} of {i}.") for i in range(400) for k in range(20)]
    labels = [(i, i % 2) for i in range(400) for _ in range(15)]
    sample, counts = Q.training_docs(*frames(spark, rows, labels))
    found = sample.collect()
    assert len(found) == 80 == len({r.doc_id for r in found}) and sum(r.good for r in found) == 40
    assert sum(counts.values()) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(400))
    assert all(r.text == f"text 0 of {r.doc_id}." for r in found)


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(2)
    table = rng.normal(size=(2, 2))
    sizes = [1, 4, 2, 6]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    odds = rng.normal(size=ends[-1])
    forward, backward = Q.chain(odds, ends, table)
    left = np.setdiff1d(np.arange(ends[-1]), ends[1:] - 1)
    pairs = dict(zip(left, Q.pair_marginals(odds, forward, backward, table, left)))
    for a, b in zip(ends[:-1], ends[1:]):
        one, two, total = np.zeros(b - a), np.zeros((b - a, 2, 2)), 0.0
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(odds[a + i] * v for i, v in enumerate(y)) + sum(table[u, v] for u, v in zip(y, y[1:])))
            total += w
            one += w * np.array(y)
            for i, (u, v) in enumerate(zip(y, y[1:])):
                two[i, u, v] += w
        assert np.allclose(Q.sigmoid(forward + backward)[a:b], one / total)
        for i in range(b - a - 1):
            assert np.allclose(pairs[a + i], two[i] / total)


def test_features_of_lines():
    own, chars, ends = Q.line_features(pa.array(["Ab cd. é\n\nAb cd. é", "x x x", ""]))
    assert chars.tolist() == [8, 0, 8, 5, 0] and ends.tolist() == [0, 3, 4, 5]
    assert own[:, -1].tolist() == [0, 0, 1, 0, 0]  # repeated
    assert np.allclose(own[3, 6], 2 / 3) and np.allclose(own[0, 0], 1 / 5)
    sliced = Q.line_features(pa.array(["zz", "x x x", "y"])[1:2])
    assert np.array_equal(sliced[0], own[3:4])
    joined = Q.with_neighbours(own, ends)
    n = own.shape[1]
    assert np.array_equal(joined[1, n : 2 * n], own[0]) and not joined[3, n : 3 * n].any() and joined[3, -3:].tolist() == [1, 1, 1]
