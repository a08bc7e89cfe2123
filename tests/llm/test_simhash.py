import itertools
import math
import os
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from decklight.llm import simhash
from decklight.llm.simhash import BKForest, components, fingerprint, keep_one_of_each, op3_simhash, shingle_set, similar_groups

SCHEMA = "doc_id long, text string, fp string, component_id int"


def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, radius=4):
    fps = [plain_fingerprint(t) for _, t in rows]
    ids = [i for i, _ in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if ids[a] is not None and ids[b] is not None and (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = label[a], label[b]
                label = [min(x, y) if z in (x, y) else z for z in label]
    least = {}
    for i, z in zip(ids, label):
        if i is not None:
            least[z] = min(least.get(z, i), i)
    return sorted(((i, f"{f:016x}", least[z] if i is not None else None) for i, f, z in zip(ids, fps, label)), key=str)


def corpus():
    random.seed(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(None, "a b"), (500, None), (501, " \n"), (502, "One"), (503, "oNE"), (504, "long " * 30_000)]
    for i in range(0, 200, 5):
        base = random.choices(words, k=random.choice([3, 30, 200]))
        for j in range(5):
            own = list(base)
            for _ in range(random.randint(0, 3)):
                own[random.randrange(len(own))] = random.choice(words)
            rows.append((i + j, " ".join(own)))
    return rows + [rows[9], rows[9]]


def test_fingerprint():
    for text in ("", "A b", "a B c d", "x y z é 漢 q r s", "a a a a a a"):
        assert fingerprint(text.encode().lower().split(), 4).tolist() == [plain_fingerprint(text)]
        assert fingerprint(text.encode().lower().split(), 4, 3)[0] == plain_fingerprint(text)


def test_forest_finds_all_within_radius():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(6)]))
    forest = BKForest(values[:, None], np.zeros(len(values), np.int64))
    number, node, _ = forest.within(values[:, None], np.zeros(len(values), np.int64), 4)
    far = np.bitwise_count(values[:, None] ^ values)
    assert sorted(zip(number.tolist(), node.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(far <= 4))))


@pytest.mark.parametrize("entries", [2048, 7])
def test_against_brute_force(spark, monkeypatch, entries):
    monkeypatch.setattr(simhash, "SHARD_ENTRIES", entries)
    monkeypatch.setattr(simhash, "FOREST_ENTRIES", 50)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, op3_simhash(docs).collect()), key=str) == brute(rows)


def test_long_chain_and_empty_table(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(7, 7)], "u long, v long")
    assert {r.component for r in components(links).collect()} == {0}
    assert op3_simhash(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("agree", [2, 4])
def test_wider_keys_and_spread_rounds_find_the_same(spark, monkeypatch, agree):
    monkeypatch.setattr(simhash, "wide_enough", lambda entries, radius: simhash.pigeonholes(radius, agree))
    monkeypatch.setattr(simhash, "ONE_TASK_EDGES", 0)
    rows = corpus()
    assert sorted(map(tuple, op3_simhash(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()), key=str) == brute(rows)


def test_keys_widen_with_the_entries():
    bits = lambda n: min(sum(b for *_, b in key) for key in simhash.wide_enough(n, 4))
    assert [bits(n) for n in (10, 8_000_000, 40_000_000, 10**11)] == [12, 12, 20, 27]
    for agree in (1, 2, 3, 4):
        assert len(simhash.pigeonholes(4, agree)) == math.comb(4 + agree, agree)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the tables")
def test_recall_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    groups = {r.doc_id: r.component_id for r in similar_groups(docs).collect()}
    held, sets = defaultdict(list), {}
    for r in docs.collect():
        sets[r.doc_id] = set(shingle_set(r.text or "", 5).tolist())
        for x in sets[r.doc_id]:
            held[x].append(r.doc_id)
    pairs = set()
    for own in held.values():
        pairs |= {(own[0], b) for b in own[1:]} if len(own) > 200 else set(itertools.combinations(own, 2))
    close = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    found = sum(groups[a] == groups[b] for a, b in close)
    assert len(close) > 50 and found >= 0.95 * len(close)


def similar(a, b):
    x, y = set(shingle_set(a or "", 5).tolist()), set(shingle_set(b or "", 5).tolist())
    return not x and not y or len(x & y) >= 0.8 * len(x | y)


def test_similar_texts_leave_one(spark):
    random.seed(9)
    words = [f"w{i}" for i in range(500)]
    rows = [(900, None), (901, ""), (None, "a b c d e f")]
    for i in range(0, 120, 4):
        base = random.choices(words, k=random.choice([40, 150, 600]))
        for j in range(4):
            own = list(base)
            for _ in range(j * len(base) // 150):
                own[random.randrange(len(own))] = random.choice(words)
            rows.append((i + j, " ".join(own)))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    kept = keep_one_of_each(docs.withColumns({"__gone": F.lit(1), "DOC": F.lit(2)}))
    assert kept.columns == [*docs.columns, "__gone", "DOC"]
    kept = {r.doc_id for r in kept.collect()}
    texts = {i: t for i, t in rows if i is not None}
    assert None in kept and 900 in kept and 901 not in kept
    for i in texts.keys() - kept:  # nothing goes without a similar text in its group
        assert any(similar(texts[i], texts[j]) for j in texts if j != i)
    left = [(a, b) for a in kept - {None} for b in kept - {None} if a < b and similar(texts[a], texts[b])]
    assert len(left) <= 1
    assert keep_one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0


def star(copies, words=300, edits=6):
    """A text, and copies of it that are edited each at its own places: like it by over 0.8, less like each other."""
    random.seed(3)
    base = [f"b{i}" for i in range(words)]
    texts = [" ".join(base)]
    for j in range(copies):
        own = list(base)
        for k, at in enumerate(random.sample(range(words // 6), edits)):
            own[at * 6 + 2] = f"e{j}_{k}"
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("chunk", [500_000, 20_000])
def test_copies_of_one_text_only(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK_SHINGLES", chunk)
    texts = star(1000)
    assert all(similar(texts[0], t) for t in texts)
    assert sum(similar(a, b) for a, b in zip(texts[1:], texts[2:])) < 50
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(5000, "other " + " ".join(f"z{i}" for i in range(50)), "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted(r.doc_id for r in keep_one_of_each(docs).collect()) == [0, 5000]


def test_similar_pairs_against_brute_force():
    rng = np.random.default_rng(2)
    base = [rng.choice(1000, 30, replace=False) for _ in range(6)]
    sets = [np.unique(np.where(rng.random(30) < 0.08, rng.integers(0, 1000, 30), base[i % 6])) for i in range(80)]
    group = np.arange(80) // 2
    for side in (np.zeros(80, np.int64), (np.arange(80) % 5 == 0).astype(np.int64)):
        label = {g: g for g in group.tolist()}
        want = dict(label)
        for a in range(80):
            for b in range(80):
                if (side[a] == 0 and side[b] == 1 or not side.any()) and (n := len(np.intersect1d(sets[a], sets[b]))) >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = want[group[a]], want[group[b]]
                    want = {g: min(x, y) if z in (x, y) else z for g, z in want.items()}
        for u, v in zip(*simhash.similar_pairs(side, group, sets, 0.8)):
            x, y = label[u], label[v]
            label = {g: min(x, y) if z in (x, y) else z for g, z in label.items()}
        assert label == want and len(set(want.values())) < 40


def test_stars_are_checked_in_parts(spark, monkeypatch):
    random.seed(21)
    words = [f"w{i}" for i in range(400)]
    middle = random.choices(words, k=90)
    rows = [(0, " ".join(middle)), (1, "word " * 200_000)]
    for i in range(2, 60):
        own = list(middle)
        for _ in range(random.choice([0, 1, 2, 4])):
            own[random.randrange(90)] = random.choice(words)
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = spark.createDataFrame([(i, 0) for i in range(1, 60)] + [(0, i) for i in range(30, 60)] + [(5, 6)], "u long, v long")
    sets = {i: set(shingle_set(t, 5).tolist()) for i, t in rows}
    wanted = {(r.u, r.v) for r in links.collect() if len(sets[r.u] & sets[r.v]) >= 0.8 * len(sets[r.u] | sets[r.v])}
    for most in (1_000, 4):
        monkeypatch.setattr(simhash, "STAR_LINKS", most)
        got = [(r.u, r.v) for r in simhash.checked_links(docs, links, 5, 0.8).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted
    assert 10 < len(wanted) < 80


def test_many_rows_without_an_id_and_a_long_text_stay(spark):
    random.seed(22)
    copy = " ".join(random.choices([f"w{i}" for i in range(90)], k=120))
    rows = [(None, copy, "f", 1)] * 300 + [(4, copy, "f", 1), (9, copy, "f", 1), (9, copy, "f", 1), (7, "long text of words " * 150_000, "f", 1), (8, None, "f", 1)]
    kept = keep_one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["None"] * 300 + ["4", "7", "8"])
