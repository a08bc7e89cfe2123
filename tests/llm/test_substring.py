import hashlib
import random

import numpy as np
import pytest

from decklight.llm import substring
from decklight.llm.fm_index import FMIndex
from decklight.llm.substring import op1_substring, remove_repeats

SCHEMA = "doc_id long, text string, anchor int, at string"


def brute(rows, k=13):
    holders = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for p in range(len(words) - k + 1):
            key = tuple(words[p : p + k])
            if i is not None:
                holders[key] = min(holders.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for p in range(len(words) - k + 1):
            if i is not None and holders[tuple(words[p : p + k])] < i:
                gone |= set(range(p, p + k))
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_index_finds_all_windows():
    random.seed(2)
    texts = [[random.randint(1, 3) for _ in range(random.randint(0, 30))] for _ in range(40)]
    other = [[random.randint(1, 3) for _ in range(random.randint(0, 30))] for _ in range(10)]
    flat = lambda ts: (np.array([x for t in ts for x in t], np.int64), np.array([len(t) for t in ts], np.int64))
    for k in (2, 5, 8, 13):
        index = FMIndex(*flat(texts), k)
        for asked in (texts, other):
            start, end = index.matching_statistics(*flat(asked))
            windows = [t[i : i + k] for t in asked for i in range(len(t) - k + 1)]
            assert len(windows) == len(start)
            for window, a, b in zip(windows, start, end):
                held = [n for n, t in enumerate(texts) for i in range(len(t) - k + 1) if t[i : i + k] == window]
                assert sorted(index.owner[a:b]) == held
        found = start < end
        least = index.least_owner(start[found], end[found], np.arange(len(texts))[::-1])
        assert [len(texts) - 1 - max(index.owner[a:b]) for a, b in zip(start[found], end[found])] == least.tolist()


def corpus():
    random.seed(3)
    words = [f"w{i}" for i in range(200)] + ["é", "\x1c", "漢"]
    passage = [" ".join(random.choices(words, k=n)) for n in (13, 20, 60, 12)]
    rows = [(None, passage[2]), (900, None), (901, ""), (902, passage[2] * 30)]
    for i in range(60):
        own = [" ".join(random.choices(words, k=random.randint(0, 40))) for _ in range(3)]
        rows.append((i, f"{own[0]}\t{random.choice(passage)}\n{own[1]} {random.choice(passage)} {own[2]}"))
    rows += [(70 + i, rows[5][1]) for i in range(20)] + [rows[8], rows[8]]
    # rows that share a doc_id but not their text
    return rows + [(20, "short"), (20, f"{passage[2]} x"), (3, rows[12][1]), (71, ""), (71, f"a b c {rows[40][1]}")]


@pytest.mark.parametrize("hot", [2_000, 3])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_IN_SAMPLE", hot)
    monkeypatch.setattr(substring, "SAMPLE_SHARE", 1.0)
    monkeypatch.setattr(substring, "SHARD_WORDS", 500)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert sorted(map(tuple, op1_substring(docs).collect()), key=str) == brute(rows)


def test_columns_stay_and_empty_table(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = remove_repeats(docs).collect()
    assert len(got) == len(rows) and got[0].__fields__ == docs.columns
    kept = sorted((str(r.doc_id), hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in got)
    assert kept == sorted((str(i), digest) for i, _, _, digest in brute(rows))
    untouched = {digest for _, _, n, digest in brute(rows) if not n}
    texts = {hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest(): t for _, t in rows}
    assert all(r.text == texts[d] for r in got if (d := hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) in untouched and r.text)
    empty = spark.createDataFrame([], SCHEMA)
    assert op1_substring(empty).count() == remove_repeats(empty).count() == 0


def test_an_anchor_that_one_text_repeats_is_hot(spark):
    random.seed(11)
    words = [f"r{i}" for i in range(9)]
    text = lambda n, own: f"{own} " + " ".join(words[i % 9] for i in range(n)) + f" {own} end"
    rows = [(1, text(30_000, "one")), (2, text(30_000, "two"))] + [(10 + i, " ".join(random.choices([f"x{j}" for j in range(500)], k=60))) for i in range(50)]
    rows += [(None, text(300, "none"))] * 40
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    plain = docs.select("doc_id", "text")
    hot = substring.hot_anchors(plain, substring.WINDOW, substring.ANCHOR)
    cold = substring.segments(plain, substring.WINDOW, substring.ANCHOR, hot).groupBy("anchor").count().agg({"count": "max"}).first()[0]
    assert cold < 20 * substring.HOT_IN_SAMPLE
    got = sorted((tuple(r)[:4] for r in op1_substring(docs).collect()), key=str)
    assert got == brute(rows)
