import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from decklight.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least):
    """The contract, term by term."""
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(UPPER)))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        seen = Counter(t for d in docs if d[0] == lang for t in d[2])
        kept = sorted(t for t in seen if seen[t] >= least)
        count = {s: Counter() for _, s in {d[:2] for d in docs if d[0] == lang}}
        for d in docs:
            if d[0] == lang:
                count[d[1]].update({t: n for t, n in d[2].items() if t in set(kept)})
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (c.total() + 2 * len(kept)) for t in kept}
        whole, ps = p(sum(count.values(), Counter())), {s: p(c) for s, c in count.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in ps:
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode()) for o in ps if o != s]
            terms = [(-f(ps[s][t], whole[t]), t.encode()) for t in kept if count[s][t] and ps[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


def corpus():
    random.seed(2)
    words = ["alpha", "Beta", "gamma", "ÉTÉ", "straße", "zeta", "漢字", "x", "éa", "z"]
    rows = []
    for i in range(160):
        own = random.choices(words, [20, 9, 7, 5, 4, 3, 3, 2, 1, 1], k=random.randint(0, 25)) + [f"only{i}"]
        rows.append((random.choice([" ", "\n", "-", "7", "\x00"]).join(own), random.choice(["en", "en", "fr", None]), random.choice(["a", "a", "b", "é", "", None])))
    return rows + [rows[0]] * 3 + [(None, "de", "a"), ("", "de", "b"), ("lone word", "xx", "one"), ("alpha " * 30_000 + "Tail" * 500, "en", "c")]


@pytest.mark.parametrize("block", [4, D.BLOCK_TERMS])
def test_equals_the_plain_count(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_TERMS", block)
    rows = corpus()
    docs = spark.createDataFrame([(i % 7, *r, "t", 1) for i, r in enumerate(rows)], SCHEMA).repartition(5)
    got = [tuple(r) for r in D.source_divergence(docs, 4).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, 4)


def test_equals_the_sql_and_empty_tables(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, *r, "t", 1) for i, r in enumerate(rows)], SCHEMA)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toPandas())
    columns = ["lang", "source", "part", "item", "value", "rank"]
    wanted = con.execute(D.OP13_SQL).fetch_df()[columns]
    assert {tuple(r) for r in D.source_divergence(docs).collect()} == set(wanted.itertuples(index=False, name=None)) == plain(rows, 10)
    assert D.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_over_64_bits_and_runs():
    count = np.array([0, 5, 12_000_000_000_000_000])
    assert D.probability(count, 10**17).tolist() == [1 + 10**9 * (int(c) + 2) // 10**17 for c in count]
    rng = np.random.default_rng(5)
    a, b = (np.sort(rng.integers(0, 4, 300)) if k else rng.integers(0, 3, 300) for k in (1, 0))
    p, q = D.probability(a, 900), D.probability(b, 700)
    assert D.pair_value(D.RunColumn(a, 900), D.RunColumn(b, 700), 300) == int(D.divergence(p, q).sum())
