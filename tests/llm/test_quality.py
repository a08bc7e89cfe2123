from collections import Counter

import re

from decklight.llm.quality import STOP_WORDS, SYMBOLS, op2_quality_rules

SCHEMA = "doc_id long, text string, n_words string, kept int"


def brute(text):
    words = [w for w in re.split(r"[ \x09-\x0D]+", text or "") if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_against_brute_force(spark):
    good = " ".join(["the quick brown fox of spain and", *(f"word{i} is" for i in range(60))])
    texts = [None, "", " \n\t ", "a b c a b c", "x\nx\n\nx", good, good, "漢字 🙂 # $%", "a a a a a", ("la la the " * 40_000), "$$$ %%% " * 60, good.replace(" ", " ")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, good, None, None)], SCHEMA)
    got = {r.doc_id: r for r in op2_quality_rules(docs).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert got[5].kept and got[6].kept and got[None].kept and not got[10].kept and not got[0].kept
    assert op2_quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0
    assert "the" in STOP_WORDS


def test_repeated_rows_and_null_ids_are_judged_one_by_one(spark):
    text = " ".join(["the quick brown fox of spain and", *(f"word{i} is" for i in range(60))])
    rows = [(1, text, "x", 1)] * 3 + [(1, "few words", "x", 1)] + [(None, text, "x", 1)] * 2
    got = [(r.doc_id, r.n_words, r.kept) for r in op2_quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()]
    n = len(text.split())
    assert sorted(got, key=str) == sorted([(1, n, True)] * 3 + [(1, 2, False)] + [(None, n, True)] * 2, key=str)
