import random
from itertools import combinations

from decklight.llm.licenses import TEMPLATES, Scanner, license_scan, longest_increasing, patience, words_of

SCHEMA = "doc_id long, text string, license int, coverage string"


def test_longest_increasing_against_brute_force():
    random.seed(1)
    for _ in range(60):
        values = random.sample(range(30), random.randint(0, 9))
        got = [values[i] for i in longest_increasing(values)]
        best = max(n for n in range(len(values) + 1) if any(list(c) == sorted(c) for c in combinations(values, n)))
        assert got == sorted(got) and len(got) == best


def test_alignment_is_monotone_and_equal():
    random.seed(2)
    for _ in range(100):
        a, b = ([random.choice("abcdefgh") for _ in range(random.randint(0, 14))] for _ in range(2))
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(patience(a, a)) == len(a)
    assert patience(list("axbyc"), list("abzc")) == [(0, 0), (2, 1), (4, 3)]


def test_templates_find_themselves():
    scanner = Scanner()
    for name, text in TEMPLATES.items():
        found = {m.license: m for m in scanner.scan("er lyth ea " * 40 + text + " onsh" * 9)}
        assert found[name].coverage == 1 and found[name].first == 120 and found[name].last == 119 + len(words_of(text))
    damaged = TEMPLATES["MIT"].replace("person", "human").replace("merge, ", "").replace("hereby", "")
    assert 0.9 < next(m for m in scanner.scan(damaged) if m.license == "MIT").coverage < 1
    assert len([m for m in scanner.scan("Released under the MIT License.\nword\n" * 5) if m.license == "MIT notice"]) == 5
    assert scanner.scan("software license version " * 10_000) == []


def plain_alignment(a, b):
    """Patience alignment by recursion, with every increasing subsequence of the anchors tried."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0), *((i + 1, j + 1) for i, j in plain_alignment(a[1:], b[1:]))]
    if a[-1] == b[-1]:
        return [*plain_alignment(a[:-1], b[:-1]), (len(a) - 1, len(b) - 1)]
    anchors = [(i, b.index(w)) for i, w in enumerate(a) if a.count(w) == 1 and b.count(w) == 1]
    chains = [c for n in range(len(anchors), 0, -1) for c in combinations(anchors, n) if all(p[1] < q[1] for p, q in zip(c, c[1:]))]
    if not chains:
        return []
    chain = max(chains, key=len)
    out, i, k = list(chain), 0, 0
    for p, q in [*chain, (len(a), len(b))]:
        out += [(i + x, k + y) for x, y in plain_alignment(a[i:p], b[k:q])]
        i, k = p + 1, q + 1
    return sorted(out)


def plain_scan(text, templates):
    """Every place of a telling word is aligned, none is left out for having too few words near it."""
    words, found = words_of(text), []
    for name, own in templates.items():
        template = words_of(own)
        telling = {w for w in template if len(w) >= 7} or set(template)
        free = 0
        for at, w in enumerate(words):
            low, high = max(free, at - len(template)), min(len(words), at + len(template))
            if w in telling and at >= free:
                pairs = plain_alignment(words[low:high], template)
                if len(pairs) >= 0.8 * len(template):
                    found.append((name, len(pairs), low + pairs[0][0]))
                    free = low + pairs[-1][0] + 1
    return found


def test_scan_against_brute_force():
    random.seed(7)
    templates = {"one": "granted without charge to any person", "two": "this software is provided as such and the author disclaims it", "three": "a b c d"}
    scanner, hits = Scanner(templates), 0
    for _ in range(150):
        words = []
        for _ in range(random.randint(0, 4)):
            own = words_of(random.choice(list(templates.values())))
            words += [w if random.random() < 0.92 else random.choice(["software", "x", "a", ""]) for w in own] + random.choices(["x", "y", "charge", "author", "b"], k=random.randint(0, 4))
        text = " ".join(words)
        # ties between equally long chains are settled alike only in their number of pairs
        got = [(m.license, m.matched) for m in scanner.scan(text)]
        assert got == [(name, n) for name, n, _ in plain_scan(text, templates)]
        hits += len(got)
    assert hits > 100


def test_rows(spark):
    rows = [(1, "x " + TEMPLATES["MIT notice"], 1, "x"), (1, "x " + TEMPLATES["MIT notice"], 1, "x"), (2, None, None, None), (3, "", None, None), (None, TEMPLATES["ISC"], None, None), (4, "the license " * 50_000, None, None)]
    got = sorted(map(tuple, license_scan(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got.count((1, "MIT notice", 1.0, 5, 1, 5, 1)) == 2
    assert (2, None, 0.0, 0, None, None, 0) in got and (3, None, 0.0, 0, None, None, 0) in got and (4, None, 0.0, 0, None, None, 0) in got
    assert [r[1] for r in got if r[0] is None] == ["ISC"] and len(got) == 6
    assert license_scan(spark.createDataFrame([], SCHEMA)).count() == 0
