import hashlib
import itertools
import random
import re
import zlib

import pytest

from decklight.llm import repair as R

GAP = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, audit string, pos int"


def faults(rows):
    """The first fault of each row, or none."""
    out, seen = [], set()
    for _, role, text in rows:
        if not text.strip(GAP):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if text.rstrip(GAP)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows, fault):
    """The least (cost, audit) over all edits with up to two inserted turns at a place, and what it gives."""
    inserted = [()] + [(a,) for a in "ua"] + [(a, b) for a in "ua" for b in "ua"]
    best = None
    choices = []
    for (_, role, text), f in zip(rows, fault):
        late = 3 * (f == "truncated")
        own = [(4, "D", None)]
        if f not in ("blank", "duplicate"):
            own += [(late, "K", (role, text)), (3 + late, "R", ("user", text)), (3 + late, "R", ("assistant", text))]
        choices.append(own)
    full = {"u": "user", "a": "assistant"}
    for edits in itertools.product(*choices):
        for gaps in itertools.product(inserted, repeat=len(rows) + 1):
            turns, audit, cost = [], "", 0
            for k, gap in enumerate(gaps):
                turns += [(full[c], "") for c in gap]
                audit += "I" * len(gap)
                cost += 3 * len(gap)
                if k < len(edits):
                    cost += edits[k][0]
                    audit += edits[k][1]
                    turns += [edits[k][2]] if edits[k][2] else []
            if (best is None or (cost, audit) < best[:2]) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in turns) if all(r for r, _ in turns) else "?"):
                best = (cost, audit, turns)
    return best


def forward(rows, fault):
    """The same for longer ones, a row at a time."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    full = {"u": "user", "a": "assistant"}

    def grown(held):
        out = dict(held)
        for _ in range(2):
            for i, (cost, audit, turns) in list(out.items()):
                for c, j in step[i].items():
                    if c != "s":
                        new = (cost + 3, audit + "I", [*turns, (full[c], "")])
                        out[j] = min(out.get(j, new), new, key=lambda v: v[:2])
        return out

    held = {0: (0, "", [])}
    for (_, role, text), f in zip(rows, fault):
        out = {}
        for i, (cost, audit, turns) in grown(held).items():
            found = [(i, (cost + 4, audit + "D", turns))]
            if f not in ("blank", "duplicate"):
                late = 3 * (f == "truncated")
                for c, j in step[i].items():
                    if role[:1] == c:
                        found.append((j, (cost + late, audit + "K", [*turns, (role, text)])))
                    elif c != "s":
                        found.append((j, (cost + 3 + late, audit + "R", [*turns, (full[c], text)])))
            for j, new in found:
                out[j] = min(out.get(j, new), new, key=lambda v: v[:2])
        held = out
    return min((v for i, v in grown(held).items() if i in (0, 3)), key=lambda v: v[:2])


def damaged(rows):
    """{conv_id: rows} by the contract."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def expected(rows, solve=forward):
    fault = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, made = solve(rows, fault)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
    )


def table(n, longest, seed=1):
    random.seed(seed)
    texts = ["One. ", "Two", "Three!\n", "Vier?", "cinq .", "", " \t", None, "é. x", "Six."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"]
    rows = []
    for conv in range(n):
        turn = random.randint(-3, 3)
        for _ in range(random.randint(1, longest)):
            turn += random.choice([0, 1, 1, 1, 2, 5])
            rows.append((conv if conv else None, turn if random.random() > 0.1 else None, random.choices(roles, [6, 6, 3, 6, 6, 1, 1, 1, 1])[0], random.choice(texts)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def checked(got, rows):
    wanted = {c: expected(own) for c, own in damaged(rows).items()}
    assert len(got) == len(wanted)
    for r in got:
        assert tuple(r)[1:] == wanted[r.conv_id], (r, damaged(rows)[r.conv_id])


def test_against_all_edits():
    random.seed(4)
    for _ in range(60):
        rows = [(i, random.choice(["user", "assistant", "system", "tool", ""]), random.choice(["A.", "b", "", "C!"])) for i in range(random.randint(0, 3))]
        fault = faults(rows)
        assert brute(rows, fault)[:2] == forward(rows, fault)[:2]


def test_conversations(spark):
    rows = table(400, 12)
    rows += rows[:40]
    checked(R.op12_repair(frame(spark, rows).repartition(6)).collect(), rows)
    none = R.op12_repair(frame(spark, []))
    assert none.count() == 0 and none.columns[:2] == ["conv_id", "gaps"]


@pytest.mark.parametrize("fold", [2, 64])
def test_long_conversations_in_segments(spark, monkeypatch, fold):
    monkeypatch.setattr(R, "FOLD", fold)
    rows = table(30, 40, 3) + [(7, None, "user", "Same.")] * 50 + [(8, t, "user", f"Turn {t}.") for t in range(60)]
    got = R.repair(R.damage(frame(spark, rows)), long_rows=12, segment_rows=5)
    checked(got.collect(), rows)


def test_very_long_text_and_dropped_rows(spark):
    gone = next(t for t in range(99) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, gone, "user", "Hello."), (6, 0, "user", "word " * 400_000 + "end."), (6, 1, "assistant", "Yes.")]
    got = {r.conv_id: r for r in R.op12_repair(frame(spark, rows)).collect()}
    assert tuple(got[5])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    checked(got.values(), rows)


def test_grammar_gives_the_sequences_back():
    random.seed(9)
    sequences = [random.choices(range(9), [8, 1, 1, 1, 1, 1, 1, 1, 1], k=random.randint(0, 60)) for _ in range(80)] + [[0] * 33]
    rules, short = R.re_pair(sequences, 9)
    grown = lambda s: [s] if s < 9 else [x for part in rules[s - 9] for x in grown(part)]
    assert [[x for s in own for x in grown(s)] for own in short] == sequences
    assert sum(map(len, short)) < sum(map(len, sequences)) / 2
