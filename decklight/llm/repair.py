"""Conversation structure repair (operator 12): grammar-compressed dynamic programming.

Each row of a conversation is one symbol: its role initial, whether it must be deleted and
whether it is truncated. The cheapest edits that give role initials ``(s?(ua)+)?`` are a
walk over the four states of that pattern, so a symbol is a min-plus matrix from state to
state, each entry a cost and the least audit string of that cost. The sequences of a slice
of conversations are compressed together by Re-Pair; each rule gets one matrix, the
product of its two symbols', made bottom-up and shared by all conversations that use it.
Audits of rules are ropes, joined and not copied; the product over a conversation's own
symbols gives its cost and audit.

An edit string fixes the roles it gives, and of two strings of one cost for the same rows
none begins with the other, so the least of a product is the product of the leasts.

Conversations of up to ``LONG_ROWS`` rows are one row of a grouped table. Longer ones, one
of which may hold a third of all rows, are cut into segments of ``SEGMENT_ROWS`` by their
place: faults are found by grouped joins, segments are solved like conversations, and
their matrices are multiplied in groups until one is left. Only their texts' hash, which is
sequential by nature, runs through one task a conversation, row by row in bounded memory.

Defined results: null roles and texts are one space, also in the damage's key; a null turn
comes first, counts in no gap, and is a turn of its own key; rows of one turn go by role,
then text, so copies stay adjacent; repeated rows are duplicates; rows of a null conv_id
are one conversation; texts of any length are read whole; a conversation without rows has
zeros, an empty audit and the hash of the empty text; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import written

#: Rows up to which a conversation is handled as one row of a table.
LONG_ROWS = 20_000
#: Rows of a segment of a longer one.
SEGMENT_ROWS = 4_096
#: Segments multiplied in one task.
FOLD = 64
#: Sequences whose result a worker remembers.
CACHE_SEQUENCES = 100_000

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the pattern: nothing yet, after s, after u, after a. Only the first and the last may end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_NEXT = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
_INITIALS = "sua"
#: Symbols: 2 * place of the initial (3 for any other) + truncated, or 8 for a row that must go.
GONE_SYMBOL = 8

Rope = str | tuple
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def flat(rope: Rope) -> str:
    if isinstance(rope, str):
        return rope
    out, stack = [], [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            stack += (top[1], top[0])
    return "".join(out)


def joined(a: Rope, b: Rope) -> Rope:
    if not a or not b:
        return a or b
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 32 else (a, b)


def before(a: Rope, b: Rope) -> bool:
    """Whether a comes before b in ASCII order; a part that both begin with as one object is not looked at."""
    while isinstance(a, tuple) and isinstance(b, tuple) and a[0] is b[0]:
        a, b = a[1], b[1]
    return flat(a) < flat(b)


def _put(matrix: Matrix, key: tuple[int, int], cost: int, audit: Rope) -> None:
    held = matrix.get(key)
    if held is None or cost < held[0] or (cost == held[0] and before(audit, held[1])):
        matrix[key] = (cost, audit)


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: first a, then b."""
    out: Matrix = {}
    for (i, k), (cost, audit) in a.items():
        for j in range(4):
            more = b.get((k, j))
            if more is not None and ((i, j) not in out or cost + more[0] <= out[i, j][0]):
                _put(out, (i, j), cost + more[0], joined(audit, more[1]))
    return out


def _inserts() -> Matrix:
    """Up to two inserted turns; more would only come back to a state."""
    one: Matrix = {(i, _NEXT[i][c]): (INSERT, "I") for i in _NEXT for c in "ua" if c in _NEXT[i]}
    none: Matrix = {(i, i): (0, "") for i in range(4)}
    out = dict(none)
    for step in (one, times(one, one)):
        for key, (cost, audit) in step.items():
            _put(out, key, cost, audit)
    return out


INSERTS = _inserts()


def symbol_matrix(symbol: int) -> Matrix:
    """Inserted turns, then what can be done with one row."""
    row: Matrix = {(i, i): (DELETE, "D") for i in range(4)}
    if symbol != GONE_SYMBOL:
        late, own = TRUNCATED * (symbol % 2), _INITIALS[symbol // 2 : symbol // 2 + 1]
        for i, to in _NEXT.items():
            for c, j in to.items():
                if c == own:
                    _put(row, (i, j), KEEP + late, "K")
                elif c != "s":
                    _put(row, (i, j), REROLE + late, "R")
    return times(INSERTS, row)


SYMBOLS = [symbol_matrix(s) for s in range(GONE_SYMBOL + 1)]


def re_pair(sequences: list[list[int]], first_rule: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Re-Pair: the most frequent pair of neighbours becomes a rule, until none occurs twice.

    Gives the rules' pairs, numbered from ``first_rule``, and the sequences in rules and symbols.
    """
    symbol = [-1]
    for s in sequences:
        symbol += [*s, -1]
    n = len(symbol)
    after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i in range(n - 1):
        if symbol[i] >= 0 <= symbol[i + 1]:
            places[symbol[i], symbol[i + 1]].add(i)
    queue = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
    heapq.heapify(queue)
    rules: list[tuple[int, int]] = []
    while queue:
        count, pair = heapq.heappop(queue)
        now = len(places.get(pair, ()))
        if now < 2 or now != -count:
            if now > 1:
                heapq.heappush(queue, (-now, pair))
            continue
        made, touched = first_rule + len(rules), set()
        for i in sorted(places.pop(pair)):
            j = after[i]
            if symbol[i] != pair[0] or symbol[j] != pair[1]:
                continue  # an overlap that the one before took
            left, right = prior[i], after[j]
            if symbol[left] >= 0:
                places[symbol[left], pair[0]].discard(left)
                places[symbol[left], made].add(left)
                touched.add((symbol[left], made))
            if symbol[right] >= 0:
                places[pair[1], symbol[right]].discard(j)
                places[made, symbol[right]].add(i)
                touched.add((made, symbol[right]))
            symbol[i], symbol[j] = made, -2
            after[i], prior[right] = right, i
        rules.append(pair)
        for t in touched:
            if len(places[t]) > 1:
                heapq.heappush(queue, (-len(places[t]), t))
    out, at = [], 1
    for s in sequences:
        own = []
        for i in range(at, at + len(s)):
            if symbol[i] >= 0:
                own.append(symbol[i])
        out.append(own)
        at += len(s) + 1
    return rules, out


def product(parts: list[Matrix]) -> Matrix:
    """The product in halves, so that ropes stay shallow."""
    if not parts:
        return {(i, i): (0, "") for i in range(4)}
    while len(parts) > 1:
        parts = [times(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def sequence_matrices(sequences: list[list[int]]) -> list[Matrix]:
    """The matrix of each sequence, by a grammar that all share."""
    rules, short = re_pair(sequences, len(SYMBOLS))
    matrices = list(SYMBOLS)
    for a, b in rules:
        matrices.append(times(matrices[a], matrices[b]))
    return [product([matrices[s] for s in own]) for own in short]


def best_end(matrix: Matrix) -> tuple[int, str]:
    """The least cost, and the least audit of it, from nothing to a legal end."""
    ended = times(matrix, INSERTS)
    cost, audit = min((c, flat(a)) for (i, j), (c, a) in ended.items() if i == START and j in (START, AFTER_A))
    return cost, audit


class Solver:
    """(cost, audit) of sequences; those met before are remembered."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, str]] = {}

    def solve(self, sequences: list[bytes]) -> list[tuple[int, str]]:
        if len(self.known) > CACHE_SEQUENCES:
            self.known.clear()
        new = [s for s in dict.fromkeys(sequences) if s not in self.known]
        solved = dict(zip(new, map(best_end, sequence_matrices([list(s) for s in new]))))
        self.known.update((s, r) for s, r in solved.items() if len(s) <= 64)
        return [solved.get(s) or self.known[s] for s in sequences]


# ---- rows -------------------------------------------------------------------------------

_FILLED = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def symbols_of(role: pa.Array, text: pa.Array, repeated: np.ndarray) -> dict[str, np.ndarray]:
    """Faults and symbols of rows, of which ``repeated`` says whether role and text came before."""
    blank = ~pc.match_substring_regex(text, _FILLED).to_numpy(zero_copy_only=False)
    duplicate = ~blank & repeated
    truncated = ~blank & ~repeated & ~pc.match_substring_regex(text, _ENDED).to_numpy(zero_copy_only=False)
    initial = pc.index_in(pc.utf8_slice_codeunits(role, 0, 1), pa.array(list(_INITIALS))).fill_null(3).to_numpy(zero_copy_only=False).astype(np.int64)
    symbol = np.where(blank | duplicate, GONE_SYMBOL, 2 * initial + truncated)
    return {"blank": blank, "duplicate": duplicate, "truncated": truncated, "initial": initial, "symbol": symbol.astype(np.uint8)}


#: Pairs of initials that may follow each other: su, ua, au.
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


class Repaired:
    """A conversation's repaired turns hashed as its rows come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.began, self.hash = audit, 0, START, False, hashlib.sha256()

    def _add(self, name: str, text: str) -> None:
        self.hash.update((b"\n" if self.began else b"") + f"{name}:{text}".encode())
        self.began = True

    def _turn(self, text: str) -> None:
        self.state = AFTER_A if self.state == AFTER_U else AFTER_U
        self._add("assistant" if self.state == AFTER_A else "user", text)

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._turn("")
            self.at += 1

    def put(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _NEXT[self.state][role[0]]
            self._add(role, text)
        elif edit == "R":
            self._turn(text)

    def finish(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def digest(audit: str, role: list[str], text: list[str]) -> str:
    lines = Repaired(audit)
    for r, t in zip(role, text):
        lines.put(r, t)
    return lines.finish()


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the runs that end at ``ends``[1:]."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends])


def solve_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A result for each row (conv_id, turns), turns a list of (turn, role, text) in order."""
    solver = Solver()
    for batch in batches:
        turns = batch["turns"]
        sizes = turns.value_lengths().to_numpy()
        flat_rows = turns.flatten()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        conv = np.repeat(np.arange(batch.num_rows), sizes)
        role, text, turn = (flat_rows.field(c) for c in ("role", "text", "turn"))
        r, t = (c.dictionary_encode() for c in (role, text))
        key = (conv * max(1, len(t.dictionary)) + t.indices.to_numpy()) * max(1, len(r.dictionary)) + r.indices.to_numpy()
        repeated = np.ones(len(key), bool)
        repeated[np.unique(key, return_index=True)[1]] = False
        found = symbols_of(role, text, repeated)
        follows = np.flatnonzero(conv[1:] == conv[:-1]) + 1
        illegal = np.zeros(len(conv), bool)
        illegal[follows] = ~_LEGAL[found["initial"][follows - 1], found["initial"][follows]]
        symbol = found["symbol"].tobytes()
        solved = solver.solve([symbol[a:b] for a, b in zip(ends[:-1], ends[1:])])
        roles, texts = role.to_pylist(), text.to_pylist()
        hashes = [digest(audit, roles[a:b], texts[a:b]) for (_, audit), a, b in zip(solved, ends[:-1], ends[1:])]
        columns = [
            batch["conv_id"], pa.array(_gaps(turn, conv, batch.num_rows)), *(pa.array(_sums(found[c], ends)) for c in ("blank", "duplicate", "truncated")), pa.array(_sums(illegal, ends)),
            pa.array([c for c, _ in solved], pa.int64()), pa.array([a for _, a in solved], pa.string()), pa.array(hashes, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", *(c.split()[0] for c in RESULT.split(", "))])


def _gaps(turn: pa.Array, conv: np.ndarray, n: int) -> np.ndarray:
    """maxTurn - minTurn + 1 - distinctTurns of each conversation, 0 without a turn; rows are in the order of turns."""
    held = turn.is_valid().to_numpy(zero_copy_only=False)
    value, own = turn.drop_null().to_numpy(), conv[held]
    out = np.zeros(n, np.int64)
    first = np.flatnonzero(np.diff(own, prepend=-1))
    if len(first):
        new = np.ones(len(own), np.int64)
        new[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
        last = np.append(first[1:], len(own)) - 1
        out[own[first]] = value[last] - value[first] + 1 - np.add.reduceat(new, first)
    return out


# ---- damage and repair ------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, there): rows damaged by the hash of their key; a dropped row stays as one that is not ``there``."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text"))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(kind != 0)))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("there"))


def repair(rows: DataFrame, long_rows: int = LONG_ROWS, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row a conversation: its faults, the cost and the letters of its cheapest edits, and the hash of what they give.

    ``rows`` have (conv_id, turn, role, text), and ``there`` if rows may be marks of conversations only.
    """
    if "there" not in rows.columns:
        rows = rows.withColumn("there", F.lit(True))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), "there")
    kind = rows.schema["conv_id"].dataType.simpleString()
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long_rows)
    long_ = written(sizes.select("conv_id"))  # at most a row for each ``long_rows`` of the input
    if long_.isEmpty():
        return _short(rows, kind)
    same = rows["conv_id"].eqNullSafe(long_["conv_id"])
    return _short(rows.join(F.broadcast(long_), same, "left_anti"), kind).unionByName(_long(rows.join(F.broadcast(long_), same, "left_semi"), segment_rows, kind))


def _short(rows: DataFrame, kind: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.when(F.col("there"), F.struct("turn", "role", "text"))))
    return rows.groupBy("conv_id").agg(turns.alias("turns")).mapInArrow(_sliced(solve_groups), f"conv_id {kind}, {RESULT}")


def _sliced(solve):
    """``solve`` over slices of a bounded number of turns' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                lists = batch["turns"]
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                size = np.concatenate([[0], np.cumsum(pc.binary_length(lists.flatten().field("text")).to_numpy(), dtype=np.int64)])[ends]
                start = 0
                for i in range(1, batch.num_rows + 1):
                    if i == batch.num_rows or size[i + 1] - size[start] > 8_000_000:
                        yield batch.slice(start, i - start)
                        start = i

        yield from solve(parts())

    return run


# ---- long conversations -----------------------------------------------------------------

_SEGMENT = "costs array<long>, audits array<string>, blank long, duplicate long, truncated long, illegal long, head int, tail int"


def _as_lists(matrix: Matrix) -> tuple[list, list]:
    held = [matrix.get((i, j)) for i in range(4) for j in range(4)]
    return [h and h[0] for h in held], [h and flat(h[1]) for h in held]


def _as_matrix(costs: list, audits: list) -> Matrix:
    return {(k // 4, k % 4): (c, a) for k, (c, a) in enumerate(zip(costs, audits)) if c is not None}


def _solve_segment(group: pa.Table) -> pa.Table:
    """The matrix and the faults of one segment of a conversation."""
    rows = group.sort_by("pos")
    costs, audits = _as_lists(sequence_matrices([rows["symbol"].to_pylist()])[0])
    initial = rows["initial"].to_numpy()
    one = {"conv": rows["conv"][0].as_py(), "segment": rows["segment"][0].as_py(), "costs": costs, "audits": audits, "head": int(initial[0]), "tail": int(initial[-1])}
    one |= {c: pc.sum(rows[c]).as_py() for c in ("blank", "duplicate", "truncated")} | {"illegal": int((~_LEGAL[initial[:-1], initial[1:]]).sum())}
    return pa.Table.from_pylist([one], _SEGMENT_ARROW)


_SEGMENT_ARROW = pa.schema(
    [("conv", pa.int64()), ("segment", pa.int64()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")), ("head", pa.int32()), ("tail", pa.int32())]
)


def _fold(group: pa.Table) -> pa.Table:
    """Up to ``FOLD`` neighbouring segments of a conversation as one."""
    rows = sorted(group.to_pylist(), key=lambda r: r["segment"])
    costs, audits = _as_lists(product([_as_matrix(r["costs"], r["audits"]) for r in rows]))
    between = sum(not _LEGAL[a["tail"], b["head"]] for a, b in zip(rows, rows[1:]))
    one = {"conv": rows[0]["conv"], "segment": rows[0]["part"], "costs": costs, "audits": audits, "head": rows[0]["head"], "tail": rows[-1]["tail"]}
    one |= {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
    one["illegal"] += int(between)
    return pa.Table.from_pylist([one], _SEGMENT_ARROW)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = [best_end(_as_matrix(r["costs"], r["audits"])) for r in batch.select(["costs", "audits"]).to_pylist()]
        columns = [batch["conv"], *(batch[c] for c in ("blank", "duplicate", "truncated", "illegal")), pa.array([c for c, _ in ends], pa.int64()), pa.array([a for _, a in ends], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def _row_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = symbols_of(batch["role"], batch["text"], batch["repeated"].to_numpy(zero_copy_only=False))
        counts = [pa.array(found[c].astype(np.int64)) for c in ("blank", "duplicate", "truncated")]
        yield pa.RecordBatch.from_arrays([batch["conv"], batch["pos"], pa.array(found["symbol"].astype(np.int32)), pa.array(found["initial"].astype(np.int32)), *counts], ["conv", "pos", "symbol", "initial", "blank", "duplicate", "truncated"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation, of rows in its order after one with its audit, held a row at a time."""
    conv, lines = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([lines.finish()], pa.string())], ["conv", "repaired_sha256"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["pos"] < 0:
                if lines:
                    yield done()
                conv, lines = row["conv"], Repaired(row["text"])
            else:
                lines.put(row["role"], row["text"])
    if lines:
        yield done()


def _long(rows: DataFrame, segment_rows: int, kind: str) -> DataFrame:
    names = rows.select("conv_id").distinct()
    names = written(names.select("conv_id", F.xxhash64("conv_id").alias("conv")))  # few: each has over ``long_rows`` rows
    own = rows.where("there").join(F.broadcast(names), rows["conv_id"].eqNullSafe(names["conv_id"])).select("conv", "turn", "role", "text")
    own = written(_placed(own.withColumn("mark", F.monotonically_increasing_id()), ["turn", "role", "text", "mark"]).drop("mark"))
    # the first of equal rows, by two hashes; places are one row each, so no text gathers its copies
    first = own.groupBy("conv", F.xxhash64("role", "text").alias("h"), F.xxhash64("text", F.lit("again"), "role").alias("g")).agg(F.min("pos").alias("pos"))
    marked = own.join(first.select("conv", "pos", F.lit(False).alias("repeated")), ["conv", "pos"], "left").withColumn("repeated", F.coalesce("repeated", F.lit(True)))
    row = "conv long, pos long, symbol int, initial int, blank long, duplicate long, truncated long"
    symbols = marked.select("conv", "pos", "role", "text", "repeated").mapInArrow(_row_symbols, row)
    symbols = symbols.withColumn("segment", F.floor(F.col("pos") / segment_rows))
    parts = written(symbols.groupBy("conv", "segment").applyInArrow(_solve_segment, f"conv long, segment long, {_SEGMENT}"))
    while parts.agg(F.max("segment")).first()[0]:  # as many times as the longest has digits to the base FOLD
        parts = parts.withColumn("part", F.floor(F.col("segment") / FOLD))
        parts = written(parts.groupBy("conv", "part").applyInArrow(_fold, f"conv long, segment long, {_SEGMENT}"))
    solved = written(parts.mapInArrow(_finish, "conv long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"))
    stream = own.select("conv", "pos", "role", "text").unionByName(solved.select("conv", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.col("audit").alias("text")))
    hashes = stream.repartition("conv").sortWithinPartitions("conv", "pos").mapInArrow(_hashes, "conv long, repaired_sha256 string")
    gaps = own.where("turn IS NOT NULL").groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"))
    out = names.join(solved, "conv", "left").join(gaps, "conv", "left").join(hashes, "conv", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` of each row in its conversation, from 0: within written ranges, then over the ranges' sizes."""
    ranged = written(rows.repartitionByRange("conv", *order).withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n"))
    start = (F.sum("n").over(Window.partitionBy("conv").orderBy("range")) - F.col("n")).alias("start")  # a row a range
    keys: list[Column] = [F.col(c).asc_nulls_first() for c in order]
    within = F.row_number().over(Window.partitionBy("range", "conv").orderBy(*keys)) - 1
    return ranged.withColumn("pos", within).join(F.broadcast(sizes.select("conv", "range", start)), ["conv", "range"]).withColumn("pos", (F.col("pos") + F.col("start")).cast("long")).drop("range", "start")


def op12_repair(conversations: DataFrame) -> DataFrame:
    return repair(damage(conversations))
