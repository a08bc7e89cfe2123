import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from decklight.llm import packing
from decklight.llm.bpe import vocabulary_path
from decklight.llm.packing import BM25Index, Packer, op6_packing, pack_documents

SCHEMA = "doc_id long, text string, start string, ids int"


def test_index_against_plain_bm25():
    random.seed(1)
    ids = [np.array([random.randint(0, 40) for _ in range(random.randint(1, 30))]) for _ in range(25)]
    index, mean = BM25Index(ids), sum(map(len, ids)) / len(ids)
    for seed in range(len(ids)):
        expected = np.zeros(len(ids))
        for term in set(ids[seed].tolist()):
            holders = [n for n, x in enumerate(ids) if term in x]
            if len(holders) > 1:
                for n in holders:
                    tf = int((ids[n] == term).sum())
                    idf = np.log1p((len(ids) - len(holders) + 0.5) / (len(holders) + 0.5))
                    expected[n] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ids[n]) / mean))
        assert np.allclose(index.scores(seed), expected, atol=1e-4)


def plain_packing(tails, window):
    """The same greedy filling, with scores from an index asked for every tail in turn."""
    index, unused, pieces, fill, sequence = BM25Index(tails), set(range(len(tails))), [], 0, -1

    def lay(n, at):
        nonlocal fill, sequence
        sequence += fill == 0
        put = min(len(tails[n]) - at, window - fill)
        pieces.append((n, at, put, sequence, fill))
        fill = (fill + put) % window
        return at + put

    while unused:
        seed = min(unused)
        unused.remove(seed)
        at = 0
        while True:
            while at < len(tails[seed]):
                at = lay(seed, at)
            if not fill:
                break
            scores, cut = index.scores(seed), None
            for n in sorted(unused, key=lambda n: (-scores[n], n)):
                if scores[n] <= 0 or not fill:
                    break
                unused.remove(n)
                end = lay(n, 0)
                if end < len(tails[n]):
                    cut = n, end
                    break
            if cut is None:
                break
            seed, at = cut
    return pieces


def test_greedy_order_against_plain_packing():
    random.seed(5)
    for _ in range(30):
        tails = [np.array([random.randint(0, 60) for _ in range(random.randint(1, 31))]) for _ in range(40)]
        assert Packer(32, 0).shard(tails) == plain_packing(tails, 32)


def test_copies_meet_wherever_they_were_read(spark):
    random.seed(9)
    rare = [f"Zyxt{i}ology" for i in range(400)]
    texts = [" ".join(random.choices(rare, k=60)) for _ in range(60)]
    rows = [(k * 60 + i, t, "x", 1) for k in range(2) for i, t in enumerate(texts)]
    pieces = pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()
    sequences = defaultdict(set)
    for r in pieces:
        sequences[r.doc_id].add(r.sequence_id)
    near = [i for i in range(60) if min(abs(a - b) for a in sequences[i] for b in sequences[60 + i]) <= 1]
    assert len(near) > 50


def check(spark, monkeypatch, rows, shard):
    monkeypatch.setattr(packing, "SHARD_TOKENS", shard)
    tokenizer = Tokenizer.from_file(vocabulary_path())
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    pieces = pack_documents(docs).collect()
    tokens = defaultdict(list)
    for r in pieces:
        tokens[r.doc_id].append(r)
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(tokens[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    by_sequence = defaultdict(list)
    for r in pieces:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    short, tasks = 0, {r.sequence_id >> 32 for r in pieces}
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
        short += at < 1024
    assert short <= len(tasks)
    assert sum(r.length for r in op6_packing(docs).collect()) == sum(r.length for r in pieces)
    cut = {(r.doc_id, r.start): r for r in op6_packing(docs).collect()}
    for r in cut.values():
        ids = tokenizer.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(ids)


def test_each_id_in_one_piece(spark, monkeypatch):
    random.seed(6)
    words = [f"word{i}" for i in range(150)]
    rows = [(0, None), (1, ""), (None, "x"), (2, "long " * 3000)]
    rows += [(i, " ".join(random.choices(words, k=random.choice([1, 40, 300, 1200])))) for i in range(3, 80)]
    for shard in (1_000_000, 5_000, 1):
        check(spark, monkeypatch, rows, shard)


def test_empty_table(spark):
    assert op6_packing(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_are_packed_one_by_one(spark):
    rows = [(1, "the same text of a few words"), (1, "the same text of a few words"), (1, "another text"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    pieces = op6_packing(docs.repartition(3)).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path())
    sizes = sorted(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(p.length for p in pieces) == sum(sizes) and sorted(p.doc_tokens for p in pieces if p.start == 0) == sizes
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append((p.offset, p.length))
    for own in windows.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 1024
