"""Lexical retrieval packing (operator 6).

Documents are encoded where they are read. Whole windows of a long document are sequences
by themselves; the tails fill the others. A tail is dealt out by a rare token of its
document, the one of the least hash, so that tails which share words meet wherever they
were read. AQE splits what a frequent key would gather in one task (a rebalance, not a
partitioning, for any tail may be packed anywhere). In a task, tails ascend by two such
keys, and every ``SHARD_TOKENS`` ids of them make a shard with its own BM25 inverted index
(terms are token ids): a seed opens a window, the index returns its unused neighbours by
falling score, and they are laid down until the window is full; the last one is cut and its
rest seeds the next window. Where no neighbour is left, the next tail follows. An open
window is carried to the next shard of the task, so a task ends with at most one short
sequence, and holds one shard.

Defined results: a null or empty text is its end id alone; a text of any length is packed
whole; rows are packed one by one, so repeated rows and null ids are packed too; of equal
scores the first tail in the order of the keys wins; an empty table gives an empty table;
other columns are not read. Sequence ids hold the task's number in the upper half, so they
depend on how the rows were dealt.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .bpe import ragged, vocabulary_path
from .shared import mixed, text_or_empty
from .tokens import library_encoder
from .words import gather, text_slices

WINDOW_TOKENS = 1024
END_ID = 0
SHARD_TOKENS = 250_000
#: Ids under this are of frequent tokens in a byte-level vocabulary, whose ids ascend as it was merged; they say little of a text.
FREQUENT_IDS = 2_000
_K1, _B = 1.2, 0.75
_TERM_BITS = 32


class BM25Index:
    """An inverted index of some token arrays, with each posting's BM25 weight."""

    def __init__(self, ids: list[np.ndarray]):
        self.size = len(ids)
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
        key, count = np.unique(np.repeat(np.arange(self.size) << _TERM_BITS, lengths) | flat, return_counts=True)
        owner, term = key >> _TERM_BITS, key & ((1 << _TERM_BITS) - 1)
        found_in = np.bincount(term)
        idf = np.log1p((self.size - found_in + 0.5) / (found_in + 0.5))
        norm = _K1 * (1 - _B + _B * lengths / max(1.0, lengths.mean() if self.size else 1.0))
        weight = (idf[term] * count * (_K1 + 1) / (count + norm[owner])).astype(np.float32)
        self.first = np.searchsorted(owner, np.arange(self.size + 1))  # a document's terms
        narrow = term.astype(np.uint16) if len(found_in) <= 1 << 16 else term  # a radix sort
        order = np.argsort(narrow, kind="stable")  # a term's documents
        self.posting, self.weight = owner[order], weight[order]
        self.start = np.concatenate([[0], np.cumsum(found_in)])
        self.term, self.found_in = term, found_in

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every document for all terms of the seed that are elsewhere too."""
        term = self.term[self.first[seed] : self.first[seed + 1]]
        term = term[self.found_in[term] > 1]
        at = gather(self.start[term], self.found_in[term])
        return np.bincount(self.posting[at], self.weight[at], self.size)


class Packer:
    """Lays documents into windows; one a task. Pieces are (tail, start in it, length, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        self.open, self.fill = first_sequence, 0  # the window that tails are laid into
        self.pieces: list[tuple[int, int, int, int, int]] = []

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def _lay(self, tail: int, start: int, length: int) -> int:
        """Puts as much of a tail as fits into the open window; returns how much."""
        if not self.fill:
            self.open = self.new()
        put = min(length, self.window - self.fill)
        self.pieces.append((tail, start, put, self.open, self.fill))
        self.fill = (self.fill + put) % self.window
        return put

    def shard(self, tails: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        index = BM25Index(tails)
        unused = np.ones(len(tails), bool)
        for seed in range(len(tails)):
            if not unused[seed]:
                continue
            unused[seed] = False
            start = 0
            while start < len(tails[seed]):
                start += self._lay(seed, start, len(tails[seed]) - start)
                if start < len(tails[seed]) or not self.fill:
                    continue
                scores = np.where(unused, index.scores(seed), -1.0)
                while self.fill:
                    n = int(scores.argmax())
                    if scores[n] <= 0:
                        break
                    scores[n], unused[n] = -1.0, False
                    put = self._lay(n, 0, len(tails[n]))
                    if put < len(tails[n]):  # cut here; its rest opens the next window and seeds it
                        seed, start = n, put
                        break
        pieces, self.pieces = self.pieces, []
        return pieces


def rare_keys(offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two keys for each document: the hash of its rare token that is least, by two hashes; without rare ones, of any token."""
    frequent = (ids < FREQUENT_IDS).astype(np.uint64) << np.uint64(63)
    keys = []
    for seed in (1, 2):
        h = mixed(ids.astype(np.uint64) + np.uint64(seed << 40)) >> np.uint64(1) | frequent
        keys.append(np.minimum.reduceat(h, offsets[:-1]).view(np.int64))  # each document has its end id
    return keys[0], keys[1]


#: ``ids`` are the bytes of unsigned 32-bit numbers, which Spark moves as they are.
_ROW = "key long, key2 long, doc_id long, start long, doc_tokens long, ids binary"


def _id_bytes(offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of such a column."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1] // 4
    return ends, np.frombuffer(data, np.uint32) if data is not None else np.empty(0, np.uint32)


def windows_and_tails(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """A row for each whole window of a document and one for its tail, with the keys by which tails are dealt out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = library_encoder(path)
        for batch in batches:
            for part in text_slices(batch):
                ends, flat = library.encode(part["text"], end_id)
                size = np.diff(ends)
                rows = -(-size // window)
                owner = np.repeat(np.arange(len(size)), rows)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(rows) - rows, rows)) * window
                length = np.minimum(window, size[owner] - start)
                key, key2 = (k[owner] for k in rare_keys(ends, flat)) if len(owner) else (np.empty(0, np.int64),) * 2
                # whole windows need no neighbours: they are spread
                spread = mixed(key.view(np.uint64) + start.astype(np.uint64)).view(np.int64)
                key = np.where(length == window, spread, key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(key2), part["doc_id"].take(pa.array(owner)), pa.array(start), pa.array(size[owner]), _id_bytes(np.append(0, np.cumsum(length)), flat)],
                    [c.split()[0] for c in _ROW.split(", ")],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(cut, _ROW)


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW_TOKENS, end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): one row a piece; with ``digest``, the crc32 of its ids, ids_crc32, for them."""
    last = "ids_crc32 long" if digest else "ids array<int>"
    kinds = f"doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, {last}"
    names = [k.split()[0] for k in kinds.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 32)
        held: list[tuple] = []  # doc_id, start, doc_tokens of tails
        ids: list[np.ndarray] = []
        size = 0

        def rows(columns: list, own: list[np.ndarray]) -> pa.RecordBatch:
            doc_id, start, tokens, sequence, offset = (pa.array(c, pa.int64()) for c in columns)
            length = pa.array([len(x) for x in own], pa.int64())
            made = pa.array([zlib.crc32(x) for x in own], pa.int64()) if digest else ragged(own, pa.int32())
            return pa.RecordBatch.from_arrays([doc_id, start, length, tokens, sequence, offset, made], names)

        def packed() -> Iterator[pa.RecordBatch]:
            pieces = packer.shard(ids)
            for i in range(0, len(pieces), 4096):
                part = pieces[i : i + 4096]
                columns = zip(*((held[n][0], held[n][1] + at, held[n][2], sequence, offset) for n, at, _, sequence, offset in part))
                yield rows(list(columns), [ids[n][at : at + put] for n, at, put, _, _ in part])

        for batch in batches:
            ends, flat = _ids_of(batch["ids"])
            length = np.diff(ends)
            info = list(zip(*(batch[c].to_pylist() for c in ("doc_id", "start", "doc_tokens"))))
            whole = np.flatnonzero(length == window).tolist()
            if whole:
                columns = [*zip(*(info[n] for n in whole)), [packer.new() for _ in whole], [0] * len(whole)]
                yield rows(columns, [flat[ends[n] : ends[n + 1]] for n in whole])
            for n in np.flatnonzero(length < window).tolist():
                held.append(info[n])
                ids.append(flat[ends[n] : ends[n + 1]])
                size += len(ids[-1])
                if size >= SHARD_TOKENS:
                    yield from packed()
                    held, ids, size = [], [], 0
        if ids:
            yield from packed()

    made = windows_and_tails(docs, path or vocabulary_path(), window, end_id)
    dealt = made.hint("rebalance", "key").sortWithinPartitions("key", "key2", "doc_id", "start")
    return dealt.drop("key", "key2").mapInArrow(pack, kinds)


def op6_packing(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The pieces, with the crc32 of their ids in place of these."""
    return pack_documents(docs, path, digest=True).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
