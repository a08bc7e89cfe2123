"""Byte-level BPE (operator 9).

A word's merges are found in a contiguous rank array: part boundaries, and for each
part the rank of joining it with the next. The array is scanned for its minimum, that
boundary is deleted and the two neighbouring ranks are looked up again. The words that
are new to a slice of texts do this side by side, a row of a matrix each. Scanning is
quadratic, so words over ``SHORT_WORD`` bytes keep the same boundaries in a linked list
and the ranks in a heap.

Texts are cut only at places across which the pre-tokenizer never joins (``words``), so
the pieces can be encoded, and cached, on their own.

Defined results: a null text is empty and gives an empty list; a text of any length is
encoded whole, with its words cut as above; equal rows give equal rows; an empty table
gives an empty table; other columns are not returned, so their names cannot clash. A
null id stays null.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .shared import text_or_empty
from .words import WordTable, gather, text_slices

SHORT_WORD = 48
#: Rows of a rank matrix.
_ROWS = 8192
_NO_RANK = np.int64(1 << 60)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# Fixed value: the published pre-tokenizer pattern of this vocabulary.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class RankArrayBPE:
    """Encoder and decoder for one vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        token_bytes = {i: bytes(alphabet[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        self.ranks = {token: i for i, token in token_bytes.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = token_bytes | {i: content.encode() for content, i in self.special.items()}
        self.token_bytes = pa.array([self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)], pa.large_binary())
        self._special_split = re.compile("(" + ("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)") + ")")
        self._words = regex.compile(PRE_TOKENS)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.table = WordTable(self.pre_tokens, self.encode_tokens, self.special)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of parts that can be joined, as sorted keys, and their ranks; the decoder needs none."""
        get, keys, joined = self.ranks.get, array("q"), array("q")
        for token, i in self.ranks.items():
            for k in range(1, len(token)):
                left, right = get(token[:k]), get(token[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    joined.append(i)
        key, rank = np.array(keys, np.int64), np.array(joined, np.int64)
        order = np.argsort(key)
        return np.append(key[order], 1 << 62), np.append(rank[order], _NO_RANK)

    def pre_tokens(self, text: str) -> list[str]:
        """The text of a special token is that token."""
        parts = self._special_split.split(text)
        return [t for part in parts for t in ([part] if part in self.special else self._words.findall(part))]

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of joining two parts, which is also the id of what they become."""
        keys, rank = self.pairs
        key = left << 32 | right
        at = np.searchsorted(keys, key)
        return np.where(keys[at] == key, rank[at], _NO_RANK)

    def merge_side_by_side(self, parts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts of each row (ids of its ``length`` bytes, then -1) after all merges, and how many are left."""
        out, left_over = np.full_like(parts, -1), length.copy()
        row = np.arange(len(parts))
        inside = np.arange(1, parts.shape[1]) < length[:, None]
        rank = np.full(inside.shape, _NO_RANK)
        rank[inside] = self._joined(parts[:, :-1][inside], parts[:, 1:][inside])
        while len(row):
            number = np.arange(len(row))
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            least = rank[number, at] if rank.shape[1] else np.full(len(row), _NO_RANK)
            going = least < _NO_RANK
            if not going.all():
                done = row[~going]
                out[done, : parts.shape[1]] = parts[~going]
                row, parts, rank, at, least = row[going], parts[going], rank[going], at[going], least[going]
                number = np.arange(len(row))
            if not len(row):
                break
            # delete the boundary between ``at`` and its neighbour, with its rank
            parts[number, at] = least
            stay = np.ones(parts.shape, bool)
            stay[number, at + 1] = False
            parts = parts[stay].reshape(len(row), -1)
            stay = np.ones(rank.shape, bool)
            stay[number, at] = False
            rank = rank[stay].reshape(len(row), -1)
            left_over[row] -= 1
            # the ranks of the new part with its neighbours
            has = np.flatnonzero(at + 1 < left_over[row])
            rank[has, at[has]] = self._joined(parts[has, at[has]], parts[has, at[has] + 1])
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self._joined(parts[has, at[has] - 1], parts[has, at[has]])
        return out, left_over

    def merge_long(self, word: bytes) -> list[int]:
        ranks, n = self.ranks, len(word)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = after[i]
            if middle >= n or middle < 0 or after[middle] != end:
                continue
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
                if (rank := ranks.get(word[i : after[end]])) is not None:
                    heapq.heappush(heap, (rank, i, after[end]))
            if before[i] >= 0 and (rank := ranks.get(word[before[i] : end])) is not None:
                heapq.heappush(heap, (rank, before[i], end))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : after[i]]])
            i = after[i]
        return out

    def encode_tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens, and how many each has."""
        words = [t.encode() for t in tokens]
        length = np.array(list(map(len, words)), np.int64)
        start, count, found = np.empty_like(length), np.empty_like(length), []
        made = 0

        def put(rows, ids: np.ndarray, size) -> None:
            nonlocal made
            start[rows], count[rows] = made + np.cumsum(size) - size, size
            found.append(ids)
            made += len(ids)

        short = np.flatnonzero(length <= SHORT_WORD)
        short = short[np.argsort(length[short], kind="stable")]
        for at in range(0, len(short), _ROWS):
            rows = short[at : at + _ROWS]
            size = length[rows]
            inside = np.arange(size[-1]) < size[:, None]
            parts = np.full(inside.shape, -1, np.int64)
            parts[inside] = self.byte_ids[np.frombuffer(b"".join([words[i] for i in rows.tolist()]), np.uint8)]
            merged, left = self.merge_side_by_side(parts, size)
            put(rows, merged[np.arange(merged.shape[1]) < left[:, None]], left)
        for i in np.flatnonzero(length > SHORT_WORD).tolist():
            own = np.array(self.merge_long(words[i]), np.int64)
            put([i], own, np.array([len(own)]))
        for i in [i for i, t in enumerate(tokens) if t in self.special]:
            put([i], np.array([self.special[tokens[i]]]), np.array([1]))
        return np.concatenate(found)[gather(start, count)].astype(np.uint32), count

    def encode(self, text: str) -> np.ndarray:
        """Ids as the library gives them."""
        return self.table.encode(pa.array([text], pa.string()))[1]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")

    def decode_rows(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The text of each row of ids."""
        lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), self.token_bytes.take(pa.array(ids)))
        joined = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
        try:
            return joined.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # ids that are not of a text
            return pa.array([b.decode("utf-8", errors="replace") for b in joined.to_pylist()], pa.string())


_loaded: dict[str, RankArrayBPE] = {}


def encoder(path: str) -> RankArrayBPE:
    """One per Python worker."""
    if path not in _loaded:
        _loaded[path] = RankArrayBPE(path)
    return _loaded[path]


def ragged(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column out of one array a row."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind.to_pandas_dtype())))


def id_lists(offsets: np.ndarray, ids: np.ndarray) -> pa.ListArray:
    """A column array<int> of unsigned ids."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))


def bpe_encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row; one map over the rows, no shuffle."""
    path = path or vocabulary_path()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(path).table
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays([part["doc_id"], id_lists(*table.encode(part["text"]))], ["doc_id", "ids"])

    return rows.mapInArrow(encode, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with the column ``decoded``; null ids give an empty text."""
    path = path or vocabulary_path()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                size = part["ids"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                texts = bpe.decode_rows(part["ids"].flatten().to_numpy(), np.concatenate([[0], np.cumsum(size, dtype=np.int64)]))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["ids"], texts], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, decoded string")


def op9_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The digest of each document's ids and of what they decode to."""
    return bpe_decode(bpe_encode(docs, path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
