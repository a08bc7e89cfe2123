"""Token ids of whole slices of texts by a table of words.

A byte-level pre-tokenizer cuts where the class of a character changes, as long as there are
only ASCII characters but the apostrophe, and Latin letters. There numpy finds where the
pre-tokens begin; they tile the bytes of a slice, and Arrow numbers them without a copy. A
stretch between two safe cuts that has other characters stays one word, which ``cut`` divides.
Only distinct words are looked up, and only unknown ones are encoded, all at once. The ids
of a text are then gathered from the table by numpy.

The table is bounded: over ``limit`` words, those that only one slice has used go, and then
the less used half, so a worker's memory does not grow with the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a Python worker remembers; at about 250 bytes each.
CACHE_WORDS = 300_000
#: Up to here, letters and digits are the same to every version of the Unicode tables.
LAST_LATIN = "\u024f"
_ODD, _LETTER, _DIGIT, _MARK, _SPACE, _BREAK = range(6)

#: Encodes pre-tokens: all their ids, and how many each has.
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def text_slices(batch: pa.RecordBatch, most_chars: int = 2_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with bounded text, so that a worker's memory is bounded too."""
    sizes = pc.utf8_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most_chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)


def gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[0], start[0] + 1, ... of all runs, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def byte_classes(odd: Iterable[str] = ()) -> np.ndarray:
    """The class of each byte; what may need a look at more than its neighbours, as an apostrophe does, is odd, and so is ``odd``."""
    kinds = np.full(256, _ODD, np.uint8)
    kinds[33:127] = _MARK
    kinds[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = _LETTER
    kinds[[*b"0123456789"]] = _DIGIT
    kinds[32], kinds[[*b"\t\n\r"]], kinds[39] = _SPACE, _BREAK, _ODD
    kinds[0xC3:0xC9] = _LETTER  # the first of two, up to U+023F
    kinds[[c.encode()[0] for c in odd]] = _ODD
    return kinds


def _ends_in_text(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether a character that is surely not white space ends before each place."""
    last, before = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    white = (before == 0xC2) & ((last == 0x85) | (last == 0xA0))
    white |= (before == 0x9A) & (last == 0x80) | (before == 0x81) & (last == 0x9F)
    white |= (before == 0x80) & ((last <= 0x8B) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
    own = kind[np.maximum(at - 1, 0)]
    return (own == _LETTER) | (own == _DIGIT) | (own == _MARK) | (last == 39) | (last >= 0x80) & ~white


def word_starts(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the words of the texts data[offsets[i]:offsets[i + 1]] begin."""
    if not len(data):
        return np.empty(0, np.int64)
    kind = kinds[data]
    latin = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))  # all letters but two
    known = np.where((data[latin] == 0xC3) & np.isin(data[latin + 1], (0x97, 0xB7)), _ODD, kind[latin])
    kind[latin] = kind[latin + 1] = known
    begins = np.empty(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    begins[1:] &= kind[:-1] != _SPACE  # it belongs to what follows
    white = kind >= _SPACE
    # white space is one word but for its last character, if text follows
    more = np.flatnonzero(white[1:] & white[:-1]) + 1
    begins[more] = ~white[np.minimum(more + 1, len(data) - 1)]
    full = np.diff(offsets) > 0
    begins[offsets[1:][full] - 1] &= ~white[offsets[1:][full] - 1] | ~white[np.maximum(offsets[1:][full] - 2, 0)]
    begins[offsets[:-1][full]] = True
    at = np.flatnonzero(begins)
    odd = kind == _ODD
    if odd.any():
        safe = white[at] & _ends_in_text(data, at, kind)
        safe[np.searchsorted(at, offsets[:-1][full])] = True
        dirty = np.logical_or.reduceat(odd, at[safe])
        at = at[safe | ~dirty[np.cumsum(safe) - 1]]
    return at


class WordTable:
    """``cut`` gives the pre-tokens of a word that has an odd byte; ``encode`` the ids of many pre-tokens.

    ``special`` are texts that are no pre-tokens; words with the first byte of one are left to ``cut``.
    """

    def __init__(self, cut: Callable[[str], list[str]], encode: Encode, special: Iterable[str] = (), limit: int = CACHE_WORDS):
        self.cut, self.encode_tokens, self.limit = cut, encode, limit
        self.kinds = byte_classes(t[0] for t in special)
        latin = [chr(c) for c in range(0xC0, 0x240) if c not in (0xD7, 0xF7) and self.kinds[chr(c).encode()[0]]]
        self._odd = re.compile(f"[^{''.join(map(re.escape, [*map(chr, np.flatnonzero(self.kinds[:128])), *latin]))}]")
        self.places: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.start, self.size, self.used = (np.empty(1 << 14, np.int64) for _ in range(3))
        self.n = self.n_ids = 0

    @property
    def after_space(self) -> list[str]:
        """The words held with a space before them."""
        return [w for w in self.places if w[0] == " "]

    def _append(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        """New words with their runs of ids."""
        while len(self.ids) < self.n_ids + len(ids):
            self.ids = np.append(self.ids, np.empty_like(self.ids))
        while len(self.start) < self.n + len(size):
            self.start, self.size, self.used = (np.append(c, np.empty_like(c)) for c in (self.start, self.size, self.used))
        at, end = self.n, self.n + len(size)
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.start[at:end] = self.n_ids + np.cumsum(size) - size
        self.size[at:end] = size
        self.used[at:end] = 0
        self.n, self.n_ids = end, self.n_ids + len(ids)
        self.places.update(zip(words, range(at, end)))

    def _learn(self, words: list[str]) -> None:
        """Adds words that the table lacks."""
        odd, places = self._odd.search, self.places
        divided = [w for w in words if odd(w)]
        cut = [self.cut(w) for w in divided]
        new = dict.fromkeys([w for w in words if not odd(w)] if divided else words)
        new.update((t, None) for tokens in cut for t in tokens if t not in places)
        if new:
            self._append([*new], *self.encode_tokens([*new]))
        left = [(w, tokens) for w, tokens in zip(divided, cut) if w not in new]
        if left:
            at = np.array([places[t] for _, tokens in left for t in tokens], np.int64)
            size = self.size[at]
            total = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *(len(tokens) for _, tokens in left)])]
            self._append([w for w, _ in left], self.ids[gather(self.start[at], size)], np.diff(total))

    def _forget(self) -> None:
        used = self.used[: self.n]
        held = used >= max(2, np.sort(used)[max(0, self.n - self.limit // 2)])
        place = np.cumsum(held) - 1
        words = {w: int(place[p]) for w, p in self.places.items() if held[p]}
        start, size, used = (c[: self.n][held] for c in (self.start, self.size, self.used))
        ids = self.ids[gather(start, size)]
        self.n = self.n_ids = 0
        self._append([], ids, size)
        self.places, self.used[: self.n] = words, used // 2

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        if self.n > self.limit:
            self._forget()
        _, offsets, data = texts.cast(pa.string()).buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        at = word_starts(data, offsets, self.kinds)
        edges = np.searchsorted(at, offsets)
        words = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(data)])
        numbered = words.dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = [*map(self.places.get, distinct)]
        if None in place:
            self._learn([w for w, p in zip(distinct, place) if p is None])
            place = [self.places[w] if p is None else p for w, p in zip(distinct, place)]
        place = np.array(place, np.int64)
        self.used[place] += 1  # in slices
        place = place[numbered.indices.to_numpy()]
        size = self.size[place]
        return np.concatenate([[0], np.cumsum(size)])[edges], self.ids[gather(self.start[place], size)]
