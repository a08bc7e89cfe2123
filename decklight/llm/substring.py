"""Substring dedup (operator 1): an FM-index per shard, asked by backward search.

A window is 13 consecutive words. Each window belongs to the least-hashed run of
six words in it (its anchor), so equal windows have equal anchors, and consecutive
windows with one anchor form a segment. The job:

1. segments are dealt out by anchor, without their words; those whose anchor is in
   one document only cannot be shared and go;
2. of each content, the segment of the least doc_id stands for all its copies; the
   words of these are cut from the texts and sent to the shard of their anchor, so
   that copies, however many, reach a shard once;
3. each shard (some anchors, of bounded size) is indexed, every segment is streamed
   through the index, and the interval of each of its windows gives the least doc_id
   that holds it;
4. windows held by a smaller doc_id go back to their documents.

Anchors that a sample shows to be frequent are dealt out window by window, by the
window's own hash, and grouped by an aggregate that combines before it shuffles, so
no anchor fills a task. They are marked in a bitmap whose size follows their number; an
anchor that is marked by chance is dealt out in the same way. They are counted in all texts
of over 50,000 characters, one of which may repeat an anchor without end, and in a tenth of
the others; this decides how rows are dealt, never which count.

Equal contents, and equal windows of frequent anchors, are known by hashes of 128 bits
together; where contents differ, the index compares the words themselves.

Defined results: a null text has no words; fewer than 13 words are never removed; a
text of any length is cut whole; rows with a null doc_id are kept whole and remove
nothing; rows that share a doc_id are one document, which removes nothing of itself,
and each loses the windows found in its own text; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .fm_index import FMIndex
from .shared import free_name, mixed, text_or_empty, written
from .words import gather, text_slices

WINDOW = 13
ANCHOR = 6
#: Anchors this often in a sample of this share of the documents are dealt out window by window. Of long texts all are
#: counted, and their segments count as this share each.
HOT_IN_SAMPLE = 64
SAMPLE_SHARE = 0.1
LONG_TEXT = 50_000
#: Bits of the map of hot anchors, at least and at most: 2 MB and 32 MB. Between them it has sixteen for each.
_MAP_BITS = (24, 28)
#: Words in a shard, besides those of its last anchor.
SHARD_WORDS = 400_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` word hashes."""
    total = np.zeros(max(0, len(words) - length + 1), np.uint64)
    for i in range(length):
        total = total * _MULTIPLIER + words[i : i + len(total)]
    return mixed(total)


def segments_of(lengths: np.ndarray, words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(text number, first word in the text, windows, anchor hash, content hash) of all segments of some texts."""
    count = max(0, len(words) - window + 1)
    if not count:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    runs = run_hashes(words, anchor)
    least, place = runs[:count].copy(), np.arange(count)
    for i in range(1, window - anchor + 1):
        better = runs[i : i + count] < least
        least[better], place[better] = runs[i : i + count][better], (np.flatnonzero(better) + i)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    good = text_of[:count] == text_of[window - 1 :]
    new = np.ones(count, bool)
    new[1:] = (place[1:] != place[:-1]) | (text_of[1:count] != text_of[: count - 1]) | ~good[:-1]
    at = np.flatnonzero(new & good)
    size = np.bincount(np.cumsum(new & good)[good] - 1, minlength=len(at))
    # the first and the last window cover a segment, so they and their number make its hash
    whole = run_hashes(words, window)
    content = mixed(whole[at] * _MULTIPLIER + whole[at + size - 1] + size.astype(np.uint64))
    return text_of[at], at - first[text_of[at]], size, least[at], content


def text_tag(text: str) -> int:
    """What tells the texts of rows that share a doc_id apart; it stands above a word's number in ``first`` and ``at``."""
    return (zlib.crc32(text.encode()) >> 1) << 32


_SEGMENT = "anchor long, content long, doc_id long, first long, windows int"
_NAMES = ["anchor", "content", "doc_id", "first", "windows"]


class HotAnchors:
    """A bitmap of anchors."""

    def __init__(self, words: np.ndarray):
        self.words, self.last = words, np.uint64(64 * len(words) - 1)

    def marked(self, key: np.ndarray) -> np.ndarray:
        bit = key & self.last
        return (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def segments(docs: DataFrame, window: int, anchor: int, hot: HotAnchors | None = None, want_hot: bool = False, carry: str | None = None) -> DataFrame:
    """Every text's segments, without words: those whose anchor is not hot, or the windows of those whose is. A whole number may be carried along."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, wide = xxhash.xxh64_intdigest, xxhash.xxh3_128_digest
        for batch in batches:
            for part in text_slices(batch):
                texts = part["text"].to_pylist()
                split = [text.encode().split() for text in texts]
                lengths = np.array([len(w) for w in split], np.int64)
                hashes = np.array([digest(w) for words in split for w in words], np.uint64)
                text, first, size, key, content = segments_of(lengths, hashes, window, anchor)
                if hot is not None:
                    pick = hot.marked(key) == want_hot
                    text, first, size, key, content = (x[pick] for x in (text, first, size, key, content))
                if want_hot:
                    at = gather(first, size)
                    text = np.repeat(text, size)
                    whole = [wide(b" ".join(split[t][a : a + window])) for t, a in zip(text.tolist(), at.tolist())]
                    own = np.frombuffer(b"".join(whole), np.uint64).reshape(-1, 2)
                    key, content, first, size = own[:, 0].copy(), own[:, 1].copy(), at, np.ones(len(own))
                tags = np.array([text_tag(t) for t in texts], np.int64)
                columns = [
                    pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), part["doc_id"].take(pa.array(text)),
                    pa.array(first + tags[text]), pa.array(size.astype(np.int32)),
                ]
                if carry:
                    columns.append(part[carry].take(pa.array(text)))
                yield pa.RecordBatch.from_arrays(columns, [*_NAMES, *([carry] if carry else [])])

    return docs.where("doc_id IS NOT NULL").mapInArrow(cut, _SEGMENT + (f", {carry} int" if carry else ""))


def hot_anchors(docs: DataFrame, window: int, anchor: int) -> HotAnchors | None:
    """Long texts and a sample of the others are cut for it; what comes to the driver is the bitmap."""
    long_text = F.length("text") > LONG_TEXT
    sample = docs.where(long_text).withColumn("long", F.lit(1)).unionByName(docs.where(~long_text).sample(SAMPLE_SHARE, seed=5).withColumn("long", F.lit(0)))
    counted = F.sum(F.when(F.col("long") == 1, SAMPLE_SHARE).otherwise(1.0))
    seen = segments(sample, window, anchor, carry="long").groupBy("anchor").agg(counted.alias("n")).where(F.col("n") >= HOT_IN_SAMPLE)
    seen = written(seen.select("anchor"))
    n = seen.count()
    if not n:
        return None
    bits = min(max(_MAP_BITS[0], (16 * n).bit_length()), _MAP_BITS[1])
    bit = F.col("anchor").bitwiseAND((1 << bits) - 1)
    marks = seen.select(F.shiftright(bit, 6).cast("int").alias("at"), F.expr("shiftleft(1L, CAST(anchor & 63 AS INT))").alias("mark"))
    rows = marks.groupBy("at").agg(F.bit_or("mark").alias("mark")).toArrow()  # one for each 64 bits at most
    words = np.zeros(1 << bits - 6, np.uint64)
    words[rows["at"].to_numpy()] = rows["mark"].to_numpy().view(np.uint64)
    return HotAnchors(words)


def shared_only(dealt: DataFrame) -> DataFrame:
    """Of segments sorted by anchor, content and doc_id: those whose anchor two documents hold, and whether
    one stands for its content; then ``high`` is the content's greatest doc_id."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def out() -> pa.RecordBatch:
            anchor, content, doc, first, windows = (np.concatenate(c) for c in zip(*held))
            n = len(anchor)
            start = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            group = np.repeat(np.arange(len(start)), np.diff(np.append(start, n)))
            shared = (np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start))[group]
            lead = np.append(True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))
            at = np.flatnonzero(lead)
            high = np.zeros(n, np.int64)
            high[at] = np.maximum.reduceat(doc, at)
            columns = (anchor, content, doc, first, windows, lead, high)
            return pa.RecordBatch.from_arrays([pa.array(c[shared]) for c in columns], [*_NAMES, "lead", "high"])

        for batch in batches:
            columns = [batch[c].to_numpy() for c in _NAMES]
            if not batch.num_rows:
                continue
            # rows of the last anchor may go on in the next batch
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut or (held and held[-1][0][-1] != columns[0][0]):
                if cut:
                    held.append([c[:cut] for c in columns])
                yield out()
                held = []
            held.append([c[cut:] for c in columns])
        if held:
            yield out()

    return dealt.mapInArrow(keep, f"{_SEGMENT}, lead boolean, high long")


def shared_segments(docs: DataFrame, window: int, anchor: int) -> tuple[DataFrame, DataFrame]:
    """(all segments that may be shared; of each content, the one of the least doc_id)."""
    hot = hot_anchors(docs, window, anchor)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = segments(docs, window, anchor, hot).repartition(parts, "anchor").sortWithinPartitions("anchor", "content", "doc_id", "first")
    cold = written(shared_only(dealt))
    places = cold.select("anchor", "content", "doc_id", "first")
    leads = cold.where("lead").select(*_NAMES, "high")
    if hot:
        warm = written(segments(docs, window, anchor, hot, True))
        least = warm.groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "first")).alias("lead"), F.max("doc_id").alias("high"))
        least = least.where(F.col("lead.doc_id") < F.col("high"))
        leads = leads.unionByName(least.select("anchor", "content", "lead.doc_id", "lead.first", F.lit(1).alias("windows"), "high"))
        places = places.unionByName(warm.select("anchor", "content", "doc_id", "first"))
    return places, leads


def with_words(docs: DataFrame, leads: DataFrame, window: int) -> DataFrame:
    """(anchor, content, segment, low, high): the words of each leading segment, joined by a space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                rows: list[tuple] = []
                for doc_id, text, found in zip(*(piece[c].to_pylist() for c in ("doc_id", "text", "parts"))):
                    tag = text_tag(text) if found else 0
                    found = [part for part in found or () if part["first"] >> 32 == tag >> 32]
                    words = text.encode().split() if found else []
                    for part in found:
                        first = part["first"] - tag
                        rows.append((part["anchor"], part["content"], b" ".join(words[first : first + part["windows"] + window - 1]), doc_id, part["high"]))
                anchor, content, segment, low, high = zip(*rows) if rows else ((),) * 5
                longs = [pa.array(c, pa.int64()) for c in (anchor, content, low, high)]
                yield pa.RecordBatch.from_arrays(
                    [longs[0], longs[1], pa.array(segment, pa.binary()).cast(pa.string()), longs[2], longs[3]],
                    ["anchor", "content", "segment", "low", "high"],
                )

    parts = leads.groupBy(F.col("doc_id").alias("part_doc_id")).agg(F.collect_list(F.struct("anchor", "content", "first", "windows", "high")).alias("parts"))
    # a left join, as the last one is, so that both read one shuffle of the texts
    joined = docs.join(parts, F.col("doc_id") == F.col("part_doc_id"), "left").select("doc_id", "text", "parts")
    return joined.mapInArrow(cut, "anchor long, content long, segment string, low long, high long")


def search_shards(distinct: DataFrame, window: int) -> DataFrame:
    """(anchor, content, least): for segments some of whose windows a smaller doc_id holds,
    the least doc_id of each window. ``distinct`` has each content once, with its doc_ids' range."""

    def index(anchor, key, segment, low, high) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        split = [s.encode().split(b" ") for s in segment]
        lengths = np.array([len(w) for w in split], np.int64)
        symbols = np.array([number.setdefault(w, len(number) + 1) for words in split for w in words], np.int64)
        fm = FMIndex(symbols, lengths, window)
        start, end = fm.matching_statistics(symbols, lengths)
        low, high = np.array(low, np.int64), np.array(high, np.int64)
        least = fm.least_owner(start, end, low)
        windows = lengths - window + 1
        owner = np.repeat(np.arange(len(windows)), windows)
        wanted = np.bincount(owner, least < high[owner], len(windows)) > 0
        held = wanted[owner]
        ends = np.concatenate([[0], np.cumsum(windows[wanted])]).astype(np.int32)
        pick = np.flatnonzero(wanted)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(anchor, np.int64)[pick]),
                pa.array(np.array(key, np.int64)[pick]),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(least[held])),
            ],
            ["anchor", "content", "least"],
        )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        size = 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("anchor", "content", "segment", "low", "high"))):
                if size >= SHARD_WORDS and row[0] != held[0][-1]:
                    yield index(*held)
                    held, size = [[], [], [], [], []], 0
                for column, value in zip(held, row):
                    column.append(value)
                size += row[2].count(" ") + 1
        if size:
            yield index(*held)

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(shards, "anchor long, content long, least array<long>")


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, at): for each document that has some, the starts of its windows that a smaller doc_id holds too, above them its text's tag."""
    places, leads = shared_segments(docs, window, anchor)
    least = search_shards(with_words(docs, leads, window), window)
    least = least.select(F.col("anchor").alias("a"), F.col("content").alias("c"), "least")
    return (
        places.join(least, (F.col("anchor") == F.col("a")) & (F.col("content") == F.col("c")))
        .select(
            "doc_id",
            F.expr("transform(filter(transform(least, (m, i) -> IF(m < doc_id, i, -1)), i -> i >= 0), i -> first + i)").alias("at"),
        )
        .where(F.size("at") > 0)
        .groupBy(F.col("doc_id").alias("found_doc_id"))
        .agg(F.flatten(F.collect_list("at")).alias("at"))
    )


def kept_words(text: str, at: list[int], window: int) -> tuple[list[bytes], int]:
    """The words of a text that none of its windows starting at ``at`` covers, and how many it has."""
    words = text.encode().split()
    starts = np.unique(np.array(at, np.int64)) - text_tag(text)
    starts = starts[(starts >= 0) & (starts < 1 << 32)]  # those of this text
    edge = np.zeros(len(words) + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    away = np.cumsum(edge)[:-1] > 0
    return [w for w, x in zip(words, away.tolist()) if not x], len(words)


def substring_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` are the words left, joined by a space."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    held = rows.where("doc_id IS NOT NULL")
    found = repeated_windows(held, window, anchor)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                count, gone, kept = [], [], []
                for text, at in zip(part["text"].to_pylist(), part["at"].to_pylist()):
                    if at:
                        left, n = kept_words(text, at, window)
                    else:
                        left = text.encode().split()
                        n = len(left)
                    count.append(n)
                    gone.append(n - len(left))
                    kept.append(b" ".join(left))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(count, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    joined = held.join(found, F.col("doc_id") == F.col("found_doc_id"), "left").select("doc_id", "text", "at")
    kinds = "doc_id long, n_words long, n_removed long, kept string"
    loose = rows.where("doc_id IS NULL").withColumn("at", F.lit(None).cast("array<long>"))  # these lose nothing, and would meet in one task
    return joined.mapInArrow(cut, kinds).unionByName(loose.mapInArrow(cut, kinds))


def op1_substring(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with its own columns; a text that loses words becomes its kept words, others stay as they are."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    found = repeated_windows(rows.where("doc_id IS NOT NULL"), window, anchor)
    name, own = free_name(docs, "__repeats"), free_name(docs, "__text")
    found = found.select(F.col("found_doc_id").alias(name + "id"), F.col("at").alias(name))
    names = docs.columns
    place = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column=own):
                out = part[own].to_pylist()
                for i, at in enumerate(part[name].to_pylist()):
                    if at:
                        left, n = kept_words(out[i] or "", at, window)
                        if len(left) < n:
                            out[i] = b" ".join(left).decode()
                columns = part.select(names).columns
                columns[place] = pa.array(out, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = StructType([StructField(f.name, StringType() if f.name == "text" else f.dataType) for f in docs.schema])
    lost = docs.where("doc_id IS NOT NULL").join(found, F.col("doc_id").cast("long") == F.col(name + "id"), "left").withColumn(own, F.col("text").cast("string"))
    cut_rows = lost.select(*names, own, name).mapInArrow(cut, schema)
    return cut_rows.unionByName(docs.where("doc_id IS NULL").withColumn("text", F.col("text").cast("string")))  # rows without an id lose nothing
