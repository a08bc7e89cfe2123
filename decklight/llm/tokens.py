"""Token ids in Parquet (operator 10) and the library encoder it shares with packing.

Ids are a ``list<int32>`` column with dictionary encoding (or delta encoding),
in files that follow each other in ascending doc_id order. Row groups are bounded
and the writer adds page indexes, so a filter on doc_id or a read of ``n_tokens``
alone skips the token pages. ``row_no`` is a row's place in its file.

Defined results: a null text is empty, so the document is its end id alone; a text of
any length is encoded whole; rows with one doc_id, equal or not, stand next to each
other as they were read, in several files if they are many, and ``start`` follows that
order; a null doc_id comes first;
an empty table gives an empty table; other columns are not carried.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import PRE_TOKENS, byte_alphabet, id_lists, vocabulary_path
from .shared import read_table, shared_folder, text_or_empty
from .words import LAST_LATIN, WordTable, text_slices

END_ID = 2


class LibraryEncoder:
    """The ``tokenizers`` library, asked once for each distinct pre-token while its word is remembered.

    Words of Latin characters are cut as the pre-tokenizer does, and the library's model encodes
    their parts; other words, and the texts of special tokens, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self._whole: set[str] = set()
        self._byte_char = {b: c for c, b in byte_alphabet().items()}
        self._words = regex.compile(PRE_TOKENS)
        self.table = WordTable(self._cut, self._encode, special)

    def _cut(self, word: str) -> list[str]:
        if (word.isascii() or max(word) <= LAST_LATIN) and not self._special.search(word):
            return self._words.findall(word)
        self._whole.add(word)
        return [word]

    def _encode(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole, self._whole = self._whole, set()
        tokens_of = {w: e.ids for w, e in zip(whole, self.tokenizer.encode_batch_fast(list(whole), add_special_tokens=False))} if whole else {}
        # no byte of a text is 255, so it stands between tokens while they are spelt as the vocabulary spells bytes
        spelt = b"\xff".join(map(str.encode, tokens)).decode("latin-1").translate(self._byte_char).split("\xff")
        tokenize = self.tokenizer.model.tokenize
        if whole:
            lists = [tokens_of[token] if token in whole else [t.id for t in tokenize(chars)] for token, chars in zip(tokens, spelt)]
        else:
            lists = [[t.id for t in tokenize(chars)] for chars in spelt]
        return np.array([*chain.from_iterable(lists)], np.uint32), np.array([*map(len, lists)], np.int64)

    def encode(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts, each closed by ``end_id``."""
        offsets, ids = self.table.encode(texts)
        return offsets + np.arange(len(offsets)), np.insert(ids, offsets[1:], np.uint32(end_id))


_encoders: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    if path not in _encoders:
        _encoders[path] = LibraryEncoder(path)
    return _encoders[path]


def encode_with_end(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids) in the order of the rows, each document closed by ``end_id``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = library_encoder(path)
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays([part["doc_id"], id_lists(*library.encode(part["text"], end_id))], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>")


def write_token_files(
    docs: DataFrame,
    out: str,
    path: str | None = None,
    end_id: int = END_ID,
    files: int | None = None,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
) -> None:
    """Files of (file_no, row_no, doc_id, n_tokens, ids); the order is file_no, then row_no, which ascends with doc_id.

    Range partitioning deals doc_ids, and the rows of one as they were read, out evenly; ``files`` defaults to the number
    of shuffle partitions. ``encoding`` is ``dictionary`` or ``delta``.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding: {encoding}")
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("tie"))
        .repartitionByRange(files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    encoded = encode_with_end(ordered, path or vocabulary_path(), end_id)
    (
        # the number of the partition, and of the row in it, as it comes
        encoded.withColumn("place", F.monotonically_increasing_id())
        .select(F.shiftright("place", 33).cast("int").alias("file_no"), F.col("place").bitwiseAND((1 << 33) - 1).alias("row_no"), "doc_id", F.size("ids").alias("n_tokens"), "ids")
        .write.option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .parquet(out)
    )


def read_token_files(spark: SparkSession, out: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The token files; bounds on doc_id are pushed down to row groups and pages."""
    rows = spark.read.schema("file_no int, row_no long, doc_id long, n_tokens int, ids array<int>").parquet(out)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows


def token_digests(spark: SparkSession, out: str) -> DataFrame:
    """Per document: ids before it, its ids and their crc32, all from the files.

    Running totals take two steps: within a file, and over the files' totals, of
    which there are as few as files.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["ids"].values.to_numpy().view(np.uint8)
            ends = batch["ids"].offsets.to_numpy().tolist()
            crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["file_no"], batch["row_no"], batch["doc_id"], pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
                ["file_no", "row_no", "doc_id", "n_tokens", "ids_crc32"],
            )

    read = read_token_files(spark, out)
    rows = read.select("file_no", "row_no", "doc_id", "ids").mapInArrow(digest, "file_no int, row_no long, doc_id long, n_tokens long, ids_crc32 long")
    per_file = read.groupBy("file_no").agg(F.sum(F.col("n_tokens").cast("long")).alias("total"))
    before = per_file.select(
        F.col("file_no").alias("f"),
        (F.sum("total").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("before"),
    )
    within = Window.partitionBy("file_no").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("upto", F.sum("n_tokens").over(within))
        .join(before, F.col("file_no") == F.col("f"))
        .select("doc_id", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
    )


def op10_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    out = shared_folder(spark)
    write_token_files(read_table(spark, sf_dir, "documents", "doc_id", "text"), out, path)
    return token_digests(spark, out)
