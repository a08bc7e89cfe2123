import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from decklight.llm.bpe import RankArrayBPE, bpe_decode, bpe_encode, op9_bpe, vocabulary_path
from decklight.llm.tokens import END_ID, LibraryEncoder, read_token_files, token_digests, write_token_files
from decklight.llm.words import byte_classes, word_starts

ODD = ["", " ", "  a", "a\n b", "a \n b", "it's  'll", "<|endoftext|>x <|endoftext|>", "é漢🙂 x" * 3, "x" * 3000, "ab" * 500 + " " * 9]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def texts():
    random.seed(5)
    alphabet = "ab Z9 \n\t\x0b\x1c\x85\xa0　'sé漢🙂'll%$. "
    return ODD + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 50))) for _ in range(500)]


def test_rank_array_matches_the_library(library):
    bpe, cached = RankArrayBPE(vocabulary_path()), LibraryEncoder(vocabulary_path())
    many = texts()
    column = pa.array(many, pa.string())
    ends, flat = cached.encode(column, 9)
    own_ends, own = bpe.table.encode(column)
    decoded = bpe.decode_rows(own, own_ends).to_pylist()
    for i, text in enumerate(many):
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text).tolist() == ids == own[own_ends[i] : own_ends[i + 1]].tolist()
        assert flat[ends[i] : ends[i + 1]].tolist() == ids + [9]
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False) == decoded[i]


def test_words_are_pre_tokens_wherever_bytes_tell(library):
    bpe, cached = RankArrayBPE(vocabulary_path()), LibraryEncoder(vocabulary_path())
    random.seed(8)
    plain, odd = "abZ 90\n\t\r .,<|-éÀß×÷ȿ", "abé \n'’漢\x85\xa0\u200b\u3000\x1c\x7fµñɏ. <|endoftext|>×"
    many = ["".join(random.choices(alphabet, k=random.randint(0, 25))) for alphabet in (plain, odd) for _ in range(3000)]
    many += ["<|endoftext|>", " <|endoftext|>\n", "it's ’tis dogs' end  ", "\r\n\r\n x", "é", "x é.\né", "", "", "\n", "a ", " a"]
    data, offsets = np.frombuffer("".join(many).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in many)])
    at = np.append(word_starts(data, offsets, byte_classes()), len(data))
    words = [bytes(data[a:b]).decode() for a, b in zip(at, at[1:])]
    edges = np.searchsorted(at[:-1], offsets)
    for text, first, last in zip(many, edges, edges[1:]):
        expected = bpe._words.findall(text)
        assert [t for w in words[first:last] for t in bpe._words.findall(w)] == expected
        if not set(text) & set("'’漢\x85\xa0\u200b\u3000\x1c\x7fµɏ×÷"):
            assert words[first:last] == expected
    column = pa.array(many, pa.string()).slice(7)
    for ends, ids in (bpe.table.encode(column), cached.table.encode(column)):
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode(t, add_special_tokens=False).ids for t in many[7:]]


def test_marks_and_lines_make_no_new_words(library):
    stems = [a + b for a in ("an", "the", "été", "ou", "ing") for b in ("on", "é", "re", "st", "ti", "wh")]
    text = " ".join(f"{a}{mark}{b.title()}" for a in stems for b in stems for mark in (".\n", ", ", ";", ". "))
    for table in (RankArrayBPE(vocabulary_path()).table, LibraryEncoder(vocabulary_path()).table):
        assert table.encode(pa.array([text]))[1].tolist() == library.encode(text, add_special_tokens=False).ids
        assert table.n <= 4 * len(stems) + 5  # a word as it is or with a capital, each with or without a space; marks and line breaks


def test_bounded_table_and_ids_of_no_text(library):
    random.seed(2)
    bpe = RankArrayBPE(vocabulary_path())
    bpe.table.limit = 60
    for _ in range(12):
        many = [" ".join(random.choices("ab,cdé1", k=random.randint(1, 5))) + " x" * random.randint(0, 3) + "".join(random.choices("abcdefg ", k=40)) for _ in range(20)]
        ends, flat = bpe.table.encode(pa.array(many))
        for i, text in enumerate(many):
            assert flat[ends[i] : ends[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(bpe.table.after_space) <= bpe.table.n < 700
    ids = library.encode("漢", add_special_tokens=False).ids[:1]
    assert bpe.decode_rows(np.array(ids * 2, np.uint32), np.array([0, 1, 2])).to_pylist() == [library.decode(ids, skip_special_tokens=False)] * 2


def test_short_and_long_words_agree():
    bpe = RankArrayBPE(vocabulary_path())
    words = [b"a", b"hello", b"unhappinesses", bytes(range(256)), b"ab" * 300, b"b", b" the", b"zq"]
    size = np.array([len(w) for w in words])
    parts = np.full((len(words), size.max()), -1)
    for row, word in zip(parts, words):
        row[: len(word)] = bpe.byte_ids[list(word)]
    merged, left = bpe.merge_side_by_side(parts, size)
    for row, n, word in zip(merged, left, words):
        assert row[:n].tolist() == bpe.merge_long(word)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int")


def test_queries_over_odd_rows(spark, library, tmp_path):
    rows = [(i, t, "x", 1) for i, t in enumerate([*ODD, "long words, " * 60_000])] + [(100, "longer than the other", None, None), (100, "b c " * 5, None, None)] + [(99, None, None, None), (100, ODD[3], None, None), (100, ODD[3], None, None), (None, "b", None, None)]
    docs = frame(spark, rows)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op9_bpe(docs).collect()}
    assert len(got) == len(rows) - 1
    decoded = {(r.doc_id, r.decoded) for r in bpe_decode(bpe_encode(docs)).collect()}
    assert decoded == {(i, t or "") for i, t, *_ in rows}
    out = f"file://{tmp_path}/tokens"
    write_token_files(docs, out, files=3)
    start, expected = 0, []
    got = sorted(map(tuple, token_digests(spark, out).collect()), key=lambda r: r[1])
    held = [(r.doc_id, r.ids) for r in sorted(read_token_files(spark, out).collect(), key=lambda r: (r.file_no, r.row_no))]
    assert sorted(i for i, *_ in rows if i is not None) == [i for i, _ in held if i is not None]
    ids_of = lambda t: library.encode(t or "", add_special_tokens=False).ids + [END_ID]
    assert sorted((str(i), ids_of(t)) for i, t, *_ in rows) == sorted((str(i), ids) for i, ids in held)
    for i, ids in held:
        ids = np.array(ids, "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == expected
    assert {r.doc_id for r in read_token_files(spark, out, 2, 4).collect()} == {2, 3, 4}


def test_empty_table_and_delta(spark, tmp_path):
    docs = frame(spark, [])
    assert op9_bpe(docs).count() == 0
    for encoding in ("dictionary", "delta"):
        write_token_files(docs, f"file://{tmp_path}/{encoding}", files=2, encoding=encoding)
        assert token_digests(spark, f"file://{tmp_path}/{encoding}").count() == 0
    with pytest.raises(ValueError):
        write_token_files(docs, f"file://{tmp_path}/x", encoding="plain")
