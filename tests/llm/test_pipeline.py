import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from decklight.llm.bpe import vocabulary_path
from decklight.llm.shared import written
from decklight.llm.simhash import shingle_set
from decklight.llm.toxicity import toxicity_scores

pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")
def test_each_stage_against_brute_force(spark):
    from tests.llm.test_quality import brute as quality
    from tests.llm.test_substring import brute as repeats

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, (names, stages) = docs.columns, zip(*pipeline.STAGES)
    assert len(stages) == 5
    rows = {r.doc_id: r for r in docs.collect()}

    scores = {r.doc_id: r.predicted for r in toxicity_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    docs = written(stages[0](spark, docs, SF))
    assert docs.columns == columns
    rows, before = {r.doc_id: r for r in docs.collect()}, rows
    assert rows == {i: r for i, r in before.items() if not scores[i]} and len(rows) > 0.8 * len(before)

    docs = written(stages[1](spark, docs, SF))
    rows, before = {r.doc_id: r for r in docs.collect()}, rows
    for i, r in before.items():
        n, chars, symbols, dup_lines, repeated = quality(r.text)
        failed = n < 50 or 100 * repeated > 50 * n or not 2 * n <= chars <= 15 * n or symbols > 0.3 * n
        assert not (failed and i in rows)
    assert all(r == before[i] for i, r in rows.items())

    assert len(rows) > 0.4 * len(before)

    docs = written(stages[2](spark, docs, SF))
    rows, before = {r.doc_id: r for r in docs.collect()}, rows
    sets = {i: set(shingle_set(r.text, 5).tolist()) for i, r in before.items()}
    close = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    assert all(any(close(i, j) for j in before if j < i) or any(close(i, j) for j in before if j != i) for i in before.keys() - rows.keys())
    assert not any(close(i, j) for i in rows for j in rows if i < j)

    docs = written(stages[3](spark, docs, SF))
    assert docs.columns == columns
    rows, before = {r.doc_id: r for r in docs.collect()}, rows
    import hashlib

    for i, _, n_removed, digest in repeats([(i, r.text) for i, r in sorted(before.items())]):
        assert hashlib.sha256(b" ".join(rows[i].text.encode().split())).hexdigest() == digest
        assert n_removed or rows[i].text == before[i].text

    tokenizer = Tokenizer.from_file(vocabulary_path())
    pieces = defaultdict(list)
    for r in stages[4](spark, docs, SF).collect():
        pieces[r.doc_id].append(r)
    for i, r in rows.items():
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [0]
        assert [x for p in sorted(pieces[i], key=lambda p: p.start) for x in p.ids] == ids
    assert pieces.keys() == rows.keys()


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")
def test_run_over_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (None, "x " * 60), (10**9, ""), (10**9, "")], "doc_id long, text string")
    many = docs.unionByName(odd, allowMissingColumns=True).unionByName(docs.limit(5))
    clashing = ("__gone", "__repeats", "__repeatsid", "at", "score", "words", "ids", "key", "row", "found_doc_id", "component_id")
    many = many.withColumns({c: F.lit(i) for i, c in enumerate(clashing)})
    last = many
    for _, stage in pipeline.STAGES[:-1]:
        last = written(stage(spark, last, SF))
        assert last.columns == many.columns
    assert {tuple(r) for r in last.select(*clashing).distinct().collect()} == {tuple(range(len(clashing)))}
    many.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"file://{tmp_path}/labels.parquet")
    assert pipeline.run(spark, f"file://{tmp_path}").count() > 0
    docs.limit(0).write.parquet(f"file://{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"file://{tmp_path}/none/labels.parquet")
    assert pipeline.run(spark, f"file://{tmp_path}/none").count() == 0
