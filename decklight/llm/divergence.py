"""Source divergence audit (operator 13): run-length columns of term counts.

Each language keeps the terms that are in enough of its documents. Its (language, source)
groups are columns of counts over these terms. The vocabulary is put in an order that
brings equal counts together, by the list of a term's (source, count) entries, and cut
into blocks. In a block every column is run-length encoded; for a pair of sources the
boundaries of their runs are merged, and the divergence of a merged run is taken once and
multiplied by its length. The sums of the blocks are added up.

A term has at most one entry a source, a block ``BLOCK_TERMS`` terms, and a hot language
or source has more blocks, not larger ones. Probabilities are whole numbers of billionths;
where a product could leave 64 bits, Python's integers are used.

Defined results: null text, lang and source are empty; a text without terms adds no count,
but its group is there; repeated rows count as documents of their own; texts are read
whole; equal values rank by the UTF-8 bytes of the item; without kept terms each pair has
the value 0 and there are no term rows; a language with one source has no pair rows; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .shared import text_or_empty, written
from .words import text_slices

#: Documents of its language that a kept term is in.
LEAST_DOCS = 10
#: Ranks of the term part.
TOP_TERMS = 10
#: Terms of a block, a power of two.
BLOCK_TERMS = 1 << 12
BILLION = 1_000_000_000
#: Over this count a product with a billion may leave 64 bits.
_SAFE_COUNT = 9_000_000_000
#: What stands between terms: all of ASCII but the letters.
_GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def slice_counts(part: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of a slice of documents: each term once for each group."""
    lists = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(part["text"]), _GAP, " "), " ")
    coded = lists.flatten().dictionary_encode()
    size = max(1, len(coded.dictionary))
    rows = np.repeat(np.arange(part.num_rows, dtype=np.int64), lists.value_lengths().to_numpy())
    in_row, count = np.unique(rows * size + coded.indices.to_numpy(), return_counts=True)
    lang, source = (part[c].dictionary_encode() for c in ("lang", "source"))
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    in_group = group[in_row // size] * size + in_row % size
    order = np.argsort(in_group, kind="stable")
    in_group, count = in_group[order], count[order]
    first = np.flatnonzero(np.diff(in_group, prepend=-1))
    key, n = in_group[first], np.add.reduceat(count, first) if len(first) else count
    docs = np.diff(first, append=len(in_group))
    filled = (coded.dictionary.take(pa.array(key % size)) if len(key) else pa.array([], pa.string()))
    kept = pc.not_equal(filled, "").to_numpy(zero_copy_only=False)
    key, n, docs = key[kept], n[kept], docs[kept]
    own = key // size
    columns = [
        lang.dictionary.take(pa.array(own // len(source.dictionary))), source.dictionary.take(pa.array(own % len(source.dictionary))),
        filled.filter(pa.array(kept)), pa.array(n, pa.int64()), pa.array(docs, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def vocabulary(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, entries): the kept terms, each with its sorted (source, n) entries."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 8_000_000):
                if part.num_rows:
                    yield slice_counts(part)

    counts = docs.mapInArrow(cut, "lang string, source string, term string, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("entries"))
    return terms.where(F.col("docs") >= least_docs).select("lang", "term", "entries")


def probability(count: np.ndarray, under: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / under), exactly."""
    count = count.astype(object) if len(count) and int(count.max()) > _SAFE_COUNT else count
    return (1 + BILLION * (count + 2) // under).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class RunColumn:
    """A column of counts as runs of equal ones: where each starts, and its probability."""

    def __init__(self, counts: np.ndarray, under: int):
        self.starts = np.flatnonzero(np.concatenate([[True], counts[1:] != counts[:-1]]))
        self.p = probability(counts[self.starts], under)

    def at(self, places: np.ndarray) -> np.ndarray:
        return self.p[np.searchsorted(self.starts, places, "right") - 1]


def pair_value(a: RunColumn, b: RunColumn, size: int) -> int:
    """The summed divergence of two columns of ``size`` terms, one product a merged run."""
    bounds = np.union1d(a.starts, b.starts)
    return int((divergence(a.at(bounds), b.at(bounds)) * np.diff(bounds, append=size)).sum())


def audit_block(block: pa.Table) -> pa.Table:
    """Rows (source, part, item, value) of one language's block.

    Its rows are terms, and one row without a term, which has each source of the language
    with what its counts are divided by, and the language's own divisor as ``under``.
    """
    head = block.filter(pc.is_null(block["term"])).to_pylist()[0]
    terms = block.filter(pc.is_valid(block["term"])).sort_by("place")
    sources = [e["source"] for e in head["entries"]]
    unders = [e["n"] for e in head["entries"]]
    lists = terms["entries"].combine_chunks()
    entries = lists.flatten()
    column = pc.index_in(entries.field("source"), pa.array(sources, pa.string())).to_numpy()
    counts = np.zeros((terms.num_rows, len(sources)), np.int64)
    counts[np.repeat(np.arange(terms.num_rows), lists.value_lengths().to_numpy()), column] = entries.field("n").to_numpy()
    columns = [RunColumn(counts[:, j], u) for j, u in enumerate(unders)]
    found = []
    for a in range(len(sources)):
        for b in range(a + 1, len(sources)):
            found.append((sources[a], "pair", sources[b], pair_value(columns[a], columns[b], terms.num_rows)))
    names, whole = terms["term"].to_pylist(), probability(counts.sum(axis=1), head["under"])
    for j, under in enumerate(unders):
        p = probability(counts[:, j], under)
        over = np.flatnonzero((counts[:, j] > 0) & (p > whole))
        value = divergence(p[over], whole[over])
        if len(over) > TOP_TERMS:  # all that could be among the first
            near = value >= np.partition(value, -TOP_TERMS)[-TOP_TERMS]
            over, value = over[near], value[near]
        ranked = sorted(zip((-value).tolist(), (names[i].encode() for i in over)))[:TOP_TERMS]
        found += [(sources[j], "term", item.decode(), -v) for v, item in ranked]
    lang = [head["lang"]] * len(found)
    source, part, item, value = zip(*found) if found else ((),) * 4
    return pa.table([pa.array(lang, pa.string()), *(pa.array(c, pa.string()) for c in (source, part, item)), pa.array(value, pa.int64())], names=["lang", "source", "part", "item", "value"])


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source's terms lie from those of the others, and which terms set it apart."""
    rows = docs.select(*(text_or_empty(c).alias(c) for c in ("lang", "source", "text")))
    kept = written(vocabulary(rows, least_docs))
    in_all = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    entry = F.explode("entries").alias("e")
    summed = kept.select("lang", entry).groupBy("lang", "e.source").agg(F.sum("e.n").alias("n"))
    groups = rows.groupBy("lang", "source").agg(F.lit(1).alias("one")).join(summed, ["lang", "source"], "left").join(in_all, "lang", "left")
    groups = written(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")))  # a row a group
    # the order in which equal entries follow each other, cut into blocks where it was made
    ordered = kept.repartitionByRange("lang", "entries", "term").sortWithinPartitions("lang", "entries", "term")
    blocks = written(ordered.select("lang", F.monotonically_increasing_id().alias("place"), "term", "entries").withColumn("block", F.shiftright("place", BLOCK_TERMS.bit_length() - 1)))
    under = F.col("n") + 2 * F.col("v")
    heads = groups.where("v > 0").groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", under.alias("n")))).alias("entries"), (F.sum("n") + 2 * F.max("v")).alias("under"))
    heads = blocks.select("lang", "block").distinct().join(heads, "lang")
    both = blocks.withColumn("under", F.lit(None).cast("long")).unionByName(heads, allowMissingColumns=True)
    parts = written(both.groupBy("lang", "block").applyInArrow(audit_block, "lang string, source string, part string, item string, value long"))
    sums = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    sums = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    top = parts.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS)  # a limit that each task applies before the shuffle
    return pairs.withColumn("rank", rank).unionByName(top.select("lang", "source", "part", "item", "value", "rank"))


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
words AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
grps AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN sizes USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) USING (lang, source)),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // CAST(g.n + 2 * g.v AS HUGEINT) AS p
  FROM grps g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
whole AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(cells.n) + 2) // CAST(any_value(t.n + 2 * t.v) AS HUGEINT) AS q
  FROM cells JOIN (SELECT lang, sum(n) AS n, max(v) AS v FROM grps GROUP BY ALL) t USING (lang) GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS o, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS f FROM cells x JOIN cells y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) v
  ON v.lang = a.lang AND v.s = a.source AND v.o = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM cells JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (FROM pairs UNION ALL FROM terms)
QUALIFY part = 'pair' OR rank <= 10"""
