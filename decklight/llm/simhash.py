"""SimHash near-dedup (operator 3) over BK-trees.

Fingerprints are made in one pass and grouped, so that any number of equal ones is
one entry with its least doc_id. Two fingerprints within ``radius`` bits agree in at
least k of ``radius + k`` blocks of bits, so the values of each k blocks are a shard, with
k as large as the number of entries needs for shards of bounded size: its fingerprints are put into a BK-tree (children keyed by their integer distance to the
parent), and each is looked up in it, following only edges within the radius of its
own distance. A shard goes to the task that holds its queries rather than to all.
Shards over ``SHARD_ENTRIES`` are cut into chunks and every pair of chunks is a task
of bounded size, so none is capped. A task returns the links of a spanning forest,
never all pairs, and the forests are joined by alternating star contractions.

``similar_groups`` finds texts by Jaccard similarity: at 0.8, one bit in seven differs,
so it uses ``WIDE_WORDS`` fingerprints of independent hashes, of which any of 30 bands
of 12 bits must agree (a miss has about one chance in 85 at 0.8, in 10,000 at 0.9), takes
BK-tree neighbours within ``WIDE_RADIUS`` bits, and checks each link of the forests
against the texts' whole shingle sets. Where a link fails between two groups, the forests
may have left out a similar pair, so all members that such links connect are compared set
by set, in chunk pairs of ``CHUNK_SHINGLES``; only passing pairs are thinned to a forest.

Defined results: a null text, or one without words, has fingerprint zero and links
like any other; a text of any length counts whole; ties and repeated rows share a component; a null doc_id keeps its
fingerprint, links nothing and has a null component_id; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .bpe import ragged
from .shared import BROADCAST_ROWS, free_name, mixed, spread_join, text_or_empty, written
from .words import text_slices

SHARD_ENTRIES = 2048
#: Entries a task holds as one forest of BK-trees.
FOREST_ENTRIES = 16_384
#: Edges up to which a round of components does not look for nodes with many: one task can hold them all.
ONE_TASK_EDGES = 1_000_000
#: Shingles of a chunk whose sets a task compares with another's.
CHUNK_SHINGLES = 100_000
#: Fingerprints that walk a tree at once; each may meet all entries of its shard.
QUERIES = 96
_BITS = 64


def fingerprint(words: list[bytes], shingle: int, wide: int = 1) -> np.ndarray:
    """``wide`` 64-bit fingerprints; the first is of the plain hashes, the others of hashes mixed with a number.

    A single one counts repeated shingles; several are of the set of shingles, as the similarity that they stand for is.
    """
    if not words:
        return np.zeros(wide, np.uint64)
    digest = xxhash.xxh64_intdigest
    count = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    if count == 1:
        hashes = np.array([digest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends]
        hashes = np.array([digest(joined[a : b - 1], 42) for a, b in zip(starts, ends[shingle - 1 :])], np.uint64)
    if wide > 1:
        hashes = np.unique(hashes)
        count = len(hashes)
    ones = np.zeros(wide * _BITS, np.int64)
    for at in range(0, count, 20_000):
        part = hashes[at : at + 20_000, None]
        if wide > 1:
            part = np.hstack([part, *(mixed(part ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) for k in range(1, wide))])
        ones += np.unpackbits(np.ascontiguousarray(part).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > count, bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, shingle: int = 4, wide: int = 1) -> DataFrame:
    """(doc_id, fp array<long> of ``wide``) for every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                fp = np.array([fingerprint(t.encode().lower().split(), shingle, wide) for t in part["text"].to_pylist()], np.uint64).reshape(-1, wide)
                ends = pa.array(np.arange(0, len(fp) * wide + 1, wide, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.ListArray.from_arrays(ends, pa.array(fp.view(np.int64).ravel()))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(make, "doc_id long, fp array<long>")


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class BKForest:
    """BK-trees over rows of fingerprint words, one tree for each run of equal ``tree`` numbers, built level by level.

    ``first_child[n]`` to ``first_child[n + 1]`` are the places of node n's children in
    ``child``, and ``edge`` holds their distances to it.
    """

    def __init__(self, values: np.ndarray, tree: np.ndarray):
        self.values = values
        n = len(values)
        new = np.append(True, tree[1:] != tree[:-1])[:n]
        self.root = np.flatnonzero(new)[np.cumsum(new) - 1]
        waiting = np.flatnonzero(~new)
        parent = self.root[waiting]
        span = values.shape[1] * _BITS + 1
        slots, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(waiting):
            far = _far(values[waiting], values[parent])
            slot, start, group = np.unique(parent * span + far, return_index=True, return_inverse=True)
            placed = waiting[start]
            slots.append(slot)
            nodes.append(placed)
            parent = placed[group]
            left = parent != waiting
            waiting, parent = waiting[left], parent[left]
        slot = np.concatenate(slots)
        order = np.argsort(slot)
        self.child, self.edge = np.concatenate(nodes)[order], slot[order] % span
        self.first_child = np.searchsorted(slot[order] // span, np.arange(n + 1))

    def within(self, query: np.ndarray, root: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, entry, distance) for every entry of the root's tree within the radius."""
        number, node = np.arange(len(query)), root
        hits = [(number[:0], node[:0], number[:0])]
        while len(node):
            far = _far(query[number], self.values[node])
            near = far <= radius
            hits.append((number[near], node[near], far[near]))
            count = self.first_child[node + 1] - self.first_child[node]
            at = np.repeat(self.first_child[node] - np.cumsum(count) + count, count) + np.arange(count.sum())
            follow = np.abs(self.edge[at] - np.repeat(far, count)) <= radius
            number, node = np.repeat(number, count)[follow], self.child[at[follow]]
        return tuple(np.concatenate(c) for c in zip(*hits))


class Forest:
    """Union-find over numbered items; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        la, lb = self.label[a], self.label[b]
        open_ = la != lb
        if not open_.any():
            return
        pairs, at = np.unique(np.column_stack([np.minimum(la, lb)[open_], np.maximum(la, lb)[open_]]), axis=0, return_index=True)
        order = np.argsort(at)  # as given: nearer ones first
        pairs, at = pairs[order], at[order]
        a, b = a[open_][at], b[open_][at]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while x in root:
                x = root[x]
            return x

        for (x, y), i, j in zip(pairs.tolist(), a.tolist(), b.tolist()):
            x, y = sorted((find(x), find(y)))
            if x != y:
                root[y] = x
                self.links.append((i, j))
        if root:
            to = np.arange(len(self.label))
            for x in root:
                to[x] = find(x)
            self.label = to[self.label]


def shard_links(shard: np.ndarray, side: np.ndarray, value: np.ndarray, rep: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the reps of values within the radius, of one shard or pair of chunks each.

    Side 0 is put into the tree; side 1 asks it. Where a shard has no side 1, side 0 asks.
    """
    order = np.lexsort((value[:, 0], side, shard))
    shard, side, value, rep = shard[order], side[order], value[order], rep[order]
    inside = side == 0
    tree = BKForest(value[inside], shard[inside])
    names, at = np.unique(shard[inside], return_index=True)
    asks = (side == 1) | ~np.isin(shard, shard[side == 1])
    asks &= np.isin(shard, names)
    entry = np.flatnonzero(inside)
    reps, item = np.unique(rep, return_inverse=True)
    forest = Forest(len(reps))
    queries = np.flatnonzero(asks)
    for i in range(0, len(queries), QUERIES):
        part = queries[i : i + QUERIES]
        root = at[np.searchsorted(names, shard[part])]
        number, node, far = tree.within(value[part], root, radius)
        near_first = np.argsort(far, kind="stable")
        forest.add(item[part[number]][near_first], item[entry[node]][near_first])
    links = np.array(forest.links, np.int64).reshape(-1, 2)
    return reps[links[:, 0]], reps[links[:, 1]]


#: A key of some blocks of bits: (word, low bit, bits) of each.
Key = list[tuple[int, int, int]]


def pigeonholes(radius: int, agree: int = 1) -> list[Key]:
    """Keys of which one must agree within the radius: of ``radius + agree`` blocks, ``agree`` are untouched."""
    n = radius + agree
    edges = [round(i * _BITS / n) for i in range(n + 1)]
    blocks = [(0, a, b - a) for a, b in zip(edges, edges[1:])]
    return [list(chosen) for chosen in combinations(blocks, agree)]


def wide_enough(entries: int, radius: int) -> list[Key]:
    """The pigeonholes of the fewest blocks that give shards of SHARD_ENTRIES on average, so that work grows with the entries."""
    for agree in range(1, 5):
        keys = pigeonholes(radius, agree)
        if entries >> min(sum(bits for *_, bits in key) for key in keys) <= SHARD_ENTRIES:
            break
    return keys


def _chunk_pairs() -> Column:
    """The chunk pairs (i, j), i <= j, that a row's ``chunk`` of ``chunks`` is in; side 1 asks side 0."""
    return F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda j: F.struct(F.least(j, F.col("chunk")).alias("i"), F.greatest(j, F.col("chunk")).alias("j"), (j < F.col("chunk")).cast("int").alias("side")),
    )


def fingerprint_links(groups: DataFrame, radius: int, keys: list[Key]) -> DataFrame:
    """(u, v): links between the groups (fp, rep) that hold their components together."""
    field = lambda word, low, bits: F.shiftrightunsigned(F.shiftleft(F.get("fp", word), _BITS - low - bits), _BITS - bits)

    def part(key: Key) -> Column:
        out = F.lit(0).cast("long")
        for block in key:
            out = F.shiftleft(out, block[2]).bitwiseOR(field(*block))
        return out

    each = F.array(*(F.struct(F.lit(i).alias("block"), part(key).alias("part")) for i, key in enumerate(keys)))
    dealt = groups.select("fp", "rep", F.explode(each).alias("key")).select("fp", "rep", "key.block", "key.part")
    sizes = written(dealt.groupBy(F.col("block").alias("b"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_ENTRIES))
    large = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    sized = dealt.join(large, (F.col("block") == F.col("b")) & (F.col("part") == F.col("p")), "left")
    chunks = F.coalesce(F.ceil(F.col("n") / SHARD_ENTRIES), F.lit(1)).cast("int")
    chunked = sized.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    placed = chunked.select("fp", "rep", "block", "part", F.explode(_chunk_pairs()).alias("pair")).select(
        F.xxhash64("block", "part", "pair.i", "pair.j").alias("shard"), F.col("pair.side").alias("side"), "fp", "rep"
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[list[np.ndarray]]) -> pa.RecordBatch:
            shard, side, rep, fp = (np.concatenate(c) for c in zip(*held))
            u, v = shard_links(shard, side, fp.view(np.uint64), rep, radius)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch[c].to_numpy() for c in ("shard", "side", "rep")]
            columns.append(batch["fp"].flatten().to_numpy().reshape(batch.num_rows, -1))
            shard, start = columns[0], 0
            while start < batch.num_rows:
                if size >= FOREST_ENTRIES:  # this shard ends before the next begins
                    end = int(np.searchsorted(shard, held[-1][0][-1], "right"))
                    if end > start:
                        held.append([c[start:end] for c in columns])
                        start = end
                    if start == batch.num_rows:
                        break
                    yield out(held)
                    held, size = [], 0
                end = min(batch.num_rows, start + FOREST_ENTRIES - size)
                held.append([c[start:end] for c in columns])
                start, size = end, size + end - start
        if held:
            yield out(held)

    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(link, "u long, v long")


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component): each linked node and the least node that it reaches.

    Large-star and small-star rounds; each round is written to the shared folder. Where
    there are many, the edges of a node that has a share of them stay where they are (``spread_join``).
    """
    edges = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    n, last = edges.count(), None
    for _ in range(most_rounds):
        if n <= ONE_TASK_EDGES:  # even a node with all of them is little work
            keep, join = (lambda df: df), (lambda rows, table: rows.join(table, "u"))
        else:
            keep, join = written, (lambda rows, table: spread_join(rows, table, "u"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = keep(join(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")))
        small = join(large, low).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        n, last = now[0], now
    raise RuntimeError("components did not settle")


def _classes(made: DataFrame, links: DataFrame, groups: DataFrame) -> DataFrame:
    """``made`` (doc_id, fp) with the component of its group."""
    found = components(links)
    classes = groups.join(found, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return spread_join(made, written(classes), "fp", "left").select("doc_id", "fp", component)


def _groups(made: DataFrame) -> DataFrame:
    return made.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    made = written(fingerprints(docs, shingle))
    groups = written(_groups(made))
    return _classes(made, fingerprint_links(groups, radius, wide_enough(groups.count(), radius)), groups)


def op3_simhash(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex(F.get("fp", 0))), 16, "0").alias("fingerprint"), "component_id")


WIDE_WORDS = 6
WIDE_RADIUS = 80
WIDE_BLOCKS = [[(word, low, 12)] for word in range(WIDE_WORDS) for low in range(0, 60, 12)]


def shingle_set(text: str, shingle: int) -> np.ndarray:
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    parts = (b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1)))
    return np.unique(np.array([xxhash.xxh64_intdigest(p, 42) for p in parts], np.uint64))


#: Links of one text that meet its shingles in one task.
STAR_LINKS = 1_000


def checked_links(docs: DataFrame, links: DataFrame, shingle: int, least: float) -> DataFrame:
    """The links whose texts have at least this Jaccard similarity, by their whole shingle sets.

    A text in the middle of a star has as many links as the star has points: they are dealt to
    parts of ``STAR_LINKS`` links, and its set goes once to each part.
    """
    links = written(links.distinct())
    ends = links.select(F.explode(F.array("u", "v")).alias("end")).distinct()
    made = shingle_sets(docs.join(ends, F.col("doc_id") == F.col("end"), "left_semi"), shingle)
    dealt = links
    parts = {}
    for c in "uv":
        parts[c] = links.groupBy(F.col(c).alias(f"{c}_end")).agg(F.ceil(F.count(F.lit(1)) / STAR_LINKS).alias("parts")).where("parts > 1")
        part = F.pmod(F.xxhash64("u", "v"), F.coalesce("parts", F.lit(1))).alias(f"{c}_part")
        dealt = dealt.join(parts[c], F.col(c) == F.col(f"{c}_end"), "left").select(*dealt.columns, part)
    dealt = written(dealt)

    def ends_of(c: str, name: str) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)).alias(f"{c}_part")
        return made.join(parts[c], F.col("doc_id") == F.col(f"{c}_end"), "left").select(F.col("doc_id").alias(c), F.col("shingles").alias(name), each)

    both = dealt.join(ends_of("u", "sa"), ["u", "u_part"]).join(ends_of("v", "sb"), ["v", "v_part"])
    common = F.size(F.array_intersect("sa", "sb"))
    similar = common >= F.lit(least) * (F.size("sa") + F.size("sb") - common)
    return both.where(similar | ((F.size("sa") == 0) & (F.size("sb") == 0))).select("u", "v")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, shingles array<long>): one row a doc_id."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                held = [shingle_set(t, shingle).view(np.int64) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], ragged(held, pa.int64())], ["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(sets, "doc_id long, shingles array<long>").dropDuplicates(["doc_id"])


def _prefixes(term: np.ndarray, first: np.ndarray, least: float) -> np.ndarray:
    """Marks the first places of each sorted set, of which two sets of this similarity share one."""
    size = np.diff(first)
    keep = size - np.ceil(least * size - 1e-9).astype(np.int64) + 1
    return np.arange(len(term)) - np.repeat(first[:-1], size) < np.repeat(keep, size)


def similar_pairs(side: np.ndarray, group: np.ndarray, sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between groups that have members of this similarity, one of them on side 0 and one on side 1, or both on side 0 if that is all.

    Every pair of two groups is compared, but a link is kept only if its groups are not joined yet.
    """
    names, item = np.unique(group, return_inverse=True)
    size = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, term, found_in = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(found_in), np.int64)
    rank[np.argsort(found_in, kind="stable")] = np.arange(len(found_in))  # rare ones first
    term = rank[term]
    order = np.lexsort((term, owner))
    term, first = term[order], np.concatenate([[0], np.cumsum(size)])
    prefix = _prefixes(term, first, least)

    def postings(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t, o = term[inside], owner[inside]
        by = np.argsort(t, kind="stable")
        return o[by], np.searchsorted(t[by], np.arange(len(found_in) + 1))

    tree = side[owner] == 0
    whole, start = postings(tree)
    short, short_start = postings(tree & prefix)
    forest = Forest(len(names))

    def meet(posting: np.ndarray, at: np.ndarray, terms: np.ndarray) -> np.ndarray:
        count = at[terms + 1] - at[terms]
        return posting[np.repeat(at[terms] - np.cumsum(count) + count, count) + np.arange(count.sum())]

    for q in np.flatnonzero(side == 1) if (side == 1).any() else range(len(sets)):
        own = term[first[q] : first[q + 1]]
        near = np.unique(meet(short, short_start, own[prefix[first[q] : first[q + 1]]]))
        near = near[forest.label[item[near]] != forest.label[item[q]]]
        if len(near):
            common = np.bincount(meet(whole, start, own), minlength=len(sets))[near]
            near = near[common >= least * (size[near] + size[q] - common)]
            forest.add(np.full(len(near), item[q]), item[near])
    links = np.array(forest.links, np.int64).reshape(-1, 2)
    return names[links[:, 0]], names[links[:, 1]]


def left_out_links(docs: DataFrame, groups: DataFrame, links: DataFrame, checked: DataFrame, shingle: int, least: float) -> DataFrame:
    """(u, v): links between verified components, out of all pairs of what unverified links connect."""
    tight = written(components(checked))
    end = lambda c: tight.select(F.col("node").alias(f"{c}_node"), F.col("component").alias(f"{c}_component"))
    joined = links.join(end("u"), F.col("u") == F.col("u_node"), "left").join(end("v"), F.col("v") == F.col("v_node"), "left")
    crossing = joined.select(F.coalesce("u_component", "u").alias("u"), F.coalesce("v_component", "v").alias("v"))
    joins = components(crossing)  # a component's least node is not among the nodes
    loose = joins.select(F.col("node").alias("t"), F.col("component").alias("loose")).unionByName(
        joins.select(F.col("component").alias("t"), F.col("component").alias("loose")).distinct()
    )
    placed = groups.select("rep").join(tight, F.col("rep") == F.col("node"), "left").select("rep", F.coalesce("component", "rep").alias("tight"))
    members = placed.join(loose, F.col("tight") == F.col("t")).select("rep", "tight", "loose")
    sets = shingle_sets(docs.join(members, F.col("doc_id") == F.col("rep"), "left_semi"), shingle)
    held = written(members.join(sets, F.col("rep") == F.col("doc_id")).select("rep", "tight", "loose", "shingles"))
    sizes = held.groupBy(F.col("loose").alias("l")).agg(F.sum(F.size("shingles")).alias("n"))
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK_SHINGLES), F.lit(1)).cast("int")
    chunked = held.join(sizes, F.col("loose") == F.col("l")).withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    dealt = chunked.select("loose", "tight", "rep", "shingles", F.explode(_chunk_pairs()).alias("pair")).select(
        F.xxhash64("loose", "pair.i", "pair.j").alias("shard"), F.col("pair.side").alias("side"), "tight", "shingles"
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            own = [x for b in parts for x in _arrays(b["shingles"])]
            u, v = similar_pairs(table["side"].to_numpy(), table["tight"].to_numpy(), own, least)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        parts: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch["shard"].to_numpy()
            edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(edges, edges[1:]):
                if parts and parts[-1]["shard"][0].as_py() != shard[a]:
                    yield out(parts)
                    parts = []
                parts.append(batch.slice(a, b - a))
        if parts:
            yield out(parts)

    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(link, "u long, v long")


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy().tolist()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def similar_groups(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(doc_id, fp, component_id): components of texts linked by word-shingle similarity."""
    made = written(fingerprints(docs, shingle, WIDE_WORDS))
    groups = written(_groups(made))
    links = written(fingerprint_links(groups, WIDE_RADIUS, WIDE_BLOCKS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    checked = written(checked_links(rows, links, shingle, least))
    return _classes(made, checked.unionByName(left_out_links(rows, groups, links, checked, shingle, least)), groups)


def keep_one_of_each(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """``docs`` without the rows whose text is similar to one of a smaller doc_id; rows with a null doc_id stay."""
    name = free_name(docs, "__gone")
    gone = similar_groups(docs, shingle, least).where(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
