"""N-gram Jaccard join: all links between texts whose word-shingle sets are alike, and the classes they form.

Equal sets are one node.  Two nodes with Jaccard similarity of ``percent`` or more share one of their first shingles
under any common order (the prefix principle); the order takes common shingles last, so that a passage many texts share
rarely leads anywhere.  Nodes that share a leading shingle and lie in the same or neighbouring band of set sizes form a
tile.  Within tiles

1. every node is paired with its tile's most central node only; hashed bitmaps bound the overlap from above, exact intersection
   of the sorted arrays decides, and the links form classes;
2. nodes of a tile that are still in different classes are compared with each other in blocks by their bitmaps (a large
   tile is spread over pairs of blocks; nodes of its largest class are not compared with each other).  At first each node
   takes its most promising partner only, which is again decided exactly and joins classes; ``rounds`` times;
3. then all pairs of nodes that are still in different classes and that the bound lets through are decided.

The last step covers every pair of a tile that the others left apart, so no link between different classes is missed;
pairs inside a class are never spelled out, and after the rounds hardly any pair is left outside.

The bitmap of a set has a bit per hash bucket, flipped by each shingle in it: two sets differ in at least as many
shingles as their bitmaps differ in bits, so |A and B| <= (|A| + |B| - bit count of the difference) / 2.  Its length
follows the band of sizes; a longer bitmap folds onto a shorter one.

Edge cases: NULL, empty and wordless texts have no shingles and link with nothing; a text with fewer words than a
shingle has its whole sequence as its only one; equal texts, repeated rows and NULL ids are documents like any other, and
a class is named by its least id that is not NULL (NULL if there is none); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.operators.graph import connected_components

from .common import materialize, ship, vector_udf
from .textarrays import parts, shingle_set, texts

#: Least occurrences of a shingle within a task, and over all tasks, for it to be ordered last.  Any order is correct.
COMMON_IN_TASK, COMMON = 4, 32
#: Most entries in the list of common shingles (8 bytes each), which is broadcast.
MAX_COMMON = 1 << 20
#: Members of a block; larger tiles are spread over pairs of blocks.
BLOCK_NODES = 1024
#: Times that every node is linked with its most promising partner before all pairs are looked at; a second time takes
#: more work than it saves.  The result is the same for any number.
ROUNDS = 1
LEAST_BITS, MOST_BITS = 64, 1 << 16


def bands(n: np.ndarray, percent: int) -> np.ndarray:
    """Band of a set size: sets that can be alike lie in the same or in neighbouring bands."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity bits, about one to two a shingle."""
    bits = 1 << max(int(len(shingles)), 1).bit_length()
    bits = min(max(bits, LEAST_BITS), MOST_BITS)
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def unpack(bitmaps: list[bytes], bits: int) -> np.ndarray:
    """Bitmaps of at least ``bits`` bits folded to that length, as rows of 64-bit words."""
    out = np.empty((len(bitmaps), bits // 64), dtype=np.uint64)
    for row, b in zip(out, bitmaps):
        row[:] = np.bitwise_xor.reduce(np.frombuffer(b, dtype=np.uint64).reshape(-1, bits // 64), axis=0)
    return out


def node_of(shingles: np.ndarray) -> int | None:
    """A 64-bit name of a set, or None for the empty one."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None


def need(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection of sets of n and m with 100 * intersection >= percent * union."""
    return -((-percent * (n + m)) // (100 + percent))


def leading(shingles: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first n - ceil(percent * n / 100) + 1 of n shingles, common ones last."""
    n = len(shingles)
    count = n - (percent * n + 99) // 100 + 1
    if len(common):
        at = np.searchsorted(common, shingles)
        last = common[np.minimum(at, len(common) - 1)] == shingles
        if last.any():
            shingles = np.concatenate([shingles[~last], shingles[last]])
    return shingles[:count]


def long_of(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


SETS = "doc_id long, node long, n long, bitmap binary, shingle long, times long, common boolean"


def describe(docs: DataFrame, size: int) -> DataFrame:
    """A row per document, and (common) a row per shingle that a task has seen often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in parts(batches, 1):
            sets = [shingle_set(t, size) for t in texts(batch, 1)]
            found, times = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
            for s, t in zip(found[times > 1].tolist(), times[times > 1].tolist()):
                seen[s] = seen.get(s, 0) + t
            if len(seen) > 1 << 18:  # any list of common shingles will do, so rare ones may be forgotten
                seen = {s: t for s, t in seen.items() if t >= COMMON_IN_TASK}
            k = len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([bitmap(s) for s in sets], pa.binary()),
                 pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array([False] * k, pa.bool_())],
                names=["doc_id", "node", "n", "bitmap", "shingle", "times", "common"])
        often = [(s, t) for s, t in seen.items() if t >= COMMON_IN_TASK]
        k = len(often)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
             pa.array(long_of(np.array([s for s, _ in often], dtype=np.uint64)), pa.int64()),
             pa.array([t for _, t in often], pa.int64()), pa.array([True] * k, pa.bool_())],
            names=["doc_id", "node", "n", "bitmap", "shingle", "times", "common"])

    return docs.mapInArrow(run, SETS)


def common_shingles(described: DataFrame, limit: int) -> np.ndarray:
    """Sorted hashes of at most ``limit`` shingles that are common over all tasks."""
    rows = (described.filter("common").groupBy("shingle").agg(F.sum("times").alias("times"))
            .filter(F.col("times") >= COMMON).orderBy(F.desc("times"), "shingle").limit(limit).select("shingle").toPandas())
    return np.sort(rows["shingle"].to_numpy(dtype=np.int64).view(np.uint64))


def leading_rows(docs: DataFrame, common: np.ndarray, percent: int, size: int) -> DataFrame:
    """(shingle, node, n) per document and leading shingle; equal sets of a task's batch once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            names, keys, nodes, sizes = set(), [], [], []
            for t in texts(batch, 1):
                s = shingle_set(t, size)
                node = node_of(s)
                if node is None or node in names:
                    continue
                names.add(node)
                lead = leading(s, common, percent)
                keys.append(lead)
                nodes.append(np.full(len(lead), node))
                sizes.append(np.full(len(lead), len(s)))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(long_of(np.concatenate(keys))), pa.array(np.concatenate(nodes)),
                     pa.array(np.concatenate(sizes))], names=["shingle", "node", "n"])

    return docs.mapInArrow(run, "shingle long, node long, n long")


def shared_rows(rows: DataFrame, witness: str = "node") -> DataFrame:
    """The distinct rows whose shingle has two or more different witnesses: one shuffle, for the rows are made from the
    texts each time they are read."""
    of = Window.partitionBy("shingle")
    return (rows.withColumn("_a", F.min(witness).over(of)).withColumn("_b", F.max(witness).over(of))
            .filter("_a != _b").drop("_a", "_b").distinct())


def alike(pairs: DataFrame, described: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are alike: bitmaps bound the overlap, arrays decide.

    ``a`` is the side with few partners, ``b`` may have many: a's array is sent to b's, never the other way."""
    sketch = described.filter("not common and node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"))
    near = (pairs.join(sketch.selectExpr("node as a", "doc_id as doc_a", "n as n_a", "bitmap as bits_a"), "a")
            .join(sketch.selectExpr("node as b", "doc_id as doc_b", "n as n_b", "bitmap as bits_b"), "b"))

    def possible(n_a: pd.Series, n_b: pd.Series, bits_a: pd.Series, bits_b: pd.Series) -> pd.Series:
        out = []
        for n, m, x, y in zip(n_a, n_b, bits_a, bits_b):
            bits = 8 * min(len(x), len(y))
            apart = int(np.bitwise_count(unpack([x], bits) ^ unpack([y], bits)).sum())
            out.append((n + m - apart) // 2 >= need(n, m, percent))
        return pd.Series(out, dtype=bool)

    keep = vector_udf(possible, "boolean")("n_a", "n_b", "bits_a", "bits_b")
    near = materialize(near.filter(keep).select("a", "b"), "jaccard-near")

    # arrays from the texts of one document per node that is in a pair
    wanted = near.select(F.col("a").alias("node")).unionAll(near.select(F.col("b").alias("node"))).distinct()
    ids = wanted.join(sketch.select("node", "doc_id"), "node")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 0):
            sets = [shingle_set(t, size) for t in texts(batch, 0)]
            rows = [(node_of(s), long_of(s)) for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                                             names=["node", "shingles"])

    named = ids.select(F.col("doc_id").alias("wanted_id")).distinct()
    sets = (docs.join(named, docs["doc_id"].eqNullSafe(named["wanted_id"]), "left_semi").select("text")
            .mapInArrow(arrays, "node long, shingles array<long>"))
    sets = materialize(sets.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "jaccard-sets")
    both = (near.join(sets.withColumnsRenamed({"node": "a", "shingles": "x"}), "a")
            .join(sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(decide, "a long, b long")


def tiles(rows: DataFrame, percent: int) -> DataFrame:
    """Rows by tile: of (shingle, band) as own, and of the next band as its smaller neighbours."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    return (rows.withColumn("band", F.explode(F.array(band, band + 1)))
            .withColumn("own", F.col("band") == band))


def first_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Every node of a tile with the tile's most central own node: as many pairs as rows at most.

    The most central node is the one whose tiles have most members in all.  A text that others were made from by
    small changes shares more with each of them than they do with each other, so it is the centre of their tiles."""
    t = tiles(rows, percent)
    members = t.groupBy("shingle", "band").agg(F.count(F.lit(1)).alias("members"), F.count_if("own").alias("owned"))
    members = members.filter("members > 1 and owned > 0")
    t = materialize(t.join(members, ["shingle", "band"]).select("shingle", "band", "own", "node", "n", "members"),
                    "jaccard-tiles")
    weight = t.filter("own").groupBy("node").agg(F.sum("members").alias("weight"))
    own = t.filter("own").join(weight, "node")
    first = (own.groupBy("shingle", "band").agg(F.max(F.struct("weight", "node", "n")).alias("first"))
             .select("shingle", "band", F.col("first.node").alias("b"), F.col("first.n").alias("m")))
    fits = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.col("node") != F.col("b"))
    return t.join(first, ["shingle", "band"]).filter(fits).select(F.col("node").alias("a"), "b").distinct()


#: Pairs, and words of bitmaps, that are looked at together.
PAIRS_AT_ONCE, WORDS_AT_ONCE = 1 << 19, 1 << 20


def unit_pairs(unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (earlier, later) of all pairs within equal values of the sorted ``unit``, in parts."""
    ends = np.append(np.flatnonzero(unit[1:] != unit[:-1]) + 1, len(unit))
    end = np.repeat(ends, np.diff(ends, prepend=0))
    later = end - np.arange(len(unit)) - 1
    total = np.cumsum(later)
    at = 0
    while at < len(unit):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        count = later[at:upto]
        left = np.repeat(np.arange(at, upto), count)
        yield left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        at = upto


def differing_bits(words: np.ndarray, start: np.ndarray, length: np.ndarray, left: np.ndarray,
                   right: np.ndarray) -> np.ndarray:
    """Bits in which the bitmaps of each pair of rows differ, the longer one folded onto the shorter one.  ``words``
    holds all bitmaps one after the other, ``start`` and ``length`` where each lies."""
    out = np.zeros(len(left), dtype=np.int64)
    shape = length[left] * (MOST_BITS + 1) + length[right]
    for s in np.unique(shape):
        pairs = np.flatnonzero(shape == s)
        long, short = sorted((int(length[left[pairs[0]]]), int(length[right[pairs[0]]])), reverse=True)
        step = max(1, WORDS_AT_ONCE // long)
        for i in range(0, len(pairs), step):
            part = pairs[i:i + step]
            sides = []
            for rows in (left[part], right[part]):
                w = int(length[rows[0]])
                bits = words[start[rows][:, None] + np.arange(w)]
                sides.append(np.bitwise_xor.reduce(bits.reshape(len(rows), w // short, short), axis=1))
            out[part] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1, dtype=np.int64)
    return out


def compare_units(rows: pa.Table, percent: int, best: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the pairs within units that are in different classes and that sizes and bitmaps allow: of two blocks
    each with the other, of one block each with the later ones; one of the two at least is the tile's own.  With
    ``best`` each node's pair whose bitmaps differ least for its size only."""
    rows = rows.combine_chunks()
    unit, node, n, cls, own, block = (rows.column(i).to_numpy() for i in range(6))
    maps = rows.column(6).combine_chunks() if rows.num_rows else rows.column(6)
    maps = maps.chunk(0) if isinstance(maps, pa.ChunkedArray) else maps
    offsets = np.frombuffer(maps.buffers()[1], dtype=np.int32)[maps.offset:maps.offset + len(maps) + 1].astype(np.int64)
    words = np.frombuffer(maps.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]].view(np.uint64)
    start, length = (offsets[:-1] - offsets[0]) // 8, np.diff(offsets) // 8
    first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    single = np.repeat(np.minimum.reduceat(block, first) == np.maximum.reduceat(block, first),
                       np.diff(np.append(first, len(unit))))
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    close = [np.zeros(0)]
    for left, right in unit_pairs(unit):
        keep = ((cls[left] != cls[right]) & (own[left] | own[right]) & (single[left] | (block[left] != block[right]))
                & (100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])))
        left, right = left[keep], right[keep]
        apart = differing_bits(words, start, length, left, right)
        keep = (n[left] + n[right] - apart) // 2 >= need(n[left], n[right], percent)
        one.append(node[left[keep]])
        two.append(node[right[keep]])
        close.append(apart[keep] / (n[left[keep]] + n[right[keep]]))
        if best:  # what has been found so far, once for each node
            a, b, c = (np.concatenate(x) for x in (one, two, close))
            first = []
            for side in (a, b):
                order = np.lexsort((a, b, c, side))
                first.append(order[np.concatenate([[True], np.diff(side[order]) != 0])] if len(order) else order)
            keep = np.unique(np.concatenate(first))
            one, two, close = [a[keep]], [b[keep]], [c[keep]]
    return np.concatenate(one), np.concatenate(two)


def mixed_tiles(t: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of :func:`tiles` that lie in a tile with nodes of different classes, with their class.  Classes only grow
    together, so a later round starts from these."""
    named = t.select("shingle", "band", "own", "node", "n").join(classes, "node", "left")
    named = named.withColumn("cls", F.coalesce("cls", "node"))
    mixed = (named.groupBy("shingle", "band").agg(F.min("cls").alias("low"), F.max("cls").alias("high"), F.max("own").alias("some"))
             .filter("low != high and some").select("shingle", "band"))
    return materialize(named.join(mixed, ["shingle", "band"]), "jaccard-mixed")


def remaining_pairs(t: DataFrame, described: DataFrame, percent: int, block_nodes: int, best: bool = False) -> DataFrame:
    """(a, b) of :func:`mixed_tiles` whose nodes are in different classes, as far as the bitmaps allow; with ``best`` a
    few pairs for each node at most.

    The nodes of a tile's largest class are dealt into blocks of their own, which never meet each other: a tile of one
    large class and a few other nodes is copied once for each block of those."""
    per_class = t.groupBy("shingle", "band", "cls").agg(F.count(F.lit(1)).alias("k"))
    blocks = lambda n: F.ceil(n / block_nodes).cast("long")
    mixed = (per_class.groupBy("shingle", "band").agg(F.max(F.struct("k", "cls")).alias("top"), F.sum("k").alias("members"))
             .select("shingle", "band", F.col("top.cls").alias("top"), blocks(F.col("top.k")).alias("majors"),
                     blocks(F.col("members") - F.col("top.k")).alias("minors")))
    mixed = materialize(mixed, "jaccard-blocks")
    bits = described.filter("not common and node is not null").groupBy("node").agg(F.first("bitmap").alias("bitmap"))
    t = t.join(mixed, ["shingle", "band"]).withColumn("major", F.col("cls") == F.col("top"))
    t = t.withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("major"), F.col("majors")).otherwise(F.col("minors"))))
    # a block of the largest class meets every other block once; those meet each other once, in the unit (least, greatest)
    pair = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    of_major = F.transform(upto(F.col("minors")), lambda j: pair(-1 - F.col("block"), j))
    of_minor = F.concat(F.transform(upto(F.col("minors")), lambda j: pair(F.least("block", j), F.greatest("block", j))),
                        F.transform(upto(F.col("majors")), lambda j: pair(-1 - j, F.col("block"))))
    t = t.withColumn("at", F.explode(F.when(F.col("major"), of_major).otherwise(of_minor)))
    own_block = F.when(F.col("major"), -1 - F.col("block")).otherwise(F.col("block"))
    unit = F.xxhash64("shingle", "band", "at.x", "at.y")
    t = t.select(unit.alias("unit"), "node", "n", "cls", "own", own_block.alias("block")).join(bits, "node")
    t = t.repartition("unit").sortWithinPartitions("unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def pairs(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            a, b = compare_units(pa.Table.from_batches(parts), percent, best)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            unit = batch.column(0).to_numpy()
            last = int(np.searchsorted(unit, unit[-1]))  # where the unit that may go on in the next batch begins
            if last or (held and held[0].column(0)[0].as_py() != unit[0]):
                whole = [*held, batch.slice(0, last)] if last else held
                yield pairs(whole)
                held = []
            held.append(batch.slice(last))
        if held:
            yield pairs(held)

    out = t.select("unit", "node", "n", "cls", "own", "block", "bitmap").mapInArrow(run, "a long, b long")
    return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similarity_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 80, size: int = 5,
                       block_nodes: int = BLOCK_NODES, max_common: int = MAX_COMMON,
                       rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, n_shingles) per document, and (node, component, component_id) per node, where a component is the
    class of nodes reachable by links and component_id its least document id."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    described = materialize(describe(docs, size), "jaccard-described")
    common = common_shingles(described, max_common)
    rows = materialize(shared_rows(leading_rows(docs, common, percent, size)), "jaccard-rows")
    links = materialize(alike(first_pairs(rows, percent), described, docs, percent, size), "jaccard-links")
    t = tiles(rows, percent)
    for k in range(rounds + 1):  # the last time all pairs
        classes = connected_components(links, src="a", dst="b").withColumnRenamed("component", "cls")
        t = mixed_tiles(t, materialize(classes, "jaccard-classes"))
        pairs = remaining_pairs(t, described, percent, block_nodes, best=k < rounds)
        links = materialize(links.unionAll(alike(pairs, described, docs, percent, size)), "jaccard-links")
    members = described.filter("not common").select("doc_id", "node", F.col("n").alias("n_shingles"))
    least = members.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = (least.join(connected_components(links, src="a", dst="b"), "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    named = materialize(named, "jaccard-named")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return members, named.select("node", "component").join(ids, "component").select("node", "component", "component_id")


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document."""
    members, nodes = similarity_classes(docs, **options)
    out = members.join(nodes, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def node_column(text: Column, size: int = 5) -> Column:
    """The node of a text, as in :func:`similarity_classes`; NULL without shingles."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([node_of(shingle_set(np.frombuffer((t or "").encode(), dtype=np.uint8), size))
                             for t in batch], dtype="Int64")

    return vector_udf(run, "long")(text)


def one_of_each_class(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5,
                      **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row stays, of its least id (NULL last); rows
    without shingles all stay.  Equal rows of that id are told apart by a hash of all columns."""
    members, nodes = similarity_classes(docs, text, doc_id, size=size, **options)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    stays = (members.join(nodes, "node").groupBy("component").agg(F.min(place).alias("x"))
             .select(F.col("x.node").alias("_node"), F.col("x.doc_id").alias("_doc_id")))
    stays = materialize(stays, "jaccard-stays")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       node_column(F.col(text).cast("string"), size).alias("node"))
    bare = rows.filter("node is null").select("row.*")
    of_id = F.col(f"row.{doc_id}").cast("long")
    first = Window.partitionBy("node").orderBy("order")
    kept = (rows.join(stays, (F.col("node") == F.col("_node")) & of_id.eqNullSafe(F.col("_doc_id")))
            .withColumn("order", F.xxhash64("row")).withColumn("number", F.row_number().over(first))
            .filter("number = 1").select("row.*"))
    return kept.unionAll(bare)
