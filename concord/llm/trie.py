"""Prefix trie of conversations: one node per distinct sequence of first turns, with totals of its subtree.

1. Turns are put in order (:mod:`concord.operators.ordered`); a node's key is the exclusive or of a hash of (depth, turn)
   over its turns, 128 bits, so that the key of the parent follows from the key and the last turn, and equal sequences
   meet by one aggregate that combines within tasks.
2. Subtree totals by time-forward processing.  Nodes are dealt into shards by range of their first turns, so that a shard
   is close to a piece of a depth-first order and a popular first turn is cut into as many shards as it needs.  Within a
   shard nodes come sorted by reverse level order (Spark's external sort); each takes the messages that its children
   have sent forward to it from a priority queue, adds its own share and sends the sum on to its parent.  The queue spills
   sorted runs to an unnamed file of the task, so its memory is bounded.  The nodes are also spooled to such a file, which
   is then read backwards to hand down the parent's conversation and the shard's root.
3. Across shards: a shard root sends its total to a parent elsewhere.  Roots below which others hang form a smaller tree,
   which is solved the same way (in one shard once it is small), then the shards that got messages are run again with
   these in their queues.  Every other shard is final after one run.

Edge cases: rows with a NULL conv_id belong to no conversation; NULL role or text is the empty string; a NULL turn comes
first, and rows with the same turn come in the order of the role and of a hash of the text; repeated rows are turns of their
own; no conversation gives no node; other columns are ignored.  A long text enters as its hash and length only.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators import ordered as O

from .common import materialize, ship

#: First turns by which nodes are dealt into shards.
PATH = 6
#: Messages that a queue holds in memory.
QUEUE_ROWS = 1 << 17
#: Nodes for which a shard is worth its overhead; trees of at most so many are solved in one.
ONE_SHARD = 50_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

KEYS = ["k1", "k2"]
PATHS = [f"f{i}" for i in range(1, PATH + 1)]


def turn_hashes(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, h1, h2 (hashes of role and text), len (code points) of the rows that have a conv_id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return (conversations.filter("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
                    F.xxhash64(F.lit(11), role, text).alias("h1"), F.xxhash64(F.lit(12), role, text).alias("h2"),
                    F.char_length(text).cast("long").alias("len")))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2, len) of :func:`turn_hashes`, pos from 1."""
    rows = O.in_order(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "h1", "h2"], "trie-turns")
    return O.scan(rows, ["conv_id"], pos=O.position()).select("conv_id", "pos", "h1", "h2", "len")


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations c whose first h turns are those of conversation c - c % group, h = crc32(c) % most:
    (conv_id, pos, h1, h2, len) rows and all conv_id.  Only the first turns of a group's first conversation are copied,
    at most ``most`` - 1 to each conversation of the group."""
    turns = materialize(turns, "trie-numbered")
    base = lambda c: c - c % group
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("long")
    convs = turns.select("conv_id").distinct().withColumn("h", h)
    firsts = (turns.filter((F.col("pos") < most) & (base(F.col("conv_id")) == F.col("conv_id")))
              .groupBy(F.col("conv_id").alias("b"))
              .agg(F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "len"))).alias("firsts")))
    convs = (convs.join(firsts, base(F.col("conv_id")) == F.col("b"), "left")
             .select("conv_id", "h", F.coalesce("firsts", F.array().cast(firsts.schema["firsts"].dataType)).alias("firsts")))
    taken = convs.select("conv_id", F.explode(F.expr("slice(firsts, 1, cast(h as int))")).alias("t")).select("conv_id", "t.*")
    moved = (convs.select("conv_id", (F.size("firsts") - F.col("h")).alias("moved")).filter("moved < 0"))
    own = (turns.filter(F.col("pos") > h).join(moved, "conv_id", "left")
           .select("conv_id", (F.col("pos") + F.coalesce("moved", F.lit(0))).alias("pos"), "h1", "h2", "len"))
    return taken.unionByName(own), convs.select("conv_id")


def step(lane: int) -> Column:
    """The share of a turn in the key of every node below it."""
    return F.xxhash64(F.lit(lane), "pos", "h1", "h2")


def members(turns: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2 (the node), p1, p2 (its parent), len, ends (its last turn), first turns f1.."""
    rows = O.in_order(turns.withColumns({"s1": step(1), "s2": step(2)}), ["conv_id"], ["pos"], "trie-order")
    at = {f: O.carried(F.when(F.col("pos") == i + 1, F.col("s1"))) for i, f in enumerate(PATHS)}
    s = O.scan(rows, ["conv_id"], k1=O.running_xor(F.col("s1")), k2=O.running_xor(F.col("s2")), after=O.lead(F.col("pos")),
               **at)
    return s.select("conv_id", F.col("pos").cast("long").alias("depth"), *KEYS,
                    F.col("k1").bitwiseXOR(F.col("s1")).alias("p1"),
                    F.col("k2").bitwiseXOR(F.col("s2")).alias("p2"), "len", F.col("after").isNull().alias("ends"),
                    *[F.coalesce(f, F.lit(-(1 << 63))).alias(f) for f in PATHS])


class Queue:
    """Least-first queue of tuples of eight numbers, key first; more than ``most`` go to sorted runs in a file."""

    def __init__(self, most: int = QUEUE_ROWS, block: int = 4096):
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (least tuple of a run, run)
        self.runs: list[Iterator[tuple]] = []
        self.most, self.block = most, block
        self.file = None

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        keep = self.most // 4
        self.file = self.file or tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(np.array(self.heap[keep:], dtype=np.int64).tobytes())
        run = self._read(at, len(self.heap) - keep)
        del self.heap[keep:]
        self.runs.append(run)
        heapq.heappush(self.heads, (next(run), len(self.runs) - 1))

    def _read(self, at: int, n: int) -> Iterator[tuple]:
        while n:
            take = min(n, self.block)
            self.file.seek(at)
            part = np.frombuffer(self.file.read(take * 64), dtype=np.int64).reshape(-1, 8)
            at, n = at + take * 64, n - take
            yield from map(tuple, part.tolist())

    def pop(self, key: tuple) -> tuple | None:
        """The least item if it starts with ``key`` (three numbers)."""
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, run = self.heads[0]
            if item[:3] != key:
                return None
            following = next(self.runs[run], None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, run))
            return item
        if self.heap and self.heap[0][:3] == key:
            return heapq.heappop(self.heap)
        return None

    def close(self) -> None:
        if self.file:
            self.file.close()


def spooled(file, blocks: list[tuple[int, int]], width: int) -> Iterator[list[int]]:
    """The rows of the blocks (place, rows) of a spool file, last first."""
    for at, n in reversed(blocks):
        file.seek(at)
        part = np.frombuffer(file.read(n * width * 8), dtype=np.int64).reshape(n, width)
        yield from part[::-1].tolist()


#: Columns of a node on its way through a shard; pd, p1, p2: depth and key of the parent; n_children, leaves and saved count what is known of its subtree.
NODE = ["depth", "k1", "k2", "pd", "p1", "p2", "conv_id", "n_convs", "n_children", "leaves", "saved", *PATHS]
SHARD_NODE = ", ".join(f"{c} long" for c in ["shard", *NODE, "parent", "rd", "r1", "r2"]) + ", root boolean"


def run_shards(nodes: DataFrame, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """SHARD_NODE of nodes sorted within partitions (the shards) by reverse level order: totals over what of the subtree
    lies in the shard; parent is the parent's conversation, rd, r1 and r2 the shard root above, root the nodes without a
    parent in the shard."""
    width = len(NODE) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Queue(queue_rows)
        spool = tempfile.TemporaryFile()
        blocks: list[tuple[int, int]] = []
        rows: list[list[int]] = []
        shard = None

        def put() -> None:
            blocks.append((spool.tell(), len(rows)))
            spool.write(np.array(rows, dtype=np.int64).tobytes())
            rows.clear()

        pad = [0] * (width - 4)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for s, depth, k1, k2, pd, p1, p2, conv, n, children, leaves, saved, *path in zip(*columns):
                shard = s
                key = (-depth, k1, k2)
                while m := queue.pop(key):
                    children += 1
                    leaves += m[3]
                    saved += m[4]
                    rows.append([0, m[7], m[5], m[6], *pad])  # an edge to the child
                rows.append([1, depth, k1, k2, pd, p1, p2, conv, n, children, leaves, saved, *path])
                if depth:
                    queue.push((-pd, p1, p2, leaves, saved, k1, k2, depth))
                if len(rows) >= 4096:
                    put()
        if rows:
            put()
        queue.close()
        # the spool backwards is in level order, keys descending: what a parent hands down waits for its children
        queue = Queue(queue_rows)
        out: list[list] = []
        here = (0, 0, 0, 0)

        def made() -> pa.RecordBatch:
            names = ["shard", *NODE, "parent", "rd", "r1", "r2"]
            cols = [pa.array(c, pa.int64()) for c in list(zip(*out))[:-1]]
            b = pa.RecordBatch.from_arrays([*cols, pa.array([r[-1] for r in out], pa.bool_())], names=[*names, "root"])
            out.clear()
            return b

        for row in spooled(spool, blocks, width):
            if row[0] == 0:  # follows its parent's row
                queue.push((row[1], ~row[2], ~row[3], *here, 0))
                continue
            _, depth, k1, k2 = row[:4]
            m = queue.pop((depth, ~k1, ~k2))
            parent, *top = m[3:7] if m else (None, depth, k1, k2)
            out.append([shard, *row[1:], parent, *top, m is None])
            here = (row[7], *top)
            if len(out) >= 8192:
                yield made()
        if out:
            yield made()
        queue.close()
        spool.close()

    return nodes.mapInArrow(run, SHARD_NODE)


def add_messages(nodes: DataFrame, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """(k1, k2, n_children, leaves, saved) of nodes sorted by (shard, reverse level order), the columns m_children,
    m_leaves and m_saved being what came from other shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, last = Queue(queue_rows), None
        for batch in batches:
            out = []
            for shard, depth, k1, k2, pd, p1, p2, n, leaves, saved, root in zip(
                    *(batch.column(i).to_pylist() for i in range(11))):
                if shard != last:
                    queue.close()
                    queue, last = Queue(queue_rows), shard
                key = (-depth, k1, k2)
                while m := queue.pop(key):
                    leaves += m[3]
                    saved += m[4]
                if not root:
                    queue.push((-pd, p1, p2, leaves, saved, k1, k2, depth))
                out.append((k1, k2, n, leaves, saved))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                             names=["k1", "k2", "n_children", "leaves", "saved"])
        queue.close()

    return nodes.mapInArrow(run, "k1 long, k2 long, n_children long, leaves long, saved long")


def level_order(shard: str | None = None) -> list[Column]:
    return [*([F.col(shard)] if shard else []), F.col("depth").desc(), F.col("k1"), F.col("k2")]


def subtree_totals(nodes: DataFrame, one_shard: int = ONE_SHARD, queue_rows: int = QUEUE_ROWS,
                   shards: int | None = None) -> DataFrame:
    """k1, k2, parent (the parent's conv_id), n_children, leaves, saved of stored NODE rows, totals over whole subtrees.
    ``shards`` is the number of shards; unless given, one per ``one_shard`` nodes, as many as Spark's shuffle partitions
    at most."""
    spark = nodes.sparkSession
    n = shards or min(-(-nodes.count() // one_shard), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = nodes.repartitionByRange(n, *PATHS, "conv_id", "depth") if n > 1 else nodes.coalesce(1)
    dealt = (dealt.withColumn("shard", F.spark_partition_id().cast("long"))
             .select("shard", *NODE).sortWithinPartitions(*level_order()))
    done = materialize(run_shards(dealt, queue_rows), "trie-shards")
    roots = done.filter("root and depth > 0").select(*KEYS, "p1", "p2", "leaves", "saved")
    heads = materialize(roots, "trie-roots")
    if heads.isEmpty():
        return done.select(*KEYS, "parent", "n_children", "leaves", "saved")
    # the nodes elsewhere that roots hang on: pre-aggregated, then looked up once
    hung = materialize(
        heads.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("children")).withColumnsRenamed({"p1": "k1", "p2": "k2"})
        .join(done.select(*KEYS, "shard", "rd", "r1", "r2", F.col("conv_id").alias("above")), KEYS), "trie-hung")
    # roots with others below them: a tree of their own, each with the totals of the plain roots below it
    inner = hung.select(F.col("r1").alias("k1"), F.col("r2").alias("k2")).distinct()
    plain = heads.join(inner, KEYS, "left_anti").groupBy("p1", "p2").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    below = (plain.withColumnsRenamed({"p1": "k1", "p2": "k2"}).join(hung.select(*KEYS, "r1", "r2"), KEYS)
             .groupBy(F.col("r1").alias("k1"), F.col("r2").alias("k2")).agg(F.sum("l").alias("l"), F.sum("s").alias("s")))
    up = hung.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("rd").alias("ud"),
                     F.col("r1").alias("u1"), F.col("r2").alias("u2"))
    tree = (done.filter("root").join(inner, KEYS).join(below, KEYS, "left").join(up, ["p1", "p2"], "left")
            .withColumns({"leaves": F.col("leaves") + F.coalesce("l", F.lit(0)),
                          "saved": F.col("saved") + F.coalesce("s", F.lit(0)),
                          "pd": F.coalesce("ud", F.lit(0)), "p1": F.coalesce("u1", F.lit(0)),
                          "p2": F.coalesce("u2", F.lit(0)), "n_children": F.lit(0).cast("long")}))
    tree = materialize(tree.select(*NODE), "trie-tree")
    fewer = max(1, min(n - 1, -(-tree.count() // one_shard)))  # in the end one shard
    solved = subtree_totals(tree, one_shard, queue_rows, fewer)
    total = (heads.join(solved.select(*KEYS, F.col("leaves").alias("tl"), F.col("saved").alias("ts")), KEYS, "left")
             .groupBy("p1", "p2").agg(F.sum(F.coalesce("tl", "leaves")).alias("m_leaves"),
                                      F.sum(F.coalesce("ts", "saved")).alias("m_saved")))
    messages = total.withColumnsRenamed({"p1": "k1", "p2": "k2"}).join(hung.select(*KEYS, "children"), KEYS)
    again = done.join(F.broadcast(hung.select("shard").distinct()), "shard", "left_semi")  # a row a shard at most
    own = nodes.select(*KEYS, F.col("leaves").alias("own_leaves"), F.col("saved").alias("own_saved"))
    again = (again.join(own, KEYS).join(messages, KEYS, "left")
             .select("shard", "depth", *KEYS, "pd", "p1", "p2", (F.col("n_children") + F.coalesce("children", F.lit(0))).alias("n"),
                     (F.col("own_leaves") + F.coalesce("m_leaves", F.lit(0))).alias("l"),
                     (F.col("own_saved") + F.coalesce("m_saved", F.lit(0))).alias("s"), "root"))
    mended = add_messages(again.repartition("shard").sortWithinPartitions(*level_order("shard")), queue_rows)
    mended = materialize(mended, "trie-mended").withColumnsRenamed(
        {"n_children": "mn", "leaves": "ml", "saved": "ms"})
    parents = heads.select(*KEYS, "p1", "p2").join(
        hung.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), "above"), ["p1", "p2"]).select(*KEYS, "above")
    return (done.join(mended, KEYS, "left").join(parents, KEYS, "left")
            .select(*KEYS, F.coalesce("parent", "above").alias("parent"), F.coalesce("mn", "n_children").alias("n_children"),
                    F.coalesce("ml", "leaves").alias("leaves"), F.coalesce("ms", "saved").alias("saved")))


PACKED = "k1 long, k2 long, first long, ids binary"
#: Bytes of ids in one packed row.
PACK = 1 << 16


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of (k1, k2, conv_id): ids are sorted and joined to strings in range partitions, so that the
    one task that must read all ids of a node in order to hash them gets a few long strings."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for k1, k2, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key != (k1, k2) or size >= PACK:
                    if ids:
                        out.append((*key, first, ",".join(ids).encode()))
                    key, first, ids, size = (k1, k2), c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if out:
                yield packed(out)
                out = []
        if ids:
            yield packed([(*key, first, ",".join(ids).encode())])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        a, b, c, d = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()),
                                           pa.array(d, pa.binary())], names=["k1", "k2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out: list[tuple] = []
            for k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if key == (k1, k2):
                    sha.update(b",")
                else:
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256()
                sha.update(ids)
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("k1", "k2", "ends_sha256"), zip(*out))))
        if key:
            yield pa.RecordBatch.from_pydict({"k1": [key[0]], "k2": [key[1]], "ends_sha256": [sha.hexdigest()]})

    strings = ends.repartitionByRange(*KEYS, "conv_id").sortWithinPartitions(*KEYS, "conv_id").mapInArrow(pack, PACKED)
    return (strings.repartition(*KEYS).sortWithinPartitions(*KEYS, "first")
            .mapInArrow(digest, "k1 long, k2 long, ends_sha256 string"))


def trie(turns: DataFrame, conversations: DataFrame, one_shard: int = ONE_SHARD, queue_rows: int = QUEUE_ROWS,
         shards: int | None = None) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node.

    ``turns`` holds (conv_id, pos from 1 without gaps, h1, h2, len) and ``conversations`` every conv_id, those without a
    turn included.
    """
    ship(turns.sparkSession)
    m = materialize(members(turns), "trie-members")
    zero = F.lit(0).cast("long")
    grouped = (m.groupBy("depth", *KEYS, "p1", "p2")
               .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("len").alias("len"),
                    F.sum(F.col("ends").cast("long")).alias("n_ends"), *[F.max(f).alias(f) for f in PATHS]))
    begun = m.filter("depth = 1").select("conv_id", F.lit(1).alias("begun"))
    started = conversations.join(begun, "conv_id", "left")
    turnless = started.filter("begun is null").select("conv_id")
    root = (started.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                        F.count_if(F.col("begun").isNull()).alias("n_ends")).filter("n_convs > 0")
            .select(zero.alias("depth"), *[zero.alias(c) for c in ("k1", "k2", "p1", "p2")], "conv_id", "n_convs",
                    zero.alias("len"), "n_ends", *[F.lit(-(1 << 63)).alias(f) for f in PATHS]))
    nodes = grouped.unionByName(root).select(
        "depth", *KEYS, F.greatest(F.col("depth") - 1, zero).alias("pd"), "p1", "p2", "conv_id", "n_convs", zero.alias("n_children"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("len")).alias("saved"), *PATHS)
    nodes = materialize(nodes, "trie-nodes")
    ends = m.filter("ends").select(*KEYS, "conv_id").unionByName(
        turnless.select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    totals = subtree_totals(nodes, one_shard, queue_rows, shards)
    return (nodes.select("depth", *KEYS, "conv_id", "n_convs").join(totals, KEYS)
            .join(end_digests(ends), KEYS, "left")
            .select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))
