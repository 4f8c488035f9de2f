"""Removal of repeated passages: every word covered by a window of ``length`` words that also starts anywhere else.

Documents are factored relative to reference blocks.  Only a block that holds a window's own words can hold a match of it,
so the corpus is cut into reference blocks by content first: each window has an anchor, the least-hashed string of
``anchor`` words in it (the leftmost of equals), and the windows of one anchor, which are neighbours, make a context.
Equal windows have equal anchors at equal places, so all places where a window starts meet in the block of its anchor.

1. Contexts are counted by (anchor, content), combined within tasks.  An anchor with one context repeats nothing.  A
   context whose content is there twice repeats as a whole, without any comparison.
2. The contents that share an anchor and differ are indexed together, many anchors to a block, by a suffix array.  Each is
   parsed greedily from left to right: a factor is the longest string at that place that also starts elsewhere in the block.
   A window inside a factor of ``length`` words or more is repeated.  A window that no factor holds crosses a factor
   boundary; those that start within ``length`` - 1 words before a boundary are looked up one by one.  So nothing is
   missed, and the parse stops at the words where a longer match would begin.
3. Repeated windows of a document are merged into runs of words and taken out.

An anchor with more than ``group`` different contents is not put into one block: its contents are cut into blocks of their
own by a longer anchor, the whole window, where equal windows are equal keys.  The result is the same.

Words are compared by 64-bit hashes, windows by all of theirs.

Edge cases: NULL is the empty text; texts of less than ``length`` words keep everything; every row is a document of its own,
so the windows of a row that is there twice are all repeated; NULL ids are ids like any other; an empty table gives an empty
result; other columns are ignored.  A very long text is hashed in parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, vector_udf
from .suffix import keyed, signed, suffix_order
from .textarrays import TABLES, mix, parts, power_tables, texts, word_hashes

ANCHOR = 12
#: Windows handled at a time.
PART = 1 << 18
PLACE = np.uint64((1 << 20) - 1)
#: Words that are indexed together, if no single anchor has more.
BLOCK_WORDS = 1 << 17
#: Most different contents of an anchor that are indexed in one block.
GROUP = 5_000
SALT = np.uint64(0x9E3779B97F4A7C15)

ROW = "h long, c long, doc long, start int, windows int"


def words_of(data: np.ndarray) -> np.ndarray:
    return word_hashes(data, TABLES[0])


def sums_of(words: np.ndarray, salt: np.uint64) -> np.ndarray:
    """Running sums with a leading 0, as in textarrays: the hash of words [i, j) is (out[j] - out[i]) * inverse power i."""
    out = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mix(words + salt) * power_tables(len(words))[0][:len(words)], out=out[1:])
    return out


def contexts_of(words: np.ndarray, length: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, content hash, first window, number of windows) of the contexts of a text, part by part."""
    for at in range(0, max(len(words) - length + 1, 0), PART):
        part = words[at:at + PART + length - 1]
        inverse = power_tables(len(part))[1]
        sums = sums_of(part, np.uint64(0))
        h = mix((sums[anchor:] - sums[:-anchor]) * inverse[:len(part) - anchor + 1])
        width = length - anchor + 1
        least = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        k = 1
        while 2 * k <= width:  # least of (hash, place) in each window, by doubling
            least = np.minimum(least[:-k], least[k:])
            k *= 2
        if k < width:
            least = np.minimum(least[:k - width], least[width - k:])
        place = (least & PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        windows = np.diff(np.append(first, len(place)))
        sums = sums_of(part, SALT)
        c = mix((sums[first + windows + length - 1] - sums[first]) * inverse[first])
        yield h[place[first]], c, first + at, windows


def context_batch(found: list[tuple]) -> pa.RecordBatch:
    h, c, doc, start, windows = (np.concatenate(x) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (signed(h), signed(c), doc.astype(np.int64),
                                                             start.astype(np.int32), windows.astype(np.int32))],
                                      names=["h", "c", "doc", "start", "windows"])


def context_rows(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """ROW per context of (key, text) documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            found = [(h, c, np.full(len(h), key), first, windows)
                     for key, data in zip(batch.column(0).to_pylist(), texts(batch, 1))
                     for h, c, first, windows in contexts_of(words_of(data), length, anchor)]
            if found:
                yield context_batch(found)

    return docs.mapInArrow(run, ROW)


def longest_elsewhere(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(longest, starts): at each place of the joined pieces, the length of the longest string that starts there, stays
    within its piece and also starts elsewhere in the pieces; starts of the pieces in the joined array, and its end."""
    k = len(pieces)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes + 1) - 1
    text = np.empty(int(ends[-1]) + 1, dtype=np.int64)
    body = np.ones(len(text), dtype=bool)
    body[ends] = False
    text[body] = np.unique(np.concatenate(pieces), return_inverse=True)[1] + k
    text[ends] = np.arange(k)  # separators that all differ: no match goes beyond a piece
    order = suffix_order(text)
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), dtype=np.int64)
    alive = np.arange(len(a))
    n = 0
    while len(alive):  # neighbours in suffix order, word by word
        same = text[a[alive] + n] == text[b[alive] + n]
        alive = alive[same]
        n += 1
        common[alive] = n
    longest = np.zeros(len(text), dtype=np.int64)
    longest[order[1:]] = common
    longest[order[:-1]] = np.maximum(longest[order[:-1]], common)
    return longest, np.append(ends - sizes, len(text))


def factor_windows(pieces: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of the windows of ``length`` words that also start elsewhere, by a greedy parse of each piece."""
    longest, starts = longest_elsewhere(pieces)
    at = starts[:-1].copy()
    end = starts[1:] - 1
    found = []

    def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
        offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(first, count) + offset

    live = np.flatnonzero(at < end)
    while len(live):  # one factor of every piece a step
        here = at[live]
        size = np.maximum(longest[here], 1)
        found.append(spread(here, np.maximum(longest[here] - length + 1, 0)))
        here = here + size
        at[live] = here
        # windows that cross the boundary into the next factor
        cross = here < end[live]
        low = np.maximum(here[cross] - length + 1, starts[:-1][live][cross])
        inner = spread(low, here[cross] - low)
        found.append(inner[longest[inner] >= length])
        live = live[cross]
    places = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    piece = np.searchsorted(starts, places, side="right") - 1
    return piece, places - starts[piece]


SPAN = "doc long, start int, windows int"


def spans_batch(doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """SPAN of windows (doc, place), neighbours taken together."""
    order = np.lexsort((place, doc))
    d, p = doc[order], place[order]
    edge = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)]))
    n = np.diff(np.append(edge, len(d)))
    return pa.RecordBatch.from_arrays([pa.array(d[edge].astype(np.int64)), pa.array(p[edge].astype(np.int32)),
                                       pa.array(n.astype(np.int32))], names=["doc", "start", "windows"])


def parse_blocks(contents: DataFrame, length: int, block_words: int) -> DataFrame:
    """SPAN of the repeated windows of (h, doc, start, words) contents; those of one h are indexed together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, np.ndarray]] = []
        total = 0

        def parsed() -> Iterator[pa.RecordBatch]:
            piece, offset = factor_windows([r[3] for r in held], length)
            if len(piece):
                doc, start = (np.array([r[i] for r in held], dtype=np.int64) for i in (1, 2))
                yield spans_batch(doc[piece], start[piece] + offset)

        for batch in batches:
            for h, d, s, w in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if total >= block_words and h != held[-1][0]:
                    yield from parsed()
                    held, total = [], 0
                held.append((h, d, s, np.frombuffer(w, dtype=np.uint64)))
                total += len(w) // 8
        if held:
            yield from parsed()

    return contents.repartition("h").sortWithinPartitions("h").mapInArrow(run, SPAN)


def cut_contents(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, doc, start, words) of the wanted (h, doc, start, windows) contexts, from the texts."""
    places = wanted.groupBy("doc").agg(F.collect_list(F.struct("h", "start", "windows")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            out = []
            for key, data, places in zip(batch.column(0).to_pylist(), texts(batch, 1), batch.column(2)):
                words, v = words_of(data), places.values
                for h, s, w in zip(*(v.field(x).to_pylist() for x in ("h", "start", "windows"))):
                    out.append((h, key, s, words[s:s + w + length - 1].tobytes()))
            for i in range(0, len(out), 2000):
                h, doc, start, cut = zip(*out[i:i + 2000])
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(doc, pa.int64()),
                                                  pa.array(start, pa.int32()), pa.array(cut, pa.binary())],
                                                 names=["h", "doc", "start", "words"])

    return (docs.join(places, docs["key"] == places["doc"]).select("key", "text", "places")
            .mapInArrow(run, "h long, doc long, start int, words binary"))


def whole_windows(contents: DataFrame, length: int) -> DataFrame:
    """ROW per window of (h, doc, start, words) contents, the window being its own anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(h, c, np.full(len(h), d), first + s, windows)
                     for d, s, w in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))
                     for h, c, first, windows in contexts_of(np.frombuffer(w, dtype=np.uint64), length, length)]
            if found:
                yield context_batch(found)

    return contents.mapInArrow(run, ROW)


def repeated_spans(docs: DataFrame, length: int = 35, anchor: int = ANCHOR, block_words: int = BLOCK_WORDS,
                   group: int = GROUP) -> DataFrame:
    """(doc, start, windows) of (key, text) documents: runs of windows that also start elsewhere, in no order."""
    rows = materialize(context_rows(docs, length, anchor), "rlz-contexts")
    # small tables by key are written before they are joined, so that both sides of a join are dealt for it alone and
    # adaptive execution may split a key with many rows
    anchors = (rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
               .filter("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed")))
    anchors = materialize(anchors, "rlz-anchors")
    met = materialize(rows.join(anchors, "h"), "rlz-met")
    alike = met.filter("not mixed").select("doc", "start", "windows")
    mixed = met.filter("mixed").drop("mixed")
    contents = materialize(mixed.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"),
                                                       F.min(F.struct("doc", "start", "windows")).alias("first")),
                           "rlz-contents")
    twice = mixed.join(contents.filter("n > 1").select("h", "c"), ["h", "c"], "left_semi").select("doc", "start", "windows")
    sizes = contents.groupBy("h").agg(F.count(F.lit(1)).alias("k"))
    firsts = materialize(cut_contents(docs, contents.select("h", "first.*"), length), "rlz-firsts")
    large = sizes.filter(F.col("k") > group).select("h")
    found = alike.unionAll(twice)
    if large.isEmpty():
        return found.unionAll(parse_blocks(firsts, length, block_words))
    windows = materialize(whole_windows(firsts.join(large, "h", "left_semi"), length), "rlz-windows")
    again = windows.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "c")
    again = materialize(again, "rlz-again")
    found = found.unionAll(windows.join(again, ["h", "c"], "left_semi").select("doc", "start", "windows"))
    return found.unionAll(parse_blocks(firsts.join(large, "h", "left_anti"), length, block_words))


def covered(starts: np.ndarray, windows: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n words lie in one of the windows."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + windows + length - 1, -1)
    return np.cumsum(change)[:n] > 0


RESULT = "n_words long, n_removed long, kept_sha256 string, kept string, spans array<struct<first:long,words:long>>"


def without_spans(with_spans: DataFrame, length: int, keep_text: bool) -> DataFrame:
    """Struct column ``r`` of RESULT from columns text, places and copies."""
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for text, places, copies in batches:
            rows = []
            for t, p, m in zip(text, places, copies):
                words = t.encode().split()  # bytes: splits at the six whitespace characters only
                n, spans = len(words), []
                if m > 1 and n >= length:
                    p = [{"start": 0, "windows": n - length + 1}]
                if p is not None and len(p):
                    gone = covered(np.array([x["start"] for x in p]), np.array([x["windows"] for x in p]), length, n)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    spans = [{"first": a, "words": b - a} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept = b" ".join(words)
                rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode() if keep_text else None,
                             spans if keep_text else None))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept", "spans"])

    return with_spans.withColumn("r", vector_udf(run, RESULT)("text", "places", "copies"))


def remove_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 35, keep_text: bool = False,
                    anchor: int = ANCHOR, block_words: int = BLOCK_WORDS, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row of ``docs``; with ``keep_text`` also the kept text (words joined
    by one space) and the removed spans (first word, number of words)."""
    rows, once = keyed(docs, text, doc_id)
    spans = repeated_spans(once, length, min(anchor, length), block_words, group)
    places = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "windows")).alias("places"))
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    full = rows.join(places, rows["key"] == places["doc"], "left")
    if copies.isEmpty():
        full = full.withColumn("copies", F.lit(1).cast("long"))
    else:
        full = full.join(copies, "key", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    out = without_spans(full.select("doc_id", "text", "places", "copies"), length, keep_text)
    return out.select("doc_id", *[f"r.{x}" for x in ["n_words", "n_removed", "kept_sha256", *["kept", "spans"] * keep_text]])
