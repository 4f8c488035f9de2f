"""Removal of long repeats: every byte covered by a string of ``length`` bytes that also starts earlier.

The corpus is cut into comparable pieces first.  Each window of ``length`` bytes has an anchor, the least-hashed string
of ANCHOR bytes in it (the leftmost of equals); equal windows have equal anchors at equal places.  The windows of one
anchor are neighbours and make a context, the bytes they cover.  So windows are equal only if their contexts have the
same anchor hash, and each window belongs to one context.

1. Contexts are brought together by anchor hash, sorted by content and place.  Equal contexts collapse to the first one:
   every later one repeats it as a whole.  Within a task they collapse before the shuffle, so that neither copies nor a
   passage that many texts share bring more than one row a task and content.
2. Contexts that differ but share an anchor may have some windows in common.  A block of them is sorted into a
   Burrows-Wheeler transform, and its intervals are extended backwards breadth first: level by level, an interval of a
   string w gives those of c + w for each byte c before it, and an interval end that no shorter string has ended marks
   two neighbouring suffixes whose common prefix is as long as w.  Marks come in order of increasing prefix, so the
   search stops at ``length``; what is not separated by then is equal in ``length`` bytes.
3. The repeated windows of a document are merged into runs of bytes and taken out.

An anchor hash with more than ``group`` different contexts is not brought into one block: its contexts are split into
their windows, each a context of its own under its own hash, which step 1 settles.

Edge cases: NULL is the empty text; texts under ``length`` bytes keep everything; equal (doc_id, text) rows are one
document, which each of them reports; rows with one id and different texts come in the order of a hash of the text, NULL
ids last; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship, text_of, vector_udf
from .textarrays import TABLES, mix, parts, power_tables, running, texts

ANCHOR = 32
#: Windows handled at a time; a longer text is taken in parts.
PART = 1 << 18
PLACE = np.uint64((1 << 20) - 1)
#: Bytes of contexts that are sorted together.
BLOCK_BYTES = 1 << 19
#: Most different contexts of an anchor that are compared in one block.
GROUP = 20_000

ROW = "h long, c long, doc long, start int, windows int"


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def contexts_of(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, content hash, first window, number of windows) of the contexts of a text, part by part."""
    for at in range(0, max(len(data) - length + 1, 0), PART):
        part = data[at:at + PART + length - 1]
        inverse = power_tables(len(part))[1]
        sums = running(part, TABLES[0])
        h = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[:len(part) - ANCHOR + 1])
        # least of (hash, place) in each window, by doubling
        width = length - ANCHOR + 1
        least = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        k = 1
        while 2 * k <= width:
            least = np.minimum(least[:-k], least[k:])
            k *= 2
        if k < width:
            least = np.minimum(least[:k - width], least[width - k:])
        place = (least & PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        windows = np.diff(np.append(first, len(place)))
        sums = running(part, TABLES[1])
        c = mix((sums[first + windows + length - 1] - sums[first]) * inverse[first])
        yield h[place[first]], c, first + at, windows


def collapsed(h: np.ndarray, c: np.ndarray, doc: np.ndarray, start: np.ndarray, windows: np.ndarray) -> list[np.ndarray]:
    """The rows of a batch with the later of equal contexts marked: windows negative, and the hash of the document in
    place of the anchor's, which spreads them evenly."""
    order = np.lexsort((start, doc, c, h))
    h, c, doc, start, windows = (x[order] for x in (h, c, doc, start, windows))
    later = np.zeros(len(h), dtype=bool)
    later[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
    h = np.where(later, mix(doc.astype(np.int64).view(np.uint64) + np.uint64(1)), h)
    return [signed(h), np.where(later, 0, signed(c)), doc, start.astype(np.int32),
            np.where(later, -windows, windows).astype(np.int32)]


def context_rows(docs: DataFrame, length: int) -> DataFrame:
    """ROW per context of (key, text) documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            found: list[tuple] = []
            for key, data in zip(batch.column(0).to_pylist(), texts(batch, 1)):
                for h, c, first, windows in contexts_of(data, length):
                    found.append((h, c, np.full(len(h), key, dtype=np.int64), first, windows))
            if found:
                columns = collapsed(*(np.concatenate(x) for x in zip(*found)))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns],
                                                 names=["h", "c", "doc", "start", "windows"])

    return docs.mapInArrow(run, ROW)


SETTLED = "compare boolean, ordinal int, h long, doc long, start int, windows int"


def settle(rows: DataFrame) -> DataFrame:
    """Rows sorted by anchor and content become repeats (compare false: all windows start again later than their first)
    and the contexts that are first of their content and share an anchor with other content (compare true)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_h = last_c = None
        contents = 0  # different contents of the current anchor so far
        waiting = None  # the first context of the current anchor, while it is the only content

        def out(compare: bool, ordinal: np.ndarray, h, doc, start, windows) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(h), compare)), pa.array(ordinal.astype(np.int32)), pa.array(h), pa.array(doc),
                 pa.array(start), pa.array(windows)], names=["compare", "ordinal", "h", "doc", "start", "windows"])

        for batch in batches:
            h, c, doc, start, windows = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            known = windows < 0
            if known.any():
                yield out(False, np.zeros(known.sum()), h[known], doc[known], start[known], -windows[known])
                h, c, doc, start, windows = (x[~known] for x in (h, c, doc, start, windows))
            if not len(h):
                continue
            new_h = np.concatenate([[h[0] != last_h], h[1:] != h[:-1]])
            new_c = new_h | np.concatenate([[c[0] != last_c], c[1:] != c[:-1]])
            if (~new_c).any():
                yield out(False, np.zeros((~new_c).sum()), h[~new_c], doc[~new_c], start[~new_c], windows[~new_c])
            # number the contents of each anchor from 1, carrying on the count of the anchor that the last batch ended in
            count = np.cumsum(new_c)
            base = np.where(new_h, count - 1, 0)
            np.maximum.accumulate(base, out=base)
            ordinal = count - base
            if not new_h.all():
                same = np.cumsum(new_h) == 0
                ordinal = np.where(same, count + contents, ordinal)
            f = np.flatnonzero(new_c)
            if waiting is not None and len(f):
                if ordinal[f[0]] == 2:
                    yield out(True, np.ones(1), *waiting)
                waiting = None
            o = ordinal[f]
            followed = np.concatenate([o[1:] == 2, [False]]) if len(f) else np.zeros(0, bool)
            chosen = (o >= 2) | followed
            if chosen.any():
                g = f[chosen]
                yield out(True, ordinal[g], h[g], doc[g], start[g], windows[g])
            if len(f) and o[-1] == 1:
                g = f[-1:]
                waiting = (h[g].copy(), doc[g].copy(), start[g].copy(), windows[g].copy())
            last_h, last_c, contents = h[-1], c[-1], int(ordinal[-1])

    return rows.repartition("h").sortWithinPartitions("h", "c", "doc", "start").mapInArrow(run, SETTLED)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling.  Symbols are numbers; all suffixes must differ."""
    n = len(text)
    # as many symbols as fit into one number at first
    bits = int(text.max()).bit_length()
    k = max(1, 62 // max(bits, 1))
    rank = np.zeros(n, dtype=np.int64)
    for i in range(k):
        rank <<= bits
        rank[:max(n - i, 0)] |= text[i:]
    order = np.argsort(rank)
    step = np.concatenate([[0], np.cumsum(rank[order][1:] != rank[order][:-1])])
    rank[order] = step
    while step[-1] < n - 1:
        after = np.full(n, -1, dtype=np.int64)
        after[:max(n - k, 0)] = rank[k:]
        key = rank * (n + 1) + after + 1
        order = np.argsort(key)
        ranked = key[order]
        step = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        rank[order] = step
        k *= 2
    return order


def equal_prefix_classes(pieces: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, piece, offset) per suffix of ``length`` bytes or more that has another one equal in ``length`` bytes.

    The pieces are joined with separators that all differ, so no common prefix reaches beyond a piece.
    """
    k = len(pieces)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes + 1) - 1
    text = np.empty(int(ends[-1]) + 1, dtype=np.int64)
    body = np.ones(len(text), dtype=bool)
    body[ends] = False
    text[body] = np.concatenate(pieces).astype(np.int64) + k  # bytes come after the separators 0 .. k - 1
    text[ends] = np.arange(k)
    n = len(text)
    order = suffix_order(text)
    before = text[order - 1]  # the Burrows-Wheeler transform; the suffix at 0 is preceded by the last separator
    # where the suffix that starts one byte earlier stands: stable by that byte
    back = np.empty(n, dtype=np.int64)
    narrow = before.astype(np.uint16) if k + 256 < 1 << 16 else before  # sorted by radix
    back[np.argsort(narrow, kind="stable")] = np.arange(n)
    ended = np.zeros(n + 1, dtype=bool)  # ended[r]: suffixes r - 1 and r are known to part within `length` bytes
    ended[[0, n]] = True
    counts = np.bincount(text, minlength=1)
    counts = counts[counts > 0]
    high = np.cumsum(counts)
    low = high - counts
    ended[high] = True
    first_byte = np.zeros(n, dtype=bool)
    first_byte[low] = True
    owner = np.empty(n, dtype=np.int64)
    for _ in range(1, length):
        if not len(low):
            break
        span = high - low
        which = np.repeat(np.arange(len(low)), span)
        at = np.arange(len(which)) - np.repeat(np.cumsum(span) - span, span) + low[which]
        byte = before[at]
        inside = byte >= k
        which, at, byte = which[inside], at[inside], byte[inside]
        if not len(at):
            break
        # going back by one byte keeps the order among equal bytes, so an interval's places with one byte before them
        # become neighbours: each such run is the interval of the longer string
        if len(at) * 8 > n:
            owner[:] = -1
            owner[back[at]] = which
            edge = np.flatnonzero((owner[1:] != owner[:-1]) | first_byte[1:]) + 1
            lo = np.concatenate([[0], edge])
            hi = np.append(edge, n)
            lo, hi = lo[owner[lo] >= 0], hi[owner[lo] >= 0]
        else:
            to = back[at]
            by = np.argsort(to)
            to, which = to[by], which[by]
            edge = np.concatenate([[True], (to[1:] != to[:-1] + 1) | (which[1:] != which[:-1]) | first_byte[to[1:]]])
            lo = to[edge]
            hi = to[np.append(np.flatnonzero(edge)[1:], len(to)) - 1] + 1
        new = ~ended[hi]
        low, high = lo[new], hi[new]
        ended[high] = True
    group = np.cumsum(ended[:n]) - 1
    several = np.bincount(group)[group] > 1
    where = order[several]
    piece = np.searchsorted(ends, where)
    return group[several], piece, where - (ends[piece] - sizes[piece])


def compare(texts_: list[np.ndarray], doc: np.ndarray, start: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(doc, start, windows) runs of the windows of a block of contexts that have an earlier equal one in the block."""
    group, piece, offset = equal_prefix_classes(texts_, length)
    if not len(group):
        return []
    place = start[piece] + offset
    order = np.lexsort((place, doc[piece], group))
    g = group[order]
    again = np.concatenate([[False], g[1:] == g[:-1]])
    d, p = doc[piece[order][again]], place[order][again]
    order = np.lexsort((p, d))
    d, p = d[order], p[order]
    if not len(d):
        return []
    edge = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)]))
    return list(zip(d[edge].tolist(), p[edge].tolist(), np.diff(np.append(edge, len(d))).tolist()))


SPAN = "doc long, start int, windows int"


def spans_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.int32())], names=["doc", "start", "windows"])


def compare_blocks(contexts: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """SPAN of the repeated windows among (h, doc, start, bytes) contexts; those of one h are compared together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, np.ndarray]] = []
        total = 0

        def flush() -> pa.RecordBatch:
            return spans_batch(compare([r[3] for r in held], np.array([r[1] for r in held], dtype=np.int64),
                                       np.array([r[2] for r in held], dtype=np.int64), length))

        for batch in batches:
            for h, d, s, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if total >= block_bytes and h != held[-1][0]:
                    yield flush()
                    held, total = [], 0
                held.append((h, d, s, np.frombuffer(b, dtype=np.uint8)))
                total += len(b)
        if held:
            yield flush()

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, SPAN)


def cut_contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, doc, start, bytes) of the wanted (h, doc, start, windows) contexts, from the texts."""
    places = wanted.groupBy("doc").agg(F.collect_list(F.struct("h", "start", "windows")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            h, doc, start, cut = [], [], [], []
            for key, data, places in zip(batch.column(0).to_pylist(), texts(batch, 1), batch.column(2)):
                v = places.values
                for a, b, w in zip(v.field("h").to_pylist(), v.field("start").to_pylist(), v.field("windows").to_pylist()):
                    h.append(a)
                    doc.append(key)
                    start.append(b)
                    cut.append(data[b:b + w + length - 1].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(doc, pa.int64()),
                                              pa.array(start, pa.int32()), pa.array(cut, pa.binary())],
                                             names=["h", "doc", "start", "bytes"])

    return (docs.join(places, docs["key"] == places["doc"]).select("key", "text", "places")
            .mapInArrow(run, "h long, doc long, start int, bytes binary"))


def single_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The windows of contexts, each as a context of its own (ROW)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for d, s, b in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                data = np.frombuffer(b, dtype=np.uint8)
                n = len(data) - length + 1
                inverse = power_tables(len(data))[1][:n]
                h, c = (mix((sums[length:] - sums[:-length]) * inverse)
                        for sums in (running(data, TABLES[0]), running(data, TABLES[1])))
                found.append((h, c, np.full(n, d, dtype=np.int64), s + np.arange(n), np.ones(n, dtype=np.int64)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in collapsed(*map(np.concatenate, zip(*found)))],
                                                 names=["h", "c", "doc", "start", "windows"])

    return contexts.mapInArrow(run, ROW)


def keyed(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """(key, doc_id, text, rest) per row, and (key, text) once per key: keys are ids where these are all there and all
    different, or else numbers in the order of (doc_id, hash of the text), equal rows alike.  ``rest`` is a struct of
    the other columns."""
    ship(docs.sparkSession)
    rest = F.struct(F.lit(0).alias(text), *[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"), rest.alias("rest"))
    unclear = rows.groupBy("doc_id").count().filter("doc_id is null or count > 1")
    if unclear.isEmpty():
        rows = rows.withColumn("key", F.col("doc_id"))
        return rows, rows.select("key", "text")
    hashed = rows.withColumn("th", F.xxhash64("text"))
    names = (hashed.select("doc_id", "th").distinct().orderBy(F.col("doc_id").asc_nulls_last(), "th")
             .withColumn("key", F.monotonically_increasing_id()))
    names = materialize(names, "repeats-keys").withColumnsRenamed({"doc_id": "i", "th": "j"})
    rows = (hashed.join(names, hashed["doc_id"].eqNullSafe(names["i"]) & (hashed["th"] == names["j"]))
            .select("key", "doc_id", "text", "rest"))
    return rows, rows.select("key", "text").dropDuplicates(["key"])


def repeated_spans(docs: DataFrame, length: int = 100, block_bytes: int = BLOCK_BYTES, group: int = GROUP) -> DataFrame:
    """(doc, start, windows) of :func:`keyed` documents: runs of windows that also start earlier, in no order."""
    settled = materialize(settle(context_rows(docs.select("key", "text"), length)), "repeats-settled")
    spans = settled.filter("not compare").select("doc", "start", "windows")
    unlike = settled.filter("compare").select("h", "doc", "start", "windows", "ordinal")
    large = unlike.filter(F.col("ordinal") > group).select("h").distinct()
    if not large.isEmpty():
        windows = single_windows(cut_contexts(docs, unlike.join(large, "h", "left_semi"), length), length)
        more = settle(windows).filter("not compare").select("doc", "start", "windows")
        spans = spans.unionAll(more)
        unlike = unlike.join(large, "h", "left_anti")
    contexts = cut_contexts(docs, unlike, length)
    return spans.unionAll(compare_blocks(contexts, length, block_bytes))


def merged(places: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by runs of windows."""
    out: list[tuple[int, int]] = []
    for a, w in sorted((p["start"], p["windows"]) for p in places):
        b = a + w + length - 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def without_spans(with_spans: DataFrame, length: int, keep_text: bool) -> DataFrame:
    """Struct column ``r`` of RESULT from columns text and places.  ``kept`` (if asked for) leaves out only whole
    characters: a run is shortened to the characters it covers entirely."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, places in batches:
            rows = []
            for t, p in zip(text, places):
                data = (t or "").encode()
                runs = merged(list(p), length) if p is not None else []
                edges = [0, *(x for r in runs for x in r), len(data)]
                digest = hashlib.sha256(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))).hexdigest()
                kept = None
                if keep_text:
                    whole = []
                    for a, b in runs:
                        while a < b and data[a] & 0xC0 == 0x80:
                            a += 1
                        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                            b -= 1
                        whole += [a, b]
                    edges = [0, *whole, len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])).decode()
                rows.append((len(data), sum(b - a for a, b in runs), len(runs), digest, kept))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return with_spans.withColumn("r", vector_udf(run, RESULT)("text", "places"))


def spanned(docs: DataFrame, text: str, doc_id: str, length: int, keep_text: bool, block_bytes: int,
            group: int) -> DataFrame:
    rows, once = keyed(docs, text, doc_id)
    spans = repeated_spans(once, length, block_bytes, group)
    places = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "windows")).alias("places"))
    return without_spans(rows.join(places, rows["key"] == places["doc"], "left"), length, keep_text)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 100,
                   keep_text: bool = False, block_bytes: int = BLOCK_BYTES, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept) per row of ``docs``."""
    out = spanned(docs, text, doc_id, length, keep_text, block_bytes, group)
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_text]
    return out.select("doc_id", *[f"r.{x}" for x in names])


def strip_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 100,
                  block_bytes: int = BLOCK_BYTES, group: int = GROUP) -> DataFrame:
    """``docs`` with the repeats taken out of the text (whole characters only), all other columns as they are."""
    out = spanned(docs, text, doc_id, length, True, block_bytes, group)
    return out.select(*[F.col("r.kept").alias(text) if c == text else F.col(f"rest.`{c}`") for c in docs.columns])
