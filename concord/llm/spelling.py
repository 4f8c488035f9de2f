"""Spelling variants: words that differ by one edit, grouped under their frequent form.

1. Words are counted per slice of texts and then together.
2. Near words by search schemes on bidirectional FM-indexes.  One edit leaves one half of a word as it is, so each word is
   looked for twice: its first half is matched exactly and extended to the right over the second with one error, and its
   second half exactly and extended to the left over the first.  The index holds the vocabulary joined by delimiters, once
   forwards and once backwards; an interval of suffix ranks is kept in step in both while the exact half is matched, and
   then goes on in the other direction.  All words of a block take each step together.
3. A word meets only words with the same exact half: words are dealt by their halves (two lengths each way, for words one
   code point longer or shorter) and searched in the block of these, so no task needs the whole vocabulary.  A half that
   more than ``group`` words share is split into blocks of its own, each of which gets all queries of that half.
4. A pair that both schemes find is the first scheme's, so pairs are counted without being brought together.
5. The form of a word is its most frequent near word, if that is at least ``ratio`` times as frequent; roots follow by
   doubling the steps along forms, which grow in frequency and so never turn back.

Edge cases: NULL and empty texts have no words; a NULL id counts as the empty text; repeated rows count again; of equally
frequent near words the least in code-point order is the form; an empty table or vocabulary gives an empty result; other
columns are ignored.  A very long text is read by a running match, a very long word is a word like any other.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship
from .suffix import suffix_order
from .textarrays import parts, texts

SHORTEST, RAREST, RATIO = 5, 3, 2
#: One in so many (document, word) pairs loses a code point.
DAMAGE = 97
#: Code points that are indexed together, if no single half has more.
BLOCK = 1 << 19
#: Most words of one half in a block.
GROUP = 50_000
#: Words searched together.
BATCH = 20_000
DELIMITER = 1


def counted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shortest: int = SHORTEST,
            damage: int = DAMAGE) -> DataFrame:
    """(word, n): letter runs, A-Z lower-cased, that have ``shortest`` code points or more after one in ``damage``
    (document, run) pairs has lost a code point, with their occurrences."""
    ship(docs.sparkSession)
    letters = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")  # shorter runs can't be words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            total: Counter = Counter()
            for key, data in zip(batch.column(0).to_pylist(), texts(batch, 1)):
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                s = data.tobytes().lower().decode()  # bytes: lower-cases A-Z only
                found = letters.findall(s) if len(s) < 1 << 22 else (m.group() for m in letters.finditer(s))
                for w, n in Counter(found).items():
                    h = zlib.crc32(w.encode(), seed)
                    if h % damage == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < shortest:
                            continue
                    total[w] += n
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                                  pa.array(list(total.values()), pa.int64())],
                                                 names=["word", "n"])

    rows = docs.select(F.col(doc_id).cast("string").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class FmIndex:
    """Burrows-Wheeler transform of a text of small numbers that ends in its only 0, with rank counts."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.places = suffix_order(text.astype(np.int64))
        self.n, self.symbols = len(text), symbols
        self.step = 64
        while self.step < symbols:  # wide alphabets: fewer samples
            self.step *= 2
        blocks = self.n // self.step + 1
        self.bwt = np.full(blocks * self.step, symbols, dtype=np.uint8 if symbols < 256 else np.int32)
        self.bwt[:self.n] = text[self.places - 1]
        self.less_than = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))[:-1]])
        cell = (np.arange(self.n) // self.step + 1) * symbols + self.bwt[:self.n]
        counts = np.bincount(cell, minlength=(blocks + 1) * symbols).reshape(blocks + 1, symbols)
        self.counts = np.cumsum(counts, axis=0, dtype=np.int32)
        self.below = np.zeros_like(self.counts)
        np.cumsum(self.counts[:, :-1], axis=1, out=self.below[:, 1:])
        self.tail = np.arange(self.step)

    def _counted(self, sampled: np.ndarray, c: np.ndarray, i: np.ndarray, lower: bool) -> np.ndarray:
        out = np.empty(len(i), dtype=np.int64)
        rows = self.bwt.reshape(-1, self.step)
        for at in range(0, len(i), 1 << 15):
            number, upto = c[at:at + (1 << 15)], i[at:at + (1 << 15)]
            block = upto // self.step
            part = rows[block]
            hit = part < number[:, None] if lower else part == number[:, None]
            hit &= self.tail[None, :] < (upto % self.step)[:, None]
            out[at:at + len(upto)] = sampled[block, number] + hit.sum(axis=1)
        return out

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c in the first i of the transform."""
        return self._counted(self.counts, c, i, False)

    def smaller(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of numbers below c in the first i of the transform."""
        return self._counted(self.below, c, i, True)

    def extend(self, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.less_than[c] + self.rank(c, low), self.less_than[c] + self.rank(c, high)

    def extensions(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """(which interval, number, low, high) for each number that extends one of the intervals."""
        small = np.flatnonzero(high - low <= 64)
        size = (high - low)[small]
        which = np.repeat(small, size)
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[small], size)
        pair, many = np.unique(which * self.symbols + self.bwt[at], return_counts=True)
        which, c = pair // self.symbols, pair % self.symbols
        start = self.less_than[c] + self.rank(c, low[which])
        out = [(which, c, start, start + many)]
        large = np.flatnonzero(high - low > 64)
        for c in range(self.symbols) if len(large) else ():
            number = np.full(len(large), c)
            a, b = self.extend(number, low[large], high[large])
            out.append((large[b > a], number[b > a], a[b > a], b[b > a]))
        return tuple(np.concatenate(x) for x in zip(*out))


class Vocabulary:
    """Bidirectional index of different words, in code-point order."""

    def __init__(self, words: list[str]):
        sizes = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        self.alphabet, codes = np.unique(points, return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.codes = codes + DELIMITER + 1
        self.symbols = len(self.alphabet) + DELIMITER + 1
        self.sizes = sizes
        self.edges = np.concatenate([[0], np.cumsum(sizes + 1)])  # places of the delimiters
        text = np.full(int(self.edges[-1]) + 1, DELIMITER, dtype=np.int64)
        body = np.ones(len(text), dtype=bool)
        body[self.edges] = False
        text[body] = self.codes
        self.n = len(text)
        self.forward = FmIndex(np.append(text, 0), self.symbols)
        self.backward = FmIndex(np.append(text[::-1], 0), self.symbols)

    def near(self, queries: np.ndarray, from_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) places of the words that differ by one edit in the half that is not matched exactly: the second
        half of the query's code points with ``from_left``, else the first."""
        size = self.sizes[queries]
        half = size // 2
        if from_left:  # the first half leftwards, then the second rightwards
            one, two = self.forward, self.backward
            exact, other = half, size - half
            first = lambda q, j: self.codes[self.starts[queries[q]] + half[q] - 1 - j]
            then = lambda q, j: self.codes[self.starts[queries[q]] + half[q] + j]
        else:  # the second half rightwards, then the first leftwards
            one, two = self.backward, self.forward
            exact, other = size - half, half
            first = lambda q, j: self.codes[self.starts[queries[q]] + half[q] + j]
            then = lambda q, j: self.codes[self.starts[queries[q]] + half[q] - 1 - j]
        n = len(queries)
        low, high = np.zeros(n, np.int64), np.full(n, one.n, np.int64)
        low2 = low.copy()
        for j in range(int(exact.max()) + 1):
            q = np.flatnonzero(exact >= j)
            c = np.full(len(q), DELIMITER)
            inner = exact[q] > j
            c[inner] = first(q[inner], j)
            # both intervals in step: the other one loses what is preceded by smaller numbers
            low2[q] += one.smaller(c, high[q]) - one.smaller(c, low[q])
            low[q], high[q] = one.extend(c, low[q], high[q])
        exact_q, exact_low, exact_high = np.arange(n), low2, low2 + (high - low)
        found_q, found_at = [], []
        q1 = low1 = high1 = np.zeros(0, np.int64)  # states with their error behind them
        for j in range(int(other.max()) + 1):
            live = other[exact_q] >= j
            exact_q, exact_low, exact_high = exact_q[live], exact_low[live], exact_high[live]
            last = other[exact_q] == j
            want = np.full(len(exact_q), DELIMITER)
            want[~last] = then(exact_q[~last], j)
            which, c, a, b = two.extensions(exact_low, exact_high)
            letter = (c > DELIMITER) & (c != want[which])
            which, c, a, b = which[letter], c[letter], a[letter], b[letter]
            # a code point more: the state stays at j.  Before an equal one it would be counted again after it
            q1, low1, high1 = (np.concatenate(x) for x in ((q1, exact_q[which]), (low1, a), (high1, b)))
            # go on from j to j + 1 (to the delimiter after the last)
            end = other[q1] == j
            c1 = np.full(len(q1), DELIMITER)
            c1[~end] = then(q1[~end], j)
            low1, high1 = two.extend(c1, low1, high1)
            there = high1 > low1
            found_q.append(q1[there & end])
            found_at.append(low1[there & end])
            go = there & ~end
            q1, low1, high1 = q1[go], low1[go], high1[go]
            # another code point, or one less (of equal neighbours the last)
            change = ~last[which]
            less = np.flatnonzero(~last)
            following = np.full(len(less), DELIMITER)
            more = other[exact_q[less]] > j + 1
            following[more] = then(exact_q[less][more], j + 1)
            less = less[following != want[less]]
            q1 = np.concatenate([q1, exact_q[which[change]], exact_q[less]])
            low1 = np.concatenate([low1, a[change], exact_low[less]])
            high1 = np.concatenate([high1, b[change], exact_high[less]])
            exact_low, exact_high = two.extend(want, exact_low, exact_high)
            stays = (exact_high > exact_low) & ~last
            exact_q, exact_low, exact_high = exact_q[stays], exact_low[stays], exact_high[stays]
        found, at = np.concatenate(found_q), two.places[np.concatenate(found_at)]
        if from_left:  # places in the reversed text: of the delimiter after the word
            return found, np.searchsorted(self.edges, self.n - 1 - at) - 1
        return found, np.searchsorted(self.edges, at)


BEST = "word string, n_near long, form_n long, form string"


#: (word, whether its first half is matched exactly) -> number of blocks of that half, and which of them are here.
Asked = dict[tuple[str, bool], tuple[int, set[int]]]


def sub_of(word: str, subs: int) -> int:
    return zlib.crc32(word.encode()) % subs


def search_block(words: list[str], counts: np.ndarray, asked: Asked) -> list[tuple]:
    """BEST rows of the queries, all of whose words are in ``words`` (sorted, different)."""
    index = Vocabulary(words)
    place = {w: i for i, w in enumerate(words)}
    out = []
    for left in (True, False):
        mine = [(place[w], *v) for (w, l), v in asked.items() if l == left]
        for at in range(0, len(mine), BATCH):
            batch = mine[at:at + BATCH]
            who = np.array([b[0] for b in batch], dtype=np.int64)
            q, w = index.near(who, left)
            half = [len(words[b[0]]) // 2 for b in batch]
            mask = np.ones(len(q), dtype=bool)
            for x, (i, k) in enumerate(zip(q.tolist(), w.tolist())):
                word, subs, here = words[batch[i][0]], *batch[i][1:]
                if not left and word[:half[i]] == words[k][:half[i]]:
                    mask[x] = False  # the other scheme's
                elif subs > 1 and sub_of(words[k], subs) not in here:
                    mask[x] = False  # another block's
            q, w = q[mask], w[mask]
            if not len(q):
                continue
            order = np.lexsort((w, -counts[w], q))
            q, w = q[order], w[order]
            first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
            many = np.diff(np.append(first, len(q)))
            out += [(words[who[q[f]]], int(m), int(counts[w[f]]), words[w[f]]) for f, m in zip(first, many)]
    return out


def dealt(vocabulary: DataFrame, shortest: int, group: int) -> DataFrame:
    """(half, sub, subs, word, n, asks): each word under the halves by which others may look for it (asks NULL), and under its
    own two halves with asks 'l' or 'r'."""
    size = F.char_length("word")
    left = lambda k: F.concat(F.lit("l"), F.substring("word", 1, k))
    right = lambda k: F.concat(F.lit("r"), F.substring(F.col("word"), size - k + 1, k))
    lengths = [size + d for d in (-1, 0, 1)]
    ok = lambda m, x: F.when(m >= shortest, x)  # noqa: E731  no word asks for a shorter one
    to_int = lambda c: F.floor(c).cast("int")
    halves = F.array_distinct(F.array_compact(F.array(*[ok(m, left(to_int(m / 2))) for m in lengths],
                                                      *[ok(m, right(to_int((m + 1) / 2))) for m in lengths])))
    index = vocabulary.select("word", "n", F.explode(halves).alias("half"), F.lit(None).cast("string").alias("asks"))
    own = F.array(F.struct(left(to_int(size / 2)).alias("half"), F.lit("l").alias("asks")),
                  F.struct(right(to_int((size + 1) / 2)).alias("half"), F.lit("r").alias("asks")))
    asks = vocabulary.select("word", "n", F.inline(own))
    large = (index.groupBy("half").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > group)
             .select("half", F.ceil(F.col("k") / group).cast("int").alias("subs")))
    subs = F.coalesce("subs", F.lit(1))
    sub = F.pmod(F.crc32(F.col("word").cast("binary")), subs).cast("int")  # as sub_of
    spread = index.join(large, "half", "left").select("half", sub.alias("sub"), subs.alias("subs"), "word", "n", "asks")
    every = asks.join(large, "half", "left").select("half", F.explode(F.sequence(F.lit(0), subs - 1)).alias("sub"),
                                                    subs.alias("subs"), "word", "n", "asks")
    return spread.unionByName(every)


def near_words(vocabulary: DataFrame, shortest: int = SHORTEST, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """BEST per word of (word, n) that has a near word: their number, the most frequent one and its n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        asked: Asked = {}
        total, last = 0, None

        def searched() -> Iterator[pa.RecordBatch]:
            words = sorted(known)
            rows = search_block(words, np.array([known[w] for w in words], dtype=np.int64), asked) if asked else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "form_n", "form"])

        for batch in batches:
            for half, sub, subs, word, n, asks in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if total >= block and (half, sub) != last:
                    yield from searched()
                    known, asked, total = {}, {}, 0
                last = (half, sub)
                if word not in known:
                    known[word] = n
                    total += len(word) + 1
                if asks:
                    asked.setdefault((word, asks == "l"), (subs, set()))[1].add(sub)
        if known:
            yield from searched()

    rows = dealt(vocabulary, shortest, group).repartition("half", "sub").sortWithinPartitions("half", "sub")
    found = rows.mapInArrow(run, BEST)
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.m")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows: the last word on the way along forms."""
    steps = materialize(forms.select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        ahead = steps.select(F.col("word").alias("w"), F.col("root").alias("next"))
        steps = materialize(steps.join(ahead, F.col("root") == F.col("w"), "left")
                            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")),
                            "spelling-steps")
        if steps.filter("on").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def spelling_variants(vocabulary: DataFrame, ratio: int = RATIO, shortest: int = SHORTEST, block: int = BLOCK,
                      group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n of a (word, n) vocabulary of different words."""
    words = materialize(vocabulary.select("word", "n"), "spelling-words")
    near = near_words(words, shortest, block, group)
    is_form = F.col("form_n") >= ratio * F.col("n")
    full = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("form")).alias("form"),
        F.when(is_form, F.col("form_n")).alias("form_n")), "spelling-forms")
    ends = roots(full.filter("form is not null").select("word", "form"))
    return full.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
