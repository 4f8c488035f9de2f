"""Toxicity by nearest labelled examples under TF-IDF cosine.

Terms are lower-cased words and beginnings of words, with terms for beginnings that recur.  :func:`fit` takes all terms
of the labelled examples, counts their document frequencies over the whole corpus and builds an inverted index of all
examples: posting lists for the terms of few examples, and for the common terms rows in blocks, each block with the
largest weight of every common term (block maxima).  The rare terms' share of a cosine is summed from the postings; with
a block's maxima it bounds the cosine of any example in it, and a block is looked at unless its bound lies below the
least cosine of the k examples with the best sums, so the neighbours are exact.  Terms that clearly mark toxic examples
weigh ``boost`` times their TF-IDF; all other terms weigh as they are, so an exact copy of an example has cosine 1.  The
neighbours' labels vote with weight 1 / (distance + softening); an isotonic fit on the examples' own leave-one-out votes
turns votes into calibrated scores.

The examples are a bounded sample of the labelled rows: at most ``per_label`` of each label, chosen by the MD5 of the id;
the index of all their terms is broadcast.  Document frequencies cover all documents.

Edge cases: a NULL or empty text, and one with no term of any example, gets the share of toxic rows among labelled
texts without a term; equal cosines go to the example with the smaller id; a document labelled twice counts as toxic if
one label says so; NULL labels and NULL ids are not learned from; with no labelled rows every score is 0; repeated rows
are scored one by one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from hashlib import blake2b
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, ship, unit_hash, vector_udf

TOKEN = re.compile(r"[^\W_]+")
BLOCK = 64
#: Terms of at least this share of the examples are common, but no more terms than MOST_COMMON.
COMMON_SHARE, MOST_COMMON = 0.02, 512
#: Queries that are looked at together.
QUERIES_AT_ONCE = 64
#: Postings of a query that are summed together: a long text has a million, with some fifty bytes each.
SUMS_AT_ONCE = 1 << 17
#: Texts whose terms are taken together, and their letters.
TEXTS_AT_ONCE, LETTERS_AT_ONCE = 256, 1 << 20
#: Words whose terms a worker remembers from one piece to the next.
MOST_SEEN = 200_000
#: Examples that are weighed or put in order together on the driver.
ROWS_AT_ONCE = 256
#: Letters of the beginnings of words that are terms besides the words themselves.
STARTS = (4, 5, 6)


def terms_of(text: str | None) -> dict[str, int]:
    """Term frequencies: words, and beginnings of words marked by a star; a beginning that recurs is also a term of its
    own at two and three times ("x*2", "x*3") and where it makes up a hundredth of the words ("x*%")."""
    words = TOKEN.findall((text or "").lower())
    out: Counter[str] = Counter(words)
    starts: Counter[str] = Counter()
    for word, n in out.items():
        for k in STARTS:
            if len(word) > k:
                starts[word[:k] + "*"] += n
    for start, n in starts.items():
        out[start] = n
        for level in (2, 3):
            if n >= level:
                out[f"{start}{level}"] = n
        if n >= 2 and 100 * n >= len(words):
            out[start + "%"] = n
    return out


@dataclass(frozen=True)
class Rows:
    """Sparse rows: row i has the terms term[start[i]:start[i + 1]] with their weights."""

    start: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> Rows:
        at, lengths = spread(self.start, rows)
        return Rows(np.append(0, np.cumsum(lengths)), self.term[at], self.weight[at], self.width)


def spread(start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of ``rows``, one row after the other, and the rows' lengths."""
    lengths = start[rows + 1] - start[rows]
    before = np.cumsum(lengths) - lengths
    places = np.repeat(start[rows] - before, lengths)
    places += np.arange(len(places))
    return places, lengths


def sparse(vectors: np.ndarray | Rows) -> Rows:
    if isinstance(vectors, Rows):
        return vectors
    row, term = np.nonzero(vectors)
    return Rows(np.searchsorted(row, np.arange(len(vectors) + 1)), term.astype(np.int32), vectors[row, term],
                vectors.shape[1])


@dataclass(frozen=True)
class Index:
    """All examples: posting lists of the rare terms, and blocks of BLOCK examples for the common ones."""

    ids: np.ndarray
    labels: np.ndarray
    start: np.ndarray  # per term its first posting; common terms have none
    at: np.ndarray  # postings: example numbers and weights
    weight: np.ndarray
    column: np.ndarray  # per term its column among the common ones, or -1
    common: np.ndarray  # examples x common terms
    maxima: np.ndarray  # blocks x common terms

    def __reduce__(self):
        """The zeros of the common terms stay here: every executor keeps the bytes of a broadcast on its disk."""
        held = np.flatnonzero(self.common)
        short = held.astype(np.min_scalar_type(self.common.size))
        return unpacked, (self.ids, self.labels, self.start, self.at, self.weight, self.column, self.common.shape, short,
                          self.common.ravel()[held], self.maxima)


def unpacked(ids: np.ndarray, labels: np.ndarray, start: np.ndarray, at: np.ndarray, weight: np.ndarray, column: np.ndarray,
             shape: tuple[int, int], held: np.ndarray, value: np.ndarray, maxima: np.ndarray) -> Index:
    common = np.zeros(shape)
    common.ravel()[held] = value
    return Index(ids, labels, start, at, weight, column, common, maxima)


def build_index(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray | Rows) -> Index:
    rows = sparse(vectors)
    n = len(rows)
    held = np.bincount(rows.term, minlength=rows.width)
    often = np.argsort(-held, kind="stable")[:MOST_COMMON]
    often = np.sort(often[held[often] >= max(1, COMMON_SHARE * n)])
    column = np.full(rows.width, -1, dtype=np.int32)
    column[often] = np.arange(len(often))
    common = np.zeros((n, len(often)))
    of = np.repeat(np.arange(n, dtype=np.int32), np.diff(rows.start))
    is_common = (column >= 0)[rows.term]
    common[of[is_common], column[rows.term[is_common]]] = rows.weight[is_common]
    # examples with the same strongest common terms lie together, which keeps the maxima of a block tight
    strong = np.empty((n, min(3, len(often))), dtype=np.int64)
    for i in range(0, n, ROWS_AT_ONCE):
        strong[i:i + ROWS_AT_ONCE] = np.argsort(-common[i:i + ROWS_AT_ONCE], axis=1, kind="stable")[:, :3]
    order = np.lexsort((ids, *strong.T[::-1])) if n else np.zeros(0, int)
    place = np.empty(n, dtype=np.int32)
    place[order] = np.arange(n)
    rare = ~is_common
    at, term = place[of[rare]], rows.term[rare]
    del of, is_common
    by_term = np.lexsort((at, term))
    at, weight = at[by_term].astype(np.min_scalar_type(n)), rows.weight[rare][by_term]
    starts = np.append(0, np.cumsum(np.bincount(term, minlength=rows.width)))
    del term, rare, by_term
    common = common[order]
    maxima = [common[i:i + BLOCK].max(axis=0) for i in range(0, n, BLOCK)]
    return Index(ids[order], labels[order], starts, at, weight, column, common, np.array(maxima).reshape(len(maxima), len(often)))


def nearest(index: Index, queries: np.ndarray | Rows, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(cosines, example numbers) of the k nearest examples per query, best first; -1 where there are fewer."""
    rows = sparse(queries)
    top = np.full((len(rows), k), -1.0)
    who = np.full((len(rows), k), -1, dtype=np.int64)
    if len(index.ids):
        for i in range(0, len(rows), QUERIES_AT_ONCE):
            some = np.arange(i, min(i + QUERIES_AT_ONCE, len(rows)))
            top[some], who[some] = nearest_of(index, rows.take(some), k)
    return top, who


def nearest_of(index: Index, rows: Rows, k: int) -> tuple[np.ndarray, np.ndarray]:
    n, m = len(rows), len(index.ids)
    slack = 1e-9  # rounding of the bound
    of = np.repeat(np.arange(n), np.diff(rows.start))
    cosine = np.empty((n, m))
    for i in range(n):
        own = slice(rows.start[i], rows.start[i + 1])
        term, weight = rows.term[own], rows.weight[own]
        held = np.flatnonzero(index.start[term + 1] > index.start[term])
        term, weight = term[held], weight[held]
        piece = np.cumsum(index.start[term + 1] - index.start[term]) // SUMS_AT_ONCE
        cuts = np.flatnonzero(np.diff(piece, append=-1)) + 1
        cosine[i] = 0.0
        for a, b in zip(np.append(0, cuts[:-1]), cuts):
            at, lengths = spread(index.start, term[a:b])
            share = index.weight.take(at, mode="clip")  # all places are there, and clip is the faster way
            share *= np.repeat(weight[a:b], lengths)
            cosine[i] += np.bincount(index.at.take(at, mode="clip"), share, m)
    column = index.column[rows.term]
    often = np.zeros((n, index.common.shape[1]))
    often[of[column >= 0], column[column >= 0]] = rows.weight[column >= 0]
    # the whole cosines of the k best sums: the k-th best is no less than the least of them
    first = np.argpartition(cosine, max(0, m - k), axis=1)[:, max(0, m - k):]
    least = np.array([(cosine[i, f] + index.common[f] @ often[i]).min() for i, f in enumerate(first)])
    bound = often @ index.maxima.T + np.maximum.reduceat(cosine, np.arange(0, m, BLOCK), axis=1) + slack
    for b in range(bound.shape[1]):
        if len(look := np.flatnonzero(bound[:, b] >= least)):
            part = slice(b * BLOCK, (b + 1) * BLOCK)
            cosine[look, part] += often[look] @ index.common[part].T
    top = np.full((n, k), -1.0)
    who = np.full((n, k), -1, dtype=np.int64)
    for i in range(n):
        found = np.flatnonzero(cosine[i] >= max(least[i] - slack, slack))
        c = np.round(cosine[i, found], 12)
        best = np.lexsort((index.ids[found], -c))[:k]
        top[i, :len(best)], who[i, :len(best)] = c[best], found[best]
    return top, who


@dataclass(frozen=True)
class Model:
    vocabulary: dict[str, int]
    terms: Broadcast | None  # the vocabulary as Terms, for the workers
    idf: np.ndarray  # times the boost of the terms that mark toxic examples
    index: Index
    label_weight: tuple[float, float]  # labelled rows per example, of label 0 and 1
    k: int
    softening: float
    no_term: float  # score of a text without any term of an example
    curve: tuple[np.ndarray, np.ndarray]  # votes and calibrated scores


def matrix(vectors: list[tuple[list[int], list[int]]], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows."""
    out = np.zeros((len(vectors), len(idf)))
    for row, (terms, counts) in zip(out, vectors):
        if len(terms):
            t = np.asarray(terms)
            w = (1.0 + np.log(np.asarray(counts, dtype=float))) * idf[t]
            row[t] = w / np.sqrt((w * w).sum())
    return out


def unit_rows(terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray) -> Rows:
    """The same as sparse rows."""
    start = np.append(0, np.cumsum([len(t) for t in terms], dtype=np.int64))
    if not start[-1]:
        return Rows(start, np.zeros(0, np.int32), np.zeros(0), len(idf))
    return weighed(start, np.concatenate(terms).astype(np.int32, copy=False), np.concatenate(counts), idf)


def weighed(start: np.ndarray, term: np.ndarray, n: np.ndarray, idf: np.ndarray) -> Rows:
    """Unit rows of the terms term[start[i]:start[i + 1]], each n times in its text."""
    w, lengths = n.astype(float), np.diff(start)
    for i in range(0, len(lengths), ROWS_AT_ONCE):  # in place: all entries of all examples are on the driver at once
        some, rows = slice(start[i], start[min(i + ROWS_AT_ONCE, len(lengths))]), lengths[i:i + ROWS_AT_ONCE]
        part = (1.0 + np.log(w[some])) * idf[term[some]]
        of = np.repeat(np.arange(len(rows)), rows)
        w[some] = part / np.sqrt(np.bincount(of, part * part, len(rows)))[of]
    return Rows(start, term, w, len(idf))


def votes(model: Model, top: np.ndarray, who: np.ndarray) -> np.ndarray:
    w = np.where(who >= 0, 1.0 / (1.0 - np.minimum(top, 1.0) + model.softening), 0.0)
    labels = model.index.labels[np.maximum(who, 0)] if len(model.index.labels) else np.zeros_like(who)
    w = w * np.where(labels == 1, model.label_weight[1], model.label_weight[0])
    total = w.sum(axis=1)
    return np.where(total > 0, (w * labels).sum(axis=1) / np.maximum(total, 1e-300), np.nan)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the rising step function nearest to y over x."""
    places, at = np.unique(x, return_inverse=True)
    weight = np.bincount(at, w)
    pools: list[list[float]] = []  # first x, last x, mean, weight
    for xi, yi, wi in zip(places, np.bincount(at, w * y) / weight, weight):
        pools.append([xi, xi, yi, wi])
        while len(pools) > 1 and pools[-2][2] > pools[-1][2]:
            a, b = pools[-2], pools.pop()
            pools[-1] = [a[0], b[1], (a[2] * a[3] + b[2] * b[3]) / (a[3] + b[3]), a[3] + b[3]]
    xs = [v for p in pools for v in (p[0], p[1])]
    ys = [p[2] for p in pools for _ in range(2)]
    return np.array(xs), np.array(ys)


def labelled_examples(labels: DataFrame, doc_id: str, label: str, per_label: int, seed: str) -> tuple[DataFrame, dict]:
    """(doc_id, label) of the bounded sample, and the number of labelled documents by label."""
    rows = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
            .filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for side in (0, 1):
        part = rows.filter(F.col("label") == side).orderBy(unit_hash(seed, F.col("doc_id")), "doc_id").limit(per_label)
        picked = part if picked is None else picked.unionAll(part)
    spark = labels.sparkSession
    local = [(r["doc_id"], r["label"]) for r in picked.collect()]  # at most 2 * per_label pairs
    return spark.createDataFrame(local, "doc_id long, label int"), counts


def term_counts(texts: DataFrame) -> tuple[pa.Table, dict[int, int]]:
    """(term, documents a of label 1, b of label 0) of all terms of (label, text) rows, by term, and the number of
    documents by label.  Copies count once; each task counts for itself before the counts are added up."""
    texts = texts.select("label", "text").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"]):
                seen[label].update(terms_of(text).keys())
        names = list(seen[0] | seen[1])
        yield pd.DataFrame({"term": names, "a": [seen[1][t] for t in names], "b": [seen[0][t] for t in names]})

    ship(texts.sparkSession)
    totals = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_term = (texts.mapInPandas(run, "term string, a long, b long").groupBy("term")
               .agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    return by_term.toArrow().sort_by("term"), totals  # the terms of at most 2 * per_label texts


def marking(counts: pa.Table, totals: dict[int, int], max_terms: int, min_z: float, min_ratio: float,
            min_docs: int) -> np.ndarray:
    """Numbers of the terms whose share of documents is larger at label 1 than at label 0, by ``min_z`` standard errors
    and ``min_ratio`` times at least (a slight difference is no evidence, however many rows prove it); the clearest
    first.  They get more weight than others."""
    if len(totals) < 2:
        return np.zeros(0, dtype=np.int64)
    a, b = counts["a"].to_numpy().astype(float), counts["b"].to_numpy().astype(float)
    pa_, pb = a / totals[1], b / totals[0]
    z = (pa_ - pb) / np.sqrt((pa_ * (1 - pa_) + 0.5 / totals[1]) / totals[1]
                             + (pb * (1 - pb) + 0.5 / totals[0]) / totals[0])
    ratio = ((a + 0.5) / totals[1]) / ((b + 0.5) / totals[0])
    found = np.flatnonzero((a + b >= min_docs) & (z >= min_z) & (ratio >= min_ratio))
    return found[np.argsort(-z[found], kind="stable")][:max_terms]


class Terms:
    """The vocabulary as the workers hold it: numbers of the words and of the beginnings of words, and by the number of a
    beginning those of its levels ("2", "3", "%"), which need no names there."""

    def __init__(self, vocabulary: dict[str, int]):
        self.width = max(1, len(vocabulary))
        self.words = {t: i for t, i in vocabulary.items() if "*" not in t}
        self.starts = {t[:-1]: i for t, i in vocabulary.items() if t[-1] == "*"}
        levels: dict[int, list[int]] = {}
        for name, i in vocabulary.items():
            if "*" in name[:-1]:
                levels.setdefault(vocabulary[name[:-1]], [-1, -1, -1])["23%".index(name[-1])] = i
        self.levels = np.array([(i, *n) for i, n in levels.items()], dtype=np.int32).reshape(-1, 4)


class Seen(dict):
    """word -> its place among the words seen; takes up the new ones."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.new.append(word)
        return place


class Reader:
    """Takes the terms from texts; remembers the numbers of a bounded number of words and of their beginnings."""

    def __init__(self, terms: Terms):
        self.terms = terms
        self.seen = Seen()
        self.numbers = np.zeros((0, 1 + len(STARTS)), dtype=np.int32)  # by place, -1: no term
        self.levels = np.full((terms.width, 3), -1, dtype=np.int32)  # by number of a beginning
        self.levels[terms.levels[:, 0]] = terms.levels[:, 1:]

    def look_up(self) -> None:
        """The numbers of the new words and of their beginnings."""
        new, words, starts = self.seen.new, self.terms.words, self.terms.starts
        found = [[words.get(w, -1) for w in new]]
        found += [[starts.get(w[:k], -1) if len(w) > k else -1 for w in new] for k in STARTS]
        self.numbers = np.concatenate([self.numbers, np.array(found, dtype=np.int32).T])
        self.seen.new = []

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row starts, terms and their counts, as :func:`terms_of`; a row's terms rise."""
        if len(self.seen) > MOST_SEEN:
            self.seen, self.numbers = Seen(), self.numbers[:0]
        found = [TOKEN.findall((t or "").lower()) for t in texts]
        words = np.array([len(f) for f in found], dtype=np.int64)
        at = np.fromiter(map(self.seen.__getitem__, chain.from_iterable(found)), np.int32, int(words.sum()))
        del found
        self.look_up()
        term = self.numbers[at]
        width = self.terms.width
        key = (np.repeat(np.arange(len(texts)) * width, words)[:, None] + term)[term >= 0]
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.diff(first, append=len(key))
        key = key[first]
        often = np.flatnonzero(n >= 2)
        doc, term = np.divmod(key[often], width)
        times, level = n[often], self.levels[term]
        told = (level >= 0) & np.stack([times >= 2, times >= 3, 100 * times >= words[doc]], 1)
        key = np.concatenate([key, ((doc * width)[:, None] + level)[told]])
        n = np.concatenate([n, np.broadcast_to(times[:, None], told.shape)[told]])
        order = np.argsort(key, kind="stable")
        doc, term = np.divmod(key[order], width)
        return np.searchsorted(doc, np.arange(len(texts) + 1)), term.astype(np.int32), n[order].astype(np.int32)

    def pieces(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """:meth:`read` of a bounded number of texts and letters at a time, but for a single text beyond them."""
        i = letters = 0
        for j, t in enumerate(texts):
            letters += len(t or "")
            if j - i == TEXTS_AT_ONCE or (j > i and letters > LETTERS_AT_ONCE):
                yield self.read(texts[i:j])
                i, letters = j, len(t or "")
        if i < len(texts):
            yield self.read(texts[i:])


def broadcast(value: object) -> Broadcast:
    """``value`` for the workers: a worker loads it once, not at every task and for every function that needs it."""
    spark = SparkSession.active()
    ship(spark)
    return spark.sparkContext.broadcast(value)


def vector_column(vocabulary: dict[str, int] | Broadcast, text: Column) -> Column:
    """struct(terms array<int>, counts array<int>) of the terms of the vocabulary that a text has, as :func:`terms_of`."""
    terms = vocabulary if isinstance(vocabulary, Broadcast) else broadcast(Terms(vocabulary))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(terms.value)
        for batch in batches:
            out = []
            for start, term, n in reader.pieces(batch.tolist()):
                out += zip(np.split(term, start[1:-1]), np.split(n, start[1:-1]))
            yield pd.DataFrame(out, columns=["terms", "counts"])

    return vector_udf(run, "terms array<int>, counts array<int>")(text)


def frequencies(texts: DataFrame, terms: Broadcast, width: int) -> tuple[np.ndarray, int]:
    """Per term the number of (text) rows that have it, and the number of rows; each task counts for itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms.value)
        seen, rows = np.zeros(width, dtype=np.int64), 0
        for batch in batches:
            for _, term, _ in reader.pieces(batch.column(0).to_pylist()):
                seen += np.bincount(term, minlength=width)
            rows += batch.num_rows
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(seen[held], rows))],
                                         names=["t", "n"])

    got = texts.mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(width + 1)
    out[got["t"].to_numpy()] = got["n"].to_numpy()  # -1 is the last
    return out[:-1], int(out[-1])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
        per_label: int = 4000, max_terms: int = 1024, min_z: float = 5.0, min_ratio: float = 3.0, min_docs: int = 5,
        k: int = 15, softening: float = 0.05, seed: str = "toxic-1", boost: float = 10.0) -> tuple[Model, DataFrame]:
    """``labels`` are the rows to learn from; ``docs`` all documents, for their texts and document frequencies.

    Returns the model, and (doc_id, text, v) with every document's terms, which reads the texts when it is evaluated:
    the terms of all texts take more room than the texts."""
    examples, counts = labelled_examples(labels, doc_id, label, per_label, seed)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    labelled = materialize(rows.join(F.broadcast(examples), "doc_id").distinct(), "toxicity-examples")
    known, totals = term_counts(labelled)
    vocabulary = {t: i for i, t in enumerate(known["term"].to_pylist())}
    terms = broadcast(Terms(vocabulary))
    vectors = rows.select("doc_id", "text", vector_column(terms, F.col("text")).alias("v"))
    frequency, n_docs = frequencies(rows.select("text"), terms, len(vocabulary))
    idf = np.log((n_docs + 1.0) / (frequency + 1.0)) + 1.0
    idf[marking(known, totals, max_terms, min_z, min_ratio, min_docs)] *= boost
    got = (labelled.select("doc_id", "label", vector_column(terms, F.col("text")).alias("v"))
           .select("doc_id", "label", "v.terms", "v.counts").toArrow().sort_by("doc_id"))
    t = c = None
    held, of = {}, [got[c].to_pylist() for c in ("doc_id", "label")]
    for i, t, c in zip(range(len(got)), got["terms"], got["counts"]):  # texts with the same terms once
        t, c = (x.values.to_numpy(zero_copy_only=False) for x in (t, c))
        held.setdefault((of[0][i], of[1][i], blake2b(t.tobytes() + c.tobytes()).digest()), (t, c))
    ids, y = np.array([g[0] for g in held], dtype=np.int64), np.array([g[1] for g in held], dtype=np.int64)
    x = unit_rows([v[0] for v in held.values()], [v[1] for v in held.values()], idf)
    del got, held, known, t, c  # as large as the index
    pa.default_memory_pool().release_unused()
    some = np.flatnonzero(np.diff(x.start) > 0)
    weight = tuple(counts.get(s, 0) / max(1, int((y == s).sum())) for s in (0, 1))
    w = np.where(y == 1, weight[1], weight[0])
    none = np.diff(x.start) == 0
    no_term = float((w * y)[none].sum() / w[none].sum()) if none.any() and w[none].sum() > 0 else 0.0
    own, known_x = ids[some], x if len(some) == len(x) else x.take(some)
    del x
    index = build_index(own, y[some], known_x)
    model = Model(vocabulary, terms, idf, index, weight, k, softening, no_term, (np.zeros(0), np.zeros(0)))
    # leave one out: an example's nearest neighbours without itself
    raw = np.full(len(own), np.nan)
    for i in range(0, len(own), 512):
        part = np.arange(i, min(i + 512, len(own)))
        top, who = nearest(index, known_x.take(part), k + 1)
        self_ = (who >= 0) & (index.ids[np.maximum(who, 0)] == own[part, None])
        raw[part] = votes(model, np.where(self_, -1.0, top), np.where(self_, -1, who))
    told = ~np.isnan(raw)
    if told.any():
        model = replace(model, curve=isotonic(raw[told], y[some][told].astype(float), w[some][told]))
    return model, vectors


RESULT = "score double, n_terms int, neighbours array<long>, cosines array<double>, neighbour_labels array<int>"


def judged(model: Model, rows: Rows) -> pd.DataFrame:
    """The columns of RESULT for unit rows."""
    value = np.full(len(rows), model.no_term)
    evidence: list[tuple] = [((), (), ())] * len(rows)
    n_terms = np.diff(rows.start)
    some = np.flatnonzero(n_terms)
    top, who = nearest(model.index, rows.take(some), model.k)
    raw = votes(model, top, who)
    if len(model.curve[0]):
        value[some] = np.where(np.isnan(raw), model.no_term, np.interp(raw, *model.curve))
    for i, a, b in zip(some, top, who):
        b = b[b >= 0]
        evidence[i] = (model.index.ids[b].tolist(), a[:len(b)].tolist(), model.index.labels[b].tolist())
    return pd.DataFrame({"score": value, "n_terms": n_terms, "neighbours": [list(e[0]) for e in evidence],
                         "cosines": [list(e[1]) for e in evidence], "neighbour_labels": [list(e[2]) for e in evidence]})


def score(model: Model, v: Column) -> Column:
    """From :func:`vector_column` of the model's vocabulary: struct(score, n_terms, neighbours, cosines, neighbour_labels):
    the calibrated score and its evidence."""
    shared = broadcast(replace(model, vocabulary={}, terms=None))  # the terms come as numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for v in batches:
            terms, counts = v["terms"].tolist(), v["counts"].tolist()
            out = [judged(model, unit_rows(terms[i:i + 1024], counts[i:i + 1024], model.idf))
                   for i in range(0, max(1, len(v)), 1024)]
            yield pd.concat(out, ignore_index=True)

    return vector_udf(run, RESULT)(v)


def score_text(model: Model, text: Column) -> Column:
    """:func:`score` straight from the texts: one Python worker a task takes the terms and looks for the neighbours."""
    terms, shared = model.terms, broadcast(replace(model, vocabulary={}, terms=None))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader, model = Reader(terms.value), shared.value
        for batch in batches:
            out = [judged(model, weighed(*piece, model.idf)) for piece in reader.pieces(batch.tolist() or [None])]
            yield pd.concat(out, ignore_index=True).iloc[:len(batch)]

    return vector_udf(run, RESULT)(text)
