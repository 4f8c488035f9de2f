"""Quality classifier from weak labels: heuristic labellers, expectation-maximisation, hashed linear scorer.

Several labellers look at a text's statistics and vote good, bad or not at all.  Expectation-maximisation over the
counts of vote patterns - all documents, but one row per pattern - estimates the share of good documents and how each
labeller votes on either kind.  The posterior of its pattern is a document's soft label, on which a logistic scorer
over hashed shape features is trained; it scores any text by itself, also where no labeller votes.

The scorer is fitted on a bounded sample of at most ``sample`` documents, chosen by the MD5 of the id; the vote counts
cover all documents.

Edge cases: NULL, empty and wordless texts get score 0 (rejected); documents with a NULL id are counted and scored, but
not in the sample; repeated rows count as often as they appear and are scored alike; with no documents the scorer is
the plain vote of the labellers' prior (everything with a word is kept); other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise
from math import isnan, nan
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, unit_hash, vector_udf

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPES = str.maketrans({c: "x" for c in "abcdefghijklmnopqrstuvwxyz"} | {c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
                       | {c: "9" for c in "0123456789"})
RUNS = re.compile(r"(.)\1+", re.S)
#: Marks that end sentences, of all scripts; the wide ones need no space after them.
WIDE_STOPS = "\u3002\uff01\uff1f\uff0e\uff61"
STOPS = frozenset(".!?\u037e\u0589\u061d\u061e\u061f\u06d4\u0700\u0701\u0702\u07f9\u0964\u0965\u0df4\u0f0d\u0f0e"
                  "\u104a\u104b\u1362\u1367\u1368\u166e\u17d4\u17d5\u1803\u1809\u1944\u1945\u1b5a\u1b5b\u1c3b\u1c3c"
                  "\u1c7e\u1c7f\u203c\u203d\u2047\u2048\u2049\ua4ff\ua60e\ua60f\ua8ce\ua8cf\ua92f\ua9c8\ua9c9"
                  "\uaa5d\uaa5e\uaa5f\uabeb" + WIDE_STOPS)
#: Thai and Lao letters: these scripts have no mark that ends a sentence.
STOPLESS = re.compile("[\u0e00-\u0eff]")
DIM = 4096
GOOD, NONE, BAD = 0, 1, 2

#: The labellers.  Each has a statistic, the value from which it votes bad, and the value up to which it
#: votes good (None: it never does); with the last field set, low values are the bad ones.
LABELLERS: tuple[tuple[str, float, float | None, bool], ...] = (
    ("symbol_ratio", 0.25, None, False),
    ("upper_ratio", 0.5, None, False),
    ("exclaim_ratio", 0.25, None, False),
    ("repeat_ratio", 0.5, None, False),
    ("adjacent_ratio", 0.2, None, False),
    ("top_word_ratio", 0.3, None, False),
    ("pipe_ratio", 0.25, None, False),
    ("words_per_stop", 120.0, 40.0, False),
    ("lower_start_ratio", 0.3, None, True),
)


def statistics(words: list[str], text: str) -> dict[str, float]:
    """NaN where a statistic does not apply to the text's script: such a labeller does not vote."""
    n = len(words)
    count = Counter(words).items()
    windows = list(zip(words, words[1:], words[2:]))
    found = Counter(windows)
    held, upto = 0, 0
    if len(found) < len(windows):
        for i, w in enumerate(windows):
            if found[w] > 1:
                held += i + 3 - max(i, upto)
                upto = i + 3
    stops = sum(c for w, c in count if w[-1] in STOPS)
    if any(map(text.count, WIDE_STOPS)):
        stops += sum(c for w, c in count if w[-1] not in STOPS and any(x in w for x in WIDE_STOPS))
    uncased = stopless = 0
    if not text.isascii():
        uncased = sum(c for w, c in count if w[0].isalpha() and w[0].lower() == w[0].upper())
        stopless = sum(c for w, c in count if STOPLESS.match(w))
    # words without case are no evidence of either case; nor are the other words where they have fewer letters' words
    judged = n - uncased
    cased = sum(c for w, c in count if w[0].isalpha()) - uncased if uncased else judged
    lower = sum(c for w, c in count if w[0].islower()) / judged if judged >= 10 else 0.5
    return {
        "symbol_ratio": sum(map(text.count, "#*$%&|<>")) / n,
        "upper_ratio": sum(c for w, c in count if w.isupper()) / n,
        "exclaim_ratio": text.count("!") / n,
        "repeat_ratio": held / n,
        "adjacent_ratio": sum(map(eq, words, words[1:])) / n,
        "top_word_ratio": max(c for _, c in count) / n if n >= 20 else 0.0,
        "pipe_ratio": text.count("|") / n,
        "words_per_stop": nan if 2 * stopless > n else n / stops if stops else 2.0 * n,
        "lower_start_ratio": nan if uncased > max(cased, n / 3) else lower,
        "word_length": sum(map(len, words)) / n,
    }


def votes(stats: dict[str, float]) -> int:
    """The pattern of all votes, as a number in base three."""
    out = 0
    for name, bad, good, low in LABELLERS:
        v = stats[name]
        vote = BAD if (v <= bad if low else v >= bad) else NONE
        if vote == NONE and good is not None and (v >= good if low else v <= good):
            vote = GOOD
        out = 3 * out + vote
    return out


@lru_cache(maxsize=50_000)
def kind(c: str) -> str:
    if c.isascii() or c.islower() or c.isupper():
        return "x" if c.islower() else "X" if c.isupper() else c
    return "." if c in STOPS else "9" if c.isdecimal() else "x" if unicodedata.category(c)[0] in "LM" else c


@lru_cache(maxsize=50_000)
def shape(word: str) -> str:
    """Letters as X and x, digits as 9, runs shortened to one.  Letters without case, and the marks on them, count as x,
    and their scripts' sentence ends as a full stop."""
    kinds = "".join(map(kind, word.translate(SHAPES)))
    return RUNS.sub(r"\1", kinds)


@lru_cache(maxsize=50_000)
def bucket(key: str) -> int:
    return zlib.crc32(key.encode()) % DIM


def features(words: list[str], stats: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shares: word shapes, pairs of shapes, last characters, and each statistic's range."""
    n = len(words)
    shapes = list(map(shape, words))
    out: dict[int, float] = {}

    def add(key: str, value: float) -> None:
        k = bucket(key)
        out[k] = out.get(k, 0.0) + value

    for s, c in Counter(shapes).items():
        add("s " + s, c / n)
        add("e " + s[-1], c / n)
    for (a, b), c in Counter(pairwise(shapes)).items():
        add(f"p {a} {b}", c / n)
    for name, v in stats.items():
        if isnan(v):
            continue
        add(f"v {name}", min(v, 3.0))
        add(f"r {name} {np.searchsorted((0.01, 0.03, 0.1, 0.2, 0.3, 0.5, 0.8, 1.5, 3, 8, 20, 50, 150), v)}", 1.0)
    return np.array(list(out), dtype=np.int32), np.array(list(out.values()), dtype=np.float32)


@dataclass(frozen=True)
class LabelModel:
    """P(good), and P(vote | kind) as labellers x (bad, good) x (good, none, bad votes)."""

    prior: float
    vote: np.ndarray


def digits(patterns: np.ndarray) -> np.ndarray:
    out = np.empty((len(patterns), len(LABELLERS)), dtype=np.int64)
    rest = patterns.astype(np.int64)
    for j in reversed(range(len(LABELLERS))):
        rest, out[:, j] = np.divmod(rest, 3)
    return out


def posterior(model: LabelModel, patterns: np.ndarray) -> np.ndarray:
    """P(good) per pattern."""
    d = digits(patterns)
    logs = np.log(model.vote)
    total = np.stack([sum(logs[j, side, d[:, j]] for j in range(len(LABELLERS))) for side in (0, 1)])
    total += np.log([[1 - model.prior], [model.prior]])
    return 1.0 / (1.0 + np.exp(np.clip(total[0] - total[1], -700, 700)))


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9,
       max_false: float = 0.002) -> LabelModel:
    """Starts from "one bad vote makes it bad"; every table is smoothed by half a vote.

    Bad documents are of several kinds, each seen by few labellers; a labeller is taken to vote bad on at most
    ``max_false`` of the good ones, so that a kind which only one labeller sees does not pass for good.  A labeller that
    does not vote gives no evidence of a bad document."""
    d = digits(patterns)
    good = np.where((d == BAD).any(axis=1), 0.1, 0.95)
    total = counts.sum()
    model = LabelModel(0.5, np.full((len(LABELLERS), 2, 3), 1 / 3))
    last = -np.inf
    for _ in range(rounds):
        table = np.empty((len(LABELLERS), 2, 3))
        for side, p in ((0, 1 - good), (1, good)):
            for j in range(len(LABELLERS)):
                table[j, side] = np.bincount(d[:, j], counts * p, 3) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        # not to vote is never evidence of a bad document: where it would be, it is as likely on either side
        share = (counts * good).sum() / total
        none = table[:, :, NONE] @ [1 - share, share]
        level = table[:, 1, NONE] < table[:, 0, NONE]
        table[level] *= ((1 - none)[:, None] / (1 - table[:, :, NONE]))[level][:, :, None]
        table[level, :, NONE] = none[level, None]
        false = np.minimum(table[:, 1, BAD], max_false)
        freed = table[:, 1, BAD] - false  # goes to the good votes where not to vote is fixed, else to both
        both = table[:, 1, :BAD] * ((1 - false) / table[:, 1, :BAD].sum(axis=1))[:, None]
        table[:, 1, :BAD] = np.where(level[:, None], table[:, 1, :BAD] + freed[:, None] * [1, 0], both)
        table[:, 1, BAD] = false
        model = LabelModel(float(np.clip((counts * good).sum() / total, 1e-3, 1 - 1e-3)), table)
        good = posterior(model, patterns)
        logs = np.log(table)
        likely = [np.log(q) + sum(logs[j, s, d[:, j]] for j in range(len(LABELLERS)))
                  for s, q in ((0, 1 - model.prior), (1, model.prior))]
        now = float((counts * np.logaddexp(*likely)).sum() / total)
        if now - last < tolerance:
            break
        last = now
    return model


def train(rows: list[tuple[list[int], list[float]]], target: np.ndarray, rounds: int = 300, rate: float = 0.5,
          decay: float = 1e-4, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch gradient steps with per-weight scaling; ``times`` are the rows'
    weights."""
    w, b = np.zeros(DIM), 0.0
    if not rows:
        return w, 1.0
    at = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    idx = np.concatenate([np.asarray(r[0], dtype=np.int64) for r in rows])
    val = np.concatenate([np.asarray(r[1]) for r in rows])
    share = np.full(len(rows), 1 / len(rows)) if times is None else times / times.sum()
    seen, b_seen = np.full(DIM, 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(at, val * w[idx], len(rows)) + b
        err = share * (1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - target)
        g = np.bincount(idx, val * err[at], DIM) + decay * w
        gb = float(err.sum())
        seen += g * g
        b_seen += gb * gb
        w -= rate * g / np.sqrt(seen)
        b -= rate * gb / np.sqrt(b_seen)
    return w, b


@dataclass(frozen=True)
class Model:
    labels: LabelModel
    weights: np.ndarray
    bias: float
    threshold: float


MEASURED = "pattern long, at array<int>, value array<float>"


def measure(text: Column) -> Column:
    """struct of MEASURED per text: its vote pattern (-1 without a word) and its hashed features."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch:
                if w := WORD.findall(t or ""):
                    s = statistics(w, t)
                    out.append((votes(s), *features(w, s)))
                else:
                    out.append((-1, [], []))
            yield pd.DataFrame(out, columns=["pattern", "at", "value"])

    return vector_udf(run, MEASURED)(text)


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, m (struct of MEASURED) per document, kept in the shared folder: each text is read once."""
    return materialize(docs.select(F.col(doc_id).alias("doc_id"), measure(F.col(text)).alias("m")), "weak-measured")


def fit(rows: DataFrame, sample: int = 20_000, threshold: float = 0.5, seed: str = "weak-1") -> Model:
    """From :func:`measured` documents."""
    rows = rows.select("doc_id", "m.*").filter("pattern >= 0")
    counts = sorted(tuple(r) for r in rows.groupBy("pattern").count().collect())  # at most 3 ** labellers rows
    if not counts:
        return Model(LabelModel(0.5, np.full((len(LABELLERS), 2, 3), 1 / 3)), np.zeros(DIM), 1.0, threshold)
    model = em(np.array([c[0] for c in counts]), np.array([c[1] for c in counts], dtype=float))
    # a bounded sample of ids, then their features
    picked = (rows.select("doc_id").filter("doc_id is not null").distinct()
              .orderBy(unit_hash(seed, F.col("doc_id")), "doc_id").limit(sample))
    # equal rows of an id come as one with their number
    got = (rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "pattern", "at", "value")
           .agg(F.count(F.lit(1)).alias("times")).toPandas())
    got = got.assign(n=got["at"].map(len)).sort_values(["doc_id", "pattern", "n", "times"], kind="stable")
    weights, bias = train(list(zip(got["at"], got["value"])), posterior(model, got["pattern"].to_numpy()),
                          times=got["times"].to_numpy(dtype=float))
    return Model(model, weights, bias, threshold)


def score(model: Model, m: Column) -> Column:
    """From :func:`measure`: struct(score, kept, label) with the scorer's P(good), whether that reaches the threshold,
    and the labellers' posterior."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = batch["pattern"].to_numpy()
            z = np.array([float(model.weights[at] @ v) + model.bias for at, v in zip(batch["at"], batch["value"])])
            value = np.where(p >= 0, 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))), 0.0)
            yield pd.DataFrame({"score": value, "kept": (p >= 0) & (value >= model.threshold),
                                "label": np.where(p >= 0, posterior(model.labels, np.maximum(p, 0)), 0.0)})

    return vector_udf(run, "score double, kept boolean, label double")(m)


def accepted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that the scorer, fitted on all of them, keeps."""
    model = fit(measured(docs, text, doc_id), **options)
    # measured again rather than stored with the rows: that took as much disk as the texts
    return docs.filter(score(model, measure(F.col(text)))["kept"])
