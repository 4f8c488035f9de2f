"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared in a plain form: lower case, every run of other characters than letters and digits one
space.  An item of length m has an error budget k = floor(rate * m).  It is cut into k + 1 pieces; wherever it occurs
with at most k edits, one piece occurs unchanged, so an Aho-Corasick automaton over the pieces of all items finds every
place to look at.  Each place is verified with Myers' bit-parallel edit distance over the window the budget allows.

The automaton is broadcast, so the items are taken in blocks of at most ``block_chars`` characters; each block is one
pass over the documents (a set of queries against all rows, in blocks).

Items shorter than ``min_chars`` in plain form are compared as whole words: with a blank at either end, in a text with
a blank at either end, so that a letter that goes on before or after them is an edit too.  With rate 0.08 they have a
budget of 0 below 13 characters, and of 1 to 3 above.

Edge cases: NULL and empty texts and items match nothing; equal items with different ids are all reported; an item with
a NULL id is searched like any other and reported with a NULL id; repeated documents are reported as often as they
appear, NULL ids with a NULL id; empty tables give no match; other columns are ignored.  Very long texts are searched
whole: places that overlap are one stretch as soon as they are found, so a text that repeats an item holds no list of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, vector_udf

OTHER = re.compile(r"[\W_]+")
MATCH = "item_id long, distance int, budget int, first int, last int"


def plain(text: str) -> str:
    return OTHER.sub(" ", text.lower()).strip()


def cut(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of as equal length as possible, with their offsets."""
    edges = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(masks: dict[str, int], m: int, window: str, k: int) -> tuple[int, int]:
    """(least edit distance of the pattern to any substring of ``window``, end of the first such), or (k + 1, -1).

    Myers' recurrence with a Python integer as the bit column; a match may start anywhere."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best, end = k + 1, -1
    for i, c in enumerate(window):
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (~(xh | up) & full)
        mh = up & xh
        if ph & top:
            distance += 1
        elif mh & top:
            distance -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up = mh | (~(xv | ph) & full)
        down = ph & xv
        if distance < best:
            best, end = distance, i + 1
            if not distance:
                break
    return best, end


def letters(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


@dataclass(frozen=True)
class Items:
    """A block of distinct plain items with all ids that have them."""

    items: tuple[tuple[str, int, tuple[int | None, ...]], ...]  # form to search, budget, ids


class Matcher:
    """Finds the items of a block in plain texts."""

    def __init__(self, block: Items):
        self.items = block.items
        self.masks: list[dict[str, int] | None] = [None] * len(block.items)
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (item, k, _) in enumerate(block.items):
            for offset, piece in cut(item, k):
                pieces.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item number the merged stretches of ``text`` (with a blank at either end) in which it may lie; only
        items that begin with a blank may take up those at the ends."""
        spans: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for n, offset in where:
                item, k, _ = self.items[n]
                start = end + 1 - length - offset
                edge = item[0] != " "
                a, b = max(edge, start - k), min(len(text) - edge, start + len(item) + k)
                if b - a < len(item) - k:
                    continue
                found = spans.setdefault(n, [])
                if found and a <= found[-1][1] and b >= found[-1][0]:
                    found[-1] = [min(a, found[-1][0]), max(b, found[-1][1])]
                else:
                    found.append([a, b])
        for n, found in spans.items():
            found.sort()
            merged = [found[0]]
            for a, b in found[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            spans[n] = merged
        return spans

    def matches(self, text: str) -> list[tuple[int | None, int, int, int, int]]:
        """(item id, least distance, budget, first, last) of the items in a plain text, by id; the match lies within
        characters first to last (last excluded)."""
        out = []
        size, text = len(text), f" {text} "
        for n, spans in self.windows(text).items():
            item, k, ids = self.items[n]
            masks = self.masks[n]
            if masks is None:
                masks = self.masks[n] = letters(item)
            best = (k + 1, 0, 0)
            for a, b in spans:
                distance, end = myers(masks, len(item), text[a:b], k)
                if distance < best[0]:
                    best = (distance, max(a, a + end - len(item) - distance), a + end)
            if best[0] <= k:
                word = item[0] == " "
                first, last = max(0, best[1] - 1 + word), min(size, best[2] - 1 - word)
                out += [(i, best[0], k, first, last) for i in ids]
        return sorted(out, key=lambda m: (m[0] is None, m))


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", rate: float = 0.08,
                min_chars: int = 40, block_chars: int = 4_000_000) -> Iterator[Items]:
    """The items in blocks of about ``block_chars`` characters; the driver holds one block at a time."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), text_of(text).alias("text"))
    size = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = size // block_chars + 1
    for b in range(blocks):
        ids: dict[str, set[int | None]] = {}
        for r in rows.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect():
            ids.setdefault(plain(r["text"]), set()).add(r["item_id"])
        kept = sorted((t if len(t) >= min_chars else f" {t} ", int(rate * len(t)),
                       tuple(sorted(i, key=lambda x: (x is None, x)))) for t, i in ids.items() if t)
        if kept:
            yield Items(tuple(kept))


def match_column(block: Items, text: Column) -> Column:
    """array of struct MATCH per text."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block)
        names = ("item_id", "distance", "budget", "first", "last")
        for batch in batches:
            yield pd.Series([[dict(zip(names, m)) for m in matcher.matches(plain(t or ""))] for t in batch])

    return vector_udf(run, f"array<struct<{MATCH.replace(' ', ':').replace(',:', ',')}>>")(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
               **options) -> DataFrame:
    """(doc_id, item_id, distance, budget, first, last) per document and item found in it."""
    out = None
    for block in item_blocks(benchmark, **options):
        found = (docs.select(F.col(doc_id).alias("doc_id"), F.explode(match_column(block, F.col(text))).alias("m"))
                 .select("doc_id", "m.*"))
        out = found if out is None else out.unionAll(found)
    if out is None:
        kinds = (("item_id", "long"), ("distance", "int"), ("budget", "int"), ("first", "int"), ("last", "int"))
        return docs.limit(0).select(F.col(doc_id).alias("doc_id"), *[F.lit(None).cast(t).alias(n) for n, t in kinds])
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    for block in item_blocks(benchmark, **options):
        docs = docs.filter(F.size(match_column(block, F.col(text))) == 0)
    return docs
