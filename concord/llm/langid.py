"""Language identification by compression: the language whose dictionary compresses a text best.

Each language gets a zstandard raw-content dictionary, made of whole labelled texts.  A text is compressed block by block
with every dictionary; the language with the fewest bytes wins, and the operator answers ``und`` when the runner-up is
nearly as good (``rejected``).

The dictionaries are fitted on a bounded sample of labelled rows: in the order of the MD5 of their ids, the different ids
of a language whose texts fit into ``dict_bytes`` together, at most ``sample`` of them; an id's texts are taken once, the
least if they differ.  With ``max_languages`` that bounds what is broadcast.  Prediction uses whole texts.

Edge cases: a NULL text or one without a letter is ``und`` with score 0; ties go to the language with more labelled
rows, then to the first in code point order; with nothing to learn from every text is ``und``; repeated rows are
predicted one by one; rows without label, NULL ids included, are only predicted; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, unit_hash, vector_udf

UNDETERMINED = "und"
RESULT = "lang string, best string, score double, margin double, rejected boolean, sizes array<long>"


@dataclass(frozen=True)
class Model:
    """Languages in order of preference on ties, and their dictionaries."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    level: int
    block_bytes: int
    min_margin: float


def normal(text: str) -> str:
    """Lower case, blanks collapsed: what dictionaries and texts have in common."""
    return " ".join(text.lower().split())


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = 1000,
        dict_bytes: int = 256 << 10, level: int = 5, block_bytes: int = 2048, min_margin: float = 0.01,
        max_languages: int = 256, seed: str = "langid-1") -> Model:
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    u = unit_hash(seed, F.col("doc_id"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .limit(max_languages + 1).collect()}
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if that is meant")
    # ids first, each once, so that the ranking carries no text; of a language's many ids only those whose number is
    # small enough to be among the first are ranked (four times as many as are needed, on average)
    ids = materialize(rows.select("lang", "doc_id", u.alias("u")).distinct(), "langid-ids")
    few = F.broadcast(ids.groupBy("lang").agg((F.lit(4.0 * sample) / F.count(F.lit(1))).alias("most")))  # a row a language
    best = Window.partitionBy("lang").orderBy("u", "doc_id")
    picked = (ids.join(few, "lang").filter("u <= most").withColumn("rank", F.row_number().over(best))
              .filter(F.col("rank") <= sample).select("lang", "doc_id", "rank"))
    # whole texts in that order as far as they fit; one that does not is passed over
    whole = (rows.join(F.broadcast(picked), ["lang", "doc_id"]).filter(F.octet_length("text") <= dict_bytes)
             .groupBy("lang", "rank").agg(F.min("text").alias("text")))
    upto = F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("rank"))
    got = whole.withColumn("upto", upto).filter(F.col("upto") <= dict_bytes).select("lang", "rank", "text").collect()
    languages = tuple(sorted(counts, key=lambda x: (-counts[x], x)))
    texts_of = {x: [normal(r["text"]) for r in sorted(got, key=lambda r: r["rank"]) if r["lang"] == x] for x in languages}
    return Model(languages, tuple("\n".join(texts_of[x]).encode() for x in languages), level,
                 block_bytes, min_margin)


def compressors(model: Model) -> list[zstandard.ZstdCompressor]:
    out = []
    for data in model.dictionaries:
        d = zstandard.ZstdCompressionDict(data or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=model.level)
        out.append(zstandard.ZstdCompressor(level=model.level, dict_data=d, write_content_size=False,
                                            write_checksum=False, write_dict_id=False))
    return out


def sizes(coders: list[zstandard.ZstdCompressor], text: str, block_bytes: int) -> list[int]:
    data = memoryview(normal(text).encode())
    blocks = [data[i:i + block_bytes] for i in range(0, len(data), block_bytes)]
    return [sum(len(c.compress(b)) for b in blocks) for c in coders]


def decide(model: Model, found: list[int]) -> tuple[str, str, float, float, bool, list[int]]:
    """Each byte saved doubles the odds; the margin is the part of the runner-up's size that the winner saves."""
    k = min(range(len(found)), key=lambda i: found[i])
    least = found[k]
    second = min((x for i, x in enumerate(found) if i != k), default=None)
    score = 1.0 / sum(2.0 ** -min(x - least, 1000) for x in found)
    margin = 1.0 if second is None else (second - least) / second
    rejected = margin < model.min_margin
    best = model.languages[k]
    return UNDETERMINED if rejected else best, best, score, margin, rejected, found


def predict(model: Model, text: Column) -> Column:
    """A struct of RESULT per text: ``lang`` is ``und`` where rejected, ``best`` is the winner all the same."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coders = compressors(model)
        nothing = (UNDETERMINED, UNDETERMINED, 0.0, 0.0, True, [])
        for batch in batches:
            yield pd.DataFrame(
                [decide(model, sizes(coders, t, model.block_bytes)) if coders and has_letter(t) else nothing
                 for t in batch], columns=["lang", "best", "score", "margin", "rejected", "sizes"])

    return vector_udf(run, RESULT)(text)
