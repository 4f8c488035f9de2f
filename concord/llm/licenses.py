"""Licence scan by canonical digest lookup (DataFrame operations only).

A text is brought to a canonical form - ASCII case, copyright lines, punctuation, spacing and equivalent spellings -
and the SHA-256 of that form is joined to the digests of known licence texts.  Whole texts are looked up, and each line
as a text of its own, which finds one-line notices inside longer documents.

Edge cases: NULL and empty texts have the digest of the empty form and match nothing, as does a known text whose form is
empty; a digest that several licences share reports the first id in code point order; repeated rows give repeated
results; rows with a NULL id are scanned like any other; other columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, text_of
from .license_texts import EQUIVALENT_SPELLINGS, LICENSE_TEXTS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that names the holder: it differs from copy to copy and is left out.
COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright[ \t]*(\([ \t]*c[ \t]*\)|©|[0-9]{4}|by[ \t]|:|<|\[)|\(c\)[ \t]*[0-9a-z<\[]|©|all rights reserved)"
#: ASCII controls, spaces and punctuation, and the typographic marks; runs become one space.
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F‘’“”–—…•\x{A0}]+"

#: The shortest beginning that holds four words.
FOUR_WORDS = "^" + PUNCTUATION[:-1] + "*(?:[^" + PUNCTUATION[1:-2] + "]+" + PUNCTUATION + "){0,3}[^" + PUNCTUATION[1:-2] + "]*"


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z; where all is ASCII that is the much cheaper lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def bare(lowered: Column) -> Column:
    """Lower-case text without punctuation; words one space apart."""
    return F.trim(F.regexp_replace(F.replace(lowered, F.lit("&"), F.lit(" and ")), PUNCTUATION, " "))


def equivalent(words: Column) -> Column:
    for old, new in EQUIVALENT_SPELLINGS:
        words = F.replace(words, F.lit(old), F.lit(new))
    return words


def canonical_of(lowered: Column) -> Column:
    kept = F.filter(F.split(lowered, "\n"), lambda x: ~x.rlike(COPYRIGHT_LINE))
    return equivalent(bare(F.array_join(kept, "\n")))


def canonical(text: Column) -> Column:
    return canonical_of(ascii_lower(text))


def opening(text: Column) -> Column:
    """The first two words of the canonical form of a lower-case line, from its first four words: no equivalent
    spelling is longer than two words."""
    return F.substring_index(equivalent(F.substring_index(bare(F.regexp_extract(text, FOUR_WORDS, 0)), " ", 4)), " ", 2)


def digest_of(lowered: Column) -> Column:
    return F.sha2(canonical_of(lowered).cast("binary"), 256)


def known_licenses(spark: SparkSession, texts: tuple[tuple[str, str], ...] = LICENSE_TEXTS) -> DataFrame:
    return spark.createDataFrame(list(texts), "license_id string, text string")


def license_digests(known: DataFrame) -> DataFrame:
    """(digest, license_id, opening), one row per digest."""
    k = known.select("license_id", canonical(text_of("text")).alias("form")).filter("form != ''")
    return (k.groupBy(F.sha2(F.col("form").cast("binary"), 256).alias("digest"))
            .agg(F.min("license_id").alias("license_id"), F.min(F.substring_index("form", " ", 2)).alias("opening")))


def license_scan(docs: DataFrame, known: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_digest, license_id (of the whole text, or NULL), n_license_lines, line_licenses (sorted, distinct)
    per row of ``docs``."""
    # written, so that Spark knows its size in bytes and broadcasts it only below its own threshold
    digests = materialize(license_digests(known), "license-digests")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("text_key"),
                       ascii_lower(text_of(text)).alias("text"))
    whole = rows.select("doc_id", "text_key", digest_of(F.col("text")).alias("text_digest"))
    whole = whole.join(digests.select(F.col("digest").alias("text_digest"), "license_id"), "text_digest", "left")
    # a line is put into canonical form only if it opens like a known text
    line = F.col("line_text")
    lines = (rows.select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line", "line_text"))
             .withColumn("opening", opening(line))
             .join(digests.select("opening", "digest", F.col("license_id").alias("line_license")), "opening")
             .filter(digest_of(line) == F.col("digest"))
             .groupBy(F.col("doc_id").alias("line_doc"), F.col("text_key").alias("line_key"))
             .agg(F.count_distinct("line").alias("n_license_lines"),
                  F.array_sort(F.collect_set("line_license")).alias("line_licenses")))
    out = whole.join(lines, F.col("doc_id").eqNullSafe(F.col("line_doc")) & (F.col("text_key") == F.col("line_key")),
                     "left")
    return out.select("doc_id", "text_digest", "license_id",
                      F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines"),
                      F.coalesce("line_licenses", F.array().cast("array<string>")).alias("line_licenses"))


def canonical_sql(text: str) -> str:
    """The DuckDB text of :func:`canonical`."""
    q = lambda s: s.replace("'", "''")
    out = (f"regexp_replace(replace(array_to_string(list_filter(string_split(translate({text}, '{UPPER}', '{LOWER}'), "
           f"chr(10)), lambda x: NOT regexp_matches(x, '{q(COPYRIGHT_LINE)}')), chr(10)), '&', ' and '), "
           f"'{q(PUNCTUATION)}', ' ', 'g')")
    for old, new in EQUIVALENT_SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim({out})"
