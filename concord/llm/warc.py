"""WARC derivatives: linked metadata and plain-text conversion records from response records.

:func:`response_records` describes pages as responses; :func:`derive_records` gives two records per response, each
referring to it (WARC-Refers-To) and carrying its URI, HTTP headers and payload digest; :func:`record_text` serialises
any record, :func:`write_warc` and :func:`read_warc` are the files.  There is no shuffle: a page becomes its two records
where it is read.  Pages without stored HTTP headers get those of a plain 200 answer with their length.

Edge cases: a NULL page body is an empty payload, whose conversion is empty; a NULL URL leaves out WARC-Target-URI;
record ids come from what a record holds, so repeated rows give repeated records with equal ids; an empty table gives no
record; other columns of the input are ignored.  Tags end at the next ``<`` if nothing closes them, so no pattern runs over
a whole page from every tag, and very long pages of unclosed tags take time in proportion to their length.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import vector_udf

HIDDEN = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<script(?:[\s/][^<>]*)?>.*?(?:</script\s*>|\Z)|<style(?:[\s/][^<>]*)?>.*?(?:</style\s*>|\Z)"
                    r"|<noscript(?:[\s/][^<>]*)?>.*?(?:</noscript\s*>|\Z)|<template(?:[\s/][^<>]*)?>.*?(?:</template\s*>|\Z)")
#: Elements that begin a new line of text.
BLOCK = re.compile(r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|"
                   r"form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|"
                   r"title|tr|ul)(?:[\s/][^<>]*)?>")
TAG = re.compile(r"<[/!?A-Za-z][^<>]*>")
BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
TITLE = re.compile(r"(?is)<title(?:\s[^<>]*)?>(.*?)</title\s*>")
TITLE_END = re.compile(r"(?i)</title\s*>")
LINK = re.compile(r"""(?is)<a\s(?:[^<>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
EXTRACT = "text string, title string, links array<string>"


def html_text(page: str) -> str:
    """The visible text: one line per block element, blanks collapsed, empty lines left out."""
    bare = html_entities.unescape(TAG.sub("", BLOCK.sub("\n", HIDDEN.sub("", page))))
    return "\n".join(x for x in (BLANKS.sub(" ", line).strip(" ") for line in bare.split("\n")) if x)


def html_title(page: str) -> str | None:
    ends = [m.end() for m in TITLE_END.finditer(page)]
    found = TITLE.search(page, 0, ends[-1]) if ends else None  # where none closes there is none
    return " ".join(html_entities.unescape(TAG.sub("", found[1])).split()) if found else None


def html_links(page: str) -> list[str]:
    return [html_entities.unescape(a or b or c).strip() for a, b, c in LINK.findall(HIDDEN.sub("", page))]


def extract(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in pages:
        yield pd.DataFrame({"text": [html_text(p) for p in batch], "title": [html_title(p) for p in batch],
                            "links": [html_links(p) for p in batch]})


def uuid_of(*parts: Column) -> Column:
    """urn:uuid from the MD5 of the parts."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.concat_ws("-", F.concat(F.lit("urn:uuid:"), F.substring(h, 1, 8)), F.substring(h, 9, 4),
                       F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def sha256_of(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def response_records(pages: DataFrame, date: str, page_id: str = "page_id", url: str = "url",
                     body: str = "html") -> DataFrame:
    """page_id, record_id, target_uri, warc_date, http_headers, payload, payload_digest per page."""
    payload = F.coalesce(F.col(body).cast("string"), F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                       F.octet_length(payload).cast("string"), F.lit("\r\n"))
    return (pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("target_uri"),
                         F.lit(date).alias("warc_date"), headers.alias("http_headers"), payload.alias("payload"),
                         sha256_of(payload).alias("payload_digest"))
            .withColumn("record_id", uuid_of(F.lit("response"), F.col("page_id"), F.col("target_uri"),
                                             F.col("payload_digest"))))


def derive_records(responses: DataFrame, date: str) -> DataFrame:
    """One metadata and one conversion record per response.

    page_id, record_type, record_id, refers_to, target_uri, warc_date, content_type, content_length (bytes),
    block_digest, source_payload_digest, source_headers, block.
    """
    r = responses.withColumn("x", vector_udf(extract, EXTRACT)(F.col("payload")))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    metadata = F.concat_ws(
        "", field("source-date", F.col("warc_date")), field("source-payload-digest", F.col("payload_digest")),
        field("source-length", F.octet_length("payload")), field("title", F.col("x.title")),
        F.array_join(F.transform("x.links", lambda u: F.concat(F.lit("outlink: "), u, F.lit("\r\n"))), ""))
    made = F.explode(F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"),
                 metadata.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("x.text").alias("block"))))
    out = r.select("page_id", "record_id", "target_uri", "http_headers", "payload_digest", made.alias("m"))
    return out.select(
        "page_id", "m.record_type", uuid_of(F.col("m.record_type"), F.col("record_id")).alias("record_id"),
        F.col("record_id").alias("refers_to"), "target_uri", F.lit(date).alias("warc_date"), "m.content_type",
        F.octet_length("m.block").cast("long").alias("content_length"), sha256_of(F.col("m.block")).alias("block_digest"),
        F.col("payload_digest").alias("source_payload_digest"), F.col("http_headers").alias("source_headers"), "m.block")


def record_text() -> Column:
    """A record in file form, without the two line ends that close it: header lines, an empty line, the block."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    # header values are one line; the source's HTTP headers are kept with their line ends written as "; "
    source = F.regexp_replace(F.rtrim(F.col("source_headers")), r"\r\n", "; ")
    return F.concat(
        F.lit("WARC/1.0\r\n"), F.concat_ws(
            "", line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
            line("WARC-Refers-To", F.concat(F.lit("<"), "refers_to", F.lit(">"))),
            line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("warc_date")),
            line("WARC-Block-Digest", F.col("block_digest")),
            line("WARC-Source-Payload-Digest", F.col("source_payload_digest")), line("WARC-Source-Headers", source),
            line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string"))),
        F.lit("\r\n"), F.col("block"))


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    records.select(record_text().alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """headers (map), block, complete (the block is as long as its header says) per record of WARC files."""
    rows = spark.read.option("lineSep", "\r\n\r\nWARC/1.0\r\n").text(path)
    text = F.regexp_replace("value", r"^WARC/1\.0\r\n", "")
    at = F.locate("\r\n\r\n", text)
    out = rows.select(F.substring(text, F.lit(1), at - 1).alias("head"),
                      F.substring(text, at + 4, F.length(text)).alias("rest"))
    headers = F.str_to_map("head", F.lit("\r\n"), F.lit(": "))
    length = F.element_at(headers, "Content-Length").cast("int")
    block = F.substring(F.col("rest").cast("binary"), F.lit(1), length)
    return out.select(headers.alias("headers"), block.cast("string").alias("block"),
                      (F.octet_length(block) == length).alias("complete"))
