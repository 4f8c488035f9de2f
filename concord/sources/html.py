"""List items, table rows and links of web pages (S20), in time proportional to the page.

A page is split at ``<`` into tokens, one row each; running counts over the tokens of a page tell which list or table,
row and cell a token stands in.  No pattern spans tags, so pages of tags that are never closed cost no more than others.
All of it is JVM-side: one shuffle brings the tokens of a page together, and every step after it keeps that partitioning.

An element that is not closed ends where the next one of its kind begins, or with its list or table.  What stands in a
nested list or table belongs to the items and rows of that one, not to the outer item or cell.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
#: U+FFFD stands for numbers that are no character.
NO_CHARACTER = "�"


def character(number: Column) -> Column:
    """The character of a code point."""
    known = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    utf32 = F.decode(F.unhex(F.lpad(F.hex(F.when(known, number)), 8, "0")), "UTF-32")
    return F.coalesce(utf32, F.lit(NO_CHARACTER))


def decoded(text: Column) -> Column:
    """Text with its character references replaced: decimal, hexadecimal and the named ones of HTML 4 (and ``&apos;``).
    Nothing is decoded twice; unknown references stay as they are."""
    names = F.create_map(*[F.lit(x) for k, v in [*sorted(name2codepoint.items()), ("apos", 39)] for x in (k, chr(v))])

    def piece(p: Column) -> Column:
        ref = F.regexp_extract(p, REFERENCE, 1)
        digits = F.substring(ref, 2, 8)
        number = F.when(F.lower(F.substring(ref, 2, 1)) == "x", F.conv(F.substring(ref, 3, 8), 16, 10)).otherwise(digits)
        char = F.when(ref.startswith("#"), character(number.try_cast("bigint"))).otherwise(F.try_element_at(names, ref))
        after = F.substring(p, F.char_length(ref) + 2, F.lit((1 << 31) - 1))
        return F.when(char.isNotNull() & (ref != ""), F.concat(char, after)).otherwise(F.concat(F.lit("&"), p))

    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), piece)
    return F.when(F.contains(text, F.lit("&")), F.concat(parts[0], F.array_join(rest, ""))).otherwise(text)


def plain(text: Column) -> Column:
    """Tagless text with references decoded and white space collapsed."""
    return F.trim(F.regexp_replace(decoded(text), r"\s+", " "))


def tokens(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """_page (a number for each row), id, _i, _tag (lower case, ``/td`` when it closes; '' for no tag), _text after it."""
    numbered = pages.select(F.monotonically_increasing_id().alias("_page"), F.col(id_col), F.col(html_col).alias("_html"))
    t = numbered.select("_page", F.col(id_col), F.posexplode(F.split("_html", "<")).alias("_i", "_t"))
    tag = F.when(F.col("_i") == 0, "").otherwise(F.lower(F.regexp_extract("_t", r"^(/?[A-Za-z][A-Za-z0-9]*)", 1)))
    end = F.instr("_t", ">")
    no_tag = (F.col("_tag") == "") & ~F.substring("_t", 1, 1).isin("!", "/", "?")
    text = (F.when(F.col("_i") == 0, F.col("_t")).when(no_tag, F.concat(F.lit("<"), F.col("_t")))
            .when(end > 0, F.substring(F.col("_t"), end + 1, F.lit((1 << 31) - 1))).otherwise(""))
    return t.withColumn("_tag", tag).withColumn("_text", text).drop("_t")


def _within(t: DataFrame, containers: tuple[str, ...], **marks: tuple[tuple[str, ...], tuple[str, ...]]) -> DataFrame:
    """Tokens with a column per mark: the place of the last token of the first tags in the same list or table, -1 after
    one of the second tags or before any."""
    closing = [f"/{c}" for c in containers]
    page = Window.partitionBy("_page").orderBy("_i")
    depth = F.sum(F.when(F.col("_tag").isin(*containers), 1).when(F.col("_tag").isin(*closing), -1).otherwise(0)).over(page)
    same = Window.partitionBy("_page", "_depth").orderBy("_i")
    state = {name: F.coalesce(F.last(F.when(F.col("_tag").isin(*opens), F.col("_i"))
                                     .when(F.col("_tag").isin(*containers, *ends), -1), ignorenulls=True).over(same), F.lit(-1))
             for name, (opens, ends) in marks.items()}
    return t.withColumn("_depth", depth).withColumns(state)


def _joined() -> Column:
    pieces = F.sort_array(F.collect_list(F.struct("_i", "_text")))
    return plain(F.array_join(F.transform(pieces, lambda p: p["_text"]), ""))


def html_items(pages: DataFrame, id_col: str, html_col: str, item: str = "li",
               lists: tuple[str, ...] = ("ul", "ol", "menu")) -> DataFrame:
    """id, position, text of each ``item`` element, in the order in which they begin."""
    t = _within(tokens(pages, id_col, html_col), lists, _item=((item,), (f"/{item}",)))
    items = t.where(F.col("_item") >= 0).groupBy("_page", id_col, "_item").agg(_joined().alias("text"))
    position = F.row_number().over(Window.partitionBy("_page").orderBy("_item")) - 1
    return items.select(id_col, position.cast("bigint").alias("position"), "text")


def html_table_rows(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """``tbody tr td``: id, position and cell texts of each table row that has cells, in the order in which they begin."""
    sections = ("tbody", "/tbody", "thead", "/thead", "tfoot", "/tfoot")
    t = _within(tokens(pages, id_col, html_col), ("table",), _body=(("tbody",), sections[1:]), _row=(("tr",), ("/tr", *sections)),
                _cell=(("td",), ("/td", "tr", "/tr", "th", "/th", *sections)))
    cells = (t.where((F.col("_body") >= 0) & (F.col("_row") >= 0) & (F.col("_cell") >= 0))
             .groupBy("_page", id_col, "_row", "_cell").agg(_joined().alias("text")))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_cell", "text"))), lambda c: c["text"])
    rows = cells.groupBy("_page", id_col, "_row").agg(ordered.alias("cells"))
    position = F.row_number().over(Window.partitionBy("_page").orderBy("_row")) - 1
    return rows.select(id_col, position.cast("bigint").alias("position"), "cells")


def html_links(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Every ``<a href="...">`` target with its position."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(r'<a\s+href="([^"]*)"'), 1)
    return pages.select(id_col, F.posexplode(hrefs).alias("position", "href")) \
        .select(id_col, F.col("position").cast("bigint").alias("position"), "href")
