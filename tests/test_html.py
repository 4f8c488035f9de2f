"""HTML rows: nesting, unclosed elements, character references, and pages of unclosed tags in linear time."""

import time

from concord.sources import html as HT


def page(spark, html):
    return spark.createDataFrame([(1, html)], "id int, html string")


def table(spark, html):
    return [(r.position, list(r.cells)) for r in HT.html_table_rows(page(spark, html), "id", "html").orderBy("position").collect()]


def items(spark, html):
    return [r.text for r in HT.html_items(page(spark, html), "id", "html").orderBy("position").collect()]


def test_nested_tables(spark):
    inner = "<table><tbody><tr><td>x</td><td>y</td></tr></tbody></table>"
    html = f"<table><thead><tr><td>head</td></tr></thead><tbody><tr><td>a{inner}b</td><td>c</td></tr><tr><th>h</th></tr></tbody></table>"
    assert table(spark, html) == [(0, ["ab", "c"]), (1, ["x", "y"])]


def test_unclosed_elements(spark):
    assert table(spark, "<TABLE><tbody><tr><td>1<td>2<tr class='r'><td>3</TABLE> after <td>no") == [(0, ["1", "2"]), (1, ["3"])]
    assert items(spark, "<ul><li>a<li>b <ol><li>c</ol> d</ul> e <li>f") == ["a", "b d", "c", "f"]
    assert items(spark, "<ul><li>a<li>b</li> not <li>c</ul>") == ["a", "b", "c"]


def test_lists_after_each_other_and_nested(spark):
    assert items(spark, "<ul><li>a <ul><li>in</li></ul> z</li></ul>x<ul>y<li>b</li></ul>") == ["a z", "in", "b"]


def test_character_references(spark):
    html = "<li>&amp;lt; &#233;&#xE9; &eacute;&euro; &#128512; &bogus; &#0; &#xD800; a & b &copy &apos;</li>"
    assert items(spark, html) == ["&lt; éé é€ \U0001F600 &bogus; � � a & b &copy '"]


def test_stray_signs_and_empty(spark):
    assert items(spark, "<li>1 < 2 and 3 > 2 <!-- no --> <br/>end</li>") == ["1 < 2 and 3 > 2 end"]
    assert items(spark, "") == [] and table(spark, "no tags") == [] and items(spark, None) == []


def test_a_megabyte_of_unclosed_tags(spark):
    df = page(spark, "warm <td> <li> up")
    for tag in ("<td>", "<tr>", "<li>", "<li ", "<tbody>", "<table>", "<", "&", "</td"):
        html = tag * ((1 << 20) // len(tag))
        df = page(spark, html).cache()
        df.count()
        t = time.time()
        HT.html_table_rows(df, "id", "html").count()
        HT.html_items(df, "id", "html").count()
        assert time.time() - t < 20, tag  # quadratic patterns took minutes
        df.unpersist()
