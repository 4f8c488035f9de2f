import hashlib

from concord.llm.warc import derive_records, html_links, html_text, html_title, read_warc, response_records, write_warc

PAGE = ('<!DOCTYPE html><html><head><title>A &amp; B\n c</title><style>p{x:1}</style><script>var t="</p><b>no</b>";</script>'
        '</head><body><!-- hidden <p>x</p> --><p>One  two<br>three &lt;4&gt;</p><ul><li><a class=k href="/x?a=1&amp;b=2">L</a>'
        "<li><a href='y'>M</a><a href=z>N</a></ul>tail &#233;&eacute;&nbsp;end</body></html>")


def test_extraction():
    assert html_text(PAGE).split("\n") == ["A & B", "c", "One two", "three <4>", "L", "MN", "tail éé end"]
    assert html_title(PAGE) == "A & B c" and html_title("<p>x") is None
    assert html_links(PAGE) == ["/x?a=1&b=2", "y", "z"]
    assert html_text("<script>never closed <p>x") == "" and html_text("a < b") == "a < b" and html_text("") == ""


def test_records_link_to_their_response_and_survive_files(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/", PAGE, "x", 5), (2, None, None, "x", 5), (3, "http://b/", "<p>ü" + "long " * 30_000, "x", 5),
         (None, "http://c/", "", "x", 5), (1, "http://a/", PAGE, "x", 5)],
        "page_id long, url string, html string, block string, record_id int")
    responses = response_records(pages, "2024-01-01T00:00:00Z")
    records = derive_records(responses, "2024-02-01T00:00:00Z")
    source = {r.record_id: r for r in responses.collect()}
    got = records.collect()
    assert len(got) == 10
    for r in got:
        s = source[r.refers_to]
        assert (r.page_id, r.target_uri, r.source_headers, r.source_payload_digest) == (
            s.page_id, s.target_uri, s.http_headers, "sha256:" + hashlib.sha256(s.payload.encode()).hexdigest())
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.content_length == len(r.block.encode())
        if r.record_type == "conversion":
            assert r.block == html_text(s.payload)
    assert len({r.record_id for r in got}) == 8  # the repeated page repeats its two records
    meta = next(r.block for r in got if r.page_id == 1 and r.record_type == "metadata")
    assert "title: A & B c\r\n" in meta and meta.count("outlink: ") == 3
    write_warc(records, str(tmp_path / "w"))
    back = read_warc(spark, str(tmp_path / "w")).collect()
    assert all(b.complete for b in back)
    assert sorted((b.headers["WARC-Record-ID"], b.headers["WARC-Refers-To"], b.headers.get("WARC-Target-URI"),
                   b.headers["WARC-Source-Payload-Digest"], b.block) for b in back) == sorted(
        (f"<{r.record_id}>", f"<{r.refers_to}>", r.target_uri, r.source_payload_digest, r.block) for r in got)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert derive_records(response_records(pages, "d"), "d").count() == 0


def test_long_pages_of_unclosed_tags_take_linear_time():
    import time
    for tag in ("<title>", "<title ", "<p ", "<a ", "<a href=\"", "<script ", "<td", "<", "</title", "<!--", "<a href="):
        page = tag * ((1 << 20) // len(tag))
        t = time.time()
        html_text(page), html_title(page), html_links(page)
        assert time.time() - t < 5, tag
    assert html_title("<title>never") is None and html_title("<title >a</title x></title>b") == "a"


def test_very_long_pages_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<title> " * 100_000 + "<p " * 100_000 + "</p>end")], "page_id long, url string, html string")
    out = {r.record_type: r for r in derive_records(response_records(pages, "d"), "d").collect()}
    assert out["conversion"].block.endswith("end") and "title:" not in out["metadata"].block
    assert derive_records(response_records(pages.limit(0), "d"), "d").count() == 0
