import zlib

from pyspark.sql import functions as F

from concord.llm.langid import compressors, fit, predict, sizes
from concord.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = QUERIES["op8_zstd_langid"](spark, SF)
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = out.join(lang, "doc_id").collect()
    assert len(rows) == lang.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_edge_cases(spark, docs_table):
    train = [(i, f"the cat and the dog number {i} were in the garden of the old house", "en") for i in range(30)]
    train += [(100 + i, f"der hund und die katze nummer {i} waren im garten des alten hauses", "de") for i in range(20)]
    odd = [(200, None, "en"), (201, "", None), (202, "123 !? 456", None), (None, "the dog and the old cat", None),
           (203, "der alte garten und die katze", None), (203, "der alte garten und die katze", None),
           (204, "the garden of the old house " * 20_000, None), (205, "q", None)]
    docs = docs_table(train + odd)
    model = fit(docs)
    assert model.languages == ("en", "de")
    got = {}
    for r in docs.select("doc_id", "text", predict(model, F.col("text")).alias("p")).collect():
        got.setdefault((r.doc_id, (r.text or "")[:9]), []).append(r.p)
    assert [p.best for p in got[200, ""]] == [p.best for p in got[201, ""]] == ["und"]
    assert got[202, "123 !? 45"][0].best == "und" and got[202, "123 !? 45"][0].score == 0
    assert got[None, "the dog a"][0].lang == "en" and got[204, "the garde"][0].best == "en"
    assert [p.best for p in got[203, "der alte "]] == ["de", "de"]
    q = got[205, "q"][0]
    assert (q.best, q.lang, q.rejected) == ("en", "und", True)  # a tie: the language with more rows, and a narrow margin
    assert got[204, "the garde"][0].sizes == sizes(compressors(model), "the garden of the old house " * 20_000, 2048)


def test_nothing_to_learn_from(spark, docs_table):
    docs = docs_table([(1, "some text", None), (2, None, "en")])
    model = fit(docs)
    assert model.languages == ()
    assert {r.p.best for r in docs.select(predict(model, F.col("text")).alias("p")).collect()} == {"und"}
    assert docs.limit(0).select(predict(model, F.col("text"))).count() == 0


def test_copies_of_one_id_leave_the_other_texts_in_the_dictionary(spark, docs_table):
    rows = [(i, f"the house number {i} and the {chr(97 + i % 26) * 5} garden", "en") for i in range(400)]
    for copied in (0, 7, 123):
        model = fit(docs_table(rows + [rows[copied]] * 3000, f"c{copied}"), sample=300)
        alone = fit(docs_table(rows, f"a{copied}"), sample=300)
        assert model.dictionaries == alone.dictionaries and model.dictionaries[0].count(b"\n") == 299


def test_dictionaries_are_whole_texts_within_their_bytes(spark, docs_table):
    rows = [(i, f"text number {i} " * 20, "en") for i in range(200)] + [(999, "long " * 10_000, "en")]
    model = fit(docs_table(rows), dict_bytes=5000)
    lines = model.dictionaries[0].decode().split("\n")
    assert 4000 < len(model.dictionaries[0]) <= 5000 and all(x.count("text number") == 20 for x in lines)


def test_sizes_by_a_plain_loop(spark, docs_table):
    import zstandard
    rows = [(i, f"the cat {i} and the dog", "en") for i in range(40)] + [(100 + i, f"der hund {i} und die katze", "de") for i in range(30)]
    docs = docs_table(rows)
    model = fit(docs)
    for r in docs.select("text", predict(model, F.col("text")).alias("p")).collect():
        plain = []
        for d in model.dictionaries:
            c = zstandard.ZstdCompressor(level=5, write_content_size=False, write_checksum=False, write_dict_id=False,
                                         dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            plain.append(len(c.compress(" ".join(r.text.lower().split()).encode())))
        assert r.p.sizes == plain and r.p.best == model.languages[min(range(2), key=lambda i: plain[i])]
