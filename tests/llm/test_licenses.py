from collections import Counter

from concord.llm.license_texts import LICENSE_TEXTS
from concord.llm.licenses import known_licenses, license_scan


def test_variants_of_a_licence_share_its_digest(spark, docs_table):
    mit = next(t for i, t in LICENSE_TEXTS if i == "MIT")
    rows = [(1, mit), (2, "Copyright (c) 2020 Some One\n\n" + mit.upper()), (3, "  © The authors\n" + mit.replace(" ", "\n  ")),
            (4, mit.replace("sublicense", "sub-licence").replace('"', "”")), (5, mit + " And more."), (6, mit[:-40]),
            (7, None), (8, ""), (9, "..."), (10, "words\nReleased under the MIT license\nand\nLICENSED UNDER CC BY-NC 4.0!"),
            (11, "Copyright notice of a text"), (13, "x\n  --RELEASED Under: tHe MIT licence!"), (14, "x\nReleased under the MIT"), (1, mit), (None, mit), (12, "word " * 40_000)]
    got = license_scan(docs_table(rows), known_licenses(spark)).collect()
    assert len(got) == len(rows)
    assert Counter(r.doc_id for r in got if r.license_id == "MIT") == Counter([1, 1, 2, 3, 4, None])
    assert len({r.text_digest for r in got if r.license_id}) == 1
    ten = next(r for r in got if r.doc_id == 10)
    assert (ten.license_id, ten.n_license_lines, ten.line_licenses) == (None, 2, ["CC-BY-NC-4.0", "MIT"])
    assert next(r.line_licenses for r in got if r.doc_id == 13) == ["MIT"]
    assert all(r.n_license_lines == 0 and r.line_licenses == [] for r in got if r.doc_id in (7, 8, 9, 11, 12, 14))


def test_shared_digest_and_empty_tables(spark, docs_table):
    known = spark.createDataFrame([("b", "Some text."), ("a", "some  TEXT"), ("c", "!"), ("d", None)],
                                  "license_id string, text string")
    got = license_scan(docs_table([(1, "some text"), (2, "!"), (3, None)]), known).collect()
    assert {(r.doc_id, r.license_id) for r in got} == {(1, "a"), (2, None), (3, None)}
    assert license_scan(docs_table([], "e"), known).count() == 0
    assert license_scan(docs_table([(1, "x")], "f"), known.limit(0)).collect()[0].license_id is None


def test_entire_long_licences_are_known(spark, docs_table):
    ids = ["Apache-2.0", "Artistic-1.0-Perl", "CC0-1.0", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1",
           "LGPL-3.0", "MPL-1.1", "MPL-2.0", "Unlicense"]
    texts = [max((t for i, t in LICENSE_TEXTS if i == x), key=len) for x in ids]
    assert min(map(len, texts)) > 1000
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, "Copyright 2021 Me\n" + t.upper()) for i, t in enumerate(texts)]
    rows += [(200 + i, t[:-200]) for i, t in enumerate(texts)]
    end = "END OF TERMS AND CONDITIONS"
    rows += [(300 + i, t[:t.index(end)] + end) for i, t in enumerate(texts) if end in t]
    got = {r.doc_id: r.license_id for r in license_scan(docs_table(rows), known_licenses(spark)).collect()}
    assert all(got[d] == (None if 200 <= d < 300 else ids[d % 100]) for d in got) and len(got) > 3 * len(ids)
