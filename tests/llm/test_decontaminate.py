import random

from concord.llm.decontaminate import find_leaks, letters, myers, plain, without_leaks


def edit_in(pattern, text):
    """Least edit distance of the pattern to any substring."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (p != t)))
    return min(row)


def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        assert min(myers(letters(p), len(p), t, len(p))[0], len(p)) == edit_in(p, t)


def make(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def damaged(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = rng.choice("abcdefghij")
        elif kind == 1:
            out.insert(i, rng.choice("abcdefghij"))
        else:
            del out[i]
    return "".join(out)


def test_against_brute_force_and_edges(spark, docs_table):
    rng = random.Random(4)
    items = [(i, make(rng, rng.randrange(10, 30)), 5) for i in range(12)]
    items += [(20, items[3][1].upper().replace(" ", ",  "), 5), (21, None, 5), (22, "", 5), (23, "too short", 5), (None, make(rng, 20), 5)]
    docs = []
    for i in range(60):
        body = make(rng, rng.randrange(5, 60))
        if i % 2:
            _, item, _ = items[rng.randrange(12)]
            body = make(rng, 9) + " " + damaged(rng, item, rng.randrange(0, 20)) + " " + body
        docs.append((i, body))
    docs += [(100, None), (101, ""), (102, "x" * 300_000 + " " + items[0][1]), (103, items[1][1]), (103, items[1][1]),
             (None, items[2][1] + " tail"), (104, items[4][1][: len(items[4][1]) // 2])]
    table = docs_table(docs)
    benchmark = spark.createDataFrame(items, "item_id long, text string, distance int")
    want = []
    for d, t in docs:
        for i, item, _ in items:
            form = plain(item or "")
            if i is not None and len(form) >= 40 and len(t or "") < 100_000:
                e = edit_in(form, plain(t or ""))
                if e <= int(0.08 * len(form)):
                    want.append((str(d), i, e))
    got = find_leaks(table, benchmark).collect()
    assert sorted((str(r.doc_id), r.item_id, r.distance) for r in got if r.doc_id != 102) == sorted(want)
    assert [(r.item_id, r.distance) for r in got if r.doc_id == 102] == [(0, 0)]
    assert len(want) > 15
    blocks = find_leaks(table, benchmark, block_chars=300).collect()  # many blocks, the same answer
    assert sorted(map(str, blocks)) == sorted(map(str, got))
    clean = without_leaks(table, benchmark)
    assert clean.columns == table.columns
    leaky = {str(r.doc_id) for r in got}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if str(d) not in leaky)


def test_empty(spark, docs_table):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f g " * 9)], "item_id long, text string")
    docs = docs_table([(1, "a b c d e f g " * 20)])
    assert find_leaks(docs, none).count() == 0 and without_leaks(docs, none).count() == 1
    assert find_leaks(docs.limit(0), one).count() == 0 and find_leaks(docs, one).count() == 1


def test_short_items_are_found_as_whole_words(spark, docs_table):
    items = [(1, "art"), (2, "Who wrote Hamlet?"), (3, "???"), (4, "x" * 39), (5, "")]
    docs = docs_table([(1, "Modern art, since 1900"), (2, "to start the party"), (3, "Q: who wrote hamlet"), (4, "art"),
                       (5, "Quiz. Who wrota Hamlet? Nobody"), (6, "a clean text on who wrote what"), (7, "x" * 36 + " y"),
                       (8, "x" * 45), (9, None), (10, "who wrote hamlets")])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance, r.budget) for r in find_leaks(docs, benchmark).collect())
    assert got == [(1, 1, 0, 0), (3, 2, 0, 1), (4, 1, 0, 0), (5, 2, 1, 1), (7, 4, 3, 3), (8, 4, 1, 3), (10, 2, 1, 1)]
    places = {(r.doc_id, r.item_id): (r.first, r.last) for r in find_leaks(docs, benchmark).collect()}
    assert (places[1, 1], places[4, 1], places[3, 2]) == ((7, 10), (0, 3), (2, 18))
    assert sorted(r.doc_id for r in without_leaks(docs, benchmark).collect()) == [2, 6, 9]


def test_items_with_null_ids_are_searched(spark, docs_table):
    item = "some words of a benchmark question that is long enough to count"
    docs = docs_table([(1, "Before: " + item + "."), (2, "nothing of the kind")])
    benchmark = spark.createDataFrame([(None, item), (7, item), (None, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark).collect()] == [(1, 7), (1, None)]
    only = benchmark.filter("item_id is null")
    assert [(r.doc_id, r.item_id) for r in find_leaks(docs, only).collect()] == [(1, None)]
    assert [r.doc_id for r in without_leaks(docs, only).collect()] == [2]


def test_a_very_long_repeated_text_needs_little_memory():
    import tracemalloc

    from concord.llm.decontaminate import Items, Matcher
    item = "the same words over and over again in one long line of words"
    m = Matcher(Items(((item, 4, (7,)), (" over and ", 0, (8,)))))
    text = plain((item + " ") * 20_000)
    tracemalloc.start()
    found = m.matches(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[:2] for f in found] == [(7, 0), (8, 0)] and peak < 40 * len(text)
