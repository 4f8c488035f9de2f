import random
import re
from collections import Counter

from concord.llm.rules import base_failed, learn_rules, rules_column, text_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


TEXTS = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "a a a a a a", "a b a b a b a", "x\nx\nx", "é é é ß",
         "one two three\nfour\n one two three\none two three", "\x0b\x0ca\tb\r\nc", "#a *b $c %d &e |f <g >h", "\x1cq \x85 r",
         "w " * 3000, " ".join(str(i % 700) for i in range(5000))]


def test_statistics_match_brute_force(spark, docs_table):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(5, "same id, other text"), (None, "no id at all"), (None, "no id at all")]
    got = text_statistics(docs_table(rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                   "n_repeat_words").collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *brute(t)) for i, t in rows)


def test_statistics_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in text_statistics(docs).select("doc_id", "n_words", "word_chars", "n_symbols",
                                                                     "n_dup_lines", "n_repeat_words").collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.select("doc_id", "text").collect()}


def test_learned_list_separates_planted_junk(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        kind = rng.random()
        symbol, upper = rng.random() * 0.05, rng.random() * 0.1
        if kind < 0.1:
            symbol = 0.4 + rng.random()
        elif kind < 0.2:
            upper = 0.6 + 0.4 * rng.random()
        rows.append((i, kind < 0.2, symbol, upper, rng.random()))
    df = spark.createDataFrame(rows, "doc_id long, bad boolean, symbol_ratio double, upper_ratio double, noise double")
    rules = learn_rules(df, features=("symbol_ratio", "upper_ratio", "noise"))
    assert 2 <= len(rules) <= 6
    wrong = df.withColumn("r", rules_column(rules)).filter("(r > 0) != bad").count()
    assert wrong <= 5


def test_no_labels_keep_everything(spark):
    df = spark.createDataFrame([], "doc_id long, bad boolean, x double")
    assert learn_rules(df, features=("x",)) == []
    same = spark.createDataFrame([(1, True, 1.0), (2, None, 1.0)], "doc_id long, bad boolean, x double")
    assert learn_rules(same, features=("x",)) == []
    assert same.select(rules_column([]).alias("r")).distinct().collect()[0].r == 0


def test_empty_table(spark, docs_table):
    s = text_statistics(docs_table([]))
    assert s.withColumn("b", base_failed()).count() == 0
