"""Quality rules as a learned decision list (DataFrame operations only).

:func:`text_statistics` measures every whole text.  :func:`learn_rules` learns, by sequential covering, an ordered list
of threshold conjunctions that recognise documents labelled bad: each rule is grown condition by condition on two
thirds of the labelled rows (FOIL's gain), pruned from the end on the last third, and kept while it is precise there;
the rows it covers then leave the data.  Every step is one aggregate over the labelled rows (counted per vector of
bins), so what reaches the driver is one row per feature and bin.  :func:`rules_column` is the list as a Spark CASE
expression.

Edge cases: a NULL or empty text has zero counts (its ratios are 0); rows without label are not learned from; with no
labelled rows the list is empty and keeps everything; repeated rows count as often as they appear; several labels of one
document all count; other columns of the inputs are ignored.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARS, materialize, remainder, text_of, word_count

#: The symbols counted as markup noise.
SYMBOLS = "#*$%&|<>"
#: Statistics that rules may test; each is one number per document.
FEATURES = ("n_words", "word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "mark_ratio",
            "digit_ratio", "distinct_ratio")


def window_hashes(words: Column, n: int = 3) -> Column:
    """Hashes of the n-word windows, in text order."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(0), F.size(words) - n),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>"))


def sorted_windows(hashes: Column) -> Column:
    """(hash, position) of the windows in hash order; empty where no window is found twice, so nothing is sorted."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), placed).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>"))


def text_statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and the ratios of FEATURES."""
    t = F.col("_text")
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("_text"))
    bare = F.translate(t, SPACE_CHARS, "")
    rows = rows.select(
        "doc_id", F.filter(F.split(t, SPACE), lambda w: w != "").alias("_words"),
        F.char_length(bare).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "").alias("_lines"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).alias("_upper"),
        (F.char_length(t) - F.char_length(F.translate(t, "!?.,;:", ""))).alias("_marks"),
        (F.char_length(t) - F.char_length(F.translate(t, "0123456789", ""))).alias("_digits"))
    rows = rows.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").alias("_n_lines"), F.size(F.array_distinct("_words")).alias("_distinct"),
        "_upper", "_marks", "_digits", window_hashes(F.col("_words")).alias("_hashes"))
    held = F.col("_windows")
    rows = rows.withColumn("_windows", sorted_windows(F.col("_hashes"))).drop("_hashes")
    # neighbours in hash order that are equal mark both positions
    same = F.zip_with(held, F.slice(held, 2, F.greatest(F.size(held), F.lit(1))),
                      lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    rows = rows.withColumn("_same", same)
    found = F.filter(F.transform(held, lambda w, j: F.when(
        F.get("_same", j) | F.coalesce(F.get("_same", j - 1), F.lit(False)), w["i"])), lambda p: p.isNotNull())
    rows = rows.withColumn("_found", F.array_sort(found))
    # a window covers three words, less what the next one covers as well
    at = F.col("_found")
    steps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))),
                       lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    rows = rows.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0), lambda x, y: x + y).cast("long"))

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ratio("word_chars", "n_words").alias("word_length"), ratio("n_symbols", "n_words").alias("symbol_ratio"),
        ratio("n_dup_lines", "_n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_ratio"),
        ratio("_upper", "word_chars").alias("upper_ratio"), ratio("_marks", "n_words").alias("mark_ratio"),
        ratio("_digits", "word_chars").alias("digit_ratio"), ratio("_distinct", "n_words").alias("distinct_ratio"))


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    """The two fixed rules, before any learned one."""
    return ((F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))


#: A condition is (feature, ">=" or "<", threshold); a rule is a list of conditions that must all hold.
Rule = list[tuple[str, str, float]]


def rule_column(rule: Rule) -> Column:
    out = F.lit(True)
    for feature, op, value in rule:
        out = out & (F.col(feature) >= value if op == ">=" else F.col(feature) < value)
    return out


def rules_column(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1), 0 where none does, as one CASE expression in list order."""
    out: Column | None = None
    for k, rule in enumerate(rules, 1):
        out = F.when(rule_column(rule), k) if out is None else out.when(rule_column(rule), k)
    return F.lit(0) if out is None else out.otherwise(0)


def learn_rules(labelled: DataFrame, features: tuple[str, ...] = FEATURES, bad: str = "bad", doc_id: str = "doc_id",
                bins: int = 32, min_precision: float = 0.9, min_support: float = 0.002) -> list[Rule]:
    """Sequential covering over rows of (doc_id, bad boolean, features).

    ``min_support`` is the least share of the labelled bad rows a rule must find; a rule whose precision on the pruning
    third stays under ``min_precision`` ends the list.  Nothing else ends it, nor a rule: a condition is added while one
    gains, and every rule takes bad rows away.
    """
    labelled = labelled.filter(F.col(bad).isNotNull())
    # candidate thresholds: quantiles of each feature over bad and over other rows, so rare kinds of junk get cuts too
    probs = [k / bins for k in range(bins + 1)]
    q = labelled.agg(*[F.percentile_approx(F.when(F.col(bad) == side, F.col(f)), probs, 2000).alias(f"{f}_{side}")
                       for f in features for side in (True, False)]).first()
    cuts = {f: sorted({float(x) for side in (True, False) for x in (q[f"{f}_{side}"] or [])}) for f in features}
    cuts = {f: c for f, c in cuts.items() if c}
    if not cuts:
        return []
    # rows become counts per vector of bins; bin b of a feature holds values with exactly b cuts at or below them
    def bin_of(f: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(x) for x in cuts[f]]), lambda x: F.col(f) >= x)).alias(f)

    binned = [bin_of(f) for f in cuts]
    cells = (labelled.select(*binned, F.col(bad).cast("long").alias("_bad"),
                             (remainder(F.col(doc_id), 3) == 0).alias("_prune"))
             .groupBy(*cuts, "_prune").agg(F.sum("_bad").alias("_pos"), F.count(F.lit(1)).alias("_n")))
    cells = materialize(cells, "rule-cells")

    def in_bins(rule: Rule) -> Column:
        out = F.lit(True)
        for f, op, value in rule:
            b = cuts[f].index(value) + 1
            out = out & (F.col(f) >= b if op == ">=" else F.col(f) < b)
        return out

    def counts(rows: DataFrame, conditions: list[Rule]) -> list[tuple[int, int]]:
        """(bad rows, rows) under each of a few rules."""
        got = rows.agg(*[F.sum(F.when(in_bins(c), F.col(k)).otherwise(0)).alias(f"{k}{j}")
                         for j, c in enumerate(conditions) for k in ("_pos", "_n")]).first()
        return [(got[f"_pos{j}"] or 0, got[f"_n{j}"] or 0) for j in range(len(conditions))]

    def histogram(rows: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
        """Per feature and bin: (bad rows, rows); one aggregate, one row per feature and bin."""
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in cuts]))
        got: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in cuts}
        for r in (rows.select(pairs.alias("x"), "_pos", "_n").groupBy("x.f", "x.b")
                  .agg(F.sum("_pos").alias("p"), F.sum("_n").alias("n")).collect()):
            got[r["f"]][r["b"]] = (r["p"], r["n"])
        return got

    rules: list[Rule] = []
    all_bad = counts(cells, [[]])[0][0]
    while True:
        left = cells
        for r in rules:
            left = left.filter(~in_bins(r))
        grow, prune = left.filter("not _prune"), left.filter("_prune")
        rule: Rule = []
        while True:
            h = histogram(grow.filter(in_bins(rule)))
            pos0 = sum(p for p, _ in next(iter(h.values())).values())
            n0 = sum(n for _, n in next(iter(h.values())).values())
            if pos0 == 0 or pos0 == n0:
                break
            best, gain = None, 1e-9
            for f, c in cuts.items():
                pos_ge, n_ge = pos0, n0
                for b, value in enumerate(c, 1):
                    p, n = h[f].get(b - 1, (0, 0))
                    pos_ge, n_ge = pos_ge - p, n_ge - n
                    for op, p1, n1 in ((">=", pos_ge, n_ge), ("<", pos0 - pos_ge, n0 - n_ge)):
                        if p1 >= max(2, min_support * all_bad):
                            g = p1 * (log2(p1 / n1) - log2(pos0 / n0))
                            if g > gain:
                                best, gain = (f, op, value), g
            if best is None:
                break
            rule = [*rule, best]
        if not rule:
            break
        # prune from the end: the shortest head of the rule that is best on rows it was not grown on
        heads = [rule[:k] for k in range(1, len(rule) + 1)]
        scored = [((2 * p - n) / n if n else -1.0, p, n, head) for (p, n), head in zip(counts(prune, heads), heads)]
        worth, p, n, head = max(scored, key=lambda s: (s[0], -len(s[3])))
        if n == 0 or p / n < min_precision:
            break
        rules.append(head)
    return rules
