"""The registered queries of the corpus operators and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, unit_hash_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import pareto_mix

    return pareto_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken",
                                                                "copies")


ORACLES["op7_pareto_mix"] = rf"""
WITH z AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk
  FROM z GROUP BY source),
s1 AS (
  SELECT *, CASE (rnk - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, row_number() OVER (ORDER BY cap / weight, rnk) AS pos FROM s1),
s3 AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0.0::DOUBLE))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0::DOUBLE)) AS theta
  FROM s2 WINDOW b AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
th AS (SELECT arg_min(theta, pos) AS theta FROM s3 WHERE theta * weight <= cap),
t AS (SELECT source, source_size, coalesce(least(cap, (SELECT theta FROM th) * weight), cap) AS target FROM s3),
d AS (
  SELECT z.doc_id, z.source, z.size, t.source_size, t.target,
         least(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END, 2.0::DOUBLE) AS e,
         {unit_hash_sql("mix-1", "z.doc_id")} AS u
  FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT *, CAST(floor(e) AS BIGINT) AS whole,
         CASE WHEN e - floor(e) > 0 AND size > 0
              THEN (u / (1 - u)) * ((1 - (e - floor(e))) / (e - floor(e))) END AS q FROM d),
f AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY q ASC NULLS LAST, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM e)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN q IS NOT NULL AND upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size AS BIGINT)
         AS taken,
       CAST(whole + CASE WHEN q IS NOT NULL AND upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM f
"""


@query
def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rules import base_failed, learn_rules, rules_column, text_statistics

    stats = materialize(text_statistics(table(spark, sf_dir, "documents")), "rule-stats")
    stats = stats.withColumn("base_failed", base_failed())
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), (F.col("quality") == 0).alias("bad"))
    labelled = stats.join(labels, stats["doc_id"] == labels["_id"]).filter(~F.col("base_failed"))
    rule = rules_column(learn_rules(labelled))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        (~F.col("base_failed") & (rule == 0)).alias("kept"), rule.cast("int").alias("rule"))


@query
def op2_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import known_licenses, license_scan

    scan = license_scan(table(spark, sf_dir, "documents"), known_licenses(spark))
    return scan.withColumn("line_licenses", F.array_join("line_licenses", ","))


def _op2_sql() -> str:
    from .licenses import canonical_sql
    from .license_texts import LICENSE_TEXTS

    known = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in r)) for r in LICENSE_TEXTS)
    return f"""
WITH k AS (
  SELECT sha256(form) AS digest, min(license_id) AS license_id
  FROM (SELECT license_id, {canonical_sql('t')} AS form FROM (VALUES {known}) v(license_id, t))
  WHERE form <> '' GROUP BY 1),
d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, r, sha256({canonical_sql('t')}) AS text_digest FROM d),
l AS (
  SELECT r, count(*) AS n, array_to_string(list_sort(list(DISTINCT k.license_id)), ',') AS ids
  FROM (SELECT r, sha256({canonical_sql('u')}) AS digest FROM (SELECT r, unnest(string_split(t, chr(10))) AS u FROM d)) x
  JOIN k USING (digest) GROUP BY r)
SELECT w.doc_id, w.text_digest, k.license_id, CAST(coalesce(l.n, 0) AS BIGINT) AS n_license_lines,
       coalesce(l.ids, '') AS line_licenses
FROM w LEFT JOIN k ON k.digest = w.text_digest LEFT JOIN l USING (r)
"""


ORACLES["op2_license_digest"] = _op2_sql()

#: The crawl and derivation times that the registered query writes into its records.
CRAWLED, DERIVED = "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z"


@query
def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import derive_records, response_records

    return derive_records(response_records(table(spark, sf_dir, "pages"), CRAWLED), DERIVED)


def _op3_sql() -> str:
    from .warc import BLOCK

    def uuid(x: str) -> str:
        h = f"md5({x})"
        return (f"('urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
                f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")

    hidden = [r"(?s)<!--.*?(?:-->|\z)"] + [rf"(?is)<{x}(?:[\s/][^<>]*)?>.*?(?:</{x}\s*>|\z)" for x in
                                           ("script", "style", "noscript", "template")]
    bare = "h"
    for x in hidden:
        bare = f"regexp_replace({bare}, '{x}', '', 'g')"
    # the entities that the test pages hold; the operator decodes all of them
    plain = lambda x: ("replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), "  # noqa: E731
                       "'&amp;', '&')").format(x)
    tagless = rf"regexp_replace({{}}, '<[/!?A-Za-z][^<>]*>', '', 'g')"
    text = tagless.format(f"regexp_replace(bare, '{BLOCK.pattern}', chr(10), 'g')")
    lines = (rf"list_transform(string_split({plain(text)}, chr(10)), "
             r"lambda x: trim(regexp_replace(x, '[ \t\r\f\v\x{A0}]+', ' ', 'g')))")
    blank = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
    title = blank.format(plain(tagless.format(r"regexp_extract(h, '(?is)<title(?:\s[^<>]*)?>(.*?)</title\s*>', 1)")))
    links = (r"list_transform(regexp_extract_all(bare, '(?is)<a\s(?:[^<>]*?\s)?href\s*=\s*"
             rf"""("[^"]*")', 1), lambda x: 'outlink: ' || trim({plain("substr(x, 2, length(x) - 2)")}) || chr(13) || chr(10))""")
    return rf"""
WITH p AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS h FROM pages),
r AS (SELECT *, 'sha256:' || sha256(h) AS pd, {bare} AS bare FROM p),
s AS (
  SELECT *, {uuid("concat_ws('|', 'response', coalesce(CAST(page_id AS VARCHAR), ''), coalesce(target_uri, ''), pd)")}
      AS rid,
    array_to_string(list_filter({lines}, lambda x: x <> ''), chr(10)) AS txt,
    'source-date: {CRAWLED}' || chr(13) || chr(10) || 'source-payload-digest: ' || pd || chr(13) || chr(10)
      || 'source-length: ' || strlen(h) || chr(13) || chr(10)
      || CASE WHEN regexp_matches(h, '(?is)<title(?:\s[^<>]*)?>(.*?)</title\s*>')
              THEN 'title: ' || {title} || chr(13) || chr(10) ELSE '' END
      || array_to_string({links}, '') AS meta
  FROM r),
m AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type, meta AS block FROM s
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', txt FROM s)
SELECT page_id, record_type, {uuid("record_type || '|' || rid")} AS record_id, rid AS refers_to, target_uri,
       '{DERIVED}' AS warc_date, content_type, CAST(strlen(block) AS BIGINT) AS content_length,
       'sha256:' || sha256(block) AS block_digest, pd AS source_payload_digest,
       'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(h) || chr(13) || chr(10) AS source_headers, block
FROM m
"""


ORACLES["op3_warc_derivatives"] = _op3_sql()


@query
def op8_zstd_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import remainder
    from .langid import fit, predict

    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = fit(docs.filter(~held_out))
    p = docs.select("doc_id", held_out.alias("held_out"), predict(model, F.col("text")).alias("p"))
    return p.select("doc_id", "held_out", F.col("p.best").alias("lang_pred"), "p.score", "p.margin", "p.rejected")


@query
def op1_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import remainder
    from .toxicity import fit, score_text

    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model, rows = fit(docs, labels.filter(remainder(F.col("doc_id"), 5) != 0))
    s = rows.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
                    score_text(model, F.col("text")).alias("s"))
    return s.select("doc_id", "held_out", "s.score", (F.col("s.score") >= 0.5).cast("int").alias("predicted"),
                    F.slice("s.neighbours", 1, 3).alias("neighbours"), F.slice("s.cosines", 1, 3).alias("cosines"))


@query
def op4_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .weak import fit, measured, score

    rows = measured(table(spark, sf_dir, "documents"))
    s = rows.select("doc_id", score(fit(rows), F.col("m")).alias("s"))
    return s.select("doc_id", "s.score", "s.kept", F.col("s.label").alias("weak_label"))


@query
def op10_pigeonhole_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


ORACLES["op5_suffix_dedup"] = """
WITH d AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, s, md5(substr(h, 2 * s + 1, 200)) AS g
      FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM d WHERE len(h) >= 200)),
again AS (SELECT r, s FROM (SELECT r, s, row_number() OVER (PARTITION BY g ORDER BY r, s) AS k FROM w) WHERE k > 1),
begun AS (SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 100 THEN 0 ELSE 1 END AS n FROM again),
numbered AS (SELECT r, s, sum(n) OVER (PARTITION BY r ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM begun),
runs AS (SELECT r, min(s) AS a, max(s) + 100 AS b FROM numbered GROUP BY r, k),
pieces AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS f, a AS t FROM runs
  UNION ALL SELECT r, max(b), 1000000000 FROM runs GROUP BY r),
kept AS (SELECT r, string_agg(substr(h, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS hx FROM pieces JOIN d USING (r) GROUP BY r),
sums AS (SELECT r, sum(b - a) AS removed, count(*) AS spans FROM runs GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(hx, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN sums USING (r)
"""

ORACLES["op6_ngram_jaccard"] = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, r, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s
  FROM t),
x AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.r AS ra, b.r AS rb, a.n AS na, b.n AS nb, count(*) AS c
          FROM x a JOIN x b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
links AS (SELECT ra, rb FROM pairs WHERE 100 * c >= 80 * (na + nb - c)),
e AS (SELECT ra AS s, rb AS t FROM links UNION ALL SELECT rb, ra FROM links),
reach(r, o) AS (SELECT r, r FROM sets UNION SELECT reach.r, e.t FROM reach JOIN e ON e.s = reach.o)
SELECT a.doc_id, CAST(len(a.s) AS BIGINT) AS n_shingles, min(b.doc_id) AS component_id
FROM sets a JOIN reach USING (r) JOIN sets b ON b.r = reach.o GROUP BY a.r, a.doc_id, len(a.s)
"""


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .trie import numbered, rebuilt, trie, turn_hashes

    return trie(*rebuilt(numbered(turn_hashes(table(spark, sf_dir, "conversations")))))


def crc32_sql(bytes_: str) -> str:
    """The CRC-32 of a DuckDB list of byte values."""
    bit = ("list_reduce(list_prepend(xor(acc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: "
           "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda acc, b: {bit}), 4294967295::BIGINT)"


ORACLES["op13_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (
  SELECT c, c - c % 100 AS b, {crc32_sql("list_transform(range(1, strlen(c::VARCHAR) + 1), lambda i: CAST(ord(substr(c::VARCHAR, i, 1)) AS BIGINT))")} % 6 AS h
  FROM (SELECT DISTINCT c FROM t)),
nb AS (SELECT s.c, count(t.i) AS n FROM s LEFT JOIN t ON t.c = s.b AND t.i <= s.h GROUP BY s.c),
u AS (
  SELECT s.c, t.i AS d, t.r, t.x FROM s JOIN t ON t.c = s.b AND t.i <= s.h
  UNION ALL
  SELECT s.c, nb.n + t.i - s.h, t.r, t.x FROM s JOIN nb ON nb.c = s.c JOIN t ON t.c = s.c AND t.i > s.h),
seq AS (
  SELECT c, d, x, list(md5(concat(strlen(r), ':', r, ':', x))) OVER (PARTITION BY c ORDER BY d) AS path FROM u),
m AS (
  SELECT c, d, length(x) AS len, md5(array_to_string(path, ',')) AS k,
         CASE WHEN d = 1 THEN '' ELSE md5(array_to_string(path[1:d - 1], ',')) END AS p FROM seq
  UNION ALL SELECT c, 0, 0, '', NULL FROM s),
ends AS (SELECT c, max(d) AS d FROM m GROUP BY c),
n AS (
  SELECT m.d, m.k, m.p, min(m.c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(m.len) AS own,
         coalesce(string_agg(m.c::VARCHAR, ',' ORDER BY m.c) FILTER (e.d = m.d), '') AS e
  FROM m JOIN ends e ON e.c = m.c GROUP BY m.d, m.k, m.p),
kids AS (SELECT p, count(*) AS n FROM n WHERE p IS NOT NULL GROUP BY p),
below AS (
  SELECT m.d, m.k, sum(n.own) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM n LEFT JOIN kids ON kids.p = n.k JOIN m ON m.c = n.conv_id AND m.d <= n.d GROUP BY m.d, m.k)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs,
       coalesce(kids.n, 0) AS n_children, below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens,
       sha256(n.e) AS ends_sha256
FROM n JOIN below ON below.d = n.d AND below.k = n.k LEFT JOIN kids ON kids.p = n.k
LEFT JOIN n q ON q.k = n.p AND q.d = n.d - 1
"""


@query
def op12_rlz_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rlz import remove_passages

    return remove_passages(table(spark, sf_dir, "documents"))


ORACLES["op12_rlz_passages"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT r, i, md5(string_agg(w, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) AS k,
             count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS n FROM x),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS c FROM g WHERE n = 35) WHERE c > 1),
m AS (
  SELECT x.r, x.i, x.w, max(again.i) OVER (PARTITION BY x.r ORDER BY x.i ROWS UNBOUNDED PRECEDING) AS s
  FROM x LEFT JOIN again ON again.r = x.r AND again.i = x.i),
k AS (SELECT r, count(*) AS kept, string_agg(w, ' ' ORDER BY i) AS t FROM m WHERE s IS NULL OR s + 34 < i GROUP BY r)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(k.kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import counted, spelling_variants

    return spelling_variants(counted(table(spark, sf_dir, "documents")).filter("n >= 3"))


ORACLES["op11_spelling_variants"] = rf"""
WITH RECURSIVE r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x
      FROM r WHERE length(w) >= 5 GROUP BY doc_id, w),
h AS (SELECT w, n, {crc32_sql("list_transform(range(1, len(x) // 2 + 1), lambda i: CAST('0x' || substr(x, 2 * i - 1, 2) AS BIGINT))")} AS h FROM c),
v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2)
                    ELSE w END AS word, n FROM h)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
q AS (SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole,
             substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM p),
e AS (
  SELECT DISTINCT a.word, b.word AS near, b.n FROM q a JOIN q b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT q.word, v.word, v.n FROM q JOIN v ON v.word = q.less
  UNION SELECT v.word, q.word, q.n FROM q JOIN v ON v.word = q.less),
b AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS form, max(n) AS form_n FROM e GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 2 * v.n THEN b.form END AS form,
         CASE WHEN b.form_n >= 2 * v.n THEN b.form_n END AS form_n FROM v LEFT JOIN b USING (word)),
w AS (
  SELECT word, word AS at, form AS next FROM f
  UNION ALL SELECT w.word, f.word, f.form FROM w JOIN f ON f.word = w.next)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n FROM f JOIN w ON w.word = f.word AND w.next IS NULL
"""
