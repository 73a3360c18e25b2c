"""Registered queries of the training-data operators: each applies one operator, with production
parameters, to its whole table and derives the digest columns from the operator's own output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import ann, bpe, decontam, lmscore, partenum, pii, quality, simhash, suffixdedup, tokenscan, urlrules, vgram, whiten
from snapflow.llm.common import table

#: Rank file of the byte-level BPE operator.
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


#: An id that the vocabulary leaves free: end of document.
EOD = 50256
#: Key of the surrogates; a deployment sets its own.
PII_KEY = "surrogate-key"
#: Quality scores from which documents are kept (rejected ones are three times likelier bad than good), and toxic scores
#: from which they are rejected.
KEEP = (0.25, 0.5)
#: Rules of the URL query: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings that start in an earlier document, removed."""
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), width=50)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by a scan of flat token files for end-of-document ids."""
    return tokenscan.document_counts(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(BPE_RANKS),
                                     public_tokenizers.PATTERN, EOD)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with personal data and secrets replaced by surrogates."""
    found = pii.replace(table(spark, sf_dir, "documents", "doc_id", "text"), PII_KEY)
    return found.select("row.doc_id", "row.text", "n_entities")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark in every whole text."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.digest(decontam.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram stupid-backoff score of every whole text under the model of all others."""
    found = lmscore.score(table(spark, sf_dir, "documents", "doc_id", "text"), order=3, alpha=0.4)
    return found.select("doc_id", "n_words", F.round("avg_log_score", 6).alias("avg_log_score"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    return ann.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0, k=20)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, weak label and score of every whole text, for quality and for toxicity, and the verdict on both."""
    found = quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"), threshold=KEEP)
    return found.withColumnRenamed("row", "doc_id")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winning rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages", "page_id", "url"), rules)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-bit fingerprints of 3-word shingles and the components linked within 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every whole text, and back."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, with_ids=False)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 32 leading components of all, whitened."""
    found = whiten.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=32, scale=64, offset=1_000_000)
    return found.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the whole texts whose sets of 5-word shingles are similar by 80 hundredths."""
    return partenum.near_sets(table(spark, sf_dir, "documents", "doc_id", "text"), size=5, percent=80)


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all whole texts, one code point of some runs left out."""
    words = vgram.vocabulary(table(spark, sf_dir, "documents", "doc_id", "text"), min_length=7, min_count=2, drop=31)
    return vgram.group_variants(words, ratio=10)


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_token_counts, op3_pii, op4_decontamination, op5_lm_scores, op6_ann,
                                   op7_quality, op8_url_rules, op9_simhash, op10_bpe, op11_whitening,
                                   op12_jaccard, op13_variants)}

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
           hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, o, unnest(range(length(h) // 2 - 49)) AS i, unnest([substr(h, 2 * x + 1, 100) FOR x IN range(length(h) // 2 - 49)]) AS s
      FROM d),
g AS (SELECT r, i FROM (SELECT r, i, o, min(o) OVER (PARTITION BY s) AS least FROM w) WHERE o > least),
n AS (SELECT *, CASE WHEN i - lag(i) OVER x <= 50 THEN 0 ELSE 1 END AS new FROM g WINDOW x AS (PARTITION BY r ORDER BY i)),
k AS (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM n),
p AS (SELECT r, span, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY r, span),
q AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM p),
c AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last,
      string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM q JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN c USING (r)""",
    "op8_url_rules": f"""
WITH rules(rh, rp, v) AS (VALUES {_RULES_SQL}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
parts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
urls AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
ranked AS (SELECT u.*, rh || rp AS rule, v, row_number() OVER (PARTITION BY u.rowid ORDER BY length(rh || rp) DESC,
           length(rh) DESC) AS k
           FROM (SELECT row_number() OVER () AS rowid, * FROM urls) u LEFT JOIN rules
           ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM ranked WHERE k = 1""",
    "op4_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_WORDS_SQL} AS ws FROM benchmark)),
w AS (SELECT DISTINCT item_id, n, unnest([array_to_string(ws[x:x + n - 1], ' ') FOR x IN range(1, len(ws) - n + 2)]) AS s FROM b
      WHERE n > 0),
g AS (SELECT r, n, unnest(range(1, len(ws) - n + 2)) AS i,
      unnest([array_to_string(ws[x:x + n - 1], ' ') FOR x IN range(1, len(ws) - n + 2)]) AS s FROM d, (SELECT DISTINCT n FROM w) AS l),
m AS (SELECT r, i, n, item_id FROM g JOIN w USING (n, s)),
h AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM m) GROUP BY r),
f AS (SELECT r, list(DISTINCT CAST(item_id AS VARCHAR)) AS ids FROM m WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(list_sort(ids), ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN f USING (r)""",
    "op5_lm_scores": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\x0C\r]+') AS ws FROM documents),
t AS (SELECT r, unnest(ws) AS c, unnest(range(len(ws))) AS i, len(ws) AS own FROM d),
p AS (SELECT *, lag(c) OVER w AS b, lag(c, 2) OVER w AS a, count(*) OVER () AS n FROM t WINDOW w AS (PARTITION BY r ORDER BY i)),
q AS (SELECT r, i, n - own AS rest,
      count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY r, c) AS n1,
      count(*) OVER (PARTITION BY b, c) - count(*) OVER (PARTITION BY r, b, c) AS n2,
      count(*) OVER (PARTITION BY a, b, c) - count(*) OVER (PARTITION BY r, a, b, c) AS n3 FROM p),
s AS (SELECT *, lag(n1) OVER w AS c1, lag(n2) OVER w AS c2 FROM q WINDOW w AS (PARTITION BY r ORDER BY i)),
v AS (SELECT r, CASE WHEN i >= 2 AND n3 > 0 THEN ln(n3) - ln(c2)
             WHEN i >= 1 AND n2 > 0 THEN ln(n2) - ln(c1) + least(i - 1, 1) * ln(0.4)
             WHEN n1 > 0 THEN ln(n1) - ln(rest) + least(i, 2) * ln(0.4)
             ELSE -ln(rest + 1) + least(i, 2) * ln(0.4) END AS x FROM s),
a AS (SELECT r, avg(x) AS m FROM v GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(m, 6) AS avg_log_score FROM d LEFT JOIN a USING (r)""",
    "op12_jaccard": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\x0C\r]+') AS ws FROM documents),
s AS (SELECT r, doc_id, list_distinct([array_to_string(ws[x:x + 4], ' ') FOR x IN range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)]) AS g
      FROM d),
e AS (SELECT r, doc_id, len(g) AS n, unnest(g) AS w FROM s),
p AS (SELECT a.r AS a, b.r AS b FROM e a JOIN e b USING (w) GROUP BY a.r, b.r
      HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
c AS (SELECT a, b FROM p UNION SELECT c.a, p.b FROM c JOIN p ON c.b = p.a),
m AS (SELECT a, min(d.doc_id) AS least FROM c JOIN d ON d.r = c.b GROUP BY a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, CASE WHEN m.a IS NULL THEN doc_id ELSE least END AS component_id
FROM s LEFT JOIN m ON m.a = s.r""",
    "op13_variants": r"""
WITH RECURSIVE tab AS (SELECT [list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)
         FOR i IN range(256)] AS t),
r AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS raw FROM documents),
l AS (SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k FROM r
      WHERE length(raw) >= 7 GROUP BY 1, 2),
b AS (SELECT w, k, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END
           FOR c IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, '')]) AS s FROM l),
h AS (SELECT w, k, xor(4294967295, list_reduce([4294967295] || s, lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)]))) AS h FROM b, tab),
d AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, 2 + h % length(w)) ELSE w END AS word, k FROM h),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
x AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS s FROM x),
pairs AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS m FROM cut a JOIN cut b USING (i, s) WHERE a.word <> b.word
          UNION SELECT DISTINCT c.word, c.n, v.word, v.n FROM cut c JOIN v ON c.s = v.word
          UNION SELECT DISTINCT v.word, v.n, c.word, c.n FROM cut c JOIN v ON c.s = v.word),
best AS (SELECT word, count(*) AS n_near, min({'less': -m, 'near': encode(near)}) AS b FROM pairs GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 10 * n THEN decode(b.near) END AS form,
      CASE WHEN -b.less >= 10 * n THEN -b.less END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n FROM f JOIN walk USING (word) JOIN f AS e ON e.word = walk.root
WHERE e.form IS NULL""",
}
