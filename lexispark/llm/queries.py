"""One registered query for each training-data operator, over whole tables,
and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, blocknames, bpe, decontam, langid, linededup, lm, neardup, pii, quality, spelling, tokenfile, trie
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> tuple[str, str]:
    """A public vocabulary file and the pattern of the rank files."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


# ------------------------------------------------------------ 3 line dedup

@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op3_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, i AS n, l[i] AS line,
         translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
repeated AS (
  SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.k IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN r.k IS NULL THEN line END, chr(10) ORDER BY n), '')) AS kept_sha256
FROM lines LEFT JOIN repeated r ON lines.k = r.k
GROUP BY doc_id
"""


# ------------------------------------------------------------ 4 byte-level BPE

@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), path, pattern,
                      columns=("n_tokens", "ids_sha256", "decoded_sha256"))


# ------------------------------------------------------------ 5 decontamination

@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, k=6)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


ORACLE["op5_decontamination"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, grams.n, item_id FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


# ------------------------------------------------------------ 9 token files

@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = vocabulary("word_bpe_49k.json")
    return tokenfile.read_documents(tokenfile.write_token_files(table(spark, sf_dir, "documents"), path, end_id=1, added=True))


# ------------------------------------------------------------ 10 language ID

@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = langid.fit(docs, F.col("doc_id").isNotNull() & (rest != 2))
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


# ------------------------------------------------------------ 7 nearest neighbours

@query
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.pmod(F.col("id"), F.lit(20)) == 0, k=20, factor=1.0)


ORACLE["op7_nearest"] = r"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""


# ------------------------------------------------------------ 8 LM scoring

@query
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    return lm.score(table(spark, sf_dir, "documents"), rest != 1, rest == 2)


# ------------------------------------------------------------ 6 near duplicates

@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8)


# ------------------------------------------------------------ 1 quality

@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no URLs: a document's source is its host, and the language
    section of the source its path."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")), host="source", path="lang")


# ------------------------------------------------------------ 2 personal data

#: For the tables here only; a real run passes its own secret.
DEMO_KEY = b"key of the registered query"


@query
def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"), DEMO_KEY)


# ------------------------------------------------------------ 13 exact dedup

@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocknames.exact_dedup(table(spark, sf_dir, "documents"))


ORACLE["op13_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(bare) AS text_sha256
FROM d WINDOW w AS (PARTITION BY bare ORDER BY n DESC, doc_id)
"""


# ------------------------------------------------------------ 12 conversation trie

@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def crc32_sql(code_points: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a list of bytes (UBIGINT)."""
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))"
    return f"xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], {code_points}), lambda c, b: {step}))"


ORACLE["op12_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
cv AS (
  SELECT c, c - c % 5 AS base, {crc32_sql("list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)")} % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
lent AS (SELECT cv.c, pos, role, text FROM cv JOIN t ON t.c = cv.base AND pos <= h),
cut AS (SELECT c, h, coalesce(k, 0) AS k FROM cv LEFT JOIN (SELECT c, count(*) AS k FROM lent GROUP BY c) USING (c)),
r AS (
  SELECT * FROM lent
  UNION ALL SELECT t.c, k + pos - h, role, text FROM t JOIN cut ON t.c = cut.c AND pos > h),
p AS (
  SELECT c, CAST(pos AS BIGINT) AS d, strlen(text) AS b,
         string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY pos) AS k FROM r
  UNION ALL SELECT c, 0, 0, '' FROM cv),
size AS (SELECT c, max(d) AS n FROM p GROUP BY c),
node AS (
  SELECT d, sha256(k) AS k, min(c) AS conv, count(*) AS n_convs, max(b) AS b,
         sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends
  FROM p JOIN size USING (c) GROUP BY d, k),
own AS (SELECT c, p.d, node.conv FROM p JOIN node ON p.d = node.d AND sha256(p.k) = node.k),
tree AS (SELECT node.*, own.conv AS up FROM node LEFT JOIN own ON own.c = node.conv AND own.d = node.d - 1),
kids AS (SELECT up AS conv, d - 1 AS d, count(*) AS n FROM tree WHERE d > 0 GROUP BY up, d - 1),
below AS (
  SELECT own.conv, own.d, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n_convs - 1) * b) AS saved
  FROM tree LEFT JOIN kids ON kids.conv = tree.conv AND kids.d = tree.d JOIN own ON own.c = tree.conv AND own.d <= tree.d
  GROUP BY own.conv, own.d)
SELECT tree.conv AS conv_id, tree.d AS depth, up AS parent_conv_id, n_convs, coalesce(kids.n, 0) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM tree JOIN below ON below.conv = tree.conv AND below.d = tree.d LEFT JOIN kids ON kids.conv = tree.conv AND kids.d = tree.d
"""


# ------------------------------------------------------------ 11 spelling variants

@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.words(table(spark, sf_dir, "documents")))


_BYTES = ("flatten(list_transform(string_split(concat(doc_id, ':', w), ''), "
          "lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::UBIGINT] ELSE [195, unicode(x) - 64]::UBIGINT[] END))")
ORACLE["op11_spelling_variants"] = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents)
  WHERE length(w) >= 6),
hashed AS (SELECT w, count(*) AS n, {crc32_sql(_BYTES)} AS h FROM runs GROUP BY doc_id, w),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN concat(left(w, CAST(h % length(w) AS BIGINT)), substr(w, CAST(h % length(w) AS BIGINT) + 2))
               ELSE w END AS word, n FROM hashed)
  GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
cuts AS MATERIALIZED (
  SELECT word, i, concat(left(word, i - 1), substr(word, i + 1)) AS cut
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT cuts.word, words.word FROM cuts JOIN words ON words.word = cut
  UNION SELECT words.word, cuts.word FROM cuts JOIN words ON words.word = cut),
near AS (
  SELECT a, b, words.n, count(*) OVER (PARTITION BY a) AS n_near,
         row_number() OVER (PARTITION BY a ORDER BY words.n DESC, b) AS rank
  FROM pairs JOIN words ON words.word = b),
forms AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near.n >= 5 * words.n THEN b END AS form,
         CASE WHEN near.n >= 5 * words.n THEN near.n END AS form_n
  FROM words LEFT JOIN near ON a = word AND rank = 1),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL),
roots AS (SELECT chain.word, chain.at AS root FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
