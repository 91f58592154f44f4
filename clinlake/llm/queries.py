"""The registered queries of these operators, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import (bm25, decontaminate, importance, jaccard_forest, langid, quotation, sentencepiece_backend, spelling, substring,
                          token_counts, token_store, toxicity, warc)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
TOKEN_LIMIT = 512


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_forest.jaccard_join(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copy_of", "copies", "n_links")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_backend.encode_decode(_table(spark, sf_dir, "documents"), PIECES)
    return coded.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_xxhash64"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip", "parity")


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.reply_order(quotation.link_quotes(_table(spark, sf_dir, "conversations")))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.write_archive(_table(spark, sf_dir, "pages")).pages()
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.write_tokens(_table(spark, sf_dir, "documents"), BYTE_BPE, END_ID).read()


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), BYTE_BPE)
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op9_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bm25.search(docs, docs.where(bm25.every_nth(F.col("doc_id")))).select("query_id", "rank", "doc_id", "score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(langid.fold(F.col("doc_id")) != 0), order=F.xxhash64("doc_id"))
    return langid.identify(docs, model).select(
        "row.doc_id", F.coalesce(langid.fold(F.col("row.doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    in_fold = toxicity.fold(F.col("doc_id")) != 0
    scored = toxicity.score(docs, toxicity.fit(docs.where(in_fold), labels.where(in_fold)))
    return scored.select("row.doc_id", F.coalesce(toxicity.fold(F.col("row.doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_ngram_jaccard_join, op2_sentencepiece, op3_quotation_linking, op4_benchmark_decontamination, op5_substring_dedup,
        op6_warc_archive, op7_token_id_output, op8_token_counts, op9_exact_topk_search, op10_language_id, op11_spelling_variants,
        op12_importance_resampling, op13_toxicity)}


_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 10 * c >= 8 * (p.n + q.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
k AS (SELECT x, min(y) AS class_id FROM r GROUP BY x),
c AS (SELECT t, min(doc_id) AS copy_of, count(*) AS copies FROM d GROUP BY t),
l AS (SELECT x, count(*) AS n_links FROM e GROUP BY x)
SELECT d.doc_id, CASE WHEN len(w) > 0 THEN class_id ELSE copy_of END AS class_id, copy_of, copies, coalesce(n_links, 0) AS n_links
FROM d JOIN k ON k.x = d.doc_id JOIN c ON c.t = d.t LEFT JOIN l ON l.x = d.doc_id
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w, least(10, len(w)) AS n FROM benchmark),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b WHERE n > 0)),
p AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT p.doc_id, p.i, p.n, g.item_id FROM p JOIN g ON p.n = g.n AND p.g = g.g),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP5 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM r),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM d),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.j) AS kept, count(*) AS n FROM p ANTI JOIN c ON p.doc_id = c.doc_id AND p.j = c.j GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, h, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS lead FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(d, 5 * CAST(i // 4 AS INTEGER) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = lead THEN NULL ELSE lead END AS refers_to
FROM x
"""


# crc32 of a text (from its hex form): the table of one byte's steps, then byte by byte.
_CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(b, range(0, 8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY b) AS tab
        FROM (SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS b))"""


def _crc32(hexed: str) -> str:
    byte = f"CAST('0x' || substr({hexed}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, length({hexed}) // 2), lambda i: {byte})),"
            " lambda c, b: xor(c >> 8, tab[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295)")


OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
t AS (SELECT doc_id, unnest(regexp_extract_all({_FOLD}, '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
k AS (SELECT w, n, hex(concat(CAST(doc_id AS VARCHAR), ':', w)) AS x FROM (SELECT doc_id, w, count(*) AS n FROM t WHERE length(w) >= 7 GROUP BY ALL)),
h AS (SELECT w, n, {_crc32("x")} AS h FROM k, crc),
v AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
c AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
p AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM c)),
e AS (SELECT a.word, b.word AS other, b.n AS other_n FROM p a JOIN p b ON a.i = b.i AND a.less = b.less AND length(a.word) = length(b.word) AND a.word <> b.word
      UNION SELECT p.word, c.word, c.n FROM p JOIN c ON p.less = c.word
      UNION SELECT c.word, p.word, p.n FROM p JOIN c ON p.less = c.word),
b AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM e GROUP BY word),
f AS MATERIALIZED (SELECT c.word, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * c.n THEN other END AS form,
             CASE WHEN other_n >= 10 * c.n THEN other_n END AS form_n FROM c LEFT JOIN b USING (word)),
r(word, place) AS (SELECT word, word FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.place WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.place AS root, f.n, f.n_near, f.form_n
FROM f JOIN r USING (word) JOIN f g ON g.word = r.place AND g.form IS NULL
"""

OP12 = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents),
i AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
v AS (SELECT w, {_crc32("x")} % 10000 AS k FROM (SELECT w, hex(w) AS x FROM (SELECT w FROM d UNION SELECT w FROM i)), crc),
s AS (SELECT k, count(*) AS s FROM d JOIN v USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM i JOIN v USING (w) GROUP BY k),
z AS (SELECT (SELECT count(*) FROM d) AS sa, (SELECT count(*) FROM i) AS ta),
g AS (SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (sa + 10000) AS DOUBLE) / CAST((coalesce(s, 0) + 1) * (ta + 10000) AS DOUBLE))) AS BIGINT) AS g
      FROM (SELECT DISTINCT k FROM v) LEFT JOIN s USING (k) LEFT JOIN t USING (k), z),
f AS (SELECT doc_id, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS weight FROM d JOIN v USING (w) JOIN g USING (k) GROUP BY doc_id),
o AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM documents LEFT JOIN f USING (doc_id)),
k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM o WHERE n_features >= 20)
SELECT o.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * (SELECT count(*) FROM k) // 100 THEN rank END AS rank
FROM o LEFT JOIN k USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": OP1, "op4_benchmark_decontamination": OP4, "op5_substring_dedup": OP5, "op6_warc_archive": OP6,
            "op11_spelling_variants": OP11, "op12_importance_resampling": OP12}
