"""The operators as queries on the benchmark tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm import bm25, bpe, cuckoo, hashtree, lang_crf, lbl, line_crf, notices, ranked, simhash, turn_trie, vector_forest, warc
from opslake.llm.common import crc32_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")


@_query(
    "op1_warc_index",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, octet_length(encode(html)) AS n, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM q
""",
)
def op1(spark: SparkSession, path: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, path, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def rank_file() -> tuple[str, str]:
    """(path, pattern) of the public tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@_query("op2_byte_bpe")
def op2(spark: SparkSession, path: str) -> DataFrame:
    return bpe.round_trip(_table(spark, path, "documents"), *rank_file())


@_query("op3_hash_tree_shards")
def op3(spark: SparkSession, path: str) -> DataFrame:
    placed = hashtree.shard_documents(_table(spark, path, "documents"), shards=24)
    return placed.withColumn("law", F.lit("key"))


@_query("op4_lbl_scores")
def op4(spark: SparkSession, path: str) -> DataFrame:
    return lbl.score_documents(_table(spark, path, "documents"), crc32_mod("doc_id", 5) == 1)


@_query(
    "op5_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
)
def op5(spark: SparkSession, path: str) -> DataFrame:
    return cuckoo.exact_groups(_table(spark, path, "documents"))


@_query("op6_decontamination")
def op6(spark: SparkSession, path: str) -> DataFrame:
    found = bm25.find_leaks(_table(spark, path, "documents"), _table(spark, path, "benchmark"))
    order = lambda a, b: (  # noqa: E731  largest overlap first, then smallest id
        F.when(a["overlap"] > b["overlap"], -1).when(a["overlap"] < b["overlap"], 1)
        .when(a["item_id"] < b["item_id"], -1).when(a["item_id"] > b["item_id"], 1).otherwise(0)
    )
    best = F.element_at(F.array_sort("leaks", order), 1)
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.transform("leaks", lambda x: x["item_id"]).alias("item_ids"),
        "n_passages",
        F.when(F.size("leaks") > 0, best["overlap"]).alias("overlap"),
        F.when(F.size("leaks") > 0, best["question_overlap"]).alias("question_overlap"),
        F.when(F.size("leaks") > 0, best["answer_overlap"]).alias("answer_overlap"),
    )


@_query("op7_simhash_near_dedup")
def op7(spark: SparkSession, path: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, path, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def quality_model(docs: DataFrame, labels: DataFrame) -> line_crf.Model:
    """Learnt from the labels whose crc32 is not 0 modulo 5."""
    return line_crf.fit(docs, labels.where(crc32_mod("doc_id", 5) != 0))


@_query("op8_line_crf_quality")
def op8(spark: SparkSession, path: str) -> DataFrame:
    docs = _table(spark, path, "documents")
    scored = line_crf.score(docs, quality_model(docs, _table(spark, path, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_query("op9_lang_crf")
def op9(spark: SparkSession, path: str) -> DataFrame:
    docs = _table(spark, path, "documents")
    known = lang_crf.fit(docs.where(crc32_mod("doc_id", 4) != 2))
    return lang_crf.identify(docs, known).select(
        "doc_id", F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@_query("op10_license_notices")
def op10(spark: SparkSession, path: str) -> DataFrame:
    return notices.find_notices(_table(spark, path, "documents")).drop("spans")


@_query(
    "op11_ranked_search",
    r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
i AS (
  SELECT row_number() OVER () AS q, item_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
t AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
m AS (SELECT r, doc_id, 75 + (25 * len(terms) * n_docs) // n_terms AS m FROM d, t WHERE len(terms) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, t WHERE term IN (SELECT term FROM i) GROUP BY term, n_docs),
s AS (SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM k WHERE place <= 20
""",
)
def op11(spark: SparkSession, path: str) -> DataFrame:
    return ranked.search(_table(spark, path, "documents"), _table(spark, path, "benchmark"))


@_query(
    "op12_conversation_trie",
    r"""
WITH o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (
  SELECT c, max(pos) AS own, c - c % 20 AS donor,
         -- crc32 of the decimal id: a byte is xored in, then shifted out in eight steps of 0
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
           string_split(c::VARCHAR, ''), lambda x: [256 + ord(x), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))),
           lambda a, x: CASE WHEN x > 0 THEN xor(a, x - 256) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END)) % 4 AS h
  FROM o GROUP BY c),
r AS (
  SELECT l.c, o.pos AS d, role, text FROM l JOIN o ON o.c = l.donor AND o.pos <= l.h
  UNION ALL
  SELECT l.c, o.pos - l.h + least(l.h, coalesce(g.own, 0)), role, text
  FROM l JOIN o ON o.c = l.c AND o.pos > l.h LEFT JOIN l g ON g.c = l.donor),
s AS (SELECT l.c, coalesce(s, []) AS s FROM l LEFT JOIN (SELECT c, list({'role': role, 'text': text} ORDER BY d) AS s FROM r GROUP BY c) USING (c)),
p AS (SELECT c, d, s, min(c) OVER (PARTITION BY d, s[1:d]) AS node FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s)),
n AS (
  SELECT d, node, count(*) AS n_convs,
         max(CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(s[d].text, '[^\x20\x09-\x0D]+')) END) AS words,
         sha256(coalesce(string_agg(c, ',' ORDER BY c) FILTER (d = len(s)), '')) AS ends_sha256
  FROM p GROUP BY d, node),
q AS (SELECT n.*, p.node AS parent FROM n LEFT JOIN p ON p.c = n.node AND p.d = n.d - 1),
k AS (SELECT a.*, (SELECT count(*) FROM q b WHERE b.d = a.d + 1 AND b.parent = a.node) AS n_children FROM q a),
t AS (
  SELECT p.d, p.node, count(*) FILTER (k.n_children = 0) AS n_leaves, sum((k.n_convs - 1) * k.words)::BIGINT AS saved_tokens
  FROM k JOIN p ON p.c = k.node AND p.d <= k.d GROUP BY p.d, p.node)
SELECT k.node AS conv_id, k.d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM k JOIN t USING (d, node)
""",
)
def op12(spark: SparkSession, path: str) -> DataFrame:
    return turn_trie.prefix_trie(_table(spark, path, "conversations"))


@_query(
    "op13_embedding_near_dedup",
    """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT r, vec_id, e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x != 0)) > 0),
l AS (SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.r != b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
w AS (SELECT r AS a, r AS b FROM v UNION SELECT w.a, l.b FROM w JOIN l ON l.a = w.b),
c AS (SELECT w.a AS r, min(v.vec_id) AS component_id FROM w JOIN v ON v.r = w.b GROUP BY w.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = v.r) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN c USING (r)
""",
)
def op13(spark: SparkSession, path: str) -> DataFrame:
    return vector_forest.near_duplicates(_table(spark, path, "embeddings"))
