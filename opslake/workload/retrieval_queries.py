"""Documents and retrieval on the benchmark tables."""

from pyspark.sql import functions as F

from opslake.plans import kg, pruned_search, quality, retrieval
from opslake.workload.registry import SQL, Tables, query
from opslake.workload.roles import Roles, with_roles

_CHUNKS = """SELECT doc_id, unnest(range(1, greatest(length(text) - 140, 1) + 1, 860)) AS start_pos, text FROM documents WHERE length(text) > 0"""


@query("x1_chunks", f"""
    SELECT doc_id, (start_pos - 1) // 860 + 1 AS chunk_no, start_pos, least(start_pos + 999, length(text)) AS end_pos,
        substring(text, start_pos, 1000) AS chunk FROM ({_CHUNKS})""")
def x1(t: Tables):
    return retrieval.chunk_text(t.documents)


def _questions(t: Tables):
    """One question vector per label: the first of its vectors."""
    return t.embeddings.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))


@query("x2_cosine_topk", """
    WITH q AS (SELECT label AS query_id, arg_min(embedding, vec_id) AS e FROM embeddings GROUP BY label),
    s AS (SELECT query_id, vec_id, list_dot_product(CAST(e AS DOUBLE[]), CAST(embedding AS DOUBLE[]))
            / sqrt(list_dot_product(CAST(e AS DOUBLE[]), CAST(e AS DOUBLE[])) * list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS score
          FROM q, embeddings)
    SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 6""")
def x2(t: Tables):
    return retrieval.cosine_topk(t.embeddings, _questions(t)).withColumn("score", F.round("score", 6))


@query("x2_pruned_topk", SQL["x2_cosine_topk"])
def x2_pruned(t: Tables):
    """The same matches, by cells of vectors of which most are skipped."""
    return pruned_search.pruned_topk(t.embeddings, _questions(t)).withColumn("score", F.round("score", 6))


def _indexed(t: Tables, docs=None):
    """Chunks with the path of their file in JSON, as a document index keeps them."""
    docs = (t.documents if docs is None else docs).select("doc_id", "text", "source")
    chunks = retrieval.chunk_text(docs).select("doc_id", "chunk_no")
    names = t.documents.select("doc_id", "source")
    path = F.concat(F.lit("documents/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return chunks.join(names, "doc_id").select("chunk_no", F.to_json(F.struct(path.alias("object_name"))).alias("attributes"))


_COUNTS = f"SELECT doc_id, count(*) AS n FROM ({_CHUNKS}) GROUP BY doc_id"
# The coverage report is about documents that an index lacks: here the German ones.
_PARTIAL = _COUNTS.replace("WHERE", "WHERE lang <> 'de' AND")


@query("x3_chunks_per_object", f"""
    SELECT 'documents/' || source || '/' || d.doc_id || '.txt' AS source_object, n AS chunk_count FROM documents d JOIN ({_COUNTS}) c ON c.doc_id = d.doc_id""")
def x3_objects(t: Tables):
    return retrieval.chunks_per_object(_indexed(t))


@query("x3_coverage", with_roles(f"""
    SELECT d.document_id, d.version AS catalog_version, split_part(d.file_name, '/', 2) AS file_name, d.file_name AS catalog_file_name,
        coalesce(c.n, 0) AS chunk_count FROM docs d LEFT JOIN ({_PARTIAL}) c ON 'DOC-' || c.doc_id = d.document_id"""))
def x3(t: Tables):
    from opslake.functions.text import base_name

    catalog = Roles(t).documents
    expected = catalog.select("document_id", base_name(F.col("file_name")).alias("file_name"))
    return retrieval.coverage(expected, catalog, _indexed(t, t.documents.where(F.col("lang") != "de")))


@query("x4_id_differences", """
    SELECT id, concat_ws('|', CASE WHEN d THEN 'documents' END, CASE WHEN l THEN 'labels' END, CASE WHEN v THEN 'vectors' END) AS held_by
    FROM (SELECT id, bool_or(s = 1) AS d, bool_or(s = 2) AS l, bool_or(s = 3) AS v FROM (
        SELECT doc_id AS id, 1 AS s FROM documents UNION ALL SELECT doc_id, 2 FROM labels UNION ALL SELECT vec_id, 3 FROM embeddings) GROUP BY id)
    WHERE NOT (d AND l AND v)""")
def x4(t: Tables):
    return quality.mapping_differences({
        "documents": t.documents.select(F.col("doc_id").alias("id")), "labels": t.labels.select(F.col("doc_id").alias("id")),
        "vectors": t.embeddings.select(F.col("vec_id").alias("id"))}, "id")


@query("x5_chunks_of_candidates", with_roles(f"""
    SELECT doc_id, (start_pos - 1) // 860 + 1 AS chunk_no, length(substring(text, start_pos, 1000)) AS n
    FROM ({_CHUNKS}) WHERE 'DOC-' || doc_id IN (SELECT document_id FROM related_documents)"""))
def x5(t: Tables):
    """Chunks of the documents that the graph links to an incident."""
    wanted = kg.related_documents(Roles(t).graph).select(F.regexp_replace("document_id", "^DOC-", "").cast("bigint").alias("doc_id"))
    chosen = retrieval.narrow(t.documents.select("doc_id", "text"), wanted, "doc_id")
    return retrieval.chunk_text(chosen).select("doc_id", "chunk_no", F.length("chunk").cast("bigint").alias("n"))


@query("x6_canonical_terms", "SELECT c_custkey, r_name AS canonical_term FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def x6(t: Tables):
    """Nation names are the synonyms of their region."""
    region_words = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("term")).agg(
        F.concat_ws("|", F.array_sort(F.collect_list("n_name"))).alias("synonyms"))
    buyers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return retrieval.canonical_term(buyers, "n_name", region_words).select("c_custkey", "canonical_term")


@query("x6_terms_in_texts", r"""
    WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS word FROM benchmark),
    t AS (SELECT translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, min('T-' || upper(substr(word, 1, 1))) AS term FROM w GROUP BY 1)
    SELECT doc_id, term, count(*) AS places FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM documents) JOIN t USING (word)
    GROUP BY doc_id, term""")
def x6_texts(t: Tables):
    """Words of the benchmark, by first letter, inside the documents."""
    from opslake.plans.terms import find_terms

    words = t.benchmark.select(F.explode(F.regexp_extract_all("text", F.lit("[a-zA-Z]+"), F.lit(0))).alias("word"))
    terms = words.groupBy(F.concat(F.lit("T-"), F.upper(F.substring("word", 1, 1))).alias("term")).agg(F.concat_ws("|", F.collect_set("word")).alias("synonyms"))
    return find_terms(t.documents, terms).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("places"))


@query("n6_version_in_force", with_roles("""
    SELECT document_id, purpose, version, effective_date FROM (SELECT *, row_number() OVER (PARTITION BY purpose
        ORDER BY effective_date DESC, version DESC, document_id) AS rn FROM docs WHERE effective_date <= '2024-06-30') WHERE rn = 1"""))
def n6(t: Tables):
    docs = Roles(t).documents.select("document_id", "purpose", "version", "effective_date")
    return retrieval.version_at(docs, "purpose", "effective_date", "2024-06-30", tie="document_id")


@query("n6_versions_as_of", with_roles("""
    SELECT o_orderkey, purpose, asked_date, document_id, version, effective_date FROM (
        SELECT q.*, d.document_id, d.version, d.effective_date,
            row_number() OVER (PARTITION BY o_orderkey ORDER BY d.effective_date DESC, d.version DESC, d.document_id) AS rn
        FROM (SELECT o_orderkey, p.purpose, strftime(DATE '2023-12-01' + CAST(o_orderkey % 420 AS INTEGER), '%Y-%m-%d') AS asked_date
              FROM orders JOIN (SELECT purpose, row_number() OVER (ORDER BY purpose) - 1 AS k, count(*) OVER () AS n FROM (SELECT DISTINCT purpose FROM docs)) p
                ON p.k = CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % n END) q
        JOIN docs d ON d.purpose = q.purpose AND d.effective_date <= q.asked_date) WHERE rn = 1"""))
def n6_many(t: Tables):
    """For every order a day and a document family; the first family is asked for by a third of them and more."""
    from pyspark.sql.window import Window

    docs = Roles(t).documents.select("document_id", "purpose", "version", "effective_date")
    families = docs.select("purpose").distinct().withColumn("k", F.row_number().over(Window.orderBy("purpose")) - 1)
    n = families.agg(F.count(F.lit(1))).scalar()
    key = F.col("o_orderkey")
    day = F.date_format(F.date_add(F.lit("2023-12-01").cast("date"), (key % 420).cast("int")), "yyyy-MM-dd")
    orders = t.orders.select("o_orderkey", day.alias("asked_date"), F.when(key % 3 == 0, F.lit(0)).otherwise(key % n).alias("k"))
    asked = orders.join(families, "k").select("o_orderkey", "purpose", "asked_date")
    return retrieval.versions_at(docs, asked, "purpose", "effective_date", "asked_date")
