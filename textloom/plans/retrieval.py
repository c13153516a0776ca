"""Queries over documents: tokens, BM25, ablation, chunks, corpus."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunking as C
from ..operators import retrieval as R
from ..session import table
from .sql import plain_trim


def _docs(spark, d):
    return table(spark, d, "documents")


def _questions(spark, d):
    return table(spark, d, "benchmark_eval_set").select(F.col("benchmark_id").alias("query_id"), F.col("input").alias("text"))


def _weight():
    """The prior weights on this data: documents' types stand for kinds of source and state of validation."""
    kind = F.when(F.col("doc_type") == "leaflet", "official_reference_chunk").when(F.col("doc_type") == "article", "local_markdown_summary").when(F.col("doc_type") == "transcript", "local_docx_manual")
    status = F.when(F.col("doc_type") == "leaflet", "guideline_or_official_source_backed").when(F.col("doc_type") == "forum_post", "needs_manual_review")
    return R.prior(kind, status)


def tokenize_counts(spark, d):
    return _docs(spark, d).select("doc_id", F.size(T.tokens(F.col("text"))).cast("long").alias("n_tokens"))


def term_frequency(spark, d):
    return R.term_counts(_docs(spark, d))


def term_doc_freq(spark, d):
    return R.document_frequency(R.term_counts(_docs(spark, d)))


def doc_length_stats(spark, d):
    return R.length_stats(_docs(spark, d)).select("n_docs", "n_tokens", F.round("avgdl", 6).alias("avgdl"))


def bm25_topk(spark, d):
    return R.search(_docs(spark, d), _questions(spark, d), 5)


def bm25_weighted_topk(spark, d):
    return R.search(_docs(spark, d), _questions(spark, d), 5, _weight())


def retrieval_ablation(spark, d):
    return R.ablation(_docs(spark, d), _questions(spark, d), F.col("source") == "leaflet_archive")


def retrieval_ablation_summary(spark, d):
    return R.ablation_summary(retrieval_ablation(spark, d), _questions(spark, d).where(F.trim("text") != "").count())


def chunk_documents(spark, d):
    made = C.chunks(_docs(spark, d), F.col("doc_id"), F.col("text"), "MD_")
    return made.select(F.col("key").alias("doc_id"), F.col("chunk_no").cast("long").alias("chunk_no"), "chunk_id", "text", "claim_summary")


def _corpus(spark, d):
    ref = table(spark, d, "reference_chunks")
    docs = _docs(spark, d).withColumn("name", F.concat_ws("-", "source", F.col("doc_id").cast("string")))
    md = C.chunks(docs.where("doc_type = 'article'"), F.col("name"), F.col("text"), "MD_")
    manual = C.chunks(docs.where("doc_type = 'transcript'"), F.col("name"), F.col("text"), "DOCX_")
    return C.reference_corpus(ref).unionByName(C.markdown_corpus(md)).unionByName(C.manual_corpus(manual))


def corpus_union(spark, d):
    return _corpus(spark, d).withColumn("topic_tags", F.array_join("topic_tags", ";"))


def corpus_index(spark, d):
    return C.corpus_index(_corpus(spark, d)).withColumn("topic_tags", F.array_join("topic_tags", ";"))


def validation_matrix(spark, d):
    return C.validation_matrix(_corpus(spark, d))


_TOK = "regexp_extract_all(lower(text), '[a-z0-9]+')"


def _bm25(weight: str = "1.0", where: str = "true", name: str = "best", questions: str = "benchmark_eval_set", docs: str = "documents") -> str:
    return f"""
{name}_docs AS (SELECT doc_id, {_TOK} AS toks, {weight} AS prior FROM {docs} WHERE {where}),
{name}_len AS (SELECT doc_id, prior, greatest(len(coalesce(toks, [])), 1) AS dl FROM {name}_docs),
{name}_n AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM {name}_len),
{name}_tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM {name}_docs) GROUP BY ALL),
{name}_df AS (SELECT term, count(*) AS df FROM {name}_tf GROUP BY term),
{name}_q AS (SELECT query_id, term, count(*) AS qf FROM (SELECT benchmark_id AS query_id, unnest(regexp_extract_all(lower(input), '[a-z0-9]+')) AS term FROM {questions}) GROUP BY ALL),
{name}_s AS (SELECT query_id, doc_id, round(sum(qf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) * any_value(prior), 6) AS score
  FROM {name}_q JOIN {name}_tf USING (term) JOIN {name}_df USING (term) JOIN {name}_len USING (doc_id), {name}_n GROUP BY ALL),
{name} AS (SELECT * FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM {name}_s WHERE score > 0) WHERE rank <= 5)"""


_WEIGHT = "CASE doc_type WHEN 'leaflet' THEN 1.8 * 1.4 WHEN 'article' THEN 0.9 WHEN 'transcript' THEN 0.55 WHEN 'forum_post' THEN 0.5 ELSE 1.0 END"
_ABLATION = f"""WITH {_bm25(name="f")}, {_bm25(where="NOT coalesce(source = 'leaflet_archive', false)", name="r")},
fa AS (SELECT query_id, list(doc_id ORDER BY rank) AS a, max(score) AS a_top FROM f GROUP BY 1), ra AS (SELECT query_id, list(doc_id ORDER BY rank) AS b, max(score) AS b_top FROM r GROUP BY 1),
h AS (SELECT DISTINCT query_id FROM f JOIN documents USING (doc_id) WHERE source = 'leaflet_archive'),
per AS (SELECT query_id, query_id IN (SELECT query_id FROM h) AS hit, a[1] IS DISTINCT FROM b[1] AS top1_changed,
  len(list_intersect(coalesce(a, []), coalesce(b, [])))::DOUBLE / greatest(len(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))), 1) AS overlap,
  round(coalesce(a_top, 0) - coalesce(b_top, 0), 6) AS top1_delta FROM fa FULL JOIN ra USING (query_id))"""


def _chunk_sql(where: str, key: str, prefix: str) -> str:
    return f"""
 p AS (SELECT {key} AS key, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS items FROM documents WHERE {where} AND text IS NOT NULL),
 walk AS (
  SELECT key, items, 1 AS i, 1 AS chunk_no, items[1] AS buf, length(items[1]) + 1 AS n, false AS flushed FROM p WHERE len(items) > 0
  UNION ALL
  SELECT key, items, i + 1, CASE WHEN n > 0 AND n + 1 + length(items[i + 1]) > 1200 THEN chunk_no + 1 ELSE chunk_no END,
    CASE WHEN n > 0 AND n + 1 + length(items[i + 1]) > 1200 THEN items[i + 1] ELSE buf || chr(10) || items[i + 1] END,
    CASE WHEN n > 0 AND n + 1 + length(items[i + 1]) > 1200 THEN length(items[i + 1]) ELSE n + length(items[i + 1]) + 1 END, false
  FROM walk WHERE i < len(items)),
 made AS (SELECT key, chunk_no, arg_max(buf, i) AS text FROM walk GROUP BY ALL),
 named AS (SELECT key, chunk_no, '{prefix}' || trim(regexp_replace(lower(key::VARCHAR), '[^a-z0-9]+', '_', 'g'), '_') || '_' || format('{{:03d}}', chunk_no) AS chunk_id, text, substr(string_split(text, chr(10))[1], 1, 160) AS claim_summary FROM made)"""


def _derived_sql(where: str, prefix: str, **v: str) -> str:
    group = "CASE WHEN contains(lower(key), 'addon') OR contains(lower(key), 'final_extension') THEN 'women_health_extension' WHEN contains(lower(key), 'knowledge_base') THEN 'women_health_core' WHEN contains(lower(key), 'reference') OR contains(lower(key), 'menstrual') THEN 'menstrual_reproductive_core' ELSE 'women_health_general' END"
    key = "concat_ws('-', source, doc_id::VARCHAR)"
    return f"""(WITH RECURSIVE {_chunk_sql(where, key, prefix)}
 SELECT chunk_id, key AS source_title, '{v["kind"]}' AS source_type, {group} AS domain_group, {group} AS topic_tags, text, claim_summary, '{v["strength"]}' AS evidence_strength, 'local_workspace' AS license_status, 'mixed' AS geography_scope,
 'mixed' AS life_stage_scope, 'medium' AS safety_relevance, '{v["train"]}' AS trainability, '{v["status"]}' AS validation_status, '{v["notes"]}' AS notes FROM named)"""


_CORPUS = f"""WITH corpus AS (
 SELECT chunk_id, source_id AS source_title, 'official_reference_chunk' AS source_type, coalesce(topic_tags[1], 'unknown') AS domain_group, array_to_string(topic_tags, ';') AS topic_tags, text, claim_summary, 'validated' AS evidence_strength,
  license_status, 'global_basics' AS geography_scope, 'mixed' AS life_stage_scope, 'high' AS safety_relevance, 'retrieval_only' AS trainability, 'guideline_or_official_source_backed' AS validation_status, '' AS notes FROM reference_chunks
 UNION ALL {_derived_sql("doc_type = 'article'", "MD_", kind="local_markdown_summary", strength="summary", train="review_before_training", status="local_summary_needs_source_trace", notes="")}
 UNION ALL {_derived_sql("doc_type = 'transcript'", "DOCX_", kind="local_docx_manual", strength="research_or_manual_summary", train="retrieval_only_until_verified", status="needs_manual_review", notes="Derived from local docx manual; do not treat as ground truth without validation.")})
"""
QUERIES = {f.__name__: f for f in (tokenize_counts, term_frequency, term_doc_freq, doc_length_stats, bm25_topk, bm25_weighted_topk, retrieval_ablation, retrieval_ablation_summary, chunk_documents, corpus_union, corpus_index, validation_matrix)}
ORACLE = {
    "tokenize_counts": f"SELECT doc_id, len({_TOK}) AS n_tokens FROM documents",
    "term_frequency": f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TOK}) AS term FROM documents) GROUP BY ALL",
    "term_doc_freq": f"SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({_TOK}) AS term FROM documents) GROUP BY ALL",
    "doc_length_stats": f"SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_tokens, round(avg(greatest(n, 1)), 6) AS avgdl FROM (SELECT coalesce(len({_TOK}), 0) AS n FROM documents)",
    "bm25_topk": f"WITH {_bm25()} SELECT query_id, doc_id, score, rank::INT AS rank FROM best",
    "bm25_weighted_topk": f"WITH {_bm25(_WEIGHT)} SELECT query_id, doc_id, score, rank::INT AS rank FROM best",
    "retrieval_ablation": _ABLATION + " SELECT * FROM per",
    "retrieval_ablation_summary": _ABLATION + ", m AS (SELECT count(*) AS n FROM benchmark_eval_set WHERE trim(input) <> '') SELECT any_value(n) AS n_queries, count_if(hit) AS n_hit, count_if(top1_changed) AS n_top1_changed, round(avg(overlap), 6) AS mean_overlap, round(sum(top1_delta) / any_value(n), 6) AS mean_top1_delta FROM per, m",
    "chunk_documents": f"WITH RECURSIVE {_chunk_sql('true', 'doc_id', 'MD_')} SELECT key AS doc_id, chunk_no, chunk_id, text, claim_summary FROM named",
    "corpus_union": _CORPUS + "SELECT * FROM corpus",
    "corpus_index": _CORPUS + "SELECT chunk_id, source_title, source_type, domain_group, topic_tags, claim_summary, safety_relevance, trainability FROM corpus",
    "validation_matrix": _CORPUS + "SELECT chunk_id, source_title, evidence_strength, license_status, validation_status, notes FROM corpus",
}
ORACLE = {k: plain_trim(q) for k, q in ORACLE.items()}
