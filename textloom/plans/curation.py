"""Queries of dedup, splits, queues, validation, ingest, export and scoring."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import curation as C
from ..operators import evaluate as E
from ..operators import export as X
from ..operators import ingest as G
from ..operators import retrieval as R
from ..operators import validate as V
from ..session import table
from .retrieval import _bm25
from .sql import plain_trim
from .texts import _TOPICS, _chain


def _int(spark, d):
    return table(spark, d, "interaction_examples")


def _rows(spark, d):
    """Interactions once per id: the first delivery."""
    df = _int(spark, d).select("interaction_id", "data_origin", "review_status", "raw_input", "normalized_case_summary", "assistant_output", "citations", "risk_level", "care_recommendation", "abstained", "human_reviewed", "split", "created_at", "ingested_at", "extracted_features")
    return C.first_per_key(df, [F.col("interaction_id")], [F.col("ingested_at"), F.col("raw_input"), F.col("assistant_output"), F.col("risk_level"), F.col("review_status")])


def exact_dedup_first(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return C.first_per_key(docs, [F.col("h")], [F.col("doc_id")]).select("doc_id", "source")


def dup_groups(spark, d):
    return C.duplicate_groups(table(spark, d, "documents"), F.sha2(F.col("text"), 256), "doc_id")


def norm_key_dedup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return C.first_per_key(docs, [F.lower(F.trim("text"))], [F.col("doc_id")]).select("doc_id")


def split_partition(spark, d):
    return _int(spark, d).select("interaction_id", T.digest_bucket(F.col("interaction_id"), 5).cast("long").alias("bucket")).distinct()


def split_routing(spark, d):
    return _rows(spark, d).select("interaction_id", C.route(F.col("interaction_id"), F.col("review_status"), F.col("risk_level")).alias("target"))


def split_summary(spark, d):
    return split_routing(spark, d).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


def review_queue(spark, d):
    return C.review_queue(_rows(spark, d), "interaction_id", "review_status", "risk_level", ["ingested_at", "interaction_id"], "2026-01-01")


def sample_hash(spark, d):
    return C.hash_sample(table(spark, d, "documents"), "doc_id", 50, "s").select("doc_id", "source")


def first_n_per_split(spark, d):
    return C.first_n_per_group(_rows(spark, d).where("split is not null"), ["split"], [F.col("interaction_id")], 5).select("split", "interaction_id")


def next_source_id(spark, d):
    cat = table(spark, d, "source_catalog")
    return cat.agg((C.max_suffix(cat, "source_id", r"^\s*[Ss][Rr][Cc](\d+)\s*$") + 1).alias("next_number"))


def known_citations(spark, d):
    keys = table(spark, d, "source_catalog").select(F.upper(F.trim("source_id")).alias("key"))
    rows = _rows(spark, d).select("interaction_id", F.transform("citations", lambda c: F.upper(F.trim(c))).alias("citations"))
    return C.known_citations(rows, "interaction_id", "citations", keys, ["SRC00006", "SRC00007"]).withColumn("citations", F.array_join("citations", ";"))


def new_interactions(spark, d):
    """Validation questions that no training question repeats (trimmed, letter case aside)."""
    rows = _rows(spark, d).where("raw_input is not null")
    return C.new_by_text(rows.where("split = 'validation'"), rows.where("split = 'train'"), "raw_input", [F.col("interaction_id")]).select("interaction_id")


def set_review(spark, d):
    rows = _rows(spark, d)
    chosen = C.hash_sample(rows.where("review_status = 'pending_human_review'"), "interaction_id", 25, "r")
    return C.set_review(rows, chosen, "interaction_id", "human_reviewed", ["pending_human_review"]).select("interaction_id", "review_status", "human_reviewed")


def unique_violations(spark, d):
    return V.not_unique(_int(spark, d), "interaction_id", "interaction_id is unique")


def fk_violations(spark, d):
    a = V.orphans(table(spark, d, "reference_chunks"), "chunk_id", "source_id", table(spark, d, "source_catalog"), "source_id", "source_id is in the catalogue")
    b = V.array_orphans(_int(spark, d), "interaction_id", "citations", table(spark, d, "source_catalog"), "source_id", "citations are in the catalogue")
    return V.all_violations(a, b)


def enum_violations(spark, d):
    a = V.unknown_values(_int(spark, d), "interaction_id", "split", ["train", "validation", "safety_train", "test"], "split is known")
    b = V.unknown_values(_int(spark, d), "interaction_id", "risk_level", list(C.LEVELS), "level is known")
    return V.all_violations(a, b)


def required_nulls(spark, d):
    a = V.missing_values(_int(spark, d), "interaction_id", ["raw_input", "assistant_output", "care_recommendation", "risk_level"], "interaction fields are filled")
    b = V.missing_values(table(spark, d, "reference_chunks"), "chunk_id", ["source_id", "text", "claim_summary", "license_status"], "chunk fields are filled")
    return V.all_violations(a, b)


def policy_violations(spark, d):
    """Rows at a high level whose question names no warning sign."""
    high = _int(spark, d).where(F.col("risk_level").isin(*C.HIGH_LEVELS))
    return V.failing(high, "interaction_id", T.contains_any(F.lower(F.col("raw_input")), ("bleed", "faint", "fever", "pain", "dizz")), "high level names a warning sign", "no warning sign")


def citation_coverage(spark, d):
    return V.citation_coverage(_int(spark, d), "citations", table(spark, d, "source_catalog"), "source_id")


def top_sources(spark, d):
    return V.most_common(table(spark, d, "documents"), "source", 8)


def label_distribution(spark, d):
    return V.distribution(_int(spark, d), F.col("risk_level"))


def split_integrity(spark, d):
    """Rows per split and their share of all rows; splits are few."""
    counts = V.distribution(_int(spark, d), F.lower(F.trim("split")))
    total = counts.agg(F.sum("n").alias("t"))
    return counts.join(F.broadcast(total)).select("label", "n", F.round(100 * F.col("n") / F.col("t"), 4).alias("percent"))


def nonempty_ratio(spark, d):
    return V.filled_ratio(_int(spark, d), F.lower(F.trim("split")), "assistant_output")


def _pages(spark, d):
    known = table(spark, d, "reference_chunks").select("content_sha1").where("content_sha1 is not null")
    return G.with_reason(G.prepared(table(spark, d, "health_pages")).distinct(), known)


def ingest_reasons(spark, d):
    return G.skip_counts(_pages(spark, d))


def ingest_sources(spark, d):
    new = _pages(spark, d).where("reason is null")
    cat = table(spark, d, "source_catalog")
    return G.source_rows(new, G.assign_sources(new, cat), "2026-01-01")


def ingest_chunks(spark, d):
    new = _pages(spark, d).where("reason is null")
    return G.chunk_rows(new, G.assign_sources(new, table(spark, d, "source_catalog"))).select("chunk_id", "source_id", F.md5("text").alias("text_md5"), "title")


def chat_export(spark, d):
    """All three messages; the user's is the whole JSON of the question, its features, citations and level."""
    rows = X.chat_rows(X.exportable(_rows(spark, d)))
    said = [F.element_at("messages", k)["content"] for k in (1, 2, 3)]
    return rows.select("interaction_id", F.md5(said[0]).alias("system_md5"), F.md5(said[1]).alias("user_md5"), F.md5(said[2]).alias("assistant_md5"), F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"))


def completion_export(spark, d):
    rows = X.completion_rows(X.exportable(_rows(spark, d)))
    return rows.select("interaction_id", F.md5("prompt").alias("prompt_md5"), "completion")


def metadata_export(spark, d):
    return X.metadata_rows(_rows(spark, d), F.concat_ws(".", F.lit("interactions"), "split")).withColumn("citations", F.array_join("citations", ";", "?"))


def local_prompts(spark, d):
    return X.exportable(_rows(spark, d)).select("interaction_id", F.md5(X.local_prompt(F.col("raw_input"), F.col("normalized_case_summary"))).alias("prompt_md5"))


def benchmark_pass(spark, d):
    """Each benchmark item against the answer of the interaction whose question BM25 ranks first for it."""
    items = table(spark, d, "benchmark_eval_set")
    rows = _rows(spark, d).where("assistant_output is not null")
    hits = R.search(rows.select(F.col("interaction_id").alias("doc_id"), F.col("raw_input").alias("text")), items.select(F.col("benchmark_id").alias("query_id"), F.col("input").alias("text")), 1)
    both = items.join(hits.select(F.col("query_id").alias("benchmark_id"), F.col("doc_id").alias("interaction_id")), "benchmark_id").join(rows, "interaction_id")
    ok = E.labels_met(F.col("expected_labels"), E.label_rules(F.col("assistant_output"), F.col("risk_level"), F.col("care_recommendation"), F.col("extracted_features")))
    return both.select("benchmark_id", "interaction_id", E.level_reached(F.col("risk_level"), F.col("expected_risk")).alias("level_ok"), ok.alias("labels_ok"), E.no_forbidden(F.col("assistant_output"), F.col("must_not_do")).alias("clean"))


def benchmark_rate(spark, d):
    return E.pass_counts(benchmark_pass(spark, d), F.col("level_ok") & F.col("labels_ok") & F.col("clean"))


def ab_score(spark, d):
    return E.compare_answers(_rows(spark, d), "normalized_case_summary", "assistant_output", "interaction_id")


def ab_summary(spark, d):
    return E.compare_summary(ab_score(spark, d))


def ab_improved(spark, d):
    return E.most_improved(ab_score(spark, d), "interaction_id")


_ROWS = """WITH rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY interaction_id ORDER BY ingested_at NULLS FIRST, raw_input NULLS FIRST, assistant_output NULLS FIRST, risk_level NULLS FIRST, review_status NULLS FIRST) AS rn FROM interaction_examples) WHERE rn = 1)
"""
_OK = "coalesce(review_status IN ('human_reviewed', 'clinician_reviewed'), false)"
_BUCKET = "(('0x' || substr(md5(interaction_id), 1, 8))::BIGINT % 5)"
_ROUTE = f"CASE WHEN NOT {_OK} THEN 'review_queue' WHEN coalesce(risk_level IN ('urgent_care', 'emergency_care'), false) THEN 'safety_train' WHEN {_BUCKET} = 0 THEN 'validation' ELSE 'train' END"
_FILLED = "coalesce(trim(raw_input), '') <> '' AND coalesce(trim(assistant_output), '') <> ''"
_W = r"'[ \t\n\x0B\f\r\x85\p{Z}]+'"
_INGEST = rf"""WITH p AS (SELECT DISTINCT page_id, trim(coalesce(CASE WHEN trim(canonical_url) <> '' THEN canonical_url END, CASE WHEN trim(url) <> '' THEN url END, '')) AS page_url, trim(coalesce(title, '')) AS page_title, content AS raw_text,
 trim(regexp_replace(coalesce(content, ''), {_W}, ' ', 'g')) AS clean_text, fetched_at, publication_date FROM health_pages),
h AS (SELECT *, sha1(page_url || chr(10) || clean_text) AS content_sha1 FROM p),
m AS (SELECT *, CASE WHEN page_url = '' OR clean_text = '' THEN 'empty' WHEN length(clean_text) < 150 THEN 'too_short' WHEN content_sha1 IN (SELECT content_sha1 FROM reference_chunks WHERE content_sha1 IS NOT NULL) THEN 'existing'
 WHEN dense_rank() OVER (PARTITION BY content_sha1 ORDER BY fetched_at, page_id) > 1 THEN 'repeated' END AS reason FROM h),
new AS (SELECT * FROM m WHERE reason IS NULL),
known AS (SELECT url AS page_url, min(upper(trim(source_id))) AS source_id FROM source_catalog WHERE url IS NOT NULL GROUP BY 1),
top AS (SELECT coalesce(max(try_cast(nullif(regexp_extract(source_id, '^\s*[Ss][Rr][Cc](\d+)\s*$', 1), '') AS BIGINT)), 0) AS t FROM source_catalog),
fresh AS (SELECT page_url, format('SRC{{:05d}}', row_number() OVER (ORDER BY page_url) + t) AS source_id, true AS is_new FROM (SELECT DISTINCT page_url FROM new WHERE page_url NOT IN (SELECT page_url FROM known)), top),
ids AS (SELECT * FROM fresh UNION ALL SELECT DISTINCT page_url, source_id, false FROM new JOIN known USING (page_url))
"""
_SCORES = "".join(", " + ", ".join("(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{p}')" for p in ps) + f")::BIGINT AS {n}_{k}" for k, ps in E.HEURISTICS.items()) for n, c in (("a", "normalized_case_summary"), ("b", "assistant_output")))


def _words(c: str) -> str:
    return f"CASE WHEN trim(coalesce({c}, '')) = '' THEN 0 ELSE len(regexp_split_to_array(trim({c}), '[ \\t\\n\\x0B\\f\\r]+')) END"


_AB = _ROWS + f", ab AS (SELECT interaction_id{_SCORES}, length(coalesce(assistant_output, '')) - length(coalesce(normalized_case_summary, '')) AS len_delta, {_words('assistant_output')} - {_words('normalized_case_summary')} AS word_delta FROM rows)"
def _any(c: str, words) -> str:
    return " OR ".join(f"contains({c}, '{w}')" for w in words) or "false"


_URGENT = "risk_level IN ('urgent_care', 'emergency_care')"
_RULES = {k: f"({_any('low', a)} OR {_any('care', c)})" for k, (a, c) in E.LABEL_WORDS.items()} | {k: f"risk_level IN {tuple(v) if len(v) > 1 else repr(v).replace(',', '')}" for k, v in E.LABEL_LEVELS.items()}
_RULES["likely_normal_variation"] = "risk_level IN ('normal_variation', 'routine_review') AND contains(low, 'normal')"
_RULES["recommend_urgent_evaluation"] = f"(contains(care, 'urgent') AND contains(care, 'today')) OR {_URGENT} OR contains(low, 'urgent')"
_RULES["possible_pregnancy_related_change"] += " OR coalesce(extracted_features.unprotected_sex_recent, false)"
_RULES["possible_infection_or_sti_related_bleeding"] += " OR coalesce(extracted_features.bleeding_after_sex, false)"
_RULES["possible_postpartum_or_breastfeeding_effect"] = "coalesce(extracted_features.breastfeeding, false) OR extracted_features.postpartum_weeks IS NOT NULL"
_LABELS = " AND ".join(f"(NOT list_contains(expected_labels, '{k}') OR coalesce({v}, false))" for k, v in _RULES.items())
_RANK = "list_position(['normal_variation', 'routine_review', 'prompt_medical_review', 'urgent_care', 'emergency_care'], {c})"
_BENCH = _ROWS + f""", {_bm25(docs="(SELECT interaction_id AS doc_id, raw_input AS text FROM rows WHERE assistant_output IS NOT NULL)")},
b AS (SELECT benchmark_id, expected_risk, expected_labels, must_not_do, rows.*, lower(assistant_output) AS low, lower(coalesce(care_recommendation, '')) AS care FROM benchmark_eval_set JOIN best ON query_id = benchmark_id AND rank = 1 JOIN rows ON doc_id = interaction_id),
passed AS (SELECT benchmark_id, interaction_id, {_RANK.format(c='risk_level')} >= {_RANK.format(c='expected_risk')} AS level_ok, {_LABELS} AS labels_ok, len(list_filter(must_not_do, lambda p: contains(low, lower(p)))) = 0 AS clean FROM b)"""
#: JSON with escapes for what is not ASCII: every such character as its UTF-16 code units
_ASCII = "list_aggregate(list_transform(regexp_extract_all({c}, '(?s).'), lambda x: CASE WHEN unicode(x) < 128 THEN x WHEN unicode(x) < 65536 THEN '\\u' || format('{{:04X}}', unicode(x)) ELSE '\\u' || format('{{:04X}}', 55296 + (unicode(x) - 65536) // 1024) || '\\u' || format('{{:04X}}', 56320 + (unicode(x) - 65536) % 1024) END), 'string_agg', '')"
_FEATURES = "CASE WHEN extracted_features IS NULL THEN '{{}}' ELSE to_json(extracted_features)::VARCHAR END"
_USER = "to_json(struct_pack(question := raw_input, extracted_features := extracted_features, citations_used := coalesce(citations, []), risk_level_target := risk_level))::VARCHAR"
_CHUNKED = r""", items AS (SELECT source_id, content_sha1, page_title, list_filter(list_transform(string_split(raw_text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS items FROM new JOIN ids USING (page_url)),
walk AS (SELECT *, 1 AS i, 1 AS no, items[1] AS buf, length(items[1]) + 1 AS n FROM items WHERE len(items) > 0
 UNION ALL SELECT source_id, content_sha1, page_title, items, i + 1, CASE WHEN n > 0 AND n + 1 + length(items[i + 1]) > 1200 THEN no + 1 ELSE no END,
  CASE WHEN n > 0 AND n + 1 + length(items[i + 1]) > 1200 THEN items[i + 1] ELSE buf || chr(10) || items[i + 1] END, CASE WHEN n > 0 AND n + 1 + length(items[i + 1]) > 1200 THEN length(items[i + 1]) ELSE n + length(items[i + 1]) + 1 END FROM walk WHERE i < len(items)),
made AS (SELECT source_id, content_sha1, page_title, no, arg_max(buf, i) AS text FROM walk GROUP BY ALL)
SELECT source_id || '_' || substr(content_sha1, 1, 8) || '_' || format('{:03d}', no) AS chunk_id, source_id, md5(text) AS text_md5, CASE WHEN page_title <> '' THEN page_title ELSE 'Untitled' END AS title FROM made"""


QUERIES = {
    f.__name__: f
    for f in (
        exact_dedup_first, dup_groups, norm_key_dedup, split_partition, split_routing, split_summary, review_queue, sample_hash, first_n_per_split, next_source_id, known_citations, new_interactions, set_review, unique_violations, fk_violations,
        enum_violations, required_nulls, policy_violations, citation_coverage, top_sources, label_distribution, split_integrity, nonempty_ratio, ingest_reasons, ingest_sources, ingest_chunks, chat_export, completion_export, metadata_export, local_prompts, benchmark_pass, benchmark_rate, ab_score, ab_summary, ab_improved,
    )
}
ORACLE = {
    "exact_dedup_first": "SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1",
    "dup_groups": "SELECT sha256(text) AS fingerprint, count(*) AS n_rows, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "norm_key_dedup": "SELECT min(doc_id) AS doc_id FROM documents GROUP BY lower(trim(text))",
    "split_partition": f"SELECT DISTINCT interaction_id, {_BUCKET} AS bucket FROM interaction_examples",
    "split_routing": _ROWS + f"SELECT interaction_id, {_ROUTE} AS target FROM rows",
    "split_summary": _ROWS + f"SELECT {_ROUTE} AS target, count(*) AS n FROM rows GROUP BY 1",
    "review_queue": _ROWS + f"SELECT format('RQAUTO{{:03d}}', row_number() OVER (ORDER BY ingested_at, interaction_id)) AS queue_id, interaction_id AS origin_record_id, CASE WHEN coalesce(risk_level IN ('urgent_care', 'emergency_care'), false) THEN 'high' ELSE 'medium' END AS severity, 'Unreviewed case requiring quality routing' AS reason, 'open' AS status, '2026-01-01' AS created_at FROM rows WHERE NOT {_OK}",
    "sample_hash": "SELECT doc_id, source FROM documents ORDER BY md5('s' || doc_id::VARCHAR), doc_id LIMIT 50",
    "first_n_per_split": _ROWS + "SELECT split, interaction_id FROM (SELECT split, interaction_id, row_number() OVER (PARTITION BY split ORDER BY interaction_id) AS r FROM rows WHERE split IS NOT NULL) WHERE r <= 5",
    "next_source_id": r"SELECT coalesce(max(try_cast(nullif(regexp_extract(source_id, '^\s*[Ss][Rr][Cc](\d+)\s*$', 1), '') AS BIGINT)), 0) + 1 AS next_number FROM source_catalog",
    "known_citations": _ROWS + ", k AS (SELECT DISTINCT upper(trim(source_id)) AS k FROM source_catalog), e AS (SELECT interaction_id, unnest(citations) AS c, generate_subscripts(citations, 1) AS i FROM rows), f AS (SELECT interaction_id, upper(trim(c)) AS c, min(i) AS i FROM e WHERE upper(trim(c)) IN (SELECT k FROM k) GROUP BY ALL), g AS (SELECT interaction_id, string_agg(c, ';' ORDER BY i) AS citations FROM f GROUP BY 1) SELECT interaction_id, coalesce(g.citations, 'SRC00006;SRC00007') AS citations FROM rows LEFT JOIN g USING (interaction_id)",
    "new_interactions": _ROWS + "SELECT min(interaction_id) AS interaction_id FROM rows WHERE split = 'validation' AND raw_input IS NOT NULL AND lower(trim(raw_input)) NOT IN (SELECT lower(trim(raw_input)) FROM rows WHERE split = 'train' AND raw_input IS NOT NULL) GROUP BY lower(trim(raw_input))",
    "set_review": _ROWS + ", c AS (SELECT interaction_id FROM rows WHERE review_status = 'pending_human_review' ORDER BY md5('r' || interaction_id), interaction_id LIMIT 25) SELECT interaction_id, CASE WHEN interaction_id IN (SELECT interaction_id FROM c) THEN 'human_reviewed' ELSE review_status END AS review_status, CASE WHEN interaction_id IN (SELECT interaction_id FROM c) THEN true ELSE human_reviewed END AS human_reviewed FROM rows",
    "unique_violations": "SELECT 'interaction_id is unique' AS check_name, interaction_id AS key, 'occurs ' || count(*) || ' times' AS message FROM interaction_examples GROUP BY interaction_id HAVING count(*) > 1",
    "fk_violations": "SELECT 'source_id is in the catalogue' AS check_name, chunk_id AS key, 'unknown ' || source_id AS message FROM reference_chunks WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM source_catalog WHERE source_id IS NOT NULL) UNION ALL SELECT 'citations are in the catalogue', interaction_id, 'unknown ' || c FROM (SELECT interaction_id, unnest(citations) AS c FROM interaction_examples) WHERE c IS NOT NULL AND c NOT IN (SELECT source_id FROM source_catalog WHERE source_id IS NOT NULL)",
    "enum_violations": "SELECT 'split is known' AS check_name, interaction_id AS key, 'split=' || split AS message FROM interaction_examples WHERE split NOT IN ('train', 'validation', 'safety_train', 'test') UNION ALL SELECT 'level is known', interaction_id, 'risk_level=' || risk_level FROM interaction_examples WHERE risk_level NOT IN ('normal_variation', 'routine_review', 'prompt_medical_review', 'urgent_care', 'emergency_care')",
    "required_nulls": " UNION ALL ".join(f"SELECT '{n}' AS check_name, {k} AS key, '{c} is missing' AS message FROM {t} WHERE coalesce(trim({c}), '') = ''" for n, t, k, cs in (("interaction fields are filled", "interaction_examples", "interaction_id", ("raw_input", "assistant_output", "care_recommendation", "risk_level")), ("chunk fields are filled", "reference_chunks", "chunk_id", ("source_id", "text", "claim_summary", "license_status"))) for c in cs),
    "policy_violations": "SELECT 'high level names a warning sign' AS check_name, interaction_id AS key, 'no warning sign' AS message FROM interaction_examples WHERE risk_level IN ('urgent_care', 'emergency_care') AND NOT coalesce(regexp_matches(lower(raw_input), 'bleed|faint|fever|pain|dizz'), false)",
    "citation_coverage": "WITH e AS (SELECT unnest(citations) AS c FROM interaction_examples), m AS (SELECT c, c IN (SELECT source_id FROM source_catalog WHERE source_id IS NOT NULL) AS known FROM e) SELECT count(*) AS n_citations, count_if(coalesce(known, false)) AS n_known, count_if(NOT coalesce(known, false)) AS n_unknown FROM m",
    "top_sources": "SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 8",
    "label_distribution": "SELECT risk_level AS label, count(*) AS n FROM interaction_examples GROUP BY 1",
    "split_integrity": "SELECT lower(trim(split)) AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM interaction_examples GROUP BY 1",
    "nonempty_ratio": "SELECT lower(trim(split)) AS grp, count(*) AS n_rows, count_if(coalesce(trim(assistant_output), '') <> '') AS n_filled, round(count_if(coalesce(trim(assistant_output), '') <> '') / count(*), 6) AS ratio FROM interaction_examples GROUP BY 1",
    "ingest_reasons": _INGEST + "SELECT coalesce(reason, 'new') AS reason, count(*) AS n FROM m GROUP BY 1",
    "ingest_sources": _INGEST + f""", first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY fetched_at, page_id) AS r FROM new JOIN fresh USING (page_url)) WHERE r = 1),
t AS (SELECT *, lower(lower(regexp_extract(page_url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)) || CASE WHEN page_title IS NULL THEN '' ELSE ' ' || page_title END) AS a, page_url AS url FROM first),
o AS (SELECT *, {_TOPICS} AS l FROM t)
SELECT source_id, CASE WHEN page_title <> '' THEN page_title ELSE 'Crawled Page ' || source_id END AS title, {_chain("lower(url)", T.ORGANISATIONS, "web")} AS organization, url, 'INTL' AS country,
 CASE WHEN len(l) = 0 THEN 'women_health_general' ELSE array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ';') END AS topic_tags, 'tier2' AS source_tier, 'web_scrape' AS document_type,
 trim(coalesce(publication_date, '')) AS publication_date, '2026-01-01' AS access_date, '2026-01-01' AS last_checked_date, 'retrieval_only' AS license_status, 'false' AS trainable_for_model_flag, 'true' AS retrieval_only_flag FROM o""",
    "ingest_chunks": _INGEST.replace("WITH p", "WITH RECURSIVE p", 1) + _CHUNKED,
    "chat_export": _ROWS + f", e AS (SELECT interaction_id, assistant_output, {_ASCII.format(c=_USER)} AS u FROM rows WHERE {_FILLED}) SELECT interaction_id, md5('{X.CHAT_SYSTEM}') AS system_md5, md5(u) AS user_md5, md5(trim(assistant_output)) AS assistant_md5, 'system,user,assistant' AS roles FROM e",
    "completion_export": _ROWS + f"SELECT interaction_id, md5('{X.COMPLETION_SYSTEM}' || chr(10) || 'Input: ' || raw_input || chr(10) || 'Extracted features: ' || {_ASCII.format(c=_FEATURES)} || chr(10) || 'Target risk: ' || risk_level || chr(10) || 'Assistant:') AS prompt_md5, replace(trim(assistant_output), chr(10), '\\n') AS completion FROM rows WHERE {_FILLED}",
    "metadata_export": _ROWS + "SELECT interaction_id, data_origin, concat_ws('.', 'interactions', split) AS split_source, review_status, risk_level, raw_input, normalized_case_summary, coalesce(human_reviewed, false) AS human_reviewed, care_recommendation, abstained, coalesce(array_to_string(list_transform(citations, lambda x: coalesce(x, '?')), ';'), '') AS citations, risk_level AS label, split FROM rows",
    "local_prompts": _ROWS + f"SELECT interaction_id, md5('Question: ' || coalesce(raw_input, '') || chr(10) || 'Case summary: ' || coalesce(normalized_case_summary, '') || chr(10) || 'Answer:') AS prompt_md5 FROM rows WHERE {_FILLED}",
    "benchmark_pass": _BENCH + " SELECT * FROM passed",
    "benchmark_rate": _BENCH + " SELECT count_if(level_ok AND labels_ok AND clean) AS n_passed, count(*) AS n_total FROM passed",
    "ab_score": _AB + " SELECT * FROM ab",
    "ab_summary": _AB + " SELECT count(*) AS n, " + ", ".join(f"sum({n}_{k})::BIGINT AS {n}_{k}" for n in "ab" for k in E.HEURISTICS) + ", round(avg(len_delta), 6) AS mean_len_delta, round(avg(word_delta), 6) AS mean_word_delta FROM ab",
    "ab_improved": _AB + " SELECT interaction_id, (b_has_follow_up - a_has_follow_up) + 0.5::DOUBLE * (b_has_education_disclaimer - a_has_education_disclaimer) AS gain FROM ab ORDER BY gain DESC, interaction_id LIMIT 5",
}
ORACLE = {k: plain_trim(q) for k, q in ORACLE.items()}
