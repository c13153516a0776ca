"""Queries of sources and sinks: whole tables are written, read back and held against the tables.

Everything is written under the shared folder of ``spark.checkpoint.dir``, in a folder of the run.
"""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..functions import web as U
from ..operators import augment as A
from ..operators import curation as C
from ..operators import evaluate as E
from ..operators import export as X
from ..operators import ingest as G
from ..session import checkpoint_root, map_pandas, table
from ..sources import files as S
from ..sources import paged as P
from ..sources import sinks as K
from ..streaming import ingest as T
from .curation import _CHUNKED, _INGEST, _ROWS, _rows
from .sql import plain_trim


def _place(spark) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/exchange-{uuid.uuid4().hex}"


def _documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "title", "source", "lang")


def _items(spark, d):
    return table(spark, d, "benchmark_eval_set").select("benchmark_id", "scenario", "input", "priority")


def json_lines_kept(spark, d):
    """Overwrite with one half, append the other, read strictly."""
    at, rows = f"{_place(spark)}/j", _rows(spark, d).select("interaction_id", "raw_input", "citations", "abstained")
    half = F.pmod(F.xxhash64("interaction_id"), F.lit(2))
    K.write_json_lines(rows.where(half == 0), at)
    K.write_json_lines(rows.where(half == 1), at, "append")
    got = S.json_lines(spark, at, rows.schema)
    return got.select("interaction_id", F.md5("raw_input").alias("raw_md5"), F.array_join("citations", ";", "?").alias("citations"), "abstained")


def json_lines_lenient(spark, d):
    """Every third line is cut short and dropped on reading; a missing path adds nothing."""
    at, rows = f"{_place(spark)}/j", _documents(spark, d)
    line = F.to_json(F.struct("doc_id", "title"))
    cut = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.substring_index(line, ",", 1)).otherwise(line)
    rows.select(cut.alias("value")).write.text(at)
    schema = "doc_id long, title string"
    return S.json_lines(spark, at, schema, "lenient").unionByName(S.json_lines(spark, f"{at}-none", schema, missing_ok=True))


def csv_kept(spark, d):
    """Two writes of CSV with headers, quotes and line breaks in values; all comes back as strings."""
    at, rows = f"{_place(spark)}/c", table(spark, d, "documents").select("doc_id", F.substring("text", 1, 300).alias("text"), "source")
    K.write_csv(rows.where("doc_id % 2 = 0"), at)
    K.write_csv(rows.where("doc_id % 2 = 1"), at, "append")
    return S.csv_strings(spark, at).select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "source")


def line_files(spark, d):
    """Distinct hosts as sorted lines with a remark, read without it; ids of a CSV as a set."""
    at = _place(spark)
    hosts = table(spark, d, "health_pages").select(U.domain(F.col("url")).alias("h"))
    K.write_sorted_lines(hosts.unionByName(spark.createDataFrame([("# hosts",)], "h string")), "h", f"{at}/l")
    K.write_csv(table(spark, d, "source_catalog").select("source_id", "title"), f"{at}/c")
    ids = S.csv_strings(spark, f"{at}/c").select(F.col("source_id").alias("line")).where("line is not null").distinct()
    return S.text_lines(spark, f"{at}/l", "#").withColumn("kind", F.lit("host")).unionByName(ids.withColumn("kind", F.lit("id")))


def markdown_files(spark, d):
    """A file per item, read as paragraphs in the order of the paths."""
    at, rows = f"{_place(spark)}/md", _items(spark, d)
    K.write_file_per_key(rows.withColumn("text", F.concat_ws("\n\n", F.concat(F.lit("# "), F.col("scenario")), "input")), "benchmark_id", "text", at, ".md")
    return S.markdown_paragraphs(spark, at).select("name", F.size("paragraphs").cast("long").alias("n_paragraphs"), F.md5(F.array_join("paragraphs", "|")).alias("text_md5"))


def _docx(it):
    for pdf in it:
        made = []
        for a, b in zip(pdf["scenario"], pdf["input"], strict=True):
            out = io.BytesIO()
            said = "".join(f"<w:p><w:r><w:t>{x.replace('&', '&amp;').replace('<', '&lt;')}</w:t></w:r></w:p>" for x in (a, b))
            with zipfile.ZipFile(out, "w") as z:
                z.writestr(zipfile.ZipInfo("word/document.xml"), f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{said}</w:body></w:document>')
            made.append(out.getvalue())
        yield pd.DataFrame({"name": pdf["name"].tolist(), "content": made})


def word_files(spark, d):
    """Word-processor files, each twice under different names: of equal bytes the first is read."""
    at, rows = f"{_place(spark)}/d", _items(spark, d)
    twice = rows.select(F.explode(F.array(F.concat(F.lit("a_"), "benchmark_id"), F.concat(F.lit("b_"), "benchmark_id"))).alias("name"), "scenario", "input")
    K.write_file_per_key(map_pandas(twice, _docx, "name string, content binary"), "name", "content", at, ".docx")
    return S.docx_paragraphs(spark, at).select("name", F.md5(F.array_join("paragraphs", "|")).alias("text_md5"))


def _articles(spark, d):
    at, rows = f"{_place(spark)}/x", _items(spark, d)
    xml = F.concat(F.lit("<a><article-title>On <i>"), F.col("scenario"), F.lit("</i></article-title>"), F.when(F.length("input") > 150, F.concat(F.lit("<abstract>\n<p>"), F.col("input"), F.lit("</p></abstract>"))).otherwise(""), F.lit("</a>"))
    K.write_file_per_key(rows.withColumn("xml", xml), "benchmark_id", "xml", at)
    return S.article_xml(spark, at)


def article_files(spark, d):
    """Article files, and the catalogue rows and candidates made of the unknown ones."""
    known = table(spark, d, "benchmark_eval_set").where("priority = 'high'").select(F.concat(F.lit("PMC_"), "benchmark_id").alias("source_id"))
    sources, made = C.article_rows(_articles(spark, d), known)
    return sources.join(made, "source_id").select("source_id", "title", "document_type", "raw_input", "normalized_case_summary", "review_status")


def split_files(spark, d):
    """A folder per split; one of them read back reads no other."""
    at = f"{_place(spark)}/s"
    K.write_splits(_rows(spark, d).select("interaction_id", C.route(F.col("interaction_id"), F.col("review_status"), F.col("risk_level")).alias("split")), at)
    return spark.read.parquet(at).where("split = 'validation'").select("interaction_id")


def versions_kept(spark, d):
    """A dataset derived from itself twice; only the last two versions stay."""
    at, rows = f"{_place(spark)}/v", _documents(spark, d).select("doc_id", "lang")
    K.write_version(rows, at)
    K.write_version(K.current_version(spark, at).withColumn("lang", F.lower("lang")), at)
    K.write_version(K.current_version(spark, at).where("lang is not null"), at)
    K.drop_versions(spark, at)
    return K.current_version(spark, at)


def manifest_file(spark, d):
    at = f"{_place(spark)}/manifest.json"
    K.write_manifest(K.manifest(_documents(spark, d), {"n_documents": F.count(F.lit(1)), "n_sources": F.countDistinct("source")}, run="exchange"), at)
    text = S.whole_files(spark, at).select(F.from_json("text", "n_documents long, n_sources long, run string").alias("m"))
    return text.select("m.*")


def paged_candidates(spark, d):
    """Work records in pages of ten with cursors, one chain per priority."""
    at, rows = _place(spark), _items(spark, d)
    work = F.struct(F.col("benchmark_id").alias("id"), F.col("scenario").alias("title"), F.concat(F.lit("10.1/"), "benchmark_id").alias("doi"), F.length("input").alias("publication_year"), F.array(F.named_struct(F.lit("pmcid"), F.lit("")), F.named_struct(F.lit("pmcid"), F.when(F.length("input") % 2 == 0, F.concat(F.lit("PMC"), "benchmark_id")).otherwise(""))).alias("locations"))
    ranked = rows.select("priority", "benchmark_id", work.alias("w"), (F.row_number().over(C.Window.partitionBy("priority").orderBy("benchmark_id")) - 1).alias("n"))
    pages = ranked.groupBy("priority", F.floor(F.col("n") / 10).alias("page")).agg(F.sort_array(F.collect_list("w")).alias("results"))
    last = pages.withColumn("most", F.max("page").over(C.Window.partitionBy("priority")))
    text = F.to_json(F.struct("results", F.when(F.col("page") < F.col("most"), F.concat(F.lit("c"), (F.col("page") + 1).cast("string"))).alias("next")))
    named = last.select(F.concat_ws("_", "priority", F.when(F.col("page") == 0, "first").otherwise(F.concat(F.lit("c"), F.col("page").cast("string")))).alias("name"), text.alias("text"))
    K.write_file_per_key(named, "name", "text", at, ".json")
    queries = sorted(r[0] for r in rows.select("priority").distinct().collect())  # a handful of queries
    return P.candidates(P.read_pages(spark, "textloom.sources.paged:folder_page", queries, folder=K.folder_of(at)))


def enriched_candidates(spark, d):
    """A record looked up per key, columns filled from it, the resume filter and the licence gate."""
    at, rows = _place(spark), _items(spark, d)
    own = F.when(F.length("scenario") % 3 == 0, F.lit(" CC BY ")).otherwise(F.lit(""))
    work = rows.select(F.col("benchmark_id").alias("doi"), own.alias("license"), F.concat(F.lit("PMC"), "benchmark_id").alias("pmcid"), (F.length("input") % 5 == 0).alias("enriched"))
    said = F.to_json(F.struct(F.when(F.length("input") % 2 == 0, "cc0").otherwise(" ").alias("license"), F.col("scenario").alias("journal")))
    K.write_file_per_key(rows.where(F.length("input") % 7 != 0).withColumn("text", said), "benchmark_id", "text", at, ".json")
    open_ = P.to_enrich(work, refresh=True).drop("enriched")
    found = P.lookup(open_, "doi", "textloom.sources.paged:folder_record", folder=K.folder_of(at))
    got = P.enrich(open_, found.where("value is not null"), "doi", ["license", "journal"], "license string, journal string")
    fine = spark.createDataFrame([("cc-by",), ("CC0",)], "license string")
    return P.eligible(got, fine).select("doi", "license", "journal", "pmcid")


def _page_links(spark, d):
    pages = table(spark, d, "health_pages").select("url").distinct().withColumn("host", U.domain(F.col("url")))
    w = C.Window.partitionBy("host").orderBy("url")
    next_ = pages.select("url", "host", F.array(F.lead("url", 1).over(w), F.lead("url", 2).over(w)).alias("next"))
    return next_.select("url", "host", F.posexplode("next").alias("pos", "target")).where("target is not null")


def crawled_pages(spark, d):
    """Breadth first from the first page of every host; a page links to the next two of its host."""
    links = _page_links(spark, d)
    seeds = table(spark, d, "health_pages").groupBy(U.domain(F.col("url")).alias("host")).agg(F.min("url").alias("url"))
    return P.crawl(seeds, links.select("url", "pos", "target"), 3, per_host=5).withColumn("depth", F.col("depth").cast("long"))


def followable_links(spark, d):
    rows = _page_links(spark, d)
    return rows.select("url", "target", U.followable(F.col("host").endswith("example"), F.col("target"), F.col("pos") + 1, 2, 2).alias("followed"))


def zipped_rows(spark, d):
    """Completions and metadata side by side by their place in the order of ids."""
    rows = X.exportable(_rows(spark, d))
    a = X.completion_rows(rows).select(F.col("interaction_id").alias("a_id"), F.md5("completion").alias("completion_md5"))
    b = X.metadata_rows(rows, F.lit("x")).select(F.col("interaction_id").alias("b_id"), "label", "split")
    return X.zipped(a, b, ["a_id"], ["b_id"])


def highest_level(spark, d):
    """The highest level that cites each source: a fold of levels, order-free."""
    each = _rows(spark, d).select(F.explode("citations").alias("source_id"), "risk_level").where("source_id is not null")
    per = each.groupBy("source_id").agg(F.collect_set("risk_level").alias("l"))
    return per.select("source_id", F.aggregate("l", F.lit("normal_variation"), C.higher_level).alias("level"))


def filled_answers(spark, d):
    """Missing answers filled from a made table, missing flags by defaults, a context paragraph put before."""
    rows = C.with_defaults(_rows(spark, d).select("interaction_id", "assistant_output", "normalized_case_summary", "risk_level", "split", "abstained"), {"abstained": False, "human_reviewed": False})
    made = rows.select("interaction_id", F.concat(F.lit("About: "), F.coalesce("normalized_case_summary", F.lit("your question"))).alias("assistant_output"))
    got = C.fill_missing(rows, made, "interaction_id", ["assistant_output"])
    said = A.context_paragraph([F.when(F.col("risk_level") == level, F.lit(f"Level {k}.")) for k, level in enumerate(C.LEVELS)] + [F.when(F.col("split").isNotNull(), F.concat(F.lit("Split "), F.col("split"), F.lit(".")))], 2)
    return got.select("interaction_id", F.md5(A.prepended(F.col("assistant_output"), said)).alias("answer_md5"), "abstained", "human_reviewed")


def case_summaries(spark, d):
    """The given summary, else what the features say, else the question's beginning."""
    f = "extracted_features."
    result = F.col(f"{f}pregnancy_test_result")
    parts = [
        (F.col(f"{f}missed_periods_count") > 0, F.lit("late period pattern")), (F.col(f"{f}postpartum_weeks").isNotNull(), F.lit("postpartum context")), (F.col(f"{f}breastfeeding"), F.lit("breastfeeding context")),
        (F.col(f"{f}bleeding_after_sex"), F.lit("postcoital bleeding")), (F.col(f"{f}flow_level") == "heavy", F.lit("heavy bleeding")), (result != "unknown", F.concat(F.lit("pregnancy_test="), result)),
    ]
    rows = _rows(spark, d)
    hint = F.when(F.col("data_origin") == "clinical_dataset", F.col("normalized_case_summary"))
    return rows.select("interaction_id", A.summary(hint, parts, F.col("raw_input")).alias("summary"))


_SLOTS = (("Thank you for writing.", "Here is what is known."), ("In short:", "For now:", "To begin with:"), ("Take care.", "Please see a clinician."))


def rebuilt_answers(spark, d):
    rows = _rows(spark, d).where("assistant_output is not null").select("interaction_id", "assistant_output", "split")
    context = F.when(F.col("split").isNotNull(), F.concat(F.lit("For "), F.lower("split"), F.lit(".")))
    return A.rebuilt(rows, "interaction_id", "assistant_output", _SLOTS, ("Please ", " today"), context).select("interaction_id", F.md5("assistant_output").alias("answer_md5"))


def _generated(spark, d):
    """Outputs of a generator around every answer: with a rule, without one, and without anything."""
    rows = _rows(spark, d).where("assistant_output is not null")
    n = F.length("assistant_output")
    text = F.translate("assistant_output", "\r", "")
    tail = F.concat(F.lit("\nPrompt: 12 tokens, "), n.cast("string"), F.lit(".5 tokens-per-sec\nGeneration: 30 tokens, "), (n % 50).cast("string"), F.lit(".25 tokens-per-sec\n"))
    out = F.when(n % 3 == 0, F.concat(F.lit("load\n==========\n"), text, tail)).when(n % 3 == 1, F.concat(text, tail)).otherwise(text)
    return rows.select("interaction_id", out.alias("out"), "normalized_case_summary", (n % 40).cast("double").alias("base_tps"), F.lit(30).alias("n_tokens"), (n % 7).cast("int").alias("base_tokens"))


def parsed_generations(spark, d):
    got = _generated(spark, d).select("interaction_id", E.parse_generation(F.col("out")).alias("p"))
    return got.select("interaction_id", F.md5("p.answer").alias("answer_md5"), "p.gen_tps", "p.prompt_tps")


def speed_deltas(spark, d):
    """A/B rows with differences of tokens and speeds, the latter only where both are known; their means."""
    rows = _generated(spark, d).withColumn("p", E.parse_generation(F.col("out"))).withColumn("answer", F.col("p.answer")).withColumn("tps", F.col("p.gen_tps"))
    return E.compare_summary(E.compare_answers(rows, "normalized_case_summary", "answer", "interaction_id", {"tokens": ("base_tokens", "n_tokens"), "tps": ("base_tps", "tps")})).select("n", "mean_tokens_delta", "mean_tps_delta")


def known_chunks_left_out(spark, d):
    """Incremental chunks: those whose ids are there are not made again."""
    pages = G.with_reason(G.prepared(table(spark, d, "health_pages")).distinct(), table(spark, d, "reference_chunks").select("content_sha1").where("content_sha1 is not null")).where("reason is null")
    made = G.chunk_rows(pages, G.assign_sources(pages, table(spark, d, "source_catalog")))
    known = made.where(F.col("chunk_id").endswith("001")).select("chunk_id")
    return G.chunk_rows(pages, G.assign_sources(pages, table(spark, d, "source_catalog")), known).select("chunk_id")


def _half_streams(spark, at, rows, name):
    """A stream over a folder, run after each half of the rows has been written there."""
    half = F.pmod(F.xxhash64(*rows.columns), F.lit(2))
    for k in (0, 1):
        rows.where(half == k).write.mode("append").parquet(f"{at}/{name}")
        yield spark.readStream.schema(rows.schema).parquet(f"{at}/{name}")


def stream_ingested(spark, d):
    """Two runs of an ingest that keeps each content once and takes up where it stopped."""
    at, rows = _place(spark), table(spark, d, "documents").select("doc_id", "text").where("text is not null")
    for stream in _half_streams(spark, at, rows, "in"):
        T.ingest_new(stream.select("text"), "text", f"{at}/out")
    return T.batches(spark, f"{at}/out").select("content_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        json_lines_kept, json_lines_lenient, csv_kept, line_files, markdown_files, word_files, article_files, split_files, versions_kept, manifest_file, paged_candidates, enriched_candidates, crawled_pages, followable_links, zipped_rows,
        highest_level, filled_answers, case_summaries, rebuilt_answers, parsed_generations, speed_deltas, known_chunks_left_out, stream_ingested,
    )
}
_HOST = "replace(lower(regexp_extract({c}, '//([^/?#]*)', 1)), 'www.', '')"
_LINKS = f"""p AS (SELECT DISTINCT url, {_HOST.format(c='url')} AS host FROM health_pages),
w AS (SELECT url, host, lead(url, 1) OVER o AS t1, lead(url, 2) OVER o AS t2 FROM p WINDOW o AS (PARTITION BY host ORDER BY url)),
l AS (SELECT url, host, 0 AS pos, t1 AS target FROM w WHERE t1 IS NOT NULL UNION ALL SELECT url, host, 1, t2 FROM w WHERE t2 IS NOT NULL)"""
_BLOCK = " OR ".join(f"contains(lower(target), '{b}')" for b in U.BLOCKED) + " OR ends_with(target, '#')"


def _picked(i: int, options) -> str:
    return f"[{', '.join(repr(o) for o in options)}][(('0x' || substr(md5('slot{i}' || interaction_id), 1, 8))::BIGINT % {len(options)}) + 1]"


_WHITE = r"'[ \t\n\x0B\f\r\x85\p{Z}]+'"
_FIT = "SELECT * FROM rows WHERE coalesce(trim(raw_input), '') <> '' AND coalesce(trim(assistant_output), '') <> ''"
_RANKED = "list_position(['normal_variation', 'routine_review', 'prompt_medical_review', 'urgent_care', 'emergency_care'], {c})"
_LEVELS = "['normal_variation', 'routine_review', 'prompt_medical_review', 'urgent_care', 'emergency_care']"
_GEN = _ROWS + ", g AS (SELECT *, length(assistant_output) AS n, trim(replace(assistant_output, chr(13), ''), ' ' || chr(9) || chr(10) || chr(13)) AS a FROM rows WHERE assistant_output IS NOT NULL)"
_DONE = """WITH w AS (SELECT benchmark_id AS doi, CASE WHEN length(scenario) % 3 = 0 THEN ' CC BY ' ELSE '' END AS license, 'PMC' || benchmark_id AS pmcid, length(input) % 5 = 0 AS done, length(input) AS n, scenario FROM benchmark_eval_set),
o AS (SELECT * FROM w WHERE NOT done OR trim(license) = ''),
g AS (SELECT doi, pmcid, scenario AS journal, CASE WHEN n % 2 = 0 THEN 'cc0' ELSE license END AS license FROM o WHERE n % 7 <> 0)
"""
ORACLE = {
    "json_lines_kept": _ROWS + "SELECT interaction_id, md5(raw_input) AS raw_md5, array_to_string(list_transform(citations, lambda x: coalesce(x, '?')), ';') AS citations, abstained FROM rows",
    "json_lines_lenient": "SELECT doc_id, title FROM documents WHERE doc_id % 3 <> 0 OR title IS NULL",
    "csv_kept": "SELECT doc_id::VARCHAR AS doc_id, md5(substr(text, 1, 300)) AS text_md5, source FROM documents",
    "line_files": f"SELECT DISTINCT {_HOST.format(c='url')} AS line, 'host' AS kind FROM health_pages UNION ALL SELECT DISTINCT source_id, 'id' FROM source_catalog WHERE source_id IS NOT NULL",
    "markdown_files": "SELECT benchmark_id AS name, 2 AS n_paragraphs, md5('# ' || scenario || '|' || input) AS text_md5 FROM benchmark_eval_set",
    "word_files": "SELECT 'a_' || benchmark_id AS name, md5(scenario || '|' || input) AS text_md5 FROM benchmark_eval_set",
    "article_files": "SELECT 'PMC_' || benchmark_id AS source_id, 'On ' || scenario AS title, 'full_text_xml' AS document_type, CASE WHEN length(input) > 150 THEN 'Summarize: ' || substr(input, 1, 500) ELSE 'Summarize the article: On ' || scenario END AS raw_input, substr('On ' || scenario, 1, 180) AS normalized_case_summary, 'pending_human_review' AS review_status FROM benchmark_eval_set WHERE coalesce(priority, '') <> 'high'",
    "split_files": _ROWS + "SELECT interaction_id FROM rows WHERE coalesce(review_status IN ('human_reviewed', 'clinician_reviewed'), false) AND NOT coalesce(risk_level IN ('urgent_care', 'emergency_care'), false) AND ('0x' || substr(md5(interaction_id), 1, 8))::BIGINT % 5 = 0",
    "versions_kept": "SELECT doc_id, lower(lang) AS lang FROM documents WHERE lang IS NOT NULL",
    "manifest_file": "SELECT count(*) AS n_documents, count(DISTINCT source) AS n_sources, 'exchange' AS run FROM documents",
    "paged_candidates": "SELECT priority AS query, benchmark_id AS work_id, scenario AS title, '10.1/' || benchmark_id AS doi, length(input)::INT AS publication_year, NULL::VARCHAR AS license, CASE WHEN length(input) % 2 = 0 THEN 'PMC' || benchmark_id END AS pmcid FROM benchmark_eval_set",
    "enriched_candidates": _DONE + "SELECT doi, license, journal, pmcid FROM g WHERE replace(lower(trim(license)), ' ', '-') IN ('cc-by', 'cc0')",
    "crawled_pages": f"""WITH RECURSIVE {_LINKS}, f AS (SELECT url, target FROM l WHERE NOT ({_BLOCK})),
c AS (SELECT min(url) AS url, 0 AS depth FROM p GROUP BY host UNION SELECT f.target, depth + 1 FROM c JOIN f USING (url) WHERE depth < 3),
m AS (SELECT url, min(depth) AS depth FROM c GROUP BY url)
SELECT url, depth FROM (SELECT url, depth, row_number() OVER (PARTITION BY {_HOST.format(c='url')} ORDER BY depth, url) AS r FROM m) WHERE r <= 5""",
    "followable_links": f"WITH {_LINKS} SELECT url, target, ends_with(host, 'example') AND pos + 1 < 2 AND len(string_split(regexp_extract(target, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')) - 1 <= 2 AND NOT ({_BLOCK}) AS followed FROM l",
    "zipped_rows": _ROWS + f", r AS ({_FIT}) SELECT interaction_id AS a_id, md5(replace(trim(assistant_output), chr(10), '\\n')) AS completion_md5, interaction_id AS b_id, risk_level AS label, split FROM r",
    "highest_level": _ROWS + f", e AS (SELECT unnest(citations) AS source_id, risk_level FROM rows) SELECT source_id, {_LEVELS}[coalesce(max({_RANKED.format(c='risk_level')}), 1)] AS level FROM e WHERE source_id IS NOT NULL GROUP BY 1",
    "filled_answers": _ROWS + f""", f AS (SELECT *, CASE WHEN coalesce(trim(assistant_output), '') = '' THEN 'About: ' || coalesce(normalized_case_summary, 'your question') ELSE assistant_output END AS a,
 concat_ws(' ', 'Level ' || ({_RANKED.format(c='risk_level')} - 1) || '.', 'Split ' || split || '.') AS c FROM rows) SELECT interaction_id, md5(CASE WHEN trim(c) = '' OR contains(a, c) THEN a ELSE c || ' ' || a END) AS answer_md5, coalesce(abstained, false) AS abstained, false AS human_reviewed FROM f""",
    "case_summaries": _ROWS + """, s AS (SELECT interaction_id, raw_input, CASE WHEN data_origin = 'clinical_dataset' THEN normalized_case_summary END AS hint, list_filter([CASE WHEN extracted_features.missed_periods_count > 0 THEN 'late period pattern' END, CASE WHEN extracted_features.postpartum_weeks IS NOT NULL THEN 'postpartum context' END,
 CASE WHEN extracted_features.breastfeeding THEN 'breastfeeding context' END, CASE WHEN extracted_features.bleeding_after_sex THEN 'postcoital bleeding' END, CASE WHEN extracted_features.flow_level = 'heavy' THEN 'heavy bleeding' END,
 CASE WHEN extracted_features.pregnancy_test_result <> 'unknown' THEN 'pregnancy_test=' || extracted_features.pregnancy_test_result END], lambda x: x IS NOT NULL) AS p FROM rows)
SELECT interaction_id, CASE WHEN coalesce(hint, '') <> '' THEN hint WHEN len(p) > 0 THEN array_to_string(p, '; ') ELSE substr(raw_input, 1, 140) END AS summary FROM s""",
    "rebuilt_answers": _ROWS + f""", s AS (SELECT interaction_id, split, concat_ws(' ', {_picked(0, _SLOTS[0])}, {_picked(1, _SLOTS[1])}, nullif(trim(regexp_replace(replace(replace(assistant_output, 'Please ', ''), ' today', ''), {_WHITE}, ' ', 'g')), ''), {_picked(2, _SLOTS[2])}) AS b FROM rows WHERE assistant_output IS NOT NULL)
SELECT interaction_id, md5(CASE WHEN split IS NULL OR contains(b, 'For ' || lower(split) || '.') THEN b ELSE 'For ' || lower(split) || '. ' || b END) AS answer_md5 FROM s""",
    "parsed_generations": _GEN + " SELECT interaction_id, md5(nullif(CASE WHEN n % 3 = 0 AND a = '' THEN 'load' || chr(10) || '==========' ELSE a END, '')) AS answer_md5, CASE WHEN n % 3 < 2 THEN (n % 50) + 0.25::DOUBLE END AS gen_tps, CASE WHEN n % 3 < 2 THEN n + 0.5::DOUBLE END AS prompt_tps FROM g",
    "speed_deltas": _GEN + " SELECT count(*) AS n, round(avg(30 - n % 7), 6) AS mean_tokens_delta, round(avg(CASE WHEN n % 3 < 2 THEN (n % 50) + 0.25::DOUBLE - n % 40 END), 6) AS mean_tps_delta FROM g",
    "known_chunks_left_out": _INGEST.replace("WITH p", "WITH RECURSIVE p", 1) + ", x AS (SELECT chunk_id FROM (" + ", ".join(_CHUNKED.split(", ", 1)[1:]).join(("WITH RECURSIVE ", "))")) + " SELECT chunk_id FROM x WHERE NOT ends_with(chunk_id, '001')",
    "stream_ingested": "SELECT DISTINCT sha256(text) AS content_sha256 FROM documents WHERE text IS NOT NULL",
}
ORACLE = {k: plain_trim(q) for k, q in ORACLE.items()}
