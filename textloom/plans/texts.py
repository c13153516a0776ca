"""Queries of the text and URL functions over documents, pages and the catalogue."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import web as U
from ..operators import curation
from ..session import table
from .sql import plain_trim


def _docs(spark, d):
    return table(spark, d, "documents")


def normalize_ws(spark, d):
    return table(spark, d, "health_pages").select("page_id", F.md5(T.collapse_white(F.col("content"))).alias("text_md5")).distinct()


def slugify(spark, d):
    return _docs(spark, d).select("doc_id", T.slug(F.col("title")).alias("slug"))


def strip_tags(spark, d):
    marked = F.concat(F.lit("<p class=\"x\">"), F.replace("text", F.lit(". "), F.lit(".</p> <p>")), F.lit("</p>"))
    return _docs(spark, d).select("doc_id", F.md5(T.strip_tags(marked)).alias("text_md5"))


def sentence_split(spark, d):
    return _docs(spark, d).select("doc_id", F.size(T.sentences(F.col("text"))).cast("long").alias("n_sentences"), F.md5(F.array_join(T.sentences(F.col("text")), "|")).alias("sentences_md5"))


def sentence_dedup(spark, d):
    once = T.distinct_ignoring_case(T.sentences(F.col("text")))
    return _docs(spark, d).select("doc_id", F.size(once).cast("long").alias("n_kept"), F.md5(F.array_join(once, " ")).alias("text_md5"))


def clean_text(spark, d):
    rows = table(spark, d, "interaction_examples").where("assistant_output is not null").select("interaction_id", T.clean(F.col("assistant_output"), names=T.NAME_FRAGMENTS).alias("x"))
    return rows.select("interaction_id", F.col("x.text").alias("cleaned"), F.col("x.removed").cast("long").alias("n_removed")).distinct()


def first_lines(spark, d):
    return _docs(spark, d).select("doc_id", T.first_line(F.col("text")).alias("summary"), T.word_count(F.col("text")).cast("long").alias("n_words"))


def license_norm(spark, d):
    return table(spark, d, "source_catalog").select(T.normal_license(F.col("license_status")).alias("license")).groupBy("license").agg(F.count(F.lit(1)).alias("n"))


def topic_infer(spark, d):
    about = F.concat_ws(" ", "url", "title")
    return table(spark, d, "health_pages").select("page_id", F.array_join(T.topics(about), ";").alias("topics")).distinct()


def org_infer(spark, d):
    return table(spark, d, "source_catalog").select(T.organisation(F.col("url")).alias("organization")).groupBy("organization").agg(F.count(F.lit(1)).alias("n"))


def name_domain(spark, d):
    return _docs(spark, d).select("source", T.domain_of_name(F.col("source")).alias("domain_group")).distinct()


def url_canonical(spark, d):
    return table(spark, d, "health_pages").select("url", U.canonical(F.col("url"), ()).alias("canonical"), U.canonical(F.col("url")).alias("canonical_kept")).distinct()


def url_host(spark, d):
    return table(spark, d, "health_pages").select("url", U.netloc(F.col("url")).alias("netloc"), U.domain(F.col("url")).alias("domain")).distinct()


def url_filter(spark, d):
    return table(spark, d, "health_pages").groupBy(U.blocked(F.col("url")).alias("blocked")).agg(F.count(F.lit(1)).alias("n"))


def host_counts(spark, d):
    """Pages per host, the five largest hosts."""
    hosts = table(spark, d, "health_pages").select(U.domain(F.col("url")).alias("host"), "page_id").groupBy("host").agg(F.countDistinct("page_id").alias("n"))
    return hosts.orderBy(F.desc("n"), "host").limit(5)


def host_allowed(spark, d):
    """Pages whose host lies under an allowed domain: an equi-join on host suffixes."""
    allowed = spark.createDataFrame([(x,) for x in ("org.example", "health.example", "test")], "suffix string")
    pages = table(spark, d, "health_pages").select("page_id", "url").distinct()
    each = pages.select("page_id", F.explode(U.host_suffixes(U.domain(F.col("url")))).alias("suffix"))
    return each.join(allowed, "suffix", "left_semi").select("page_id").distinct()


def host_cap_first_n(spark, d):
    pages = curation.first_per_key(table(spark, d, "health_pages").select("page_id", "url", "fetched_at"), [F.col("page_id")], [F.col("fetched_at"), F.col("url")])
    pages = pages.withColumn("host", U.domain(F.col("url")))
    return curation.first_n_per_group(pages, ["host"], [F.col("fetched_at"), F.col("page_id")], 3).select("host", "page_id")


def _html(spark, d):
    """Every page's content put into markup: title, language, date, a paragraph a line, and a link a line."""
    p = table(spark, d, "health_pages").where("content is not null").select("page_id", "url", "title", "language", "publication_date", "content").distinct()
    lines = F.transform(F.split("content", "\n"), lambda x: F.translate(x, "<>&\r", ""))
    place = F.when(F.pmod("page_id", F.lit(2)) == 0, F.concat(F.lit('<meta name="citation_publication_date" content="'), F.coalesce("publication_date", F.lit("")), F.lit('">'))).otherwise(F.concat(F.lit("<time datetime='"), F.coalesce("publication_date", F.lit("")), F.lit("'>")))
    head = F.concat(F.coalesce(F.concat(F.lit('<html lang="'), F.col("language"), F.lit('">')), F.lit("<html>")), F.lit("<head><title> "), F.translate(F.coalesce("title", F.lit("")), "<>&\r", ""), F.lit(" </title>"), place, F.lit("</head><body><main>"))
    links = F.transform(lines, lambda x, i: F.concat(F.lit('<a class="l" href="'), F.when(i % 3 == 0, F.concat(F.lit("/topics/"), F.length(x).cast("string"))).when(i % 3 == 1, F.concat(F.lit("more?n="), F.length(x).cast("string"), F.lit("#part"))).otherwise("mailto:desk@site.example"), F.lit('">x</a>')))
    body = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "\n")
    return p.select("page_id", "url", F.concat(head, body, F.array_join(links, " "), F.lit("</main></body></html>")).alias("html"))


def page_fields(spark, d):
    h, u = F.col("html"), F.col("url")
    said = U.html_paragraphs(h)
    return _html(spark, d).select("page_id", U.html_title(h, u).alias("title"), U.html_language(h).alias("language"), U.html_date(h).alias("published"), F.size(said).cast("long").alias("n_paragraphs"), F.length(F.array_join(said, " ")).cast("long").alias("content_len"), F.md5(F.array_join(said, " ")).alias("content_md5"))


def page_links(spark, d):
    """The first 25 links of each page that pass the filters."""
    links = _html(spark, d).select("page_id", "url", F.posexplode(U.first_links(F.col("html"), F.col("url"), 25)).alias("pos", "target"))
    return links.select("page_id", "url", F.col("pos").cast("long").alias("pos"), "target")


def search_links(spark, d):
    """The first three results of each kind among the links of a results page made of the host's pages."""
    pages = table(spark, d, "health_pages").select(U.domain(F.col("url")).alias("host"), "page_id").distinct().groupBy("host").agg(F.sort_array(F.collect_set("page_id")).alias("ids"))
    links = F.flatten(F.transform("ids", lambda i: F.array(F.concat(F.lit("/"), i.cast("string"), F.lit("/")), F.concat(F.lit("/wiki/P"), i.cast("string"), F.lit("x")), F.lit("/wiki/Special:All"))))
    return pages.select("host", F.array_join(U.search_hits(links, "article", 3), " ").alias("articles"), F.array_join(U.search_hits(links, "wiki", 3), " ").alias("wiki"))


def content_gate(spark, d):
    """Pages whose content type is HTML, the type told by the page's language and status."""
    kind = F.when(F.col("http_status") >= 400, "application/json").when(F.col("language").isNull(), "Text/HTML; charset=utf-8").otherwise(F.concat(F.lit("application/xhtml+xml; lang="), "language"))
    return table(spark, d, "health_pages").groupBy(U.is_html(kind).alias("is_html")).agg(F.countDistinct("page_id").alias("n"))


def path_filter(spark, d):
    return table(spark, d, "health_pages").groupBy(U.path_allowed(F.col("url")).alias("allowed")).agg(F.countDistinct("page_id").alias("n"))


_WS = r"[ \t\n\x0B\f\r\x85\p{Z}]+"
_SENT = r"list_filter(list_transform(string_split(regexp_replace(trim({c}), '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"
_ONCE = "list_filter({s}, lambda x, i: list_position(list_transform({s}, lambda y: lower(y)), lower(x)) = i)"


def _q(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


_DROP = " OR ".join(f"regexp_matches(x, {_q(p)})" for p in (*T.DROP_PATTERNS, *T.TEMPLATE_PATTERNS)) + "".join(f" OR contains(x, {_q(n)})" for n in T.NAME_FRAGMENTS)


def _chain(col: str, rules, default: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains({col}, {_q(p)})" for p in ps) + f" THEN {_q(v)}" for v, ps in rules) + f" ELSE {_q(default)} END"


_TOPICS = "list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(a, {_q(p)})" for p in ps) + f" THEN {_q(v)} END" for v, ps in T.TOPICS) + "], lambda x: x IS NOT NULL)"
_DOM = "replace(lower(split_part(split_part(regexp_replace(split_part(url, '#', 1), '^.*://', ''), '/', 1), '?', 1)), 'www.', '')"
_BLOCK = " OR ".join(f"contains(lower(url), {_q(b)})" for b in U.BLOCKED) + " OR ends_with(url, '#')"
_HTML = f"""WITH h AS (SELECT DISTINCT page_id, url, translate(coalesce(title, ''), '<>&' || chr(13), '') AS title, language, coalesce(publication_date, '') AS publication_date, list_transform(string_split(content, chr(10)), lambda x: translate(x, '<>&' || chr(13), '')) AS lines FROM health_pages WHERE content IS NOT NULL),
s AS (SELECT *, list_filter(list_transform(lines, lambda x: trim(regexp_replace(x, {_q(_WS)}, ' ', 'g'))), lambda x: length(x) > 20) AS said FROM h)
"""
QUERIES = {f.__name__: f for f in (normalize_ws, slugify, strip_tags, sentence_split, sentence_dedup, clean_text, first_lines, license_norm, topic_infer, org_infer, name_domain, url_canonical, url_host, url_filter, host_counts, host_allowed, host_cap_first_n, page_fields, page_links, search_links, content_gate, path_filter)}
ORACLE = {
    "normalize_ws": f"SELECT DISTINCT page_id, md5(trim(regexp_replace(content, '{_WS}', ' ', 'g'))) AS text_md5 FROM health_pages",
    "slugify": "SELECT doc_id, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM documents",
    "strip_tags": f"SELECT doc_id, md5(trim(regexp_replace(regexp_replace('<p class=\"x\">' || replace(text, '. ', '.</p> <p>') || '</p>', '<[^>]+>', ' ', 'g'), '{_WS}', ' ', 'g'))) AS text_md5 FROM documents",
    "sentence_split": f"WITH s AS (SELECT doc_id, {_SENT.format(c='text')} AS s FROM documents) SELECT doc_id, len(s) AS n_sentences, md5(array_to_string(s, '|')) AS sentences_md5 FROM s",
    "sentence_dedup": f"WITH s AS (SELECT doc_id, {_SENT.format(c='text')} AS s FROM documents), o AS (SELECT doc_id, {_ONCE.format(s='s')} AS o FROM s) SELECT doc_id, len(o) AS n_kept, md5(array_to_string(o, ' ')) AS text_md5 FROM o",
    "clean_text": f"WITH s AS (SELECT interaction_id, assistant_output AS t, {_SENT.format(c='assistant_output')} AS s FROM interaction_examples WHERE assistant_output IS NOT NULL), k AS (SELECT *, list_filter(s, lambda x: NOT ({_DROP})) AS k FROM s), o AS (SELECT *, {_ONCE.format(s='k')} AS o FROM k) SELECT DISTINCT interaction_id, CASE WHEN len(o) = 0 THEN trim(t) ELSE trim(regexp_replace(array_to_string(o, ' '), '[ \\t\\n\\x0B\\f\\r]{{2,}}', ' ', 'g')) END AS cleaned, len(s) - len(o) AS n_removed FROM o",
    "first_lines": "SELECT doc_id, substr(string_split(text, chr(10))[1], 1, 160) AS summary, CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text), '[ \\t\\n\\x0B\\f\\r]+')) END AS n_words FROM documents",
    "license_norm": "SELECT replace(lower(trim(license_status)), ' ', '-') AS license, count(*) AS n FROM source_catalog GROUP BY 1",
    "topic_infer": f"WITH p AS (SELECT page_id, lower(concat_ws(' ', url, title)) AS a FROM health_pages), t AS (SELECT page_id, {_TOPICS} AS l FROM p), o AS (SELECT page_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM t) SELECT DISTINCT page_id, CASE WHEN len(l) = 0 THEN 'women_health_general' ELSE array_to_string(l, ';') END AS topics FROM o",
    "org_infer": f"SELECT {_chain('lower(url)', T.ORGANISATIONS, 'web')} AS organization, count(*) AS n FROM source_catalog GROUP BY 1",
    "name_domain": f"SELECT DISTINCT source, {_chain('lower(source)', T.NAME_DOMAINS, 'women_health_general')} AS domain_group FROM documents",
    "url_canonical": "WITH u AS (SELECT DISTINCT url, regexp_extract(url, '^([a-z]+)://', 1) AS s, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS h, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p, list_filter(string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_')) AS q, list_filter(string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> '' AND (NOT starts_with(x, 'utm_') OR split_part(x, '=', 1) IN ('utm_medium', 'utm_source', 'utm_campaign'))) AS q2 FROM health_pages), v AS (SELECT url, s || '://' || h || CASE WHEN length(p) > 1 THEN regexp_replace(p, '/$', '') ELSE p END AS r, q, q2 FROM u) SELECT url, r || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical, r || CASE WHEN len(q2) > 0 THEN '?' || array_to_string(q2, '&') ELSE '' END AS canonical_kept FROM v",
    "url_host": f"SELECT DISTINCT url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS netloc, {_DOM} AS domain FROM health_pages",
    "url_filter": f"SELECT ({_BLOCK}) AS blocked, count(*) AS n FROM health_pages GROUP BY 1",
    "host_counts": f"SELECT {_DOM} AS host, count(DISTINCT page_id) AS n FROM health_pages GROUP BY 1 ORDER BY n DESC, host LIMIT 5",
    "host_allowed": f"SELECT DISTINCT page_id FROM health_pages WHERE regexp_matches({_DOM}, '(^|[.])(org[.]example|health[.]example|test)$')",
    "host_cap_first_n": f"WITH f AS (SELECT page_id, url, fetched_at FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY fetched_at, url) AS r FROM health_pages) WHERE r = 1), h AS (SELECT {_DOM} AS host, page_id, fetched_at FROM f) SELECT host, page_id FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY fetched_at, page_id) AS r FROM h) WHERE r <= 3",
    "search_links": f"WITH p AS (SELECT host, list(page_id ORDER BY page_id)[1:3] AS i FROM (SELECT DISTINCT {_DOM} AS host, page_id FROM health_pages) GROUP BY 1) SELECT host, array_to_string(list_transform(i, lambda x: '/' || x || '/'), ' ') AS articles, array_to_string(list_transform(i, lambda x: '/wiki/P' || x || 'x'), ' ') AS wiki FROM p",
    "content_gate": "SELECT contains(CASE WHEN http_status >= 400 THEN 'json' WHEN language IS NULL THEN 'html' ELSE 'xhtml' END, 'html') AS is_html, count(DISTINCT page_id) AS n FROM health_pages GROUP BY 1",
    "path_filter": "SELECT (" + " OR ".join(f"contains(lower(url), {_q(k)})" for k in U.PATH_KEYWORDS) + ") AS allowed, count(DISTINCT page_id) AS n FROM health_pages GROUP BY 1",
    "page_fields": _HTML + f"""SELECT DISTINCT page_id, CASE WHEN trim(title) <> '' THEN trim(regexp_replace(title, {_q(_WS)}, ' ', 'g')) ELSE 'Crawled Page: ' || url END AS title, coalesce(lower(substr(nullif(regexp_extract(language, '^[A-Za-z-]+'), ''), 1, 2)), 'en') AS language,
 CASE WHEN length(publication_date) >= 4 AND NOT regexp_matches(publication_date, '["'']') THEN split_part(trim(publication_date), 'T', 1) ELSE '' END AS published, len(said) AS n_paragraphs, length(array_to_string(said, ' ')) AS content_len, md5(array_to_string(said, ' ')) AS content_md5 FROM s""",
    "page_links": _HTML + """, l AS (SELECT DISTINCT page_id, url, lines FROM s), e AS (SELECT page_id, url, generate_subscripts(lines, 1) - 1 AS i, length(unnest(lines)) AS n FROM l),
 k AS (SELECT page_id, url, row_number() OVER (PARTITION BY page_id, url ORDER BY i) - 1 AS pos, regexp_extract(url, '^[a-z]+://') || lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS root, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p, i, n FROM e WHERE i % 3 < 2)
 SELECT page_id, url, pos, root || CASE WHEN i % 3 = 0 THEN '/topics/' || n ELSE CASE WHEN p = '' THEN '/' ELSE regexp_replace(p, '[^/]*$', '') END || 'more?n=' || n END AS target FROM k WHERE pos < 25""",
}
ORACLE = {k: plain_trim(q) for k, q in ORACLE.items()}
