"""The queries of problems 1-3 and 5-10, and SQL for those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..session import checkpointed, table
from . import boilerplate, cross_split, eval_leaks, mixing, packing, pairs, personal, site_lines, splitting, tokens

INT = "interaction_examples"


def p1_found(spark, d):
    return cross_split.cross_split_pairs(table(spark, d, INT), "interaction_id", "raw_input", "split")


def p1_report(spark, d):
    return cross_split.cross_split_report(table(spark, d, INT), "interaction_id", "raw_input", "split", "data_origin")


def p1_links(spark, d):
    """One row per linked record: its class of equal texts and the classes of the other side it is linked to."""
    links, members = cross_split.cross_split_links(table(spark, d, INT), "interaction_id", "raw_input", "split")
    both = links.select(F.col("a").alias("k"), F.col("b").alias("o"), F.lit(cross_split.EVAL).alias("side")).unionByName(links.select(F.col("b").alias("k"), F.col("a").alias("o"), F.lit(cross_split.TRAIN).alias("side")))
    n = both.groupBy("k", "side").agg(F.countDistinct("o").alias("n_links"))
    return members.select("id", "k", "side").distinct().join(n, ["k", "side"]).select(F.col("id").alias("interaction_id"), F.col("k").alias("class_id"), F.when(F.col("side") == cross_split.EVAL, "evaluation").otherwise("training").alias("side"), "n_links")


def p2_found(spark, d):
    return pairs.pair_defects(table(spark, d, INT), "interaction_id", "raw_input", "assistant_output").withColumnRenamed("id", "interaction_id")


def p3_found(spark, d):
    """Chunks that come out in more than one piece."""
    pieces = splitting.split_texts(table(spark, d, "reference_chunks"), "chunk_id", "text", whole=False)
    return pieces.where("n_pieces > 1").select(F.col("id").alias("chunk_id")).distinct()


def p3_pieces(spark, d):
    pieces = splitting.split_texts(table(spark, d, "reference_chunks"), "chunk_id", "text")
    return pieces.withColumnRenamed("id", "chunk_id")


def p3_checked(spark, d):
    """Per chunk text: its pieces are within the limit, and put together without their overlaps they are the text."""
    rows = table(spark, d, "reference_chunks").where("text is not null").select(F.struct("chunk_id", F.md5("text").alias("of")).alias("id"), "text").distinct()
    p = splitting.split_texts(rows.withColumn("id", F.to_json("id")), "id", "text").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("piece_no", "n_repeated", "piece"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: F.substring(x["piece"], x["n_repeated"] + 1, F.length(x["piece"]))), "")
    return p.select(F.get_json_object("id", "$.chunk_id").alias("chunk_id"), F.md5(text).alias("text_md5"), F.forall("p", lambda x: F.length(x["piece"]) <= splitting.LIMIT).alias("within"))


_PAGES = ("page_id", "content", ["canonical_url", "url"])


def p5_found(spark, d):
    return site_lines.repeated_lines(table(spark, d, "health_pages"), *_PAGES).select(F.col("page").alias("page_id"), "line_no").distinct()


def p5_lines(spark, d):
    """Every line tested (on four pages of its site or more) with its counts and its ratio."""
    lines, excess = site_lines.line_excess(table(spark, d, "health_pages"), *_PAGES)
    return site_lines.named(lines, excess).select("site", "form", "pages", "site_pages", "outside", F.round("ratio", 4).alias("ratio"), "repeated")


def p5_rejected(spark, d):
    """How many tested lines each of the two conditions alone rejects."""
    _, excess = site_lines.line_excess(table(spark, d, "health_pages"), *_PAGES)
    return excess.groupBy("repeated", "significant").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("pages").alias("n_pages"))


def p5_clean(spark, d):
    return site_lines.without_repeated_lines(table(spark, d, "health_pages"), *_PAGES).withColumnRenamed("page", "page_id")


def p6_leaks(spark, d):
    """Evaluation items held by training records, in full or in part."""
    rows = table(spark, d, INT).where(cross_split.split_side(F.col("split")) == cross_split.TRAIN)
    return eval_leaks.item_leaks(rows, "interaction_id", ["raw_input", "assistant_output"], table(spark, d, "benchmark_eval_set"), "benchmark_id", "input")


def p6_found(spark, d):
    found = p6_leaks(spark, d).where(F.col("run") >= eval_leaks.WINDOW)
    return found.select(F.col("item").alias("benchmark_id"), F.col("id").alias("interaction_id")).distinct()


def _key(spark) -> bytes:
    """The key of the pseudonyms from the configuration; the checks, which set none, have one of their own."""
    return (spark.conf.get("spark.textloom.pseudonym.key", None) or os.environ.get("TEXTLOOM_PSEUDONYM_KEY") or "key of the checks").encode()


def p10_spans(spark, d):
    return personal.personal_spans(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "person_names"))


def p10_found(spark, d):
    return p10_spans(spark, d).select(F.col("id").alias("doc_id"), F.col("kind").alias("pii_type"), "start_pos").distinct()


def p10_clean(spark, d):
    clean = personal.without_personal(table(spark, d, "documents"), "doc_id", "text", _key(spark), table(spark, d, "person_names"))
    return clean.withColumnRenamed("id", "doc_id")


def p10_checked(spark, d):
    """The texts rebuilt from the placeholders' surroundings and the values found: nothing else is changed."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    spans = p10_spans(spark, d).distinct().groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start_pos", "end_pos", "value"))).alias("s"))
    rows = docs.join(spans, docs["doc_id"] == spans["id"], "left")
    piece = F.aggregate(
        F.coalesce("s", F.array().cast("array<struct<start_pos:int,end_pos:int,value:string>>")),
        F.struct(F.lit("").alias("t"), F.lit(0).alias("at")),
        lambda a, x: F.struct(F.concat(a["t"], F.substring(F.col("text"), a["at"] + 1, x["start_pos"] - a["at"]), x["value"]).alias("t"), x["end_pos"].alias("at")),
        lambda a: F.concat(a["t"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))),
    )
    return rows.select("doc_id", F.md5(piece).alias("text_md5"))


_TITLED = ("page_id", "content", "title", ["canonical_url", "url"])


def p7_found(spark, d):
    return boilerplate.page_furniture(table(spark, d, "health_pages"), *_TITLED).select(F.col("page").alias("page_id"), "line_no").distinct()


def p7_main(spark, d):
    return boilerplate.main_body(table(spark, d, "health_pages"), *_TITLED).withColumnRenamed("page", "page_id")


def _sizes(spark, d):
    return checkpointed(tokens.token_counts(table(spark, d, "documents"), "doc_id", "text", "source"))


def p8_packed(spark, d):
    """Every document's place in the containers of each pack."""
    return packing.pack_texts(_sizes(spark, d), table(spark, d, "pack_sizes")).withColumnRenamed("id", "doc_id")


def p8_report(spark, d):
    packs = table(spark, d, "pack_sizes")
    return packing.packing_report(packing.pack_texts(_sizes(spark, d), packs), packs)


def p8_checked(spark, d):
    """Per pack and document: placed once and whole, cut only where it is larger than the container, and no container too full."""
    packs = table(spark, d, "pack_sizes").distinct()
    placed = packing.pack_texts(_sizes(spark, d), packs).join(F.broadcast(packs), "pack_name")
    full = placed.groupBy("pack_name", "container").agg((F.sum(F.col("n_tokens") + F.col("separator_tokens")) <= F.max(F.col("capacity_tokens") + F.col("separator_tokens"))).alias("fits"))
    per = placed.join(full, ["pack_name", "container"]).groupBy("pack_name", "id").agg(F.bool_and("fits").alias("fits"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"), F.max("capacity_tokens").alias("c"), F.countDistinct("part_no").alias("parts"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end"))
    whole = (F.col("n") == F.col("parts")) & (F.col("end") == F.col("t")) & (F.col("n") == F.ceil(F.col("t") / F.col("c")))
    return per.select("pack_name", F.col("id").alias("doc_id"), "fits", whole.alias("whole"))


def p9_mixed(spark, d):
    """The documents drawn for each slot of each mix."""
    return mixing.mix_sources(_sizes(spark, d), table(spark, d, "mix_targets"))[0].withColumnRenamed("id", "doc_id")


def p9_report(spark, d):
    return mixing.mix_sources(_sizes(spark, d), table(spark, d, "mix_targets"))[1]


def p9_checked(spark, d):
    """The report computed again from what was drawn: no record used too often, tokens and shares as reported."""
    targets = table(spark, d, "mix_targets").select("mix_name", "source", "max_repeats").distinct()
    drawn, report = mixing.mix_sources(_sizes(spark, d), table(spark, d, "mix_targets"))
    per = drawn.groupBy("mix_name", "source", "id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t")).groupBy("mix_name", "source").agg(F.max("n").alias("most"), F.sum("t").alias("t"))
    rows = report.join(per, ["mix_name", "source"], "left").join(targets, ["mix_name", "source"])
    right = (F.coalesce("t", F.lit(0)) == F.col("tokens")) & (F.coalesce("most", F.lit(0)) == F.col("most_repeats"))
    return rows.select("mix_name", "source", "target_share", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_cap"), right.alias("as_reported"))


QUERIES = {"p1_links": p1_links, "p3_checked": p3_checked, "p8_checked": p8_checked, "p9_checked": p9_checked, "p10_checked": p10_checked, "p8_packed": p8_packed, "p8_report": p8_report, "p9_mixed": p9_mixed, "p9_report": p9_report, "p7_found": p7_found, "p7_main": p7_main, "p10_found": p10_found, "p10_clean": p10_clean, "p6_found": p6_found, "p6_leaks": p6_leaks, "p5_found": p5_found, "p5_lines": p5_lines, "p5_rejected": p5_rejected, "p5_clean": p5_clean, "p3_found": p3_found, "p3_pieces": p3_pieces, "p2_found": p2_found, "p1_found": p1_found, "p1_report": p1_report}
_P5 = r"""
WITH pages AS (
  SELECT page_id, content, regexp_replace(regexp_replace(lower(regexp_extract(coalesce(canonical_url, url), '//([^/?#]*)', 1)), ':[0-9]+$', ''), '^www\.', '') AS site FROM health_pages),
lines AS (
  SELECT page_id, site, i AS line_no, trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '#', 'g'), '[^\p{L}#]+', ' ', 'g')) AS form
  FROM (SELECT page_id, site, unnest(string_split(content, chr(10))) AS l, generate_subscripts(string_split(content, chr(10)), 1) AS i FROM pages WHERE content IS NOT NULL)),
n AS (SELECT site, count(DISTINCT page_id) AS n FROM pages GROUP BY site),
k AS (SELECT site, form, count(DISTINCT page_id) AS k FROM lines WHERE regexp_matches(form, '\p{L}') GROUP BY ALL)
SELECT DISTINCT page_id, line_no::INT AS line_no FROM lines JOIN k USING (site, form) JOIN n USING (site) WHERE k >= 4 AND k >= 0.2 * n
"""
_P5_CLEAN = (
    _P5.split("SELECT DISTINCT page_id, line_no")[0]
    + """, bad AS (SELECT site, form FROM k JOIN n USING (site) WHERE k >= 4 AND k >= 0.2 * n),
texts AS (SELECT DISTINCT page_id, site, content FROM pages),
cut AS (SELECT page_id, site, content, unnest(string_split(content, chr(10))) AS l, generate_subscripts(string_split(content, chr(10)), 1) AS i FROM texts WHERE content IS NOT NULL),
marked AS (SELECT *, (site, trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '#', 'g'), '[^\\p{L}#]+', ' ', 'g'))) IN (SELECT (site, form) FROM bad) AS gone FROM cut)
SELECT page_id, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text, count_if(gone)::INT AS n_removed FROM marked GROUP BY page_id, site, content
UNION ALL SELECT page_id, NULL, NULL FROM texts WHERE content IS NULL"""
)
_P5_LINES = (
    _P5.split("SELECT DISTINCT page_id, line_no")[0]
    + """, t AS (SELECT site, form, k, n, k >= 4 AND k >= 0.2 * n AS repeated FROM k JOIN n USING (site)),
o AS (SELECT form, coalesce(sum(k) FILTER (NOT repeated), 0) AS stray FROM t GROUP BY form), a AS (SELECT sum(n) AS total FROM n),
x AS (SELECT site, form, k::DOUBLE AS k1, n::DOUBLE AS n1, (stray - CASE WHEN repeated THEN 0 ELSE k END)::DOUBLE AS k2, (total - n)::DOUBLE AS n2, repeated FROM t JOIN o USING (form), a WHERE k >= 4),
y AS (SELECT *, CASE WHEN n2 > 0 THEN (k1 + k2) / (n1 + n2) ELSE 1 / n1 END AS p FROM x),
g AS (SELECT *, 2 * (CASE WHEN k1 > 0 THEN k1 * ln(k1 / n1 / p) ELSE 0 END + CASE WHEN n1 > k1 THEN (n1 - k1) * ln((n1 - k1) / n1 / (1 - p)) ELSE 0 END + CASE WHEN k2 > 0 THEN k2 * ln(k2 / n2 / p) ELSE 0 END + CASE WHEN n2 > k2 THEN (n2 - k2) * ln((n2 - k2) / n2 / (1 - p)) ELSE 0 END) AS g FROM y)
SELECT site, form, k1::BIGINT AS pages, n1::BIGINT AS site_pages, k2::BIGINT AS outside, round(CASE WHEN n2 > 0 AND k1 / n1 <= k2 / n2 THEN 0 ELSE g END, 4) AS ratio, repeated FROM g"""
)
#: words after the folding of full-width forms, the only compatibility forms in these tables; the second engine has no NFKC
_WIDE, _PLAIN = "".join(map(chr, range(0xFF10, 0xFF5B))), "".join(map(chr, range(0x30, 0x7B)))
_FOLDED = f"regexp_extract_all(lower(translate(regexp_replace({{c}}, '[­​-‏⁠-⁤﻿᠎]', '', 'g'), '{_WIDE}', '{_PLAIN}')), '[\\p{{{{L}}}}\\p{{{{N}}}}]+')"
_GRAMS = "unnest(list_transform(range(1, greatest(len(w) - 8, 1)), lambda i: array_to_string(w[i:i + 9], ' ')))"
_P6 = f"""WITH b AS (SELECT benchmark_id, {_FOLDED.format(c='input')} AS w FROM benchmark_eval_set), bg AS (SELECT DISTINCT benchmark_id, {_GRAMS} AS g FROM b WHERE len(w) >= 10),
t AS (SELECT interaction_id, {_FOLDED.format(c='t')} AS w FROM (SELECT interaction_id, unnest([raw_input, assistant_output]) AS t FROM interaction_examples WHERE regexp_replace(lower(split), '^\\s+|\\s+$', '', 'g') IN ('train', 'safety_train')) WHERE t IS NOT NULL),
tg AS (SELECT interaction_id, {_GRAMS} AS g FROM t WHERE len(w) >= 10)
SELECT DISTINCT benchmark_id, interaction_id FROM tg JOIN bg USING (g)"""
_MIXES = "SELECT DISTINCT mix_name, source, target_share, true AS within_cap, true AS as_reported FROM mix_targets WHERE target_share > 0"
ORACLE: dict[str, str] = {
    "p3_checked": "SELECT DISTINCT chunk_id, md5(text) AS text_md5, true AS within FROM reference_chunks WHERE text IS NOT NULL",
    "p8_checked": "SELECT DISTINCT pack_name, doc_id, true AS fits, true AS whole FROM documents, pack_sizes WHERE text <> ''",
    "p9_checked": _MIXES,
    "p10_checked": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "p6_found": _P6,
    "p5_lines": _P5_LINES, "p5_found": _P5, "p5_clean": _P5_CLEAN, "p3_found": "SELECT DISTINCT chunk_id FROM reference_chunks WHERE length(text) > 1200"}
