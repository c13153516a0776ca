"""BM25 over a corpus for a stated set of queries, and what changes when a source is left out.

The corpus is read once for the statistics (length, document frequency of the queries' terms) and
once for the scores. Queries are the small side: their terms, and for each term the queries that have
it with their weights, go to the tasks in blocks. A task looks the words of its documents up in those,
multiplies postings by postings of queries as two sparse matrices -- the work is the number of
(document, term, query) matches -- and passes on its own best k per query, so what is shuffled is k
rows per query and task and not a row per matching pair.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import checkpointed, map_pandas

K1, B = 1.5, 0.75
BLOCK_QUERIES = 2000
# Prior weights by kind of source and by state of validation; any other counts 1.
SOURCE_WEIGHTS = {"official_reference_chunk": 1.8, "local_markdown_summary": 0.9, "local_docx_manual": 0.55}
VALIDATION_WEIGHTS = {"guideline_or_official_source_backed": 1.4, "local_summary_needs_source_trace": 0.8, "needs_manual_review": 0.5}

_TOKEN = re.compile("[a-z0-9]+")


def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, term, tf)."""
    rows = docs.select(F.col(key).alias("doc_id"), F.explode(tokens(F.col(text))).alias("term"))
    return rows.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def length_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: n_docs, n_tokens, avgdl; a document without tokens has length 1."""
    n = F.coalesce(F.size(tokens(F.col(text))), F.lit(0))
    return docs.select(n.alias("n")).agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens"), F.avg(F.greatest("n", F.lit(1)).cast("double")).alias("avgdl"))


def prior(source_type: Column, status: Column) -> Column:
    def weight(c, table):
        m = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
        return F.coalesce(F.try_element_at(m, c), F.lit(1.0))

    return weight(source_type, SOURCE_WEIGHTS) * weight(status, VALIDATION_WEIGHTS)


class _Best:
    """The best k per query so far: scores fall, ids rise."""

    def __init__(self, n_queries: int, k: int):
        self.k, self.q, self.id, self.s = k, np.zeros(0, np.int64), None, np.zeros(0)

    def add(self, q: np.ndarray, ids: np.ndarray, s: np.ndarray) -> None:
        if self.id is not None:
            q, ids, s = np.concatenate((self.q, q)), np.concatenate((self.id, ids)), np.concatenate((self.s, s))
        order = np.lexsort((ids, -s, q))
        q, ids, s = q[order], ids[order], s[order]
        first = np.concatenate(([True], q[1:] != q[:-1])) if len(q) else np.zeros(0, bool)
        nth = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        keep = nth < self.k
        self.q, self.id, self.s = q[keep], ids[keep], s[keep]


#: documents scored at a time, and cells of a dense block of scores
SCORED, CELLS = 2000, 1 << 22


def _score(it, block, k: int, average: dict[str, float]):
    """The best k per query for each prior and statistics in ``block``; rows are (doc_id, text, prior, rest)."""
    names, terms, sides = block.value
    best = {side: _Best(len(names), k) for side in sides}
    for whole in it:
        for a in range(0, len(whole), SCORED):
            pdf = whole.iloc[a : a + SCORED]
            rows, cols, tfs, size = [], [], [], np.ones(len(pdf))
            for i, t in enumerate(pdf["text"]):
                found = _TOKEN.findall(t.lower()) if isinstance(t, str) else []
                size[i] = len(found) or 1
                for w, tf in Counter(filter(terms.__contains__, found)).items():
                    rows.append(i)
                    cols.append(terms[w])
                    tfs.append(tf)
            if not rows:
                continue
            rows, cols, tfs = np.array(rows), np.array(cols), np.array(tfs, float)
            ids, prior, rest = pdf["doc_id"].to_numpy(), pdf["prior"].to_numpy(float), pdf["rest"].to_numpy(bool)
            for side, (start, query, weight) in sides.items():
                at = np.flatnonzero(rest[rows]) if side == "rest" else np.arange(len(rows))
                if not len(at):
                    continue
                r, c, tf = rows[at], cols[at], tfs[at]
                value = tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[r] / average[side]))
                many = start[c + 1] - start[c]
                for lo, hi in _stretches(r, many):
                    n = many[lo:hi]
                    at_q = np.arange(int(n.sum())) + np.repeat(start[c[lo:hi]] - (np.cumsum(n) - n), n)
                    doc0 = int(r[lo])
                    cell = (np.repeat(r[lo:hi], n) - doc0) * len(names) + query[at_q]
                    got = np.bincount(cell, weights=np.repeat(value[lo:hi], n) * weight[at_q], minlength=0)
                    hit = np.flatnonzero(got)
                    d, q = np.divmod(hit, len(names))
                    s = np.round(got[hit] * prior[d + doc0], 6)
                    best[side].add(q[s > 0], ids[(d + doc0)[s > 0]], s[s > 0])
    for side, b in best.items():
        if len(b.q):
            yield pd.DataFrame({"side": side, "query_id": [names[q] for q in b.q], "doc_id": b.id, "score": b.s})


def _stretches(docs: np.ndarray, many: np.ndarray):
    """Places of whole documents, together at most CELLS matches (or one document)."""
    end = np.flatnonzero(np.concatenate((docs[1:] != docs[:-1], [True]))) + 1
    total = np.cumsum(many)[end - 1]
    lo = base = 0
    for j in range(len(end)):
        if j + 1 == len(end) or total[j + 1] - base > CELLS:
            yield lo, int(end[j])
            lo, base = int(end[j]), int(total[j])


def _answers(docs: DataFrame, queries: DataFrame, k: int, weight: Column | None, rest: Column | None) -> DataFrame:
    """(side, query_id, doc_id, score, rank): the best k of all documents ("full") and, where given, of those with ``rest``."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", (weight if weight is not None else F.lit(1.0)).alias("prior"), (rest if rest is not None else F.lit(False)).alias("rest"))
    n_tokens = F.coalesce(F.size(tokens(F.col("text"))), F.lit(0))
    stats = rows.select(F.greatest(n_tokens, F.lit(1)).cast("double").alias("n"), "rest").agg(
        F.count(F.lit(1)).alias("full"), F.avg("n").alias("full_avg"), F.count_if("rest").alias("rest"), F.avg(F.when(F.col("rest"), F.col("n"))).alias("rest_avg")
    ).first()
    sides = ("full", "rest") if rest is not None else ("full",)
    average = {side: float(stats[f"{side}_avg"] or 1.0) for side in sides}
    schema = f"side string, query_id {dict(queries.dtypes)['query_id']}, doc_id {dict(docs.dtypes)['doc_id']}, score double"
    out, block = None, []

    def answer(block):
        terms = {t: j for j, t in enumerate(sorted({t for _, c in block for t in c}))}
        if not terms:
            return None
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string"))  # the terms of BLOCK_QUERIES queries
        once = rows.select("rest", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
        df = {r["term"]: r for r in once.join(wanted, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("full"), F.count_if("rest").alias("rest")).collect()}
        j, q, qf = (np.array(x) for x in zip(*((terms[t], i, n) for i, (_, c) in enumerate(block) for t, n in c.items()), strict=True))
        order = np.lexsort((q, j))
        j, q, qf = j[order], q[order], qf[order]
        start = np.searchsorted(j, np.arange(len(terms) + 1))
        made = {}
        for side in sides:
            f = np.array([df[t][side] if t in df else 0 for t in terms], float)
            n = max(stats[side], 1)
            made[side] = start, q, (np.log(1 + (n - f + 0.5) / (f + 0.5)))[j] * qf
        data = spark.sparkContext.broadcast(([q for q, _ in block], terms, made))
        return map_pandas(rows, partial(_score, block=data, k=k, average=average), schema)

    for r in queries.select("query_id", "text").toLocalIterator():
        block.append((r["query_id"], Counter(_TOKEN.findall((r["text"] or "").lower()))))
        if len(block) == BLOCK_QUERIES:
            got, block = answer(block), []
            out = got if out is None else out if got is None else out.unionByName(got)
    got = answer(block) if block else None
    out = got if out is None else out if got is None else out.unionByName(got)
    if out is None:
        out = spark.createDataFrame([], schema)
    best = Window.partitionBy("side", "query_id").orderBy(F.desc("score"), "doc_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 5, weight: Column | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank): the best k of docs (doc_id, text) for queries (query_id, text).

    Scores are rounded to six places before ranking; ties go to the smaller doc_id; zero scores are no
    answers. Null and tokenless texts count as documents of length 1 and match nothing. ``weight``
    multiplies a document's score.
    """
    return _answers(docs, queries, k, weight, None).drop("side")


def ablation(docs: DataFrame, queries: DataFrame, excluded: Column, k: int = 5) -> DataFrame:
    """Per query: answers with and without the excluded documents (all statistics rebuilt for the rest).

    Both sides are scored in one pass over the documents.
    """
    both = checkpointed(_answers(docs, queries, k, None, ~F.coalesce(excluded, F.lit(False))))
    full, rest = both.where("side = 'full'"), both.where("side = 'rest'")
    gone = docs.where(excluded).select("doc_id").withColumn("gone", F.lit(True))

    def packed(x, name):
        return x.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda s: s["doc_id"]).alias(name), F.max("score").alias(f"{name}_top"))

    hits = full.join(gone, "doc_id").groupBy("query_id").agg(F.count(F.lit(1)).alias("n_excluded"))
    out = packed(full, "a").join(packed(rest, "b"), "query_id", "full").join(hits, "query_id", "left")
    none = F.array().cast(f"array<{dict(docs.dtypes)['doc_id']}>")
    a, b = F.coalesce("a", none), F.coalesce("b", none)
    return out.select(
        "query_id",
        (F.coalesce("n_excluded", F.lit(0)) > 0).alias("hit"),
        (~F.try_element_at(a, F.lit(1)).eqNullSafe(F.try_element_at(b, F.lit(1)))).alias("top1_changed"),
        (F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))).alias("overlap"),
        F.round(F.coalesce("a_top", F.lit(0.0)) - F.coalesce("b_top", F.lit(0.0)), 6).alias("top1_delta"),
    )


def ablation_summary(per_query: DataFrame, n_queries: int) -> DataFrame:
    return per_query.agg(
        F.lit(n_queries).cast("long").alias("n_queries"),
        F.count_if("hit").alias("n_hit"),
        F.count_if("top1_changed").alias("n_top1_changed"),
        F.round(F.avg("overlap"), 6).alias("mean_overlap"),
        F.round(F.sum("top1_delta") / n_queries, 6).alias("mean_top1_delta"),
    )
