from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from textloom.operators import augment as A
from textloom.operators import curation as C
from textloom.operators import evaluate as E
from textloom.operators import export as X
from textloom.operators import features as FX
from textloom.operators import ingest as G
from textloom.operators import retrieval as R
from textloom.operators import validate as V

DOCS = [(1, "red apple red"), (2, "green apple pear"), (3, ""), (4, None), (5, "blue sky over the red house"), (6, "green apple pear")]
QUERIES = [("a", "red apple"), ("b", "pear pear green"), ("c", "nothing"), ("d", "")]


def bm25(docs, queries, k, weight=lambda i: 1.0):
    toks = {i: (t or "").lower().split() for i, t in docs}
    n, avg = len(toks), sum(max(len(t), 1) for t in toks.values()) / len(toks)
    df = Counter(w for t in toks.values() for w in set(t))
    out = {}
    for q, text in queries:
        scores = []
        for i, t in toks.items():
            tf = Counter(t)
            s = sum(log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * max(len(t), 1) / avg)) * qf for w, qf in Counter(text.split()).items() if tf[w])
            if s > 0:
                scores.append((-round(s * weight(i), 6), i))
        for r, (s, i) in enumerate(sorted(scores)[:k], 1):
            out[q, r] = (i, -s)
    return out


def tables(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(QUERIES, "query_id string, text string")


@pytest.mark.parametrize("k", [1, 2, 5])
def test_search_equals_brute_force(spark, k):
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in R.search(*tables(spark), k).collect()}
    assert got == bm25(DOCS, QUERIES, k)


def test_search_with_weights_and_no_documents(spark):
    docs, queries = tables(spark)
    w = F.when(F.col("doc_id") == 5, 3.0).otherwise(1.0)
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in R.search(docs, queries, 5, w).collect()}
    assert got == bm25(DOCS, QUERIES, 5, lambda i: 3.0 if i == 5 else 1.0)
    assert R.search(docs.limit(0), queries).count() == 0
    assert R.search(docs, queries.limit(0)).count() == 0


def test_ablation_rebuilds_the_statistics(spark):
    docs, queries = tables(spark)
    got = {r["query_id"]: r for r in R.ablation(docs, queries, F.col("doc_id") == 1, 2).collect()}
    full, rest = bm25(DOCS, QUERIES, 2), bm25([d for d in DOCS if d[0] != 1], QUERIES, 2)
    assert got["a"]["hit"] and got["a"]["top1_changed"] and got["a"]["top1_delta"] == pytest.approx(full["a", 1][1] - rest["a", 1][1], abs=1e-6)
    assert not got["b"]["hit"] and not got["b"]["top1_changed"] and got["b"]["overlap"] == 1.0


def test_numbered_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    rows = C.numbered(df, ["k"]).collect()
    assert sorted((r["k"], r["ordinal"]) for r in rows) == [(i, i + 1) for i in range(1000)]
    assert C.numbered(df.limit(0), ["k"]).count() == 0


def test_first_per_key_with_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 4, "w"), ("a", 1, "y")], "k string, o int, v string")
    got = {(r["k"], r["v"]) for r in C.first_per_key(df, [F.col("k")], [F.col("o"), F.col("v")]).collect()}
    assert got == {("a", "y"), (None, "w")}


def test_routing_is_a_partition(spark):
    rows = [(f"i{k}", s, level) for k, (s, level) in enumerate((s, v) for s in ("human_reviewed", "rejected", None, "clinician_reviewed") for v in (*C.LEVELS, None))]
    df = spark.createDataFrame(rows, "i string, s string, l string").select("*", C.route(F.col("i"), F.col("s"), F.col("l")).alias("t"))
    for r in df.collect():
        if r["s"] not in C.REVIEWED:
            assert r["t"] == "review_queue"
        elif r["l"] in C.HIGH_LEVELS:
            assert r["t"] == "safety_train"
        else:
            assert r["t"] in ("train", "validation")


def test_levels_are_ordered(spark):
    got = spark.createDataFrame([("urgent_care", "routine_review")], "a string, b string").select(C.higher_level(F.col("a"), F.col("b")).alias("h"), C.level_rank(F.lit("odd")).alias("r")).first()
    assert tuple(got) == ("urgent_care", 0)


def test_set_review_changes_the_chosen_only(spark):
    df = spark.createDataFrame([("a", "pending", False), ("b", "pending", False), ("c", "rejected", False)], "id string, review_status string, human_reviewed boolean")
    got = {r["id"]: tuple(r)[1:] for r in C.set_review(df, df.where("id <> 'b'"), "id", "clinician_reviewed", ["pending"]).collect()}
    assert got == {"a": ("clinician_reviewed", True, True), "b": ("pending", False, False), "c": ("rejected", False, False)}


def test_fill_missing_and_defaults(spark):
    df = spark.createDataFrame([("a", ""), ("b", "kept"), ("c", None)], "id string, x string")
    made = spark.createDataFrame([("a", "new"), ("b", "other")], "id string, x string")
    assert {tuple(r) for r in C.fill_missing(df, made, "id", ["x"]).collect()} == {("a", "new"), ("b", "kept"), ("c", None)}
    assert C.with_defaults(df, {"x": "d", "y": 1}).where("id = 'c'").first().asDict() == {"id": "c", "x": "d", "y": 1}


def test_new_by_text(spark):
    old = spark.createDataFrame([("o", "Hello ")], "id string, t string")
    new = spark.createDataFrame([("a", "hello"), ("b", "Bye"), ("c", " bye")], "id string, t string")
    assert [r["id"] for r in C.new_by_text(new, old, "t", [F.col("id")]).collect()] == ["b"]


def test_violations(spark):
    df = spark.createDataFrame([("a", "x", ["k1", "zz"]), ("a", "", None), ("b", None, [])], "id string, v string, refs array<string>")
    parents = spark.createDataFrame([("k1",), ("k1",)], "k string")
    assert [r["key"] for r in V.not_unique(df, "id", "u").collect()] == ["a"]
    assert sorted(r["key"] for r in V.missing_values(df, "id", ["v"], "m").collect()) == ["a", "b"]
    assert [r["message"] for r in V.array_orphans(df, "id", "refs", parents, "k", "o").collect()] == ["unknown zz"]
    assert [r["message"] for r in V.unknown_values(df, "id", "v", ["y", ""], "e").collect()] == ["v=x"]
    assert tuple(V.citation_coverage(df, "refs", parents, "k").first()) == (2, 1, 1)
    assert tuple(V.citation_coverage(df.limit(0), "refs", parents, "k").first()) == (0, 0, 0)


def test_ingest_numbers_new_sources_and_skips_repeats(spark):
    long = "word " * 60
    rows = [(1, "https://a.example/1", None, "T", long, "2023-01-01", None), (2, "https://a.example/1", None, "T", long, "2023-01-02", None), (3, "https://b.example/2", " ", None, "short", "2023", None), (4, None, None, "x", long, "2023", None), (5, "https://c.example/3", None, "", "New\n" + long, "2023", "2020")]
    pages = spark.createDataFrame(rows, "page_id long, url string, canonical_url string, title string, content string, fetched_at string, publication_date string")
    marked = G.with_reason(G.prepared(pages))
    assert {r["page_id"]: r["reason"] for r in marked.collect()} == {1: None, 2: "repeated", 3: "too_short", 4: "empty", 5: None}
    new = marked.where("reason is null")
    cat = spark.createDataFrame([("src00007", "https://a.example/1"), ("SRC00009", None)], "source_id string, url string")
    ids = {r["page_url"]: (r["source_id"], r["is_new"]) for r in G.assign_sources(new, cat).collect()}
    assert ids == {"https://a.example/1": ("SRC00007", False), "https://c.example/3": ("SRC00010", True)}
    made = G.source_rows(new, G.assign_sources(new, cat), "2024-01-01").collect()
    assert [(r["source_id"], r["title"]) for r in made] == [("SRC00010", "Crawled Page SRC00010")]
    assert len({r["chunk_id"] for r in G.chunk_rows(new, G.assign_sources(new, cat)).collect()}) == 2


def test_export_rows(spark):
    df = spark.createDataFrame([("i", "q é", " a\nb ", ["k"], "l", None)], "interaction_id string, raw_input string, assistant_output string, citations array<string>, risk_level string, extracted_features struct<a:int>")
    chat = X.chat_rows(df).first()["messages"]
    assert [m["role"] for m in chat] == ["system", "user", "assistant"] and chat[2]["content"] == "a\nb"
    assert chat[1]["content"].isascii() and '"extracted_features":null' in chat[1]["content"]
    assert X.completion_rows(df).first()["completion"] == "a\\nb"
    with pytest.raises(ValueError):
        X.zipped(spark.range(3), spark.range(4).withColumnRenamed("id", "j"), ["id"], ["j"])
    both = X.zipped(spark.range(3), spark.range(10, 13).withColumnRenamed("id", "j"), ["id"], ["j"]).collect()
    assert sorted(map(tuple, both)) == [(0, 10), (1, 11), (2, 12)]


def test_scores_and_parsing(spark):
    s = spark.createDataFrame([("Educational information, not a diagnosis. Follow-up questions: x?",)], "t string").select(E.answer_scores(F.col("t")).alias("s")).first()["s"].asDict()
    assert s == {"has_education_disclaimer": True, "has_follow_up": True, "mentions_pregnancy_test": False, "mentions_urgent": False, "mentions_diagnosis": True, "has_not_diagnosis_warning": True}
    out = "==========\nThe answer.\nPrompt: 12 tokens, 99.5 tokens-per-sec\nGeneration: 8 tokens, 20.25 tokens-per-sec"
    got = spark.createDataFrame([(out,)], "t string").select(E.parse_generation(F.col("t")).alias("g")).first()["g"]
    assert tuple(got) == ("The answer.", 20.25, 99.5)


def test_unknown_labels_count_as_met(spark):
    df = spark.createDataFrame([("see a doctor", "urgent_care", ["urgent_care_needed", "odd"]), ("x", "routine_review", ["urgent_care_needed"]), (None, None, None)], "a string, l string, e array<string>")
    got = [r["m"] for r in df.select(E.labels_met(F.col("e"), E.label_rules(F.col("a"), F.col("l"))).alias("m")).collect()]
    assert got == [True, False, True]


@pytest.mark.parametrize(
    ("text", "field", "want"),
    [
        ("I'm 34 years old", "age_years", 34),
        ("i am 3 weeks late now and my age is 29", "age_years", 29),
        ("i am 3 weeks late, age 29", "age_years", None),
        ("my age is 7", "age_years", None),
        ("I am 20 days late", "age_years", None),
        ("my period came two weeks ago", "last_menstrual_period_days_ago", 14),
        ("bleeding was about 3 months ago", "last_menstrual_period_days_ago", 90),
        ("soaked pads for 9 days", "bleeding_duration_days", 9),
        ("pain 7/10", "pain_score_0_10", 7),
        ("2 months postpartum", "postpartum_weeks", 8),
        ("I lost 3.5 kg", "recent_weight_change_kg", -3.5),
        ("gained 4 lbs", "recent_weight_change_kg", 4.0),
        ("I sleep about 6 hours", "sleep_hours", 6.0),
        ("on metformin and aspirin with pcos", "medications", ["metformin", "aspirin"]),
        ("during a walk", "contraception_method", "ring"),
        ("after menopause I feel dizzy", "red_flags", ["possible_hemodynamic_symptoms", "postmenopausal_bleeding"]),
        ("", "life_stage", "reproductive"),
    ],
)
def test_features(spark, text, field, want):
    assert FX.extract(spark.createDataFrame([(1, text)], "i int, t string"), "i", "t").first()[field] == want


def test_augmentation_is_deterministic(spark):
    t = spark.createDataFrame([(k, f"text {k}") for k in range(5)], "template_id int, raw_input string")
    a, b = (sorted(map(tuple, A.scaled(t.repartition(n), 12, (("More.", 50), ("Less.", 30))).collect())) for n in (1, 4))
    assert a == b and len({x[-1] for x in a}) == len(a) == 12
    df = spark.createDataFrame([("k", "p. rest"), ("k", None)], "k string, t string")
    assert [r[0] for r in df.select(A.prepended(F.col("t"), F.lit("p."))).collect()] == ["p. rest", "p."]
