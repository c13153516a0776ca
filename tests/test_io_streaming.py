import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from textloom.operators.references import current_orphans
from textloom.sources import files as S
from textloom.sources import paged as P
from textloom.sources import sinks as K
from textloom.streaming import ingest as T


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_json_lines(spark, tmp_path):
    good = put(f"{tmp_path}/a.jsonl", '{"a": 1}\n\n{"a": 2}\n')
    bad = put(f"{tmp_path}/b.jsonl", '{"a": 1}\n{"a": \n')
    assert S.json_lines(spark, good, "a int").count() == 2
    with pytest.raises(Exception):
        S.json_lines(spark, bad, "a int").collect()
    assert [r["a"] for r in S.json_lines(spark, bad, "a int", "lenient").collect()] == [1]
    assert S.json_lines(spark, f"{tmp_path}/none.jsonl", "a int", missing_ok=True).count() == 0


def test_csv_lines_and_markdown(spark, tmp_path):
    at = put(f"{tmp_path}/c.csv", 'id,t\n1,"a, ""b""\nc"\n2,\n')
    rows = S.csv_strings(spark, at).collect()
    assert [r["t"] for r in rows] == ['a, "b"\nc', None]
    lines = put(f"{tmp_path}/l.txt", "# x\n a \n\nb\n")
    assert [r["line"] for r in S.text_lines(spark, lines, "#").collect()] == ["a", "b"]
    put(f"{tmp_path}/md/One File.md", "# T\n\npara one\n\n\n para two ")
    row = S.markdown_paragraphs(spark, f"{tmp_path}/md").first()
    assert row["paragraphs"] == ["# T", "para one", "para two"]


def test_docx_once_per_content(spark, tmp_path):
    xml = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>Hel</w:t></w:r><w:r><w:t>lo</w:t></w:r></w:p><w:p/><w:p><w:r><w:t> two </w:t></w:r></w:p></w:body></w:document>'
    os.makedirs(f"{tmp_path}/d")
    with zipfile.ZipFile(f"{tmp_path}/d/a.docx", "w") as z:
        z.writestr(zipfile.ZipInfo("word/document.xml"), xml)
    for name, data in (("b.docx", open(f"{tmp_path}/d/a.docx", "rb").read()), ("broken.docx", b"no zip")):
        with open(f"{tmp_path}/d/{name}", "wb") as f:
            f.write(data)
    got = {r["name"]: r["paragraphs"] for r in S.docx_paragraphs(spark, f"{tmp_path}/d").collect()}
    assert got == {"a": ["Hello", "two"], "broken": None}


def test_article_xml(spark, tmp_path):
    put(f"{tmp_path}/x/P1.xml", "<a><article-title>On <i>x</i></article-title><abstract><p>First.</p>\n<p>Second.</p></abstract></a>")
    put(f"{tmp_path}/x/P2.xml", "<a/>")
    got = {r["name"]: (r["title"], r["abstract"]) for r in S.article_xml(spark, f"{tmp_path}/x").collect()}
    assert got == {"P1": ("On x", "First. Second."), "P2": (None, None)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", "é", "train"), ("a", None, "test")], "k string, v string, split string")
    K.write_json_lines(df, f"{tmp_path}/j")
    text = "".join(r["value"] for r in spark.read.text(f"{tmp_path}/j").collect())
    assert text.isascii() and '"v":null' in text
    K.write_json_lines(df, f"{tmp_path}/j", "append")
    assert spark.read.json(f"{tmp_path}/j").count() == 4
    K.write_splits(df, f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/s").where("split = 'test'").count() == 1
    K.write_sorted_lines(df, "k", f"{tmp_path}/l")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/l").collect()] == ["a", "b"]
    K.write_file_per_key(df, "k", "v", f"{tmp_path}/f", ".txt")
    assert os.listdir(f"{tmp_path}/f") == ["b.txt"]
    K.write_manifest(K.manifest(df, {"n": F.count(F.lit(1))}, run_date="2024-01-01"), f"{tmp_path}/m.json")
    assert json.load(open(f"{tmp_path}/m.json")) == {"n": 2, "run_date": "2024-01-01"}
    # a dataset derived from itself
    K.write_version(df, f"{tmp_path}/v")
    K.write_version(K.current_version(spark, f"{tmp_path}/v").where("k = 'a'"), f"{tmp_path}/v")
    assert K.current_version(spark, f"{tmp_path}/v").count() == 1


def test_paged_source_follows_cursors(spark, tmp_path):
    page = {"results": [{"id": "W1", "title": "t", "doi": "d1", "locations": [{"pmcid": ""}, {"pmcid": "P7"}]}], "next": "c2"}
    put(f"{tmp_path}/q_first.json", json.dumps(page))
    put(f"{tmp_path}/q_c2.json", json.dumps({"results": [{"id": "W2", "locations": []}], "next": None}))
    rows = P.read_pages(spark, "textloom.sources.paged:folder_page", ["q"], folder=str(tmp_path))
    got = {r["work_id"]: r["pmcid"] for r in P.candidates(rows).collect()}
    assert got == {"W1": "P7", "W2": None}


def test_enrich_prefers_filled_values(spark):
    rows = spark.createDataFrame([("1", "old", None), ("2", "own", "x")], "doi string, license string, journal string")
    found = spark.createDataFrame([("1", '{"license": "cc-by", "journal": "J"}')], "key string, value string")
    got = {r["doi"]: (r["license"], r["journal"], r["enriched"]) for r in P.enrich(rows, found, "doi", ["license", "journal"], "license string, journal string").collect()}
    assert got == {"1": ("cc-by", "J", True), "2": ("own", "x", False)}


def test_crawl_is_breadth_first_with_caps(spark):
    edges = [("https://a.example/", 0, "https://a.example/1"), ("https://a.example/", 1, "https://b.example/x"), ("https://a.example/1", 0, "https://a.example/2"), ("https://a.example/1", 1, "https://a.example/"), ("https://a.example/2", 0, "https://a.example/f.pdf"), ("https://a.example/2", 1, "https://a.example/3")]
    links = spark.createDataFrame(edges, "url string, pos int, target string")
    seeds = spark.createDataFrame([("https://a.example/",)], "url string")
    allowed = spark.createDataFrame([("a.example",)], "domain string")
    got = {r["url"]: r["depth"] for r in P.crawl(seeds, links, 3, allowed=allowed).collect()}
    assert got == {"https://a.example/": 0, "https://a.example/1": 1, "https://a.example/2": 2, "https://a.example/3": 3}
    assert P.crawl(seeds, links, 3, per_host=2, allowed=allowed).count() == 2


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    folder = f"{tmp_path}/in"
    spark.createDataFrame([("a",), ("b",), ("a",)], "t string").write.parquet(f"{folder}/1")
    stream = spark.readStream.schema("t string").option("recursiveFileLookup", True).parquet(folder)
    place = f"{tmp_path}/place"
    assert T.run_once(T.once_per_content(stream, "t"), place).count() == 2
    spark.createDataFrame([("b",), ("c",)], "t string").write.parquet(f"{folder}/2")
    assert T.run_once(T.once_per_content(stream, "t"), place).count() == 3


def test_ingest_new_adds_each_content_once(spark, tmp_path):
    folder, place = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([("a",), ("b",), ("a",)], "t string").write.parquet(f"{folder}/1")
    stream = spark.readStream.schema("t string").option("recursiveFileLookup", True).parquet(folder)
    T.ingest_new(stream, "t", place)
    spark.createDataFrame([("b",), ("c",)], "t string").write.parquet(f"{folder}/2")
    T.ingest_new(stream, "t", place)
    assert sorted(r["t"] for r in T.batches(spark, place).collect()) == ["a", "b", "c"]


def test_a_batch_delivered_again_adds_nothing(spark, tmp_path):
    place = f"{tmp_path}/state"
    spark.createDataFrame([("k", 1, 0), ("j", 1, 1)], "key string, refs long, exist long").write.parquet(f"{tmp_path}/d")
    stream = spark.readStream.schema("key string, refs long, exist long").parquet(f"{tmp_path}/d")
    T.keep_reference_counts(stream, place)
    # the commit of the batch is lost: the next run gives it again
    for f in os.listdir(f"{place}-log/commits"):
        os.remove(f"{place}-log/commits/{f}")
    T.keep_reference_counts(stream, place)
    assert {tuple(r) for r in T.reference_counts(spark, place).collect()} == {("k", 1, 0), ("j", 1, 1)}


def test_a_failed_read_is_no_empty_state(spark, tmp_path):
    folder, place = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([("a",)], "t string").write.parquet(f"{folder}/1")
    stream = spark.readStream.schema("t string").option("recursiveFileLookup", True).parquet(folder)
    T.ingest_new(stream, "t", place)
    spark.createDataFrame([("b",)], "t string").write.parquet(f"{folder}/2")
    for root, _, names in os.walk(place):
        for n in names:
            if n.endswith(".parquet"):
                with open(f"{root}/{n}", "wb") as f:
                    f.write(b"no parquet")
                os.remove(f"{root}/.{n}.crc")
    with pytest.raises(Exception):
        T.ingest_new(stream, "t", place)
    assert T.batches(spark, f"{tmp_path}/nothing") is None


def test_pace_keeps_the_rate():
    now, slept = [0.0], []

    def sleep(x):
        slept.append(x)
        now[0] += x

    pace = P.Pace(4, clock=lambda: now[0], sleep=sleep)
    for _ in range(5):
        pace.wait()
    assert sum(slept) == pytest.approx(1.0)


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from textloom.session import checkpoint_root

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *_: None)))


def test_cap_and_upkeep_streams(spark, tmp_path):
    spark.createDataFrame([("h", k) for k in range(9)] + [("g", 1)], "host string, page_id long").write.parquet(f"{tmp_path}/p")
    rows = T.run_once(T.cap_per_host(spark.readStream.schema("host string, page_id long").parquet(f"{tmp_path}/p"), 4), f"{tmp_path}/o")
    assert {r["host"]: r["count"] for r in rows.groupBy("host").count().collect()} == {"h": 4, "g": 1}
    spark.createDataFrame([("k", 1, 0), ("j", 1, 0), ("j", 0, 1)], "key string, refs long, exist long").write.parquet(f"{tmp_path}/d")
    T.keep_reference_counts(spark.readStream.schema("key string, refs long, exist long").parquet(f"{tmp_path}/d"), f"{tmp_path}/state")
    assert [r["key"] for r in current_orphans(T.reference_counts(spark, f"{tmp_path}/state")).collect()] == ["k"]


def test_pipeline_orders_steps_and_keeps_versions(spark, tmp_path):
    from textloom.plans.pipeline import Step, run

    steps = [Step("c", ("b", "x"), lambda b, x: b.join(x, "id")), Step("b", ("x",), lambda x: x.where("id > 1"))]
    got = run(steps, {"x": spark.range(4)}, f"{tmp_path}/p")
    assert sorted(r["id"] for r in got["c"].collect()) == [2, 3]
    assert sorted(os.listdir(f"{tmp_path}/p")) == ["b", "c"]
    with pytest.raises(KeyError):
        run([Step("c", ("nothing",), lambda n: n)], {})


def test_articles_become_sources_and_candidates(spark):
    from textloom.operators.curation import article_rows, first_and_last, last_per_key

    articles = spark.createDataFrame([("1", "T", "An abstract."), ("2", None, None), ("3", "K", None)], "name string, title string, abstract string")
    sources, made = article_rows(articles, spark.createDataFrame([("PMC_3",)], "source_id string"))
    assert {r["source_id"]: r["title"] for r in sources.collect()} == {"PMC_1": "T", "PMC_2": "Untitled"}
    assert {r["raw_input"] for r in made.collect()} == {"Summarize: An abstract.", "Summarize the article: Untitled"}
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, o int, v string")
    assert {tuple(r) for r in last_per_key(df, [F.col("k")], [F.col("o")]).collect()} == {("a", 2, "y"), ("b", 1, None)}
    assert [r["value"] for r in first_and_last(spark.range(9), "id", 2, 1).collect()] == [0, 1, 8]


def test_search_hits(spark):
    from textloom.functions.web import path_allowed, search_hits

    df = spark.createDataFrame([(["/123/", "/about", "/wiki/Sleep", "/wiki/Special:All", "/123/", "/456"],)], "l array<string>")
    row = df.select(search_hits(F.col("l"), "article", 5).alias("a"), search_hits(F.col("l"), "wiki", 5).alias("w")).first()
    assert row["a"] == ["/123/", "/456"] and row["w"] == ["/wiki/Sleep"]
    urls = spark.createDataFrame([("https://www.nhs.uk/conditions/x",), ("https://www.nhs.uk/other/x",), ("https://a.example/thyroid",)], "u string")
    assert [r[0] for r in urls.select(path_allowed(F.col("u"))).collect()] == [True, False, True]
