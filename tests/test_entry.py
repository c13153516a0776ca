import os
import subprocess
import sys

import __spark_entry__ as entry
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_works_without_the_subpackage(tmp_path):
    code = "import sys, importlib.abc\nclass No(importlib.abc.MetaPathFinder):\n    def find_spec(self, name, path=None, target=None):\n        if name.startswith('textloom.llm'): raise ModuleNotFoundError(name)\nsys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nassert 'p4_found' in e.queries() and not any(q.startswith('p1_') for q in e.queries())\nassert not any(m.startswith('textloom.llm') for m in sys.modules)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT})


@pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables")
def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"query_id", "doc_id", "score", "rank"}


@pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", ["p4_found", "p4_report", "chunk_documents", "corpus_union", "clean_text", "ingest_chunks", "ab_summary", "extract_features", "split_routing", "benchmark_pass", "page_fields", "page_links", "json_lines_kept", "csv_kept", "paged_candidates", "crawled_pages", "stream_ingested", "p4_upkeep"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SMALL}/{f}')")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert sorted(got.columns) == sorted(want.columns)

    def rows(df):
        return sorted(tuple("" if pd.isna(x) else f"{x:.6g}" if isinstance(x, float) else str(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))

    assert rows(got) == rows(want)
