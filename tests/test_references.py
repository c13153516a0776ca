import random
from datetime import datetime

from textloom.operators import references as R


def brute(refs, stays):
    out = set()
    for t, r, k, d in refs:
        k = (k or "").strip().upper()
        if not k:
            continue
        own = [(a or None, z or None) for s, a, z in stays if (s or "").strip().upper() == k]
        if not own:
            out.add((t, r, k, d, "missing"))
        elif d is not None and not any((a is None or a <= d) and (z is None or d < z) for a, z in own):
            late = all(a is not None for a, _ in own) and d < min(a for a, _ in own)
            out.add((t, r, k, d, "late" if late else "deleted"))
    return out


def frames(spark, refs, stays):
    a = spark.createDataFrame(refs, "table_name string, record_id string, source_key string, day string")
    b = spark.createDataFrame(stays, "source_id string, access_date string, removed_date string")
    return a, b


def test_orphans_equal_brute_force(spark):
    rng = random.Random(3)
    days = [f"2023-{m:02d}-{d:02d}" for m in range(1, 5) for d in (1, 11, 21)]
    stays = []
    for k in range(12):
        for _ in range(rng.randint(1, 3)):
            a = rng.choice([*days, None])
            z = rng.choice([None, *days])
            stays.append((rng.choice([f"src{k}", f" SRC{k} "]), a, z))
    stays += stays[:4]
    refs = [(rng.choice("ab"), f"r{i}", rng.choice([f"SRC{rng.randint(0, 15)}", f"src{rng.randint(0, 15)} ", None, "  "]), rng.choice([*days, None])) for i in range(300)]
    refs += refs[:20]
    got = {tuple(r) for r in R.orphan_references(*frames(spark, refs, stays)).collect()}
    assert got == brute(refs, stays)


def test_edges(spark):
    refs = [("t", "r", "S1", "2023-01-01"), ("t", "r", "S1", "2023-01-01"), ("t", None, "s1", None)]
    none = frames(spark, refs, [])[1]
    got = R.orphan_references(frames(spark, refs, [])[0], none).collect()
    assert sorted((r["record_id"] or "", r["kind"]) for r in got) == [("", "missing"), ("r", "missing")]
    assert R.orphan_references(*frames(spark, [], [("S1", None, None)])).count() == 0
    # a stay that ends before it starts never holds, but the key exists
    got = R.orphan_references(*frames(spark, refs, [("S1", "2022-05-01", "2022-01-01")])).collect()
    assert [r["kind"] for r in got if r["record_id"] == "r"] == ["deleted"]
    # other columns, even of clashing names, are not read
    a, b = frames(spark, refs, [("S1", "2024-01-01", None)])
    got = R.orphan_references(a.selectExpr("*", "1 as key", "2 as kind"), b.selectExpr("*", "3 as day", "4 as refs")).collect()
    assert [r["kind"] for r in got if r["record_id"] == "r"] == ["late"]


def test_reference_log_reads_both_tables(spark):
    i = spark.createDataFrame([("i1", ["A", None], datetime(2023, 1, 2)), ("i2", None, None)], "interaction_id string, citations array<string>, created_at timestamp")
    c = spark.createDataFrame([("c1", "B", "2023-01-03T10:00:00Z"), ("c2", "B", "2023"), ("c3", None, None)], "chunk_id string, source_id string, accessed_at string")
    got = {(r["record_id"], r["source_key"], r["day"]) for r in R.reference_log(i, c).collect()}
    assert got == {("i1", "A", "2023-01-02"), ("i1", None, "2023-01-02"), ("c1", "B", "2023-01-03"), ("c2", "B", None), ("c3", None, None)}


def test_merged_counts_do_not_depend_on_batches(spark):
    deltas = [("a", 1, 0), ("a", 0, 1), ("b", 1, 0), ("a", 0, -1), ("b", -1, 0), ("c", 2, 0)]
    schema = "key string, refs long, exist long"
    empty = spark.createDataFrame([], schema)
    whole = R.merge_counts(empty, spark.createDataFrame(deltas, schema))
    step = empty
    for d in deltas:
        step = R.merge_counts(step, spark.createDataFrame([d], schema))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, step.collect())) == [("a", 1, 0), ("c", 2, 0)]
    assert {r["key"] for r in R.current_orphans(whole).collect()} == {"a", "c"}
