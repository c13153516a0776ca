"""Queries of feature extraction and augmentation."""

from pyspark.sql import functions as F

from ..operators import augment as A
from ..operators import features as X
from ..session import table

_SUFFIXES = (("It has been stressful.", 40), ("I also feel tired.", 30), ("I am not sure what to do.", 20))
_OPEN = ("Thank you for writing.", "Here is what is known.", "Many people ask this.")
_CLOSE = ("Please see a clinician.", "Take care.")


def _inputs(spark, d):
    a = table(spark, d, "interaction_examples").select(F.col("interaction_id").alias("id"), F.col("raw_input").alias("text"))
    b = table(spark, d, "benchmark_eval_set").select(F.col("benchmark_id").alias("id"), F.col("input").alias("text"))
    return a.unionByName(b).where("text is not null").distinct()


def extract_features(spark, d):
    out = X.extract(_inputs(spark, d), "id", "text")
    lists = list(X.LISTS)
    keep = ["id", *X.FLAGS, *X.CHOICES, "last_menstrual_period_days_ago", "bleeding_duration_days", "pain_score_0_10", "postpartum_weeks", "recent_weight_change_kg", "extracted_summary"]
    return out.select(*keep, *(F.array_join(c, ";").alias(c) for c in lists))


def extract_ages(spark, d):
    """Stated ages without a span of time next to them, and hours of sleep."""
    return X.extract(_inputs(spark, d), "id", "text").select("id", "age_years", "sleep_hours")


#: a rule table of its own for documents: the compiler takes any
_DOC_FLAGS = {"names_a_visit": ("appointment", "visit the"), "is_question": ("?",)}
_DOC_CHOICES = {"tone": ((("urgent", ("at once", "emergency")), ("calm", ("usually", "as a rule"))), "plain")}
_DOC_LISTS = {"themes": (("bleeding", ("bleed",)), ("sleep", ("sleep", "tired")), ("pain", ("pain", "ache")))}


def compiled_rules(spark, d):
    c = X.compile_rules(F.lower("text"), _DOC_FLAGS, _DOC_CHOICES, _DOC_LISTS)
    return table(spark, d, "documents").where("text is not null").select("doc_id", *(c[k].alias(k) for k in (*_DOC_FLAGS, *_DOC_CHOICES)), F.array_join(c["themes"], ";").alias("themes"))


def varied_answers(spark, d):
    rows = table(spark, d, "interaction_examples").where("assistant_output is not null").select("interaction_id", "assistant_output").distinct()
    return A.varied(rows, "interaction_id", "assistant_output", _OPEN, _CLOSE, ("Thank you for writing.",))


def scaled_interactions(spark, d):
    templates = table(spark, d, "benchmark_eval_set").select("benchmark_id", F.col("input").alias("raw_input"))
    return A.scaled(templates, 1000, _SUFFIXES)


def _q(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


def _any(ps) -> str:
    return "(" + " OR ".join(f"contains(t, {_q(p)})" for p in ps) + ")"


def _num(p: str, g: int = 1, kind: str = "INT") -> str:
    return f"try_cast(nullif(regexp_extract(t, {_q(p)}, {g}), '') AS {kind})"


_LMP = f"(CASE regexp_extract(t, {_q(X.LAST_PERIOD)}, 1) " + " ".join(f"WHEN '{w}' THEN {k}" for k, w in enumerate(X.NUMBER_WORDS, 1)) + f" ELSE {_num(X.LAST_PERIOD)} END * CASE WHEN starts_with(regexp_extract(t, {_q(X.LAST_PERIOD)}, 2), 'week') THEN 7 WHEN starts_with(regexp_extract(t, {_q(X.LAST_PERIOD)}, 2), 'month') THEN 30 ELSE 1 END)"


def _choice(name: str) -> str:
    rules, default = X.CHOICES[name]
    return "CASE " + " ".join(f"WHEN {_any(p)} THEN {_q(v)}" for v, p in rules) + f" ELSE {_q(default)} END"


_SQL = (
    "WITH i AS (SELECT DISTINCT id, lower(text) AS t, text FROM (SELECT interaction_id AS id, raw_input AS text FROM interaction_examples UNION ALL SELECT benchmark_id, input FROM benchmark_eval_set) WHERE text IS NOT NULL), "
    "f AS (SELECT id, "
    + ", ".join(f"{_any(p)} AS {k}" for k, p in X.FLAGS.items())
    + ", "
    + ", ".join(f"{_choice(k)} AS {k}" for k in X.CHOICES)
    + f", {_LMP} AS last_menstrual_period_days_ago, CASE WHEN {_any(('heavy', 'soaked', 'for'))} THEN {_num(X.DURATION)} END AS bleeding_duration_days, {_num(X.PAIN)} AS pain_score_0_10, CASE WHEN starts_with(regexp_extract(t, {_q(X.POSTPARTUM)}, 2), 'month') THEN 4 ELSE 1 END * {_num(X.POSTPARTUM)} AS postpartum_weeks, "
    + f"CASE WHEN {_any(('lost', 'weight down', 'down by'))} THEN -{_num(X.LOST, 1, 'DOUBLE')} WHEN {_any(('gained', 'weight up', 'up by'))} THEN {_num(X.GAINED, 1, 'DOUBLE')} END AS recent_weight_change_kg, "
    + ", ".join("array_to_string(list_filter([" + ", ".join(f"CASE WHEN {_any(p)} THEN {_q(v)} END" for v, p in rules) + f"], lambda x: x IS NOT NULL), ';') AS {k}" for k, rules in X.LISTS.items())
    + " FROM i) SELECT *, 'life_stage=' || life_stage || coalesce('; lmp_days_ago=' || last_menstrual_period_days_ago, '') || CASE WHEN bleeding_after_sex THEN '; postcoital_bleeding=true' ELSE '' END || CASE WHEN unprotected_sex_recent THEN '; recent_unprotected_sex=true' ELSE '' END AS extracted_summary FROM f"
)


def _pick(salt: str, options, key: str = "interaction_id") -> str:
    return "[" + ", ".join(_q(o) for o in options) + f"][('0x' || substr(md5('{salt}' || {key}), 1, 8))::BIGINT % {len(options)} + 1]"


# the pattern without its look-around, which the SQL engine lacks: what stands next to a match is cut out and looked at
_STATED = r"^(?:i['’]?\s*am|i['’]?\s*m|my age|age)\s*(?:is)?\s*(\d{1,3})(?:\s*years?\b|\b)"
_NEAR = "contains({c}, 'day') OR contains({c}, 'week') OR contains({c}, 'month')"
_AGES = f"""WITH i AS (SELECT DISTINCT id, lower(text) AS t FROM (SELECT interaction_id AS id, raw_input AS text FROM interaction_examples UNION ALL SELECT benchmark_id, input FROM benchmark_eval_set) WHERE text IS NOT NULL),
p AS (SELECT id, t, unnest(range(1, length(t) + 1)) AS i FROM i), w AS (SELECT id, t, i, substr(t, i, 60) AS r FROM p WHERE substr(t, i, 1) IN ('i', 'm', 'a') AND (i = 1 OR NOT regexp_matches(substr(t, i - 1, 1), '[a-z0-9_]'))),
m AS (SELECT id, i, regexp_extract(r, {_q(_STATED)}) AS whole, try_cast(regexp_extract(r, {_q(_STATED)}, 1) AS INT) AS n, t FROM w WHERE regexp_matches(r, {_q(_STATED)})),
a AS (SELECT id, t, arg_min(n, i) AS n FROM (SELECT *, substr(t, i + length(whole), 10) AS after, substr(t, greatest(i - 12, 1), least(12, i - 1)) AS before FROM m) WHERE n BETWEEN 8 AND 90 AND NOT ({_NEAR.format(c="after")}) AND NOT ({_NEAR.format(c="before")}) GROUP BY id, t)
SELECT id, a.n AS age_years, coalesce({_num(X.SLEEP, 1, "DOUBLE")}, {_num(X.SLEEP, 2, "DOUBLE")}) AS sleep_hours FROM i LEFT JOIN a USING (id, t)"""
_TAKEN = " || ".join(f"CASE WHEN ('0x' || substr(md5({_q(x)} || id), 1, 8))::BIGINT % 100 < {n} THEN ' ' || {_q(x)} ELSE '' END" for x, n in _SUFFIXES)
_SCALED = f"""WITH t AS (SELECT benchmark_id, input, row_number() OVER (ORDER BY md5(concat_ws('|', benchmark_id, input))) - 1 AS k, count(*) OVER () AS n FROM benchmark_eval_set),
m AS (SELECT id, benchmark_id, input || {_TAKEN} AS raw_input FROM (SELECT range AS id FROM range(2000)) JOIN t ON id % n = k), f AS (SELECT raw_input, min(id) AS id FROM m GROUP BY 1)
SELECT m.id AS row_no, benchmark_id, m.raw_input FROM m JOIN f ON m.id = f.id AND m.raw_input = f.raw_input ORDER BY 1 LIMIT 1000"""
QUERIES = {f.__name__: f for f in (extract_features, extract_ages, compiled_rules, varied_answers, scaled_interactions)}
ORACLE = {
    "extract_features": _SQL,
    "extract_ages": _AGES,
    "compiled_rules": "SELECT doc_id, " + ", ".join(f"{_any(p)} AS {k}" for k, p in _DOC_FLAGS.items()) + ", CASE WHEN contains(t, 'at once') OR contains(t, 'emergency') THEN 'urgent' WHEN contains(t, 'usually') OR contains(t, 'as a rule') THEN 'calm' ELSE 'plain' END AS tone, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {_any(p)} THEN '{v}' END" for v, p in _DOC_LISTS["themes"]) + "], lambda x: x IS NOT NULL), ';') AS themes FROM (SELECT doc_id, lower(text) AS t FROM documents WHERE text IS NOT NULL)",
    "scaled_interactions": _SCALED,
    "varied_answers": f"SELECT DISTINCT interaction_id, {_pick('open', _OPEN)} || ' ' || trim(regexp_replace(replace(assistant_output, 'Thank you for writing.', ''), '[ \\t\\n\\x0B\\f\\r\\x85\\p{{Z}}]+', ' ', 'g'), ' ') || ' ' || {_pick('close', _CLOSE)} AS assistant_output FROM interaction_examples WHERE assistant_output IS NOT NULL",
}
