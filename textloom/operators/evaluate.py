"""Scoring of answers: text heuristics, label predicates, expected levels, and A/B summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, word_count
from .curation import level_rank

# Phrases that mark a property of an answer.
HEURISTICS = {
    "has_education_disclaimer": ("educational information",),
    "has_follow_up": ("follow-up", "follow up", "questions"),
    "mentions_pregnancy_test": ("pregnancy test",),
    "mentions_urgent": ("urgent medical evaluation", "urgent evaluation", "emergency care", "emergency room", "needs urgent", "urgent medical"),
    "mentions_diagnosis": ("you have", "you are likely", "is likely", "diagnosis"),
    "has_not_diagnosis_warning": ("not a diagnosis",),
}


def answer_scores(c: Column, heuristics: dict = HEURISTICS) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.struct(*(contains_any(low, p).alias(k) for k, p in heuristics.items()))


def no_forbidden(answer: Column, forbidden: Column) -> Column:
    """None of the phrases stands in the answer, letter case aside."""
    low = F.lower(F.coalesce(answer, F.lit("")))
    return ~F.exists(F.coalesce(forbidden, F.array().cast("array<string>")), lambda p: F.contains(low, F.lower(p)))


def level_reached(actual: Column, expected: Column) -> Column:
    return level_rank(actual) >= level_rank(expected)


def labels_met(labels: Column, rules: dict[str, Column]) -> Column:
    """Every expected label whose rule is known is met; labels without a rule count as met."""
    names = list(rules)
    known = F.create_map(*(x for n in names for x in (F.lit(n), F.coalesce(rules[n], F.lit(False))))) if names else None
    if known is None:
        return F.lit(True)
    return F.forall(F.coalesce(labels, F.array().cast("array<string>")), lambda x: F.coalesce(F.try_element_at(known, x), F.lit(True)))


# The words that meet a label, in the answer and in the care that goes with it.
LABEL_WORDS = {
    "possible_pregnancy_related_change": (("pregnancy",), ("pregnancy",)),
    "possible_infection_or_sti_related_bleeding": (("infection", "sti", "discharge"), ()),
    "recommend_pregnancy_test": (("pregnancy test",), ("pregnancy test",)),
    "recommend_clinician_visit": ((), ("clinician", "review", "evaluation")),
    "provide_education": (("educational information",), ()),
    "ask_follow_up_questions": (("follow-up", "?"), ()),
    "abstain_due_to_uncertainty": (("unknown", "not sure"), ()),
}
# The levels that meet a label.
LABEL_LEVELS = {
    "prompt_medical_review": ("prompt_medical_review", "urgent_care", "emergency_care"),
    "urgent_care_needed": ("urgent_care", "emergency_care"),
    "emergency_care_needed": ("emergency_care",),
}


def label_rules(answer: Column, level: Column, care: Column | None = None, features: Column | None = None) -> dict[str, Column]:
    """A predicate for each label: words of the answer and its care, its level, and features of the case."""
    low, with_care = (F.lower(F.coalesce(c, F.lit(""))) for c in (answer, care if care is not None else F.lit("")))
    rules = {k: contains_any(low, a) | contains_any(with_care, c) for k, (a, c) in LABEL_WORDS.items()}
    rules |= {k: level.isin(*v) for k, v in LABEL_LEVELS.items()}
    rules["likely_normal_variation"] = level.isin("normal_variation", "routine_review") & F.contains(low, F.lit("normal"))
    rules["recommend_urgent_evaluation"] = (F.contains(with_care, F.lit("urgent")) & F.contains(with_care, F.lit("today"))) | level.isin(*LABEL_LEVELS["urgent_care_needed"]) | F.contains(low, F.lit("urgent"))

    def feature(name):
        return F.coalesce(features[name], F.lit(False)) if features is not None else F.lit(False)

    rules["possible_pregnancy_related_change"] |= feature("unprotected_sex_recent")
    rules["possible_infection_or_sti_related_bleeding"] |= feature("bleeding_after_sex")
    rules["possible_postpartum_or_breastfeeding_effect"] = feature("breastfeeding") | (features["postpartum_weeks"].isNotNull() if features is not None else F.lit(False))
    return rules


def pass_counts(df: DataFrame, passed: Column) -> DataFrame:
    return df.agg(F.count_if(passed).alias("n_passed"), F.count(F.lit(1)).alias("n_total"))


def compare_answers(pairs: DataFrame, a: str, b: str, key: str, numbers: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Per prompt: lengths, words, heuristics of both answers and their differences.

    ``numbers`` names further pairs of numeric columns (tokens, speeds); their difference is null where either is.
    """
    x, y = answer_scores(F.col(a)), answer_scores(F.col(b))
    n = [F.length(F.coalesce(F.col(c), F.lit(""))) for c in (a, b)]
    w = [word_count(F.coalesce(F.col(c), F.lit(""))) for c in (a, b)]
    flags = [s[k].cast("long").alias(f"{p}_{k}") for p, s in (("a", x), ("b", y)) for k in HEURISTICS]
    return pairs.select(F.col(key), *flags, (n[1] - n[0]).cast("long").alias("len_delta"), (w[1] - w[0]).cast("long").alias("word_delta"), *((F.col(y) - F.col(x)).alias(f"{k}_delta") for k, (x, y) in (numbers or {}).items()))


def compare_summary(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in rows.columns if c.startswith(("a_", "b_"))]
    """Sums of the heuristics and means of the differences, each over the rows that have it."""
    return rows.agg(F.count(F.lit(1)).alias("n"), *sums, *(F.round(F.avg(c), 6).alias(f"mean_{c}") for c in rows.columns if c.endswith("_delta")))


def most_improved(rows: DataFrame, key: str, n: int = 5) -> DataFrame:
    gain = (F.col("b_has_follow_up") - F.col("a_has_follow_up")) + 0.5 * (F.col("b_has_education_disclaimer") - F.col("a_has_education_disclaimer"))
    return rows.select(key, gain.alias("gain")).orderBy(F.desc("gain"), key).limit(n)


# How a generator's output marks its parts.
RULE, PROMPT_MARK, RULED_BY = r"={10,}", "Prompt:", r"\s+\d+\s+tokens,\s+([0-9.]+)\s+tokens-per-sec"


def parse_generation(out: Column) -> Column:
    """Struct(answer, gen_tps, prompt_tps) from the output of a generator.

    The answer stands between a rule and the prompt's mark; without a rule, before the mark; without
    either, it is the whole output. Blank answers and absent speeds are null.
    """

    def number(name):
        return F.regexp_extract(out, f"{name}:{RULED_BY}", 1).try_cast("double")

    ruled = F.regexp_extract(out, rf"(?s){RULE}\n(.*?)\n(?:{RULE}\n)?{PROMPT_MARK}", 1)
    ruled = F.regexp_replace(ruled, rf"\n?{RULE}\s*$", "")
    ruled, before = (F.trim(x, F.lit(" \n\r\t")) for x in (ruled, F.split(out, PROMPT_MARK)[0]))
    text = F.when(ruled != "", ruled).otherwise(before)
    return F.struct(F.nullif(text, F.lit("")).alias("answer"), number("Generation").alias("gen_tps"), number("Prompt").alias("prompt_tps"))
