"""Free text into typed fields: phrase tables and patterns compiled to columns.

Matching is by substring of the lower-cased text, as the tables were made for. Each table is plain
data; ``compile_rules`` turns any list of (name, rule) into columns, so other tables can be used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, labels, when_chain

# Phrases of the flags.
FLAGS = {
    "clots_present": ("clot", "large clots", "lots of clots"),
    "spotting_between_periods": ("spotting", "between periods", "light bleed"),
    "bleeding_after_sex": ("bleed after sex", "after sex", "postcoital"),
    "sexually_active": ("sex", "sexual"),
    "unprotected_sex_recent": ("unprotected sex", "no protection", "without contraception", "raw", "unsafe sex"),
    "pregnancy_known": ("i'm pregnant", "i am pregnant", "pregnant"),
    "emergency_contraception_used": ("emergency contraception", "ec pill"),
    "breastfeeding": ("breastfeeding", "breast fed", "nursing"),
    "exclusive_breastfeeding": ("exclusive breastfeeding", "only breastfeeding"),
    "partial_breastfeeding": ("mixed feeding", "combining"),
    "contraception_recent_change": ("started", "change", "stopped", "switched"),
    "shift_work_flag": ("shift", "night shift", "rotating"),
    "trying_to_conceive": ("trying to get pregnant", "trying for a baby", "trying to conceive"),
    "infertility_history_flag": ("trying for a baby for a year", "trying for years", "infertility"),
    "abortion_history_flag": ("miscarriage", "abortion", "terminated"),
}
# Ordered choices, the first that fits, and the default.
CHOICES = {
    "life_stage": (
        (
            ("postpartum", ("postpartum", "post partum", "gave birth", "after delivery", "after birth", "post delivery")),
            ("breastfeeding", ("breastfeeding", "breast fed", "nursing")),
            ("perimenopause", ("menopause", "postmenopause", "perimenopause", "after menopause")),
            ("adolescent", ("first period", "got my first", "menarche", "started periods", "adolescent", "teen")),
        ),
        "reproductive",
    ),
    "flow_level": ((("very_heavy", ("very heavy", "soaked", "pad every hour", "heavy bleeding", "heavy")), ("light", ("spotting", "light bleed", "light bleeding", "light")), ("moderate", ("moderate",))), "unknown"),
    "pregnancy_test_result": (
        (
            ("positive", ("pregnancy test is positive", "test is positive", "pregnancy is positive", "got positive")),
            ("negative", ("pregnancy test is negative", "test is negative", "pregnancy is negative", "got negative")),
            ("not_done", ("pregnancy test", "not done", "haven't taken", "not taken")),
        ),
        "unknown",
    ),
    "contraception_method": (
        (
            ("iud", ("iud", "copper iud", "hormonal iud", "spiral")),
            ("pill", ("pill", "birth control pill", "oral contraceptive")),
            ("implant", ("implant", "rod")),
            ("injection", ("injection", "shot", "depo")),
            ("patch", ("patch",)),
            ("ring", ("ring",)),
            ("condom", ("condom", "condoms")),
            ("none", ("none", "not using", "without protection")),
        ),
        "unknown",
    ),
    "stress_level": ((("high", ("very stressed", "very stressful", "high stress", "stressed out", "extremely stressed")), ("moderate", ("a lot of stress", "moderate stress", "stressed")), ("low", ("low stress", "little stress"))), "unknown"),
    "exercise_level": (
        (
            ("very_high", ("intense training", "very high", "marathon", "very active", "daily run")),
            ("high", ("high intensity", "gym", "training hard")),
            ("low", ("few workouts", "low activity", "sedentary", "not active")),
            ("moderate", ("moderate", "regular exercise", "walk daily", "exercise")),
        ),
        "unknown",
    ),
}
# Lists of labels, all that fit.
LISTS = {
    "red_flags": (
        ("possible_hemodynamic_symptoms", ("dizzy", "faint", "fainting", "chest pain", "shortness of breath", "severe bleeding", "very heavy")),
        ("postmenopausal_bleeding", ("postmenopause", "after menopause", "menopause bleeding")),
        ("postcoital_bleeding", ("bleed after sex", "postcoital", "after sex")),
        ("severe_pelvic_pain_pattern", ("one-sided", "one sided", "sudden severe")),
        ("infertility_concern", ("can't get pregnant", "trying for a year", "trying to conceive")),
    ),
    "symptoms": (
        ("nausea", ("nausea", "nauseous")),
        ("cramps", ("cramps", "cramping", "pelvic cramps")),
        ("headache", ("headache", "head ache", "migraine")),
        ("fatigue", ("tired", "fatigue", "exhausted")),
        ("dizziness", ("dizzy", "dizziness", "lightheaded")),
        ("fever", ("fever", "feeling hot", "temperature")),
        ("discharge", ("discharge", "smelly discharge", "odor", "odour")),
        ("rash_itching", ("itch", "itching", "itchy", "rash")),
        ("spotting", ("spotting", "light spotting", "postcoital")),
        ("breast_tender", ("breast pain", "breast tenderness")),
    ),
    "medications": tuple((m, (m,)) for m in ("metformin", "thyroxine", "levothyroxine", "ibuprofen", "naproxen", "aspirin", "warfarin", "valproate")),
    "known_conditions": tuple((m, (m,)) for m in ("pcos", "fibroids", "thyroid", "endometriosis", "adenomyosis", "hyperprolactinemia", "poi")),
}
# Number words and patterns of the numeric fields.
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")
AGE = r"(?s)(?<!week.{0,8})(?<!month.{0,7})(?<!day.{0,9})\b(?:i['’]?\s*am|i['’]?\s*m|my age|age)\s*(?:is)?\s*(\d{1,3}+)(?>\s*years?\b|\b)(?!.{0,7}day)(?!.{0,6}week)(?!.{0,5}month)"
LAST_PERIOD = r"\b(?:period|last period|bleeding|menses)\b.*?(?:was|is|been|came|come)?\s*(?:about|around)?\s*(\d+|one|two|three|four|five|six|seven|eight|nine|ten)\s+(day|days|week|weeks|month|months)\s+ago"
POSTPARTUM = r"\b(\d+)\s*(weeks?|months?)\s+(?:ago|after delivery|postpartum|after birth|after giving birth)\b"
DURATION = r"\b(?:for|lasting|since)\s*(\d{1,2})\s+days?\b"
PAIN = r"\b(\d)\s*/\s*10\b"
SLEEP = r"\bsleep\b.*?(\d+(?:\.\d+)?)|\bhours\b.*?(\d+(?:\.\d+)?)"
LOST = r"(?:lost|down|drop)\s*(\d+(?:\.\d+)?)\s*(?:kg|kgs|kilos|pounds|lbs|lb)"
GAINED = r"(?:gained|up|gain)\s*(\d+(?:\.\d+)?)\s*(?:kg|kgs|kilos|pounds|lbs|lb)"


def _number(text: Column, pattern: str, group: int = 1, kind: str = "int") -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast(kind)


def age(text: Column) -> Column:
    """The first stated age from 8 to 90 with no span of time next to it."""
    found = F.transform(F.regexp_extract_all(text, F.lit(AGE), F.lit(1)), lambda x: x.try_cast("int"))
    return F.try_element_at(F.filter(found, lambda x: x.between(8, 90)), F.lit(1))


def days_since_period(text: Column) -> Column:
    word, unit = F.regexp_extract(text, LAST_PERIOD, 1), F.regexp_extract(text, LAST_PERIOD, 2)
    words = F.create_map(*(x for k, w in enumerate(NUMBER_WORDS, 1) for x in (F.lit(w), F.lit(k))))
    n = F.coalesce(word.try_cast("int"), F.try_element_at(words, word))
    return n * F.when(unit.startswith("week"), 7).when(unit.startswith("month"), 30).otherwise(1)


def compile_rules(text: Column, flags: dict = FLAGS, choices: dict = CHOICES, lists: dict = LISTS) -> dict[str, Column]:
    out = {k: contains_any(text, p) for k, p in flags.items()}
    out |= {k: when_chain(text, rules, default) for k, (rules, default) in choices.items()}
    return out | {k: labels(text, rules) for k, rules in lists.items()}


def extract(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """One row per input row: key and all fields. A null text gives nulls, an empty text the defaults."""
    text = F.lower(F.col(text_col))
    c = compile_rules(text)
    weeks = F.when(F.regexp_extract(text, POSTPARTUM, 2).startswith("month"), 4).otherwise(1) * _number(text, POSTPARTUM)
    lost, gained = contains_any(text, ("lost", "weight down", "down by")), contains_any(text, ("gained", "weight up", "up by"))
    change = F.when(lost, -_number(text, LOST, 1, "double")).when(gained, _number(text, GAINED, 1, "double"))
    sleep = F.coalesce(_number(text, SLEEP, 1, "double"), _number(text, SLEEP, 2, "double"))
    lmp = days_since_period(text)
    parts = F.array(
        F.concat(F.lit("life_stage="), c["life_stage"]),
        F.when(lmp.isNotNull(), F.concat(F.lit("lmp_days_ago="), lmp.cast("string"))),
        F.when(c["bleeding_after_sex"], F.lit("postcoital_bleeding=true")),
        F.when(c["unprotected_sex_recent"], F.lit("recent_unprotected_sex=true")),
    )
    made = c | {
        "age_years": age(text),
        "last_menstrual_period_days_ago": lmp,
        "bleeding_duration_days": F.when(contains_any(text, ("heavy", "soaked", "for")), _number(text, DURATION)),
        "pain_score_0_10": _number(text, PAIN),
        "postpartum_weeks": weeks,
        "sleep_hours": sleep,
        "recent_weight_change_kg": change,
        "miscarriage_history_flag": F.lit(False),
        "last_menstrual_period_date": F.lit(None).cast("string"),
        "missed_periods_count": F.lit(None).cast("int"),
        "last_sex_date": F.lit(None).cast("string"),
        "live_birth_count": F.lit(None).cast("int"),
        "weight_kg": F.lit(None).cast("double"),
        "extracted_summary": F.array_join(F.filter(parts, lambda x: x.isNotNull()), "; "),
    }
    return df.select(F.col(key), *(v.alias(k) for k, v in made.items()))
