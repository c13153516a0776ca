"""Text functions on columns: tokens, sentences, cleaning, small normal forms. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = r"(?U)\s+"
SENTENCE_END = r"(?<=[.!?])\s+"

# Sentences that cleaning removes wherever the pattern occurs.
DROP_PATTERNS = (
    r"(?i)URL has been copied to the clipboard",
    r"(?i)Reported age:\s*\d+",
    r"(?i)^Based on the current knowledge base:.*$",
)
# Whole sentences that are template text.
TEMPLATE_PATTERNS = (
    r"(?i)^Common factors that shift cycles include stress, recent illness, changes in exercise, and hormonal fluctuations\.?$",
    r"(?i)^Menstrual timing can vary month to month, especially with stress, travel, or lifestyle changes\.?$",
    r"(?i)^Cycle timing can vary due to stress, changes in routine, weight shifts, or contraception changes\.?$",
    r"(?i)^This pattern should be reviewed by a clinician.*$",
    r"(?i)^A clinician should review this pattern soon\.?$",
    r"(?i)^This pattern needs urgent medical evaluation\.?$",
    r"(?i)^Because red-flag symptoms may be present, urgent evaluation is recommended\.?$",
    r"(?i)^This can be within normal variation.*$",
    r"(?i)^This may fit normal variation.*$",
    r"(?i)^This may be normal, but follow up if it continues or worsens\.?$",
    r"(?i)^Stress can affect cycle timing and symptoms, so it may be a contributing factor\.?$",
    r"(?i)^Major changes in exercise or training load can also shift cycle timing\.?$",
    r"(?i)^This is educational information, not a diagnosis\.?$",
    r"(?i)^Follow-up questions:.*$",
)
# Fragments of personal stories.
NAME_FRAGMENTS = ("Carole", "Leila", "Lauren", "Liz", "Leslie", "Paula", "At 36,", "At age", "She had ,", "He had ,")


def tokens(c: Column) -> Column:
    """Lower-case runs of a-z and 0-9; null for null."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def collapse_white(c: Column) -> Column:
    """Any white space, Unicode's included, to one blank; trimmed."""
    return F.trim(F.regexp_replace(c, WHITE, " "))


def strip_tags(c: Column) -> Column:
    return collapse_white(F.regexp_replace(c, "<[^>]+>", " "))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def first_filled(*columns: Column) -> Column:
    """The first column that is neither null nor blank."""
    return F.coalesce(*(blank_to_null(c) for c in columns))


def sentences(c: Column) -> Column:
    """Split after . ! ? before white space; trimmed, blanks left out."""
    parts = F.transform(F.split(F.trim(c), SENTENCE_END), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside a lambda an outer expression is computed per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def distinct_ignoring_case(items: Column) -> Column:
    """The first of each group of strings equal but for case, in order."""

    def first_places(low: Column) -> Column:
        return F.filter(items, lambda s, i: F.array_position(low, F.element_at(low, i + 1)) == i + 1)

    return let(F.transform(items, lambda s: F.lower(s)), first_places)


def matches_any(c: Column, patterns: Sequence[str]) -> Column:
    return c.rlike("|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def contains_any(c: Column, phrases: Sequence[str]) -> Column:
    """Some phrase is a substring: byte searches, which are faster than one alternation pattern."""
    hit = F.lit(False)
    for k, p in enumerate(phrases):
        hit = F.contains(c, F.lit(p)) if k == 0 else hit | F.contains(c, F.lit(p))
    return hit


def clean(c: Column, drop: Sequence[str] = DROP_PATTERNS, templates: Sequence[str] = TEMPLATE_PATTERNS, names: Sequence[str] = ()) -> Column:
    """Struct(text, removed): sentences dropped by pattern, template or repetition; a text that would vanish stays."""
    def joined(once: Column) -> Column:
        text = F.trim(F.regexp_replace(F.array_join(once, " "), r"\s{2,}", " "))
        return F.struct(F.when(F.size(once) == 0, F.trim(c)).otherwise(text).alias("text"), F.size(once).alias("kept"))

    def cleaned(all_: Column) -> Column:
        kept = F.filter(all_, lambda s: ~(matches_any(s, drop) | matches_any(s, templates) | contains_any(s, names)))
        return let(let(distinct_ignoring_case(kept), joined), lambda x: F.struct(x["text"].alias("text"), (F.size(all_) - x["kept"]).alias("removed")))

    return let(sentences(c), cleaned)


def strip_fragments(c: Column, fragments: Sequence[str]) -> Column:
    for f in fragments:
        c = F.replace(c, F.lit(f), F.lit(""))
    return collapse_white(c)


def first_line(c: Column, n: int = 160) -> Column:
    return F.substring(F.split(c, "\n")[0], 1, n)


def word_count(c: Column) -> Column:
    """White-space separated words; none for blank."""
    return F.when(F.trim(c) == "", 0).otherwise(F.size(F.split(F.trim(c), r"\s+")))


def normal_license(c: Column) -> Column:
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("-"))


def digest_bucket(c: Column, n: int) -> Column:
    """The first 32 bits of the MD5 of a key, modulo n: the same on every engine."""
    return (F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % n).cast("int")


def when_chain(c: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The first rule one of whose phrases the text contains."""
    out = None
    for value, phrases in rules:
        out = F.when(contains_any(c, phrases), value) if out is None else out.when(contains_any(c, phrases), value)
    return out.otherwise(default) if out is not None else F.lit(default)


def labels(c: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """All rules one of whose phrases the text contains, in the rules' order, each label once."""
    hits = F.array(*(F.when(contains_any(c, p), F.lit(v)) for v, p in rules))
    return F.array_distinct(F.filter(hits, lambda x: x.isNotNull()))


# Document domains by name, publishing organisations by host, topics by keyword.
NAME_DOMAINS = (("women_health_extension", ("addon", "final_extension")), ("women_health_core", ("knowledge_base",)), ("menstrual_reproductive_core", ("reference", "menstrual")))
ORGANISATIONS = (("WHO", ("who.int",)), ("CDC", ("cdc.gov",)), ("ACOG", ("acog.org",)), ("Office on Women's Health", ("womenshealth.gov",)), ("NICHD", ("nichd.nih.gov",)), ("NHS", ("nhs.uk",)), ("NICE", ("nice.org.uk",)), ("MedlinePlus", ("medlineplus.gov",)), ("Mayo Clinic", ("mayoclinic.org",)), ("NIH", ("nih.gov",)))
TOPICS = (
    ("menstrual_reproductive_core", ("menstrual", "period")),
    ("pregnancy_fertility", ("pregnancy", "fertility")),
    ("menstrual_reproductive_core", ("ovulation",)),
    ("postpartum_breastfeeding", ("breastfeeding", "postpartum")),
    ("pcos_endocrine", ("pcos",)),
    ("endometriosis", ("endometriosis",)),
    ("structural_uterine", ("fibroid",)),
    ("infection_sti", ("pid", "sti")),
    ("contraception", ("contraception",)),
    ("endocrine", ("thyroid", "hormone")),
    ("menopause_perimenopause", ("perimenopause", "menopause")),
)


def domain_of_name(c: Column) -> Column:
    return when_chain(F.lower(c), NAME_DOMAINS, "women_health_general")


def organisation(url: Column) -> Column:
    return when_chain(F.lower(url), ORGANISATIONS, "web")


def topics(c: Column) -> Column:
    found = labels(F.lower(c), TOPICS)
    return F.when(F.size(found) == 0, F.array(F.lit("women_health_general"))).otherwise(found)
