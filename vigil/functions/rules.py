"""Classification, result and outcome rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vigil.functions.text import blank_to_null

# Source words and the canonical value each stands for.
CLASSIFICATION_WORDS = {
    "SUSPECTED": ["suspected"],
    "PROBABLE": ["probable"],
    "CONFIRMED": ["confirmed"],
    "DISCARDED": ["discarded", "not a case", "no case"],
}
FINAL_ONLY_DISCARDED = ["negative"]
LAB_RESULT_WORDS = {
    "POSITIVE": ["positive", "detected", "reactive", "present"],
    "NEGATIVE": ["negative", "not detected", "non-reactive", "non reactive", "absent"],
    "INCONCLUSIVE": ["indeterminate", "inconclusive", "invalid", "equivocal"],
}
CASE_RESULT_WORDS = {
    "POSITIVE": [
        "positive", "detected", "reactive", "positive/detected", "positive / detected",
    ],
    "NEGATIVE": [
        "negative", "not detected", "not_detected", "non-reactive", "non reactive",
        "nonreactive", "negative/not detected", "negative / not detected",
    ],
    "INCONCLUSIVE": ["inconclusive", "indeterminate", "invalid"],
}
DEATH_WORDS = [
    "dead", "death", "died", "deceased", "deceased/dead", "deceased /dead",
    "deceased / dead",
]
OUTCOME_WORDS = {
    "ALIVE": ["alive", "living"],
    "RECOVERED": ["recovered", "recovery", "discharged", "alive and discharged"],
    "ON_TREATMENT": [
        "admitted", "on treatment", "under treatment", "ongoing", "hospitalized",
        "hospitalised",
    ],
    "TRANSFERRED": ["transferred", "referred", "transfer out", "transferred out"],
    "LOST_TO_FOLLOW_UP": ["lost to follow up", "lost to follow-up", "lost", "ltfu"],
}
SCREENING_WORDS = {"SUSPECTED": ["suspected"], "PROBABLE": ["probable"]}


def by_words(c: Column, words: dict[str, list[str]], blank: str | None, other: Column) -> Column:
    """Canonical value for a word; `blank` when there is no text, `other` for the rest.

    One map lookup, so that the generated code does not repeat the cleaned text per word.
    """
    pairs = [(w, value) for value, synonyms in words.items() for w in synonyms]
    if blank is not None:
        pairs.append(("", blank))
    canonical = F.create_map(*(F.lit(x) for pair in pairs for x in pair))
    word = F.lower(F.coalesce(F.trim(c), F.lit("")))
    return F.coalesce(F.try_element_at(canonical, word), other)


def as_sent(c: Column) -> Column:
    return F.upper(blank_to_null(c))


def initial_classification(c: Column) -> Column:
    return by_words(c, CLASSIFICATION_WORDS, "UNKNOWN", as_sent(c))


def final_classification(c: Column) -> Column:
    discarded = CLASSIFICATION_WORDS["DISCARDED"] + FINAL_ONLY_DISCARDED
    words = {**CLASSIFICATION_WORDS, "DISCARDED": discarded}
    return by_words(c, words, "UNKNOWN", as_sent(c))


def reporting_classification(final: Column, initial: Column) -> Column:
    """Final classification once known, else the initial one."""
    known = F.nullif(blank_to_null(final), F.lit("UNKNOWN"))
    return F.when(known.isNotNull(), final).otherwise(
        F.when(blank_to_null(initial).isNotNull(), initial).otherwise("UNKNOWN")
    )


def investigation_status(final: Column) -> Column:
    return F.when(final.isin("CONFIRMED", "DISCARDED"), "CONCLUDED").otherwise("OPEN")


def screening_outcome(c: Column) -> Column:
    return by_words(c, SCREENING_WORDS, "NORMAL", as_sent(c))


def screening_category(
    suspected: Column, probable: Column, normal: Column, flagged: Column, outcome: Column
) -> Column:
    return (
        F.when(suspected == 1, "SUSPECTED")
        .when(probable == 1, "PROBABLE")
        .when(normal == 1, "NORMAL")
        .when(flagged == 1, "FLAGGED")
        .otherwise(F.coalesce(F.upper(blank_to_null(outcome)), F.lit("UNKNOWN")))
    )


def lab_result_category(c: Column) -> Column:
    return by_words(c, LAB_RESULT_WORDS, "UNKNOWN", F.lit("OTHER"))


def case_result_category(c: Column) -> Column:
    return by_words(c, CASE_RESULT_WORDS, "UNKNOWN", F.lit("OTHER"))


def source_outcome(c: Column, lab_result: Column) -> Column:
    """Outcome as sent, canonical. A death is not taken from it: with a negative
    laboratory result the person counts as alive, otherwise the value is dropped."""
    alive = {**OUTCOME_WORDS, "ALIVE": OUTCOME_WORDS["ALIVE"] + DEATH_WORDS}
    not_death = F.when(~F.lower(F.trim(c)).isin(DEATH_WORDS), as_sent(c))
    return F.when(lab_result == "NEGATIVE", by_words(c, alive, None, as_sent(c))).otherwise(
        by_words(c, OUTCOME_WORDS, None, not_death)
    )


def validated_death(died_on: Column, final: Column, lab_result: Column) -> Column:
    proven = died_on.isNotNull() & (final == "CONFIRMED") & (lab_result == "POSITIVE")
    return F.when(proven, 1).otherwise(0)


def outcome_validation(died_on: Column, final: Column, lab_result: Column) -> Column:
    """What is missing for a death date to count, null when nothing is."""
    return F.when(
        died_on.isNotNull(),
        F.when(final != "CONFIRMED", "DEATH_DATE_WITHOUT_CONFIRMED_CLASSIFICATION")
        .when(lab_result == "NEGATIVE", "DEATH_DATE_WITH_NEGATIVE_LAB_RESULT")
        .when(
            lab_result.isin("UNKNOWN", "INCONCLUSIVE", "OTHER"),
            "DEATH_DATE_WITHOUT_POSITIVE_LAB_RESULT",
        ),
    )


def treatment_outcome(died: Column, outcome: Column) -> Column:
    return (
        F.when(died == 1, "DECEASED")
        .when(outcome.isin(list(OUTCOME_WORDS)), outcome)
        .otherwise("UNKNOWN")
    )
