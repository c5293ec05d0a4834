"""How a text column holding timestamps is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigil.functions import temporal as tm


def timestamp_profile(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    raw, text = F.col(column), F.trim(column)
    parsed = tm.instant(raw)
    return df.select(
        *keep,
        raw.alias(f"raw_{column}"),
        text.alias(f"trimmed_{column}"),
        F.length(raw).alias("raw_character_length"),
        F.length(text).alias("trimmed_character_length"),
        F.when(raw.isNull(), "SOURCE_NULL")
        .when(text == "", "SOURCE_EMPTY")
        .when(text.rlike(tm.ISO_INSTANT), "ISO_TIMESTAMP_MATCH")
        .otherwise("NO_PATTERN_MATCH")
        .alias("timestamp_pattern_status"),
        parsed.alias(f"parsed_{column}"),
        tm.local_date(parsed).alias("parsed_screening_date"),
    )
