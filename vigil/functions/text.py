"""Text cleaning: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The words accepted as yes and no.
YES_WORDS = ("yes", "true", "1", "y")
NO_WORDS = ("no", "false", "0", "n")


def blank_to_null(c: Column) -> Column:
    """Trim spaces (only spaces) and turn an empty rest into null."""
    return F.nullif(F.trim(c), F.lit(""))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def folded(c: Column) -> Column:
    """Case-insensitive join key: trimmed, lower case, null when blank."""
    return F.lower(blank_to_null(c))


def first_present(*cols: Column) -> Column:
    """First candidate that is not blank."""
    return F.coalesce(*(blank_to_null(c.cast("string")) for c in cols))


def title_words(c: Column) -> Column:
    """Capitalise after every character that is not a letter or digit.

    The built-in initcap only treats white space as a word boundary.
    """
    pieces = F.split(F.lower(c), r"(?<=[^\p{L}\p{N}])")
    return F.array_join(F.transform(pieces, F.initcap), "")


def normalise_sex(c: Column) -> Column:
    word = F.lower(F.trim(c))
    return (
        F.when(word.isin("male", "m"), "Male")
        .when(word.isin("female", "f"), "Female")
        .otherwise(title_words(blank_to_null(c)))
    )


def yes_no(c: Column) -> Column:
    """Yes/no words to boolean; anything else is null."""
    word = F.lower(F.trim(c))
    return F.when(word.isin(*YES_WORDS), True).when(word.isin(*NO_WORDS), False)


def yes_flag(c: Column) -> Column:
    """1 for a yes word, 0 for anything else including null."""
    return F.when(F.lower(F.trim(c)).isin(*YES_WORDS), 1).otherwise(0)
