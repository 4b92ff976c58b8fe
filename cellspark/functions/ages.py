"""Age extraction from development-stage text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stage patterns and the species names the age rules know. (?U) makes \s and \d
# take in non-ASCII blanks and digits; digits that do not parse as a number give null.
YEARS_PATTERN = r"(?U)(\d+(?:\.\d+)?)-year-old"
MONTHS_PATTERN = r"(?U)(\d+(?:\.\d+)?)\s*-?\s*m(?:onth)?"
HUMAN = "Homo sapiens"
MOUSE = "Mus musculus"


def age_in_years(stage: Column) -> Column:
    """``22-year-old stage`` -> 22.0; anything else -> null."""
    return F.regexp_extract(stage, YEARS_PATTERN, 1).try_cast("double")


def age_in_months(stage: Column) -> Column:
    """``24m``, ``5-month-old`` -> months. Loose on purpose: any number followed by ``m`` counts."""
    return F.regexp_extract(stage, MONTHS_PATTERN, 1).try_cast("double")
