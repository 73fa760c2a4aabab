"""Text normalisation of identifiers and categories."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: spellings of a missing entry left behind by text conversions
MISSING_SPELLINGS = ["", "nan", "<NA>"]


def category(text: Column, missing: str = "<missing>") -> Column:
    """Trimmed text, with null, empty and not-a-number spellings turned into ``missing``."""
    trimmed = F.trim(text.cast("string"))
    return F.when(trimmed.isNull() | trimmed.isin(MISSING_SPELLINGS), missing).otherwise(trimmed)


def legacy_category(text: Column) -> Column:
    """The older rule: empty text becomes ``Unknown``, a missing entry a category of its own."""
    trimmed = F.trim(text.cast("string"))
    return F.when(trimmed.isNull(), "<missing>").when(trimmed == "", "Unknown").otherwise(trimmed)


def pad_two(text: Column) -> Column:
    """Zero-padded to two characters; longer text is kept whole."""
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)
