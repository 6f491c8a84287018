"""Column expressions on texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    """Number of words as a long; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
