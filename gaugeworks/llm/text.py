"""Column expressions on whole texts shared by the operators."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def filled(text: Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(text, F.lit(""))


def folded(text: Column) -> Column:
    """A-Z become lower case, every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(filled(text), SPACE), lambda w: w != "")
