"""Joins that adaptive execution can split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dealt_anew(key: str) -> Column:
    """The same whole number as a new expression, under the same name.

    An aggregate by a key is already dealt out by it, and a join on that key reads it as it
    lies; then the other side cannot be split where a key is hot. With this, the (small)
    aggregate is dealt out once more for the join, and adaptive execution splits the hot
    partitions of the other side.
    """
    return F.bitwise_not(F.bitwise_not(F.col(key))).alias(key)
