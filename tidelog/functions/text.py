"""Similarity of texts by the words they share, for rows that carry no embedding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_blank(text: Column) -> Column:
    """True if there is something other than white space in the text; null counts as blank."""
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def words(text: Column) -> Column:
    """The distinct words of a text, lower-cased."""
    split = F.split(F.regexp_replace(F.lower(text), r"[\s\p{Punct}]+", " "), " ")
    return F.array_remove(F.array_distinct(split), "")


def word_cosine(left: Column, right: Column) -> Column:
    """Cosine of two word sets: shared words over the geometric mean of the set sizes; 0 if either is empty."""
    shared = F.size(F.array_intersect(left, right)).cast("double")
    area = (F.size(left) * F.size(right)).cast("double")
    return F.when(area > 0, shared / F.sqrt(area)).otherwise(F.lit(0.0))
