"""Column expressions on text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokenize(column: Column | str, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case words of a text in order, repeats kept, stop-words removed."""
    words = F.split(F.lower(column), r"\W+")
    dropped = ["", *stop_words]
    return F.filter(words, lambda word: ~word.isin(dropped))


def strip_quotes(column: Column | str) -> Column:
    return F.translate(column, '"', "")


def contains_any(column: Column | str, terms: Sequence[str]) -> Column:
    """Whether the lower-cased text holds any of the terms."""
    found = F.lit(False)
    for term in terms:
        found = found | F.lower(column).contains(term)
    return found
