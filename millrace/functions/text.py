"""Text cleaning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_first(text: Column, mark: str) -> Column:
    """Array of at most two parts, cut at the first ``mark`` (taken literally)."""
    return F.split(text, re.escape(mark), 2)


def split_every(text: Column, mark: str) -> Column:
    """Array of all parts, cut at every ``mark`` (taken literally)."""
    return F.split(text, re.escape(mark))


def part(parts: Column, index: int) -> Column:
    """Part ``index``, null when there are fewer; ``parts[index]`` raises under ANSI."""
    return F.get(parts, F.lit(index))


def pad_start(text: Column, width: int, pad: str = "0") -> Column:
    """Pad on the left up to ``width``. Longer text stays whole, unlike with ``lpad``."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, pad))


def text_or_empty(value: Column) -> Column:
    """Text form of a value, with ``''`` for a missing one: one group key for "missing"."""
    return F.coalesce(value.cast("string"), F.lit(""))


def join_texts(texts: Column, mark: str) -> Column:
    """Array joined by ``mark``; a null array gives ``''`` (``array_join`` gives null)."""
    return F.concat_ws(mark, texts)


def drop_last(text: Column) -> Column:
    """Text without its last character, as for the ``Z`` that ends a UTC stamp."""
    return F.left(text, F.length(text) - 1)
