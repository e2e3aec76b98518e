"""Text to number without raising under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_whole(text: Column) -> Column:
    """Whole number, null where the text is none."""
    return text.try_cast("bigint")


def to_number(text: Column) -> Column:
    """Number with ``.`` or ``,`` as its decimal mark, null where the text is none.

    A Java type suffix (``5d``, ``5f``) is no number, though a plain cast takes it.
    """
    plain = F.replace(text, F.lit(","), F.lit("."))
    return F.when(~text.rlike(r"[dDfF]\s*$"), plain.try_cast("double"))
