"""JSON text parsed once per document, against a declared schema.

One ``from_json`` beats one path lookup per wanted field: a path function parses the whole
text on each call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# An explicit mode also keeps the optimizer from splitting the parse into one per field.
_LENIENT = {"mode": "PERMISSIVE"}


def parse(text: Column, schema: T.DataType) -> Column:
    """Parsed document; fields are null where absent, mistyped or in malformed text."""
    return F.from_json(text, schema, _LENIENT)


def parse_pairs(text: Column) -> Column:
    """Record of any shape as a map from field name to text (nested values as JSON text)."""
    return F.from_json(text, T.MapType(T.StringType(), T.StringType()), _LENIENT)


def path_text(text: Column, path: str) -> Column:
    """Text at one path, ``''`` when the path leads nowhere."""
    return F.coalesce(F.get_json_object(text, path), F.lit(""))
