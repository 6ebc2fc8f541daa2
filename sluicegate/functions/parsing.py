"""JSON text to structs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_once(text: Column, schema: T.StructType, options: Mapping[str, str] | None = None) -> Column:
    """``from_json`` as a generated column, one per row, NULL where the text is.

    A plain one would be copied into every filter on a parsed field that moves below the projection,
    and the text parsed once for each; no filter moves below a generator it depends on.
    """
    return F.explode(F.array(F.from_json(text, schema, dict(options or {}))))
