"""JSON text -> edit records, for a batch or a streaming DataFrame alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgefilter.schemas import EDIT_STREAM_SCHEMA


def parse_edit_json(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Each text value holds one JSON object or an array of them.

    The array schema accepts both; garbage or NULL parses to NULL and
    ``explode`` then yields no row; a field of the wrong type becomes NULL
    in that field only.
    """
    parsed = lines.select(F.from_json(F.col(value_col).cast("string"), EDIT_STREAM_SCHEMA).alias("data"))
    return parsed.selectExpr("explode(data) as record").select("record.*")
