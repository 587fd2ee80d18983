"""JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def to_json_value(df: DataFrame, cols=None, name: str = "value") -> DataFrame:
    """One JSON text per row (what a publisher puts on a topic)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias(name))


def from_json_text(c, schema: StructType) -> Column:
    """S3 + P1: decode bytes to text and parse with a fixed schema (PERMISSIVE).

    Malformed text gives an all-null struct; a field that does not fit its
    type (e.g. an int overflow) becomes null and the others survive.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col.cast("string"), schema)


def parse_records(df: DataFrame, schema: StructType, value_col: str = "value",
                  keep: tuple = ()) -> DataFrame:
    """P1 + P2: parse ``value`` and flatten the struct (``data.*``)."""
    return (df.select(*keep, from_json_text(value_col, schema).alias("data"))
              .select(*keep, "data.*"))


def pack_json(*cols, keep_nulls: bool = False) -> Column:
    """Pack columns into one JSON document.

    ``keep_nulls=True`` writes ``null`` fields as a Python ``json.dumps``
    would; the default drops them, as Spark's ``to_json`` does.
    """
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*cols), opts)
