"""Lookups with defaults.

The lookup is a plain left join: Catalyst and AQE broadcast it where its
size in bytes is below ``spark.sql.autoBroadcastJoinThreshold``, and
otherwise shuffle both sides (with skew splitting). No job runs while the
plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_with_default(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str,
                        fields: dict) -> DataFrame:
    """Left join ``df`` to ``lookup`` and default each looked-up field.

    ``fields`` maps ``lookup column -> (output name, default)``. A key with
    no match (or a null key) gets the defaults; ``df`` keeps every row.
    """
    renamed = lookup.select(F.col(right_key).alias("_lk_key"),
                            *[F.col(src).alias(f"_lk_{src}") for src in fields])
    # a lookup keyed by id must hold one row per id, or the join would
    # multiply input rows: keep the largest row per id
    vals = [f"_lk_{src}" for src in fields]
    renamed = (renamed.groupBy("_lk_key").agg(F.max(F.struct(*vals)).alias("_lk"))
               .select("_lk_key", *[F.col(f"_lk.{v}").alias(v) for v in vals]))
    joined = df.join(renamed, df[left_key] == renamed["_lk_key"], "left")
    outs = [F.coalesce(F.col(f"_lk_{src}"), F.lit(default)).alias(name)
            for src, (name, default) in fields.items()]
    return joined.select(*[df[c] for c in df.columns], *outs)
