"""Sums, counts and distinct keys.

All are hash aggregates with a map-side partial step; hot keys are
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def sum_per_key(df: DataFrame, key, value: str, alias: str, drop_null_keys: bool = True) -> DataFrame:
    """A3/A4: sum of ``value`` per key.

    ``drop_null_keys`` mirrors a pandas ``groupby`` (null groups vanish);
    set it to False to keep them as A6 does.
    """
    keys = [key] if isinstance(key, str) else list(key)
    src = df
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        src = df.where(cond)
    return src.groupBy(*keys).agg(F.sum(value).alias(alias))


def observed_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while an action runs, without a second pass.

    Read ``obs.get["n"]`` after the action on the returned frame.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs
