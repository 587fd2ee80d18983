"""Best row per key, top-1 per key and ranked reads.

Top-1 per key is written as ``max(struct(order..., payload...))`` grouped
by the key, not as a window: the aggregate is combined map-side (partial
aggregation), so a key that holds a third of all rows still shuffles one
row per map task, and the same expression runs in a streaming aggregate
(update / complete mode), where windows are not allowed. Ties on the order
columns fall to the payload columns in order, largest first, so the chosen
row is always fixed; rows that tie on every field are identical in the
output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(cols):
    return [cols] if isinstance(cols, str) else list(cols)


def best_struct(order, payload=()) -> Column:
    """``max(struct(order..., payload...))`` — the largest row by ``order``."""
    cols = _names(order) + [c for c in _names(payload) if c not in _names(order)]
    return F.max(F.struct(*cols))


def newest_struct(ts, payload=()) -> Column:
    """A2: the newest row by a timestamp column (string order for text)."""
    return best_struct([ts], payload)


def best_row_per_key(df: DataFrame, keys, order, payload=(), alias: str = "best",
                     flatten: bool = True, prefix: str = "") -> DataFrame:
    """The best row of each key group.

    ``order`` columns rank descending, ``payload`` columns ride along and
    break remaining ties. With ``flatten`` the struct is expanded into
    ``prefix + field`` columns.
    """
    keys = _names(keys)
    agg = df.groupBy(*keys).agg(best_struct(order, payload).alias(alias))
    if not flatten:
        return agg
    fields = _names(order) + [c for c in _names(payload) if c not in _names(order)]
    return agg.select(*keys, *[F.col(f"{alias}.{f}").alias(prefix + f) for f in fields])


def top1_per_key(df: DataFrame, key, measure, tiebreak=(), keep_cols=()) -> DataFrame:
    """One row per ``key`` with the largest ``measure``.

    ``tiebreak`` fixes the winner among equal measures (largest first);
    ``keep_cols`` are returned as well. Output columns are the input names.
    """
    payload = list(_names(tiebreak)) + [c for c in _names(keep_cols) if c not in _names(tiebreak)]
    return best_row_per_key(df, key, [measure], payload, alias="_top")


def one_row_per_key(df: DataFrame, keys, order=None) -> DataFrame:
    """Keep one row per key, chosen by ``order`` (default: every other
    column in schema order), instead of an arbitrary ``dropDuplicates`` row."""
    keys = _names(keys)
    rest = [c for c in df.columns if c not in keys]
    order = _names(order) if order else rest
    payload = [c for c in rest if c not in order]
    out = best_row_per_key(df, keys, order, payload, alias="_one")
    return out.select(*df.columns)


def key_summary(df: DataFrame, key, measure, best_payload, ts, newest_payload,
                total_alias: str = "total") -> DataFrame:
    """A5: running total, best row and newest row of each key in one pass."""
    return df.groupBy(key).agg(
        F.sum(measure).alias(total_alias),
        best_struct([measure], best_payload).alias("top"),
        newest_struct(ts, newest_payload).alias("newest"),
    )


def ranked_read(df: DataFrame, score: str = "score", member: str = "member",
                n: int | None = None, ascending: bool = False) -> DataFrame:
    """Members ordered by score (ties by member); top ``n`` when given.

    With a limit this plans as TakeOrderedAndProject: each task keeps its
    own top ``n`` and only those reach the final merge.
    """
    s = F.col(score).asc() if ascending else F.col(score).desc()
    out = df.orderBy(s, F.col(member).asc())
    return out.limit(n) if n is not None else out


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    """The first ``n`` rows by ``order`` (list of Columns or names, descending)."""
    cols = [F.col(c).desc() if isinstance(c, str) else c for c in _names(order)]
    return df.orderBy(*cols).limit(n)
