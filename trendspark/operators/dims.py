"""Surrogate keys and dimensions.

``md5`` mode attaches keys with a projection: the key is a function of the
natural key, so the batch is never joined to its own distinct keys and no
shuffle is spent on it. ``uuid`` mode reproduces the random keys: distinct
natural keys get a ``uuid()``, the result is frozen with ``checkpoint()``
(random keys must not be recomputed after a lost executor) and joined back
with a left join, leaving a null key for a null natural key. A
``KeyRegistry`` makes random keys hold over batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize_key, surrogate_key, uuid_key
from ..session import checkpoint_dir
from .ranking import one_row_per_key


class KeyRegistry:
    """F6 over batches: the random key that a name has been given, insert-if-absent.

    ``known(sk)`` gives the committed ``(natural, key)`` rows of a key column,
    or None; only ``names`` are kept (keys of single events never come
    again). ``tables`` are a batch's new rows, which must be committed with
    the batch, as its facts refer to them.
    """

    def __init__(self, known, names):
        self.known, self.names = known, frozenset(names)
        self.tables: dict[str, DataFrame] = {}

    def keys(self, sk: str, naturals: DataFrame) -> DataFrame:
        """``(natural, key)`` of the distinct ``naturals``: known keys, and new ones for new names."""
        known = self.known(sk)
        if known is None:
            known = naturals.sparkSession.createDataFrame([], "natural string, key string")
        # names without a known key get one; frozen, as random keys must not be computed again
        given = naturals.select(F.col("natural").cast("string").alias("natural")).where(F.col("natural").isNotNull()).join(
            known.select("natural", F.col("key").alias("_known")), "natural", "left")
        given = given.select("natural", F.col("_known").isNull().alias("is_new"), F.coalesce("_known", uuid_key()).alias("key")).checkpoint(eager=True)
        self.tables[f"Keys_{sk}"] = given.where("is_new").select("natural", "key")
        return given.select("natural", "key")


def attach_key(df: DataFrame, platform: str, sk: str, natural, mode: str = "md5",
               normalize: bool = False, registry: KeyRegistry | None = None) -> DataFrame:
    """Add surrogate key column ``sk`` for ``natural``.

    ``natural`` is a column name or a Column (J3 passes a concatenation).
    With ``normalize`` the key is ``lower(trim(natural))`` (J2).
    """
    nat: Column = F.col(natural) if isinstance(natural, str) else natural
    if normalize:
        nat = normalize_key(nat)
    if mode == "md5":
        return df.withColumn(sk, surrogate_key(platform, nat))
    if mode != "uuid":
        raise ValueError(f"unknown key mode {mode!r}")
    spark = df.sparkSession
    checkpoint_dir(spark)
    keyed = df.withColumn("_nk", nat)
    if registry is not None and sk in registry.names:
        given = registry.keys(sk, keyed.select(F.col("_nk").alias("natural")).distinct())
        return keyed.join(given.select(F.col("natural").alias("_nk"), F.col("key").alias(sk)), "_nk", "left").drop("_nk")
    dim = (keyed.select("_nk").distinct().withColumn(sk, uuid_key())
           .checkpoint(eager=True))
    # a null natural key matches nothing in an equi-join -> null key
    return keyed.join(dim, "_nk", "left").drop("_nk")


def attach_keys(df: DataFrame, platform: str, specs: list, mode: str = "md5", registry: KeyRegistry | None = None) -> DataFrame:
    """Several independent key attachments on one frame (a star row)."""
    for spec in specs:
        sk, natural = spec[0], spec[1]
        normalize = spec[2] if len(spec) > 2 else False
        df = attach_key(df, platform, sk, natural, mode=mode, normalize=normalize, registry=registry)
    return df


def dimension(df: DataFrame, sk: str, attrs: dict, order=None, unique: bool = False) -> DataFrame:
    """Dimension rows of one batch: one row per key.

    ``attrs`` maps output name -> column name/Column. With ``unique`` the
    attributes are a function of the key (the key hashes them), so the
    rows are the distinct pairs: a hash aggregate, combined map-side.
    Otherwise several rows may share a key and ``order`` (output names)
    picks the row (largest wins), default all attributes in order, so the
    row is fixed, not arbitrary.
    """
    cols = [F.col(sk)] + [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in attrs.items()]
    rows = df.select(*cols)
    if unique:
        return rows.distinct()
    return one_row_per_key(rows, sk, order=order)


def new_dimension_rows(batch_dim: DataFrame, existing: DataFrame | None, sk: str) -> DataFrame:
    """Rows of ``batch_dim`` with a key that is not yet in ``existing`` (left anti).

    Keeps keys unique across batches in md5 mode. A null key names nothing
    and never becomes a dimension row.
    """
    batch_dim = batch_dim.where(F.col(sk).isNotNull())
    if existing is None:
        return batch_dim
    return batch_dim.join(existing.select(sk), sk, "left_anti")
