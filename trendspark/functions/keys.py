"""Keys: normalisation, date/time keys and surrogate keys.

Surrogate keys come in two modes:

* ``md5`` (default): ``md5(platform || '|' || natural key)``. A pure function
  of the row, so every write of a fan-out, every retry after a lost
  executor and every later batch gives the same key; no join is needed to
  attach it, and the same name keeps its key across batches.
* ``uuid``: random, as a per-row ``uuid()``. Callers must freeze such keys
  (write or ``checkpoint()`` the frame) before using them twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c) -> Column:
    """``lower(trim(k))`` — SQL trim, spaces only, as the warehouse does."""
    return F.lower(F.trim(_c(c)))


def date_key(ts) -> Column:
    """``yyyyMMdd`` as int. Strings are read as naive ISO timestamps."""
    return F.date_format(_ntz(ts), "yyyyMMdd").cast("int")


def time_key(ts) -> Column:
    """``HHmm`` as a string, keeping leading zeros."""
    return F.date_format(_ntz(ts), "HHmm")


def _ntz(ts) -> Column:
    # an offset in the text is ignored: keys use the wall clock as written;
    # text that is no time gives a null key and does not stop the load
    return _c(ts).cast("string").try_cast("timestamp_ntz")


def surrogate_key(platform: str, natural) -> Column:
    """md5 key of one natural key; null natural key -> null key (F2 concat)."""
    return F.md5(F.concat(F.lit(platform), F.lit("|"), _c(natural).cast("string")))


def row_key(platform: str, *cols) -> Column:
    """md5 key of a row's content: every identifying column, nulls marked.

    Each part carries its length, so no two different rows give one text.
    Rows equal in all these columns share a key: it names the content, and a
    record that is published twice is one content.
    """
    parts = [F.lit(platform)]
    for c in cols:
        text = _c(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK)))
    return F.md5(F.concat_ws("|", *parts))


def uuid_key() -> Column:
    """random key (``uuid()``), for the reference-compatible mode."""
    return F.expr("uuid()")
