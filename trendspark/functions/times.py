"""Time text (F8-F10). Results do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_iso_utc(c) -> Column:
    """F8: epoch seconds -> ``yyyy-MM-dd'T'HH:mm:ss+00:00`` (UTC)."""
    secs = _c(c).cast("bigint")
    ts = F.timestamp_add("SECOND", secs, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def iso_to_ntz(c) -> Column:
    """Parse ISO text (naive or with an offset) into a wall-clock timestamp; other text gives null."""
    return _c(c).cast("string").try_cast("timestamp_ntz")


def processing_time() -> Column:
    """processing-time stamp; one value per query (per micro-batch)."""
    return F.current_timestamp()


def poll_stamp(ts: Column | None = None) -> Column:
    """a poll's stamp as text, of ``ts`` or of the processing time."""
    return F.date_format(processing_time() if ts is None else ts, "yyyy-MM-dd HH:mm:ss")


def iso_naive(ts) -> Column:
    """Naive ISO text with microseconds, as ``datetime.isoformat()`` writes it."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
