"""Column -> Column helpers (scalar functions F1-F21).

All are built from JVM-side Spark SQL expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from .keys import (date_key, normalize_key, row_key, surrogate_key,
                   time_key, uuid_key)
from .records import from_json_text, pack_json, parse_records, to_json_value
from .text import (absolute_url, count_or_zero, first_token, last_token,
                   not_found, percent_token, rank_score, strip_ws, url_from_id,
                   fill_size_template)
from .times import epoch_to_iso_utc, iso_to_ntz, processing_time

__all__ = [
    "absolute_url", "count_or_zero", "date_key", "epoch_to_iso_utc",
    "fill_size_template", "first_token", "from_json_text",
    "iso_to_ntz", "last_token", "normalize_key", "not_found", "pack_json",
    "parse_records", "percent_token", "processing_time", "rank_score",
    "row_key", "strip_ws", "surrogate_key", "time_key", "to_json_value",
    "url_from_id", "uuid_key",
]
