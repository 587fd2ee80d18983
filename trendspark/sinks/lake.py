"""Lake records (K9, K10, F10): stamp ``ingested_at`` into each JSON record
and route it to ``topic=/year=/month=/day=`` folders.

The record text is kept as published: ``ingested_at`` is appended to the
object, so field order and number formats are untouched; a record that has
the field already is written anew with the field replaced. Texts that are
not one JSON object from end to end are returned separately (quarantine)
instead of stopping the archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import iso_naive, processing_time


#: White space around and inside a record's braces.
_BLANK = " \t\n\r\x0b\f"


def _parsed(value: Column) -> Column:
    """What the check of a text needs, as a struct: the text's values as the elements of an array (``named`` or ``plain``), and ``whole``.

    A parser stops after the first value, so the text is parsed inside an
    array (which must then have one element) and inside an object: what
    closes one of the two early breaks the other. Only a text with a ``]`` can
    close the array, so others need no second parse. All fields are taken
    (``named``) only of a text that may have the stamp's, by its name or by
    escapes; of others the parser passes over what it reads (``plain``).
    """
    in_array = F.concat(F.lit("["), value, F.lit("]"))
    in_object = F.from_json(F.concat(F.lit('{"k":'), value, F.lit("}")), "struct<k:map<string,string>>")
    may_name = F.contains(value, F.lit("ingested_at")) | F.contains(value, F.lit("\\"))
    return F.struct(F.when(may_name, F.from_json(in_array, "array<map<string,string>>")).alias("named"),
                    F.when(~may_name, F.from_json(in_array, "array<struct<ingested_at:string>>")).alias("plain"),
                    F.when(F.contains(value, F.lit("]")), in_object["k"].isNotNull()).otherwise(True).alias("whole"))


def _checked(named: Column, plain: Column, whole: Column) -> tuple[Column, Column]:
    """``(whether the whole text is one JSON object, whether it has the stamp's field)`` of a parsed text."""
    def one(values):
        return F.coalesce((F.size(values) == 1) & F.get(values, F.lit(0)).isNotNull(), F.lit(False))
    has_stamp = F.map_contains_key(F.get(named, F.lit(0)), F.lit("ingested_at"))
    return (one(named) | one(plain)) & F.coalesce(whole, F.lit(False)), F.coalesce(has_stamp, F.lit(False))


def is_json_object(value: Column) -> Column:
    """Whether the whole text is one JSON object."""
    parsed = _parsed(value)
    return _checked(parsed["named"], parsed["plain"], parsed["whole"])[0]


def record_body(value: Column) -> Column:
    """What is between the braces of a JSON object's text."""
    def inside(text):     # cut by bytes, as a brace is one
        return F.substring(text.cast("binary"), F.lit(2), F.octet_length(text) - 2).cast("string")
    # a trim goes over a text by its characters; without blanks at the braces there is nothing to trim
    tight = F.startswith(value, F.lit('{"')) & F.endswith(value, F.lit("}"))
    for blank in _BLANK:
        tight = tight & ~F.endswith(value, F.lit(blank + "}"))
    return F.when(tight, inside(value)).otherwise(F.btrim(inside(F.btrim(value, F.lit(_BLANK))), F.lit(_BLANK)))


def stamp_record(value: Column, ingested_at: Column, has_stamp: Column, body: Column | None = None) -> Column:
    """``{...}`` -> ``{..., "ingested_at": "<iso>"}`` (``{}`` -> ``{"ingested_at": ...}``); ``body``: the text's ``record_body``, if at hand."""
    body = record_body(value) if body is None else body
    field = F.concat(F.lit('"ingested_at": "'), ingested_at, F.lit('"'))
    appended = F.concat(F.lit("{"), body, F.when(body == "", "").otherwise(", "), field, F.lit("}"))
    # variants keep the values of the other fields as they are
    others = F.map_filter(F.from_json(value, "map<string,variant>"), lambda k, v: k != "ingested_at")
    stamp = F.map_from_arrays(F.array(F.lit("ingested_at")), F.array(F.parse_json(F.concat(F.lit('"'), ingested_at, F.lit('"')))))
    replaced = F.to_json(F.map_concat(others, stamp))
    return F.when(has_stamp, replaced).otherwise(appended)


def routed_rows(raw: DataFrame, route_ts: Column | None = None) -> DataFrame:
    """``(kind, topic, year, month, day, value)``: each raw ``(topic, value)`` row once.

    Records (``kind`` ``lake``) are stamped; what isn't a JSON object
    (``rejects``) is kept as JSON of its topic and text. ``route_ts``
    (default, and where it is null: processing time, one value per
    micro-batch, as the archiver stamps its records) gives both ``ingested_at`` and the
    ``year/month/day`` folder (zero-padded month and day, K10); rejects
    are filed by their topic alone.
    """
    ts = processing_time() if route_ts is None else F.coalesce(route_ts, processing_time())
    text = F.col("value").cast("string")
    # inline(array(...)): what follows reads the parsed text. A generator's own expressions are evaluated wherever they
    # stand, so it holds each parse once and the conditions on it come after it, where several columns may read them
    rows = raw.select("topic", text.alias("value"), ts.alias("_ts"), F.inline(F.array(_parsed(text))))
    ok, has_stamp = _checked(F.col("named"), F.col("plain"), F.col("whole"))
    rows = rows.select("topic", "value", ok.alias("_ok"), has_stamp.alias("_has"), record_body(F.col("value")).alias("_body"),
                       iso_naive(F.col("_ts")).alias("_iso"))
    day = F.substring_index("_iso", "T", 1)     # a date may have a year of more than four digits

    def part(of_date):
        return F.when(F.col("_ok"), of_date).otherwise("-")
    return rows.select(
        F.when(F.col("_ok"), "lake").otherwise("rejects").alias("kind"), "topic",
        part(F.substring_index(day, "-", 1)).alias("year"), part(F.substring(day, -5, 2)).alias("month"), part(F.substring(day, -2, 2)).alias("day"),
        F.when(F.col("_ok"), stamp_record(F.col("value"), F.col("_iso"), F.col("_has"), F.col("_body")))
         .otherwise(F.to_json(F.struct("topic", "value"))).alias("value"))


def lake_rows(raw: DataFrame, route_ts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Archive rows and rejects (``topic, value``) of raw ``(topic, value)`` rows."""
    rows = routed_rows(raw, route_ts)
    bad = rows.where("kind = 'rejects'").select(F.from_json("value", "topic string, value string").alias("r")).select("r.topic", "r.value")
    return rows.where("kind = 'lake'").select("topic", "value", "year", "month", "day"), bad
