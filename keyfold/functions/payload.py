"""JSON payloads: parse, check, extract metadata, write."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Put behind a payload before parsing. Drawn by each process, so no payload can hold it.
_END = uuid.uuid4().hex


def _framed(payload: Column | str) -> tuple[Column, Column]:
    """The payload as first element of an array, and whether it is all of that element.

    ``try_parse_json`` stops at the end of the first value and ignores what follows. So
    an end mark is the second element: it is found there only if exactly one document
    stands before it. Parsing once answers both.
    """
    framed = F.try_parse_json(F.concat(F.lit("["), _col(payload), F.lit(f',"{_END}"]')))
    return framed, F.coalesce(F.try_variant_get(framed, "$[1]", "string") == _END, F.lit(False))


def parsed(payload: Column | str) -> Column:
    """The payload as a variant, null unless the whole text is one JSON document.

    Objects that repeat a name keep the last value, see ``session.SETTINGS``.
    """
    framed, whole = _framed(payload)
    return F.when(whole, F.try_variant_get(framed, "$[0]", "variant"))


def is_json(payload: Column | str) -> Column:
    return _framed(payload)[1]


def string_field(document: Column, name: str) -> Column:
    """A top-level field of a variant, only when it holds a JSON string."""
    field = F.try_variant_get(document, f"$.{name}", "variant")
    return F.when(
        F.schema_of_variant(field) == "STRING", F.try_variant_get(document, f"$.{name}", "string")
    )


def _parsed_once(df: DataFrame, payload: str) -> DataFrame:
    """Adds ``_document``, the payload as a variant or null, and ``_whole``, whether it is JSON.

    The parse is a generated row of one: expressions above it read its result, where a
    projection would be merged with them and parse again for each.
    """
    framed = F.try_parse_json(F.concat(F.lit("["), _col(payload), F.lit(f',"{_END}"]')))
    rows = df.select("*", F.inline(F.array(F.struct(framed.alias("_framed")))))
    whole = F.coalesce(F.try_variant_get("_framed", "$[1]", "string") == _END, F.lit(False))
    return rows.withColumn("_whole", whole).withColumn(
        "_document", F.when(F.col("_whole"), F.try_variant_get("_framed", "$[0]", "variant"))).drop("_framed")


def with_event_metadata(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``event_id`` and ``event_type`` from string fields ``id`` and ``type``; each payload is parsed once."""
    document = F.col("_document")
    return _parsed_once(df, payload).withColumns({
        "event_id": string_field(document, "id"),
        "event_type": string_field(document, "type"),
    }).drop("_document", "_whole")


def checked_payload(df: DataFrame, schema: T.StructType | None = None, payload: str = "payload") -> DataFrame:
    """Messages with ``document``, ``error_category`` and ``error_message``, in one pass and one parse.

    A payload that is not JSON has no document and the category permanent: no retry makes
    it parse. Excise records are left out.
    """
    rows = _parsed_once(df.where(F.col(payload).isNotNull()), payload)
    document = F.col("_document") if schema is None else F.when(F.col("_whole"), F.from_json(F.col(payload), schema))
    return rows.withColumns({
        "document": document,
        "error_category": F.when(~F.col("_whole"), F.lit("permanent")),
        "error_message": F.when(~F.col("_whole"), F.lit("message payload is not JSON")),
    }).drop("_document", "_whole")


def decode_payload(
    df: DataFrame, schema: T.StructType | None = None, payload: str = "payload"
) -> tuple[DataFrame, DataFrame]:
    """Parsed messages, and the records whose payload is not JSON, as two frames (``checked_payload`` is one)."""
    rows = checked_payload(df, schema, payload)
    good = rows.where("error_category IS NULL").drop("error_category", "error_message")
    return good, rows.where("error_category IS NOT NULL").drop("document")


def _finite(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        infinite = F.abs(value) == F.lit(float("inf"))
        return F.when(~(F.isnan(value) | infinite), value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: _finite(e, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, e: _finite(e, kind.valueType))
    if isinstance(kind, T.StructType):
        fields = [_finite(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def encode_payload(df: DataFrame, column: str) -> Column:
    """JSON text of a column; NaN and the infinities become null at any depth.

    Nulls inside arrays and structs stay; a null document has no text.
    """
    kind = df.schema[column].dataType
    value = _finite(F.col(column), kind)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    # to_json takes containers only: write a one-element array and drop its brackets
    text = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.when(
        F.col(column).isNotNull(), F.substring(text, F.lit(2), F.length(text) - 2)
    )


def is_null_item(item: Column | str) -> Column:
    """A missing item or a JSON ``null``: neither may be stored."""
    # Blanks around it are JSON's own; anything else behind it makes no document.
    return _col(item).isNull() | F.coalesce(_col(item).rlike("^[ \\t\\r\\n]*null[ \\t\\r\\n]*$"), F.lit(False))


WRITES = ("set", "push", "unshift")


def checked_items(ops: DataFrame, item: str = "item") -> DataFrame:
    """Operations with ``error_category`` and ``error_message``: transient for writes of null, which leave the store untouched."""
    text = ops.schema[item].dataType == T.StringType()
    null = is_null_item(item) if text else F.col(item).isNull()
    bad = F.coalesce(F.col("op").isin(*WRITES), F.lit(False)) & null
    return ops.withColumns({
        "error_category": F.when(bad, F.lit("transient")),
        "error_message": F.when(bad, F.lit("null cannot be stored; use clear or delete")),
    })


def reject_null_items(ops: DataFrame, item: str = "item") -> tuple[DataFrame, DataFrame]:
    """Accepted operations, and writes of null, as two frames (``checked_items`` is one)."""
    rows = checked_items(ops, item)
    return rows.where("error_category IS NULL").drop("error_category", "error_message"), rows.where("error_category IS NOT NULL")


def checked_utf8(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows with text ``payload``, or ``error_category`` permanent where the bytes are not UTF-8."""
    text = F.col(value).cast("string")
    valid = F.col(value).isNull() | F.is_valid_utf8(text)
    return df.withColumns({
        "payload": F.when(valid, text),
        "error_category": F.when(~valid, F.lit("permanent")),
        "error_message": F.when(~valid, F.lit("payload is not UTF-8")),
    })


def validate_utf8(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Rows whose bytes are UTF-8, with text ``payload``, and the others, as two frames (``checked_utf8`` is one)."""
    rows = checked_utf8(df, value)
    bad = rows.where("error_category IS NOT NULL")
    return rows.where("error_category IS NULL").drop("error_category", "error_message"), bad.drop("payload")


def record_columns(df: DataFrame) -> DataFrame:
    """Record metadata only; the payload column is never read."""
    return df.select("topic", "part", "off", "ts", "key")
