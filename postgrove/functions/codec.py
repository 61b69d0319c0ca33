"""JSON messages to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def decode_json(text: Column, schema: T.StructType) -> Column:
    """JSON text as a struct; what does not fit the schema gives NULL fields."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def encode_json(*columns: Column | str) -> Column:
    """Columns as one JSON object, NULL fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def decode_one_object(text: Column, schema: T.StructType) -> Column:
    """The object ``text`` consists of; NULL if it is anything else or goes on after it.

    Spark's parser stops at the end of the first value. Within an array and within
    an object it has to go on to the closing bracket, and no text after a value can
    close both.
    """
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema))
    nested = F.from_json(
        F.concat(F.lit('{"value":'), text, F.lit("}")), T.StructType().add("value", schema)
    )
    alone = (F.size(listed) == 1) & nested["value"].isNotNull()
    return F.when(alone, nested["value"])
