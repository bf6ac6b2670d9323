"""JSON texts of unknown schema, parsed once: VARIANT values give both type and rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.session import materialize

CORRUPT = "_corrupt_record"

# A quoted name, a plain name, or a type without counterpart in a table.
_TOKEN = re.compile(r"(`(?:[^`]|``)*`)(?=: )|(\w+)(?=: )|OBJECT(?=<)|VOID|VARIANT|DECIMAL\(\d+,\d+\)")
_TABLE_TYPES = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}


def table_type(variant_type: str) -> str:
    """The type of a table's column for the type of variants.

    Nulls and values of several types become text, fractions and numbers beyond a long
    doubles; objects become structs.
    """
    def told(match: re.Match) -> str:
        if match[1]:
            return match[1]
        return f"`{match[2]}`" if match[2] else _TABLE_TYPES.get(match[0], "DOUBLE")

    return _TOKEN.sub(told, variant_type)


def json_rows(texts: DataFrame, column: str = "value",
              schema: T.StructType | str | None = None) -> DataFrame:
    """One row per JSON object in ``column``, with its fields as columns.

    Without a ``schema`` it is that of all objects together, a field that only some have
    included.  The texts are parsed once, into a table of variants, from which both the
    schema and the rows come.  Blank texts are passed over; if some others are no object,
    they give rows of nulls with their text in ``_corrupt_record``.  No object at all gives
    no other column.
    """
    parsed = texts.select(F.col(column).alias("text"), F.try_parse_json(column).alias("v"))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    parsed = materialize(parsed.filter(F.trim(F.translate("text", "\t\r\n", "   ")) != "").select(
        F.when(is_object, F.col("v")).alias("v"), F.when(~is_object, F.col("text")).alias(CORRUPT)),
        "variants")
    found = parsed.agg(F.schema_of_variant_agg("v").alias("kind"),
                       F.count(CORRUPT).alias("n_corrupt")).first()
    kind = found["kind"]
    if schema is not None:
        kind = schema if isinstance(schema, str) else schema.simpleString()
        kind = kind if kind.lower().startswith("struct<") else f"struct<{kind}>"
    elif kind and kind.startswith("OBJECT"):
        kind = table_type(kind)
    else:
        kind = None
    fields = ["row.*"] if kind else []
    rows = parsed if kind is None else parsed.withColumn("row", F.try_variant_get("v", "$", kind))
    return rows.select(*fields, *([CORRUPT] if found["n_corrupt"] or not kind else []))
