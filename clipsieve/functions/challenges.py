"""Hashtag lists from the mixed formats in which posts carry them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipsieve.functions.arrays import bind, empty_array
from clipsieve.functions.text import strip

# Keys that may name a tag inside an object, first truthy one wins.
TAG_KEYS = ("title", "name", "challenge_name")


def _non_empty(tags: Column) -> Column:
    return F.filter(tags, lambda tag: tag.isNotNull() & (tag != ""))


def _truthy_variant(value: Column) -> Column:
    """Text of a JSON value, or null where the value counts as false (0, "", [], {}, false, null)."""

    def by_first_character(written: Column) -> Column:
        first = F.left(written, F.lit(1))
        return (
            F.when(first == '"', F.nullif(F.try_variant_get(value, "$", "string"), F.lit("")))
            .when(first == "t", F.lit("True"))
            .when(first.isin("f", "n"), F.lit(None).cast("string"))
            .when(first.isin("[", "{"), F.when(~written.isin("[]", "{}"), written))
            .otherwise(
                F.when(
                    F.try_variant_get(value, "$", "double") != 0,
                    F.try_variant_get(value, "$", "string"),
                )
            )
        )

    return bind(F.to_json(value), by_first_character)


def _tag_of_item(item: Column) -> Column:
    first = F.left(F.to_json(item), F.lit(1))
    named = F.coalesce(
        *[bind(F.try_variant_get(item, f"$.{key}", "variant"), _truthy_variant) for key in TAG_KEYS]
    )
    return F.when(first == '"', F.try_variant_get(item, "$", "string")).when(first == "{", named)


def _from_text(value: Column) -> Column:
    text = strip(value)
    is_list = text.startswith("[") & text.endswith("]")
    items = F.try_variant_get(F.try_parse_json(F.when(is_list, text)), "$", "array<variant>")
    from_json = F.transform(items, _tag_of_item)
    pieces = F.transform(F.split(text, ","), lambda piece: strip(F.btrim(piece, F.lit("# "))))
    return F.when(is_list, F.coalesce(from_json, empty_array("string"))).otherwise(pieces)


def _truthy_field(value: Column, data_type: T.DataType) -> Column:
    text = value.cast("string")
    if isinstance(data_type, T.StringType):
        return F.nullif(text, F.lit(""))
    if isinstance(data_type, T.BooleanType):
        return F.when(value, F.lit("True"))
    if isinstance(data_type, T.NumericType):
        return F.when(value != 0, text)
    return text


def _tag_of_struct(value: Column, data_type: T.StructType) -> Column:
    present = [key for key in TAG_KEYS if key in data_type.names]
    named = [_truthy_field(value.getField(key), data_type[key].dataType) for key in present]
    return F.coalesce(*named) if named else F.lit(None).cast("string")


def parse_challenges(value: Column, data_type: T.DataType) -> Column:
    """``array<string>`` of tags as written, never null and without empty tags.

    Text is a JSON list (of strings and objects) or comma separated; broken JSON gives no tags. Native
    arrays of strings or structs, and a single struct, are read directly. Other types give no tags.
    """
    if isinstance(data_type, T.StringType):
        tags = _from_text(value)
    elif isinstance(data_type, T.StructType):
        tags = F.array(_tag_of_struct(value, data_type))
    elif isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StringType):
        tags = value
    elif isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
        tags = F.transform(value, lambda item: _tag_of_struct(item, data_type.elementType))
    else:
        tags = empty_array("string")
    return F.coalesce(_non_empty(tags), empty_array("string"))
