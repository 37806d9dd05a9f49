"""Documents of any content as a declared shape, and what that shape does not hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

_FIELDS, _ITEMS = "map<string,variant>", "array<variant>"


def shaped(document: Column, shape: StructType) -> Column:
    """A variant as the declared struct; a field that is absent, or of another type, is NULL and its neighbours are not."""
    return F.try_variant_get(document, "$", shape.simpleString())


def is_object(document: Column) -> Column:
    return F.try_variant_get(document, "$", _FIELDS).isNotNull()


def undeclared(document: Column, shape: StructType) -> Column:
    """What ``shaped`` leaves out, as a JSON object from JSON pointers to values; NULL if that is nothing.

    A whole value of another type counts, and so do unknown fields at any depth, those of array elements included.
    A declared text takes any value, so nothing of it is left out.
    """
    return F.nullif(F.to_json(F.map_from_entries(_left_out(document, shape, F.lit("")))), F.lit("{}"))


def _left_out(value: Column, shape: DataType, pointer: Column) -> Column:
    """(pointer, value) of everything below ``value`` that ``shape`` does not take."""
    whole = F.array(_entry(pointer, value))
    nothing = F.filter(whole, lambda _: F.lit(False))
    absent = value.isNull() | F.is_variant_null(value)
    if isinstance(shape, StructType):
        fields = F.try_variant_get(value, "$", _FIELDS)
        unknown = F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(shape.fieldNames()))
        found = [F.transform(unknown, lambda e: _entry(F.concat(pointer, F.lit("/"), _escaped(e["key"])), e["value"]))]
        for field in shape:
            if not isinstance(field.dataType, StringType):
                inner = F.try_variant_get(value, f'$["{field.name}"]', "variant")
                found.append(_left_out(inner, field.dataType, F.concat(pointer, F.lit(f"/{field.name}"))))
        return F.when(absent, nothing).when(fields.isNull(), whole).otherwise(F.concat(*found))
    if isinstance(shape, ArrayType):
        items = F.try_variant_get(value, "$", _ITEMS)
        inside = F.transform(items, lambda v, i: _left_out(v, shape.elementType, F.concat(pointer, F.lit("/"), i.cast("string"))))
        return F.when(absent, nothing).when(items.isNull(), whole).otherwise(F.flatten(inside))
    return F.when(absent | F.try_variant_get(value, "$", shape.simpleString()).isNotNull(), nothing).otherwise(whole)


def _entry(pointer: Column, value: Column) -> Column:
    return F.struct(pointer.alias("at"), value.alias("value"))


def _escaped(key: Column) -> Column:
    """A key as a step of a JSON pointer."""
    return F.replace(F.replace(key, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
