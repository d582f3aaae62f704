"""Columns and struct fields of a batch brought to a table's, by name and at every depth."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from tableflow.functions.columns import is_orderable, quoted

# How a value that is no struct, array or map is brought from one type to another.
Convert = Callable[[Column, DataType, DataType], Column]


def _key(name: str) -> str:
    """A name as the session tells names apart."""
    session = SparkSession.active()
    return name if session.conf.get("spark.sql.caseSensitive", "false") == "true" else name.lower()


def _by_name(fields: StructType) -> dict[str, StructField]:
    return {_key(f.name): f for f in fields.fields}


def spelled(names: Iterable[str], schema: StructType) -> tuple[str, ...]:
    """Names as a schema spells them; names it doesn't have stay."""
    known = _by_name(schema)
    return tuple(known[_key(n)].name if _key(n) in known else n for n in names)


def named_like(batch: DataFrame, stored: StructType) -> DataFrame:
    """A batch whose columns are spelled as the table's."""
    names = spelled(batch.columns, stored)
    return batch if list(names) == batch.columns else batch.toDF(*names)


def _alike(a: DataType, b: DataType) -> bool:
    """Equal types, whatever may be null."""
    return a.simpleString() == b.simpleString()


def evolved_type(stored: DataType, batch: DataType) -> DataType:
    """The table's type, and within its structs the fields that a batch brings, behind the table's."""
    if isinstance(stored, StructType) and isinstance(batch, StructType):
        return evolved(stored, batch)
    if isinstance(stored, ArrayType) and isinstance(batch, ArrayType):
        return ArrayType(evolved_type(stored.elementType, batch.elementType))
    if isinstance(stored, MapType) and isinstance(batch, MapType):
        return MapType(stored.keyType, evolved_type(stored.valueType, batch.valueType))
    return stored


def evolved(stored: StructType, batch: StructType) -> StructType:
    """The table's columns and types, then those that a batch brings; structs alike, at every depth."""
    incoming, known = _by_name(batch), _by_name(stored)
    kept = [
        StructField(f.name, evolved_type(f.dataType, incoming[_key(f.name)].dataType), f.nullable)
        if _key(f.name) in incoming else f
        for f in stored.fields
    ]
    return StructType(kept + [f for f in batch.fields if _key(f.name) not in known])


def conformed_type(stored: DataType, batch: DataType) -> DataType:
    """The batch's type with the table's names and types for what the table has."""
    if isinstance(stored, StructType) and isinstance(batch, StructType):
        known = _by_name(stored)
        found = [(f, known.get(_key(f.name))) for f in batch.fields]
        return StructType(
            [StructField(s.name, conformed_type(s.dataType, f.dataType)) if s else f for f, s in found]
        )
    if isinstance(stored, ArrayType) and isinstance(batch, ArrayType):
        return ArrayType(conformed_type(stored.elementType, batch.elementType))
    if isinstance(stored, MapType) and isinstance(batch, MapType):
        return MapType(stored.keyType, conformed_type(stored.valueType, batch.valueType))
    return stored


def cast(value: Column, source: DataType, target: DataType) -> Column:
    return value.cast(target)


def fitted(value: Column, source: DataType, target: DataType, convert: Convert = cast) -> Column:
    """A value in another type: struct fields by name, those it lacks null, at every depth."""
    if _alike(source, target):
        return value
    if isinstance(source, StructType) and isinstance(target, StructType):
        return F.when(value.isNotNull(), F.struct(*_fields(value, source, target, convert)))
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        return F.transform(value, lambda e: fitted(e, source.elementType, target.elementType, convert))
    if isinstance(source, MapType) and isinstance(target, MapType) and _alike(source.keyType, target.keyType):
        return F.transform_values(value, lambda _, v: fitted(v, source.valueType, target.valueType, convert))
    return convert(value, source, target)


def _fields(value: Column, source: StructType, target: StructType, convert: Convert) -> list[Column]:
    own = _by_name(source)
    return [
        fitted(value.getField(own[_key(f.name)].name), own[_key(f.name)].dataType, f.dataType, convert).alias(f.name)
        if _key(f.name) in own else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]


def overlaid(value: Column, before: Column, source: DataType, stored: DataType, target: DataType) -> Column:
    """A new value in place of a stored one. Struct fields that the new one doesn't have stay as they were;
    arrays and maps are replaced as a whole, and a null replaces a struct."""
    if not (isinstance(source, StructType) and isinstance(target, StructType) and isinstance(stored, StructType)):
        return fitted(value, source, target)
    new, old = _by_name(source), _by_name(stored)
    fields = []
    for f in target.fields:
        n, o = new.get(_key(f.name)), old.get(_key(f.name))
        if n is None:
            part = fitted(before.getField(o.name), o.dataType, f.dataType)
        elif o is None:
            part = fitted(value.getField(n.name), n.dataType, f.dataType)
        else:
            part = overlaid(value.getField(n.name), before.getField(o.name), n.dataType, o.dataType, f.dataType)
        fields.append(part.alias(f.name))
    return F.when(value.isNotNull(), F.struct(*fields))


def in_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows in another schema, by name; columns they lack are null."""
    own = _by_name(df.schema)
    return df.select(*[
        fitted(quoted(own[_key(f.name)].name), own[_key(f.name)].dataType, f.dataType).alias(f.name)
        if _key(f.name) in own else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _exact(column: str) -> Convert:
    """A conversion that fails the job where a value doesn't survive it."""
    def convert(value: Column, source: DataType, target: DataType) -> Column:
        there = value.try_cast(target)
        lost = value.isNotNull() & there.isNull()
        if is_orderable(source) and is_orderable(target):
            lost = value.isNotNull() & (there.isNull() | ~there.try_cast(source).eqNullSafe(value))
        message = f"a value of '{column}' doesn't fit the table's type {target.simpleString()}"
        return F.when(lost, F.raise_error(F.lit(message)).cast(target)).otherwise(there)

    return convert


def in_stored_types(updates: DataFrame, stored: StructType) -> DataFrame:
    """The batch with the names and types the table has for its columns and struct fields. A value that the
    table's type can't hold fails the job, so that no file of another type comes to lie beside the
    stored ones."""
    updates = named_like(updates, stored)
    changed = {}
    for field in stored.fields:
        if field.name not in updates.columns:
            continue
        source = updates.schema[field.name].dataType
        target = conformed_type(field.dataType, source)
        if not _alike(source, target):
            changed[field.name] = fitted(quoted(field.name), source, target, _exact(field.name))
    return updates.withColumns(changed) if changed else updates
