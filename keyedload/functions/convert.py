"""Value conversion to the column types of a table.

A value that does not fit raises and fails the load, whatever the session's ANSI setting is:
the conversion is a ``try_cast`` that raises where a non-null input came out null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedload.functions.names import col
from keyedload.spec import TableSpec

_INTEGRAL = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_COMPLEX = (T.ArrayType, T.MapType, T.StructType)


def cannot_fail(source: T.DataType, target: T.DataType) -> bool:
    """True when every value of ``source`` has a ``target`` value."""
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(target, T.StringType):
        return not isinstance(source, _COMPLEX)
    if type(source) in _INTEGRAL:
        if type(target) in _INTEGRAL:
            return _INTEGRAL.index(type(source)) <= _INTEGRAL.index(type(target))
        return isinstance(target, (T.FloatType, T.DoubleType))
    return isinstance(source, T.FloatType) and isinstance(target, T.DoubleType)


def same_shape(source: T.DataType, target: T.DataType) -> bool:
    """Equal types, not regarding nullability inside collections."""
    return source.simpleString() == target.simpleString()


def to_millis(value: Column, target: T.DataType) -> Column:
    """Timestamps keep milliseconds, as the table type does."""
    if isinstance(target, T.TimestampType):
        return F.date_trunc("millisecond", value)
    if isinstance(target, T.TimestampNTZType):
        # date_trunc would go through the session zone; take off the microseconds instead.
        micros = (F.extract(F.lit("SECOND"), value) * F.lit(1000000)).cast("bigint")
        return F.timestamp_add("MICROSECOND", (-F.pmod(micros, F.lit(1000))).cast("int"), value)
    return value


def convert(name: str, source: T.DataType, target: T.DataType) -> Column:
    """Column ``name`` as ``target``; nulls stay null and a value that does not fit raises, inside collections too."""
    return _converted(name, col(name), source, target)


def _converted(name: str, value: Column, source: T.DataType, target: T.DataType) -> Column:
    if same_shape(source, target):
        return to_millis(value, target)
    if cannot_fail(source, target):
        return to_millis(value.cast(target), target)
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(value, lambda x: _converted(name, x, source.elementType, target.elementType))
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _converted(name, e["key"], source.keyType, target.keyType).alias("key"),
                _converted(name, e["value"], source.valueType, target.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    if _same_width(source, target):
        fields = [
            _converted(name, value.getField(s.name), s.dataType, t.dataType).alias(t.name)
            for s, t in zip(source.fields, target.fields)
        ]
        return F.when(value.isNotNull(), F.struct(*fields)).cast(target)
    if isinstance(target, _COMPLEX):
        return value.cast(target)
    converted = value.try_cast(target)
    shown = F.coalesce(value.cast("string"), F.lit("?"))
    problem = F.concat(F.lit(f"column {name}: cannot convert to {target.simpleString()}: "), shown)
    checked = F.when(value.isNull() | converted.isNotNull(), converted).otherwise(F.raise_error(problem).cast(target))
    return to_millis(checked, target)


def _same_width(source: T.DataType, target: T.DataType) -> bool:
    both = isinstance(source, T.StructType) and isinstance(target, T.StructType)
    return both and len(source.fields) == len(target.fields)


# Letters no number of the kind is written with; "e" marks an exponent, floats may be infinite or NaN.
_NOT_IN_EXACT = "[A-DF-Za-df-z]"
_NOT_IN_FLOAT = "[bcghj-mo-su-xzBCGHJ-MO-SU-XZ]"


def _clearly_no_number(value: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """A cheap sign of a bad number. A failing cast costs far more than a look at the letters."""
    if not isinstance(source, T.StringType):
        return None
    if type(target) in _INTEGRAL or isinstance(target, T.DecimalType):
        return value.rlike(_NOT_IN_EXACT)
    if isinstance(target, (T.FloatType, T.DoubleType)):
        return value.rlike(_NOT_IN_FLOAT)
    return None


def is_bad(name: str, source: T.DataType, target: T.DataType) -> Column | None:
    """Condition that finds values which do not fit, or hold an element that does not; None when all fit."""
    found = _bad(col(name), source, target)
    return None if found is None else F.coalesce(found, F.lit(False))


def _bad(value: Column, source: T.DataType, target: T.DataType) -> Column | None:
    if same_shape(source, target) or cannot_fail(source, target):
        return None
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return _any_bad([(value, lambda x: x, source.elementType, target.elementType)])
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        entries = F.map_entries(value)
        key = (entries, lambda e: e["key"], source.keyType, target.keyType)
        return _any_bad([key, (entries, lambda e: e["value"], source.valueType, target.valueType)])
    if _same_width(source, target):
        pairs = zip(source.fields, target.fields)
        found = [_bad(value.getField(s.name), s.dataType, t.dataType) for s, t in pairs]
        return _either([F.coalesce(b, F.lit(False)) for b in found if b is not None])
    if isinstance(target, _COMPLEX):
        return None
    fails = value.try_cast(target).isNull()
    obvious = _clearly_no_number(value, source, target)
    return value.isNotNull() & (fails if obvious is None else obvious | fails)


def _any_bad(parts: list) -> Column | None:
    """Whether an element of an array is bad; ``parts`` are arrays, what to look at in an element, and its types."""

    def exists(elements: Column, part, source: T.DataType, target: T.DataType) -> Column | None:
        if same_shape(source, target) or cannot_fail(source, target):
            return None
        return F.coalesce(F.exists(elements, lambda x: F.coalesce(_bad(part(x), source, target), F.lit(False))), F.lit(False))

    return _either([b for b in (exists(*p) for p in parts) if b is not None])


def _either(conditions: list[Column]) -> Column | None:
    out = None
    for c in conditions:
        out = c if out is None else out | c
    return out


def convert_columns(df: DataFrame, spec: TableSpec, columns: list[str]) -> dict[str, Column]:
    """Converted data columns by name. Null keys raise."""
    out = {}
    key = set(spec.key)
    for name in columns:
        target = spec.type_of(name)
        value = convert(name, df.schema[name].dataType, target)
        if name in key:
            problem = F.raise_error(F.lit(f"{spec.full_name}: null in key column {name}"))
            value = F.coalesce(value, problem.cast(target))
        out[name] = value.alias(name)
    return out


def bad_columns(df: DataFrame, spec: TableSpec, columns: list[str]) -> Column | None:
    """Names of a row's columns whose values do not fit, an empty array for a row that fits; None when every row fits."""
    bad = {c: is_bad(c, df.schema[c].dataType, spec.type_of(c)) for c in columns}
    names = [F.when(cond, F.lit(c)) for c, cond in bad.items() if cond is not None]
    return F.filter(F.array(*names), lambda x: x.isNotNull()) if names else None


def split_rejects(df: DataFrame, spec: TableSpec, columns: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows that fit, and rows that do not with the names of the bad columns in ``_bad_columns``."""
    names = bad_columns(df, spec, columns)
    if names is None:
        return df, None
    marked = df.withColumn("_bad_columns", names)
    return marked.where(F.size("_bad_columns") == 0).drop("_bad_columns"), marked.where(F.size("_bad_columns") > 0)
