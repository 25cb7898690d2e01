"""A lattice of types: any two types have a least one that holds the values of both.

Whole numbers widen to doubles, structs to the union of their fields, arrays by their elements; what
has nothing else in common becomes text, which is the top. A field that one side lacks stays.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Each holds all values of those before it.
NUMBERS = [IntegerType, LongType, DoubleType]


def join_types(a: DataType, b: DataType) -> DataType:
    """The least type above both. Associative, commutative and idempotent, so that the order in
    which schemas are met does not matter."""
    a, b = _plain(a), _plain(b)
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return join_structs(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(join_types(a.elementType, b.elementType))
    if type(a) in NUMBERS and type(b) in NUMBERS:
        return max(a, b, key=lambda kind: NUMBERS.index(type(kind)))
    return StringType()


def join_structs(a: StructType, b: StructType) -> StructType:
    """Both sides' fields by name, in alphabetical order, each of the joined type; all may be null."""
    kinds = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        kinds[f.name] = join_types(kinds.get(f.name, NullType()), f.dataType)
    return StructType([StructField(n, _plain(kind)) for n, kind in sorted(kinds.items())])


def _plain(kind: DataType) -> DataType:
    """The type of the lattice that stands for a type, without nullability and metadata."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return StructType([StructField(f.name, _plain(f.dataType)) for f in fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_plain(kind.elementType))
    if isinstance(kind, (FloatType, DecimalType)):
        whole = isinstance(kind, DecimalType) and kind.scale == 0
        return LongType() if whole and kind.precision <= 18 else DoubleType()
    if isinstance(kind, (NullType, BooleanType, DateType, TimestampType, TimestampNTZType)):
        return type(kind)()
    return type(kind)() if type(kind) in NUMBERS else StringType()


def settled(kind: DataType) -> DataType:
    """The type for reading: fields that were only ever null are text."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, settled(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(settled(kind.elementType))
    return StringType() if isinstance(kind, NullType) else kind


def ddl(kind: DataType) -> str:
    """The type as DDL text, with all field names quoted."""
    if isinstance(kind, StructType):
        names = [f"`{f.name.replace('`', '``')}`: {ddl(f.dataType)}" for f in kind.fields]
        return f"STRUCT<{', '.join(names)}>"
    if isinstance(kind, ArrayType):
        return f"ARRAY<{ddl(kind.elementType)}>"
    return kind.simpleString()
