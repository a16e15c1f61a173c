"""Tables whose columns may widen: a lattice of types, a log of schemas, and old files read through casts.

Where rows bring a new column, a wider type or a new field of a struct, the table's schema grows to hold both and the next
generation of files begins. Files are never rewritten: each generation is read with the schema the log
has for it, and cast to the newest one. Types widen along byte, short, int, long, double, text; float to double; decimals to
wider ones and then to double; date to timestamp; all other plain types meet in text. Structs widen by field, arrays and
maps by element. A plain type and a nested one have nothing in common and are refused.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from longform.sources.files import Taken, commit_text, exists, names, read_text

_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_FRACTION = (T.FloatType(), T.DoubleType())
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19), strict=True))


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType | T.ArrayType | T.MapType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        both = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            both[f.name] = wider(both[f.name], f.dataType) if f.name in both else f.dataType
        return T.StructType([T.StructField(name, kind, True) for name, kind in both.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType), True)
    if _nested(a) or _nested(b):
        raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    numbers = (*_WHOLE, *_FRACTION)
    decimals = [k for k in (a, b) if isinstance(k, T.DecimalType)]
    if decimals and all(k in _WHOLE or isinstance(k, T.DecimalType) for k in (a, b)):
        shapes = [(k.precision - k.scale, k.scale) if isinstance(k, T.DecimalType) else (_DIGITS[k], 0) for k in (a, b)]
        whole, scale = max(s[0] for s in shapes), max(s[1] for s in shapes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if all(k in numbers or isinstance(k, T.DecimalType) for k in (a, b)):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def widened(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as ``want``, which is at least as wide."""
    if have == want:
        return value
    if isinstance(have, T.StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [
            (widened(value.getField(f.name), known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: widened(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType):
        values = F.transform_values(value, lambda _, x: widened(x, have.valueType, want.valueType))
        return F.transform_keys(values, lambda k, _: widened(k, have.keyType, want.keyType))
    return value.cast(want)


def conformed(df: DataFrame, want: T.StructType) -> DataFrame:
    """All columns of ``want``, null where ``df`` has none."""
    have = {f.name: f.dataType for f in df.schema.fields}
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
    columns = [
        (widened(quoted(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields
    ]
    return df.select(*columns)


def _open(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed throughout, as files may lack any of it."""
    return T.StructType.fromJson(json.loads(json.dumps(kind.jsonValue()).replace('"nullable": false', '"nullable": true').replace('ull": false', 'ull": true')))


@dataclass(frozen=True)
class GrowingTable:
    """Files below ``path/generation=N``; ``path-schemas/N.json`` has the schema of generation N, from 1."""

    spark: SparkSession
    path: str
    format: str = "parquet"

    def schemas(self) -> list[T.StructType]:
        found = [n for n in names(self.spark, f"{self.path}-schemas") if n[:1].isdigit()]
        return [T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}-schemas/{n}"))) for n in found]

    def append(self, df: DataFrame) -> None:
        """Add rows of any columns; the table's schema grows to hold them, unless no type does."""
        while True:
            known = self.schemas()
            want = wider(known[-1], _open(df.schema)) if known else _open(df.schema)
            if known and want == known[-1]:
                break
            try:
                commit_text(self.spark, f"{self.path}-schemas/{len(known) + 1:06d}.json", want.json())
                known.append(want)
                break
            except Taken:  # another writer's schema came first: hold both
                continue
        conformed(df, want).write.format(self.format).mode("append").save(self._folder(len(known)))

    def _folder(self, generation: int) -> str:
        return f"{self.path}/generation={generation:06d}"

    def read(self) -> DataFrame:
        """All rows under the newest schema."""
        known = self.schemas()
        if not known:
            raise ValueError(f"nothing has been appended to {self.path}")
        parts = [
            conformed(self.spark.read.schema(schema).format(self.format).load(self._folder(n)), known[-1])
            for n, schema in enumerate(known, 1)
            if exists(self.spark, self._folder(n))
        ]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], known[-1])

    def register(self, name: str) -> None:
        """A view of the table for SQL texts, under its newest schema."""
        self.read().createOrReplaceTempView(name)
