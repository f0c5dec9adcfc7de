"""Tables whose schema grows: every append widens it, and all rows read back under the newest one.

Types widen along a lattice: whole numbers to wider ones, to decimals that hold
both, to double; dates to timestamps; anything else that differs to text.
Structures widen field by field, arrays and maps by their elements. A column that
an append lacks is null in its rows; one that it adds is null in the rows before.
Names are compared without case, and keep the case in which they came first.

Layout: <path>/data/<append>, <path>/log/<number>.json, the folder and its
schema. A number is created without overwriting, so two appends never share one,
and an append counts once its number is there; the newest schema is that of all
numbers together, so none depends on who came first.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType, ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from pennant.sources.files import Files

WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]
#: Digits of whole numbers as decimals.
DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}


class Drift(ValueError):
    """An append whose columns aren't those of the table."""


def widen(a: DataType, b: DataType) -> DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widen(a.elementType, b.elementType), True)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(widen(a.keyType, b.keyType), widen(a.valueType, b.valueType), True)
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if {type(a), type(b)} <= {DateType, TimestampType, TimestampNTZType}:
        zoned = isinstance(a, TimestampType) or isinstance(b, TimestampType)
        return TimestampType() if zoned else TimestampNTZType()
    kinds = [DecimalType(DIGITS[t], 0) if t in DIGITS else t for t in (a, b)]
    if all(isinstance(t, DecimalType) for t in kinds):
        scale = max(t.scale for t in kinds)
        digits = max(t.precision - t.scale for t in kinds) + scale
        return DecimalType(digits, scale) if digits <= 38 else DoubleType()
    if all(isinstance(t, DecimalType | FloatType | DoubleType) for t in kinds):
        return DoubleType()
    return StringType()


def merged(a: StructType, b: StructType) -> StructType:
    """Fields of a, widened by those of b, and then what b adds."""
    other = {f.name.lower(): f for f in b}
    own = {f.name.lower() for f in a}
    fields = [StructField(f.name, widen(f.dataType, other[f.name.lower()].dataType) if f.name.lower() in other else f.dataType, True) for f in a]
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in b if f.name.lower() not in own])


def _text(c: Column, have: DataType) -> Column:
    return F.to_json(c) if isinstance(have, StructType | ArrayType | MapType) else c.cast("string")


def conform(c: Column, have: DataType, want: DataType) -> Column:
    """A value of one type as one of a wider type."""
    if have == want:
        return c
    if isinstance(want, StructType):
        fields = {f.name.lower(): f for f in have}
        parts = [(conform(c[fields[f.name.lower()].name], fields[f.name.lower()].dataType, f.dataType) if f.name.lower() in fields else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(c, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(want, MapType) and isinstance(have, MapType):
        return F.map_from_entries(F.transform(F.map_entries(c), lambda e: F.struct(conform(e["key"], have.keyType, want.keyType).alias("key"), conform(e["value"], have.valueType, want.valueType).alias("value"))))
    return _text(c, have) if isinstance(want, StringType) else c.cast(want)


class EvolvingTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.own = spark, path.rstrip("/"), Files(spark, path)

    def log(self) -> list[tuple[int, str, StructType]]:
        """Number, folder and schema of every append, in order."""
        found = [(n, self.own.read(f"log/{n}.json")) for n in reversed(self.own.numbers("log"))]
        return [(n, x["folder"], StructType.fromJson(x["schema"])) for n, x in found if x]

    def schema(self, upto: int | None = None) -> StructType:
        return reduce(merged, [s for n, _, s in self.log() if upto is None or n <= upto], StructType())

    def append(self, df: DataFrame, drift: str = "widen") -> int:
        """Add rows and return the append's number. drift: widen, or error where the columns or a type would change."""
        if len({c.lower() for c in df.columns}) < len(df.columns):
            raise Drift(f"two columns differ by case alone: {df.columns}")
        before = self.schema()
        if drift == "error" and before.fields and (merged(before, df.schema) != merged(before, before) or {c.lower() for c in df.columns} != {c.lower() for c in before.names}):
            raise Drift(f"{df.schema.simpleString()} isn't {before.simpleString()}")
        void = [f.name for f in df.schema if isinstance(f.dataType, NullType)]
        folder = f"data/{uuid.uuid4().hex}"
        df.drop(*void).write.parquet(f"{self.path}/{folder}")
        entry = {"folder": folder, "schema": StructType([StructField(f.name, f.dataType, True) for f in df.schema if f.name not in void]).jsonValue()}
        while True:
            number = (self.own.numbers("log") or [0])[0] + 1
            if self.own.create(f"log/{number}.json", entry):
                return number

    def read(self, upto: int | None = None) -> DataFrame:
        """All rows under the newest schema, or under that of an earlier append."""
        want = self.schema(upto)
        out = self.spark.createDataFrame([], want)
        for n, folder, have in self.log():
            if upto is None or n <= upto:
                rows, fields = self.spark.read.schema(have).parquet(f"{self.path}/{folder}"), {f.name.lower(): f for f in have}
                out = out.unionByName(rows.select(*[(conform(F.col(f"`{fields[f.name.lower()].name}`"), fields[f.name.lower()].dataType, f.dataType) if f.name.lower() in fields else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]))
        return out
