"""Schema alignment: rebuilding nested columns to a target type, and drift as rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def paths(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, str]]:
    for f in schema.fields:
        name = f"{prefix}{f.name}"
        yield name, f.dataType.typeName() if isinstance(f.dataType, T.StructType) else f.dataType.simpleString()
        if isinstance(f.dataType, T.StructType):
            yield from paths(f.dataType, f"{name}.")


def drift(source: T.StructType, target: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(path, missing | extra | type_changed, source type, target type), by path."""
    s, t = dict(paths(source)), dict(paths(target))
    kind = lambda p: "missing" if p not in s else "extra" if p not in t else "type_changed"
    return [(p, kind(p), s.get(p), t.get(p)) for p in sorted({*s, *t}) if s.get(p) != t.get(p)]


def drift_report(df: DataFrame, target: T.StructType) -> DataFrame:
    """drift() of df against a target as rows, with the rows of df that each difference touches, counted in one pass.

    A missing column touches every row, an extra one the rows with a value, a changed type the rows whose value it loses.
    """
    wanted = {}

    def types(schema: T.StructType, prefix: str = "") -> None:
        for f in schema.fields:
            wanted[prefix + f.name] = f.dataType
            if isinstance(f.dataType, T.StructType):
                types(f.dataType, f"{prefix}{f.name}.")

    types(target)
    found = drift(df.schema, target)
    hit = {
        "missing": lambda p: F.lit(True),
        "extra": lambda p: F.col(p).isNotNull(),
        "type_changed": lambda p: F.col(p).isNotNull() & (F.lit(True) if isinstance(wanted[p], T.StructType) else F.col(p).try_cast(wanted[p]).isNull()),
    }
    counts = df.agg(*[F.count_if(hit[kind](p)).alias(f"n{k}") for k, (p, kind, *_) in enumerate(found)]) if found else df.limit(0).agg(F.lit(0).alias("none"))
    text = lambda x: F.lit(x).cast("string")
    rows = [F.struct(text(p).alias("path"), text(kind).alias("kind"), text(a).alias("source_type"), text(b).alias("target_type"), F.col(f"n{k}").alias("n_rows")) for k, (p, kind, a, b) in enumerate(found)]
    empty = F.array().cast("array<struct<path:string,kind:string,source_type:string,target_type:string,n_rows:bigint>>")
    return counts.select(F.inline(F.array(*rows) if rows else empty))


def _aligned(c: Column, source: T.DataType | None, target: T.DataType) -> Column:
    if not isinstance(target, T.StructType):
        return F.lit(None).cast(target) if source is None else c.try_cast(target)
    known = {f.name: f.dataType for f in source.fields} if isinstance(source, T.StructType) else {}
    made = F.struct(*[_aligned(c[f.name], known.get(f.name), f.dataType).alias(f.name) for f in target.fields])
    return F.when(c.isNotNull(), made) if known else F.lit(None).cast(target)


def align_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """df with exactly the target's columns, nested ones too: missing ones null, extra ones dropped, others cast."""
    known = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_aligned(df[f.name] if f.name in known else F.lit(None), known.get(f.name), f.dataType).alias(f.name) for f in target.fields])


#: Number types, each narrower than the ones after it that may hold it.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Decimal digits of the whole types.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds both without loss and that files of either type are read as; None for a conflict.

    Structs have the fields of both, in the order they are met; arrays and maps are widened inside.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return union_of(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = widened(a.elementType, b.elementType)
        return None if inner is None else T.ArrayType(inner)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        value = widened(a.valueType, b.valueType)
        return None if value is None or a.keyType != b.keyType else T.MapType(a.keyType, value)
    kinds = {type(a), type(b)}
    if kinds <= set(WHOLE):
        return max(a, b, key=lambda x: WHOLE.index(type(x)))
    if kinds <= {T.FloatType, T.DoubleType} or (T.DoubleType in kinds and kinds <= {T.DoubleType, *WHOLE[:3]}):
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if T.DecimalType in kinds and kinds <= {T.DecimalType, *WHOLE}:
        digits = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (DIGITS[type(x)], 0) for x in (a, b)]
        whole, scale = (max(x) for x in zip(*digits))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def union_of(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """The columns of both, widened; None if a column's types conflict."""
    names = [f.name for f in a.fields] + [f.name for f in b.fields if f.name not in a.fieldNames()]
    one = lambda n: widened(a[n].dataType, b[n].dataType) if n in a.fieldNames() and n in b.fieldNames() else (a if n in a.fieldNames() else b)[n].dataType
    types = [one(n) for n in names]
    return None if any(t is None for t in types) else T.StructType([T.StructField(n, t) for n, t in zip(names, types)])


def read_evolving(spark: SparkSession, parts: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(all rows of Parquet parts written with differing schemas, the conflicts among them as drift rows).

    Added, missing and widened columns, nested ones too, are read by one scan under the union of the schemas; the reader widens. A part whose types
    conflict with those of the parts before it (a text where there were numbers) is read by itself and cast: what cannot be cast is null and
    counted in the drift rows (part, path, kind, source_type, target_type, n_rows). Only the parts' schemas come to the driver.
    """
    schema, alike, other = None, [], []
    for part in parts:
        own = spark.read.parquet(part).schema
        both = own if schema is None else union_of(schema, own)
        if both is None:
            other.append((part, own))
        else:
            schema = both
            alike.append(part)
    # A part in conflict may still bring columns that no other has.
    for _, own in other:
        schema = T.StructType([*schema.fields, *[f for f in own.fields if f.name not in schema.fieldNames()]])
    frames, drifts = [spark.read.schema(schema).parquet(*alike)], []
    for part, own in other:
        mine = spark.read.parquet(part)
        frames.append(align_to_schema(mine, schema))
        drifts.append(drift_report(mine, schema).where("kind = 'type_changed'").select(F.lit(part).alias("part"), "*"))
    rows = reduce(DataFrame.unionByName, frames)
    empty = spark.createDataFrame([], "part string, path string, kind string, source_type string, target_type string, n_rows bigint")
    return rows, reduce(DataFrame.unionByName, drifts, empty)
