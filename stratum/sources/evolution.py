"""Type evolution: one schema for files that were written with different ones.

``common_type`` is the least type that holds the values of both: the integers widen
among themselves, integers and float to double, decimals to the precision of both, date to
timestamp; everything else that differs becomes text.  Structs are joined field by
field, arrays and maps by their elements.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _decimal(t: T.DataType) -> T.DecimalType | None:
    if isinstance(t, T.DecimalType):
        return t
    return T.DecimalType(_DIGITS[type(t)], 0) if type(t) in _DIGITS else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType), True)
    if isinstance(a, _INTS) and isinstance(b, _INTS):
        return max((a, b), key=lambda t: _INTS.index(type(t)))
    reals = (T.FloatType, T.DoubleType)
    if isinstance(a, (*reals, *_INTS, T.DecimalType)) and isinstance(b, (*reals, *_INTS, T.DecimalType)):
        if isinstance(a, reals) or isinstance(b, reals):
            return T.DoubleType()
        x, y = _decimal(a), _decimal(b)
        scale = max(x.scale, y.scale)
        whole = max(x.precision - x.scale, y.precision - y.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    for day, stamp in ((a, b), (b, a)):
        if isinstance(day, T.DateType) and isinstance(stamp, (T.TimestampType, T.TimestampNTZType)):
            return stamp
    return T.StringType()


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both in the order met; a field of both has their common type."""
    fields = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        fields[f.name] = common_type(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def _has_struct(t: T.DataType) -> bool:
    return isinstance(t, (T.StructType, T.ArrayType, T.MapType))


def to_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` as ``want``; struct fields are matched by name, missing ones are null."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = {f.name: f.dataType for f in have.fields}
        made = F.struct(*[(to_type(c.getField(f.name), fields[f.name], f.dataType) if f.name in fields
                           else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])
        return F.when(c.isNotNull(), made)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: to_type(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and _has_struct(have):
        return F.to_json(c)
    return c.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, by name: narrower types widened, missing columns null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(to_type(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])



# ------------------------------------------------------------ folders of mixed files
# Spark names the files of one write alike: part-<task>-<write id>...
_WRITE_ID = re.compile(r"^part-\d+-([0-9a-f-]{36})")


def _data_files(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.getFileStatus(root).getPath().toString()
    found = fs.listFiles(root, True)
    out = []
    while found.hasNext():
        st = found.next()
        name = st.getPath().toString()
        if st.getLen() and not any(p[:1] in ("_", ".") and "=" not in p for p in name[len(base):].split("/")):
            out.append(name)
    return sorted(out)


def schema_groups(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """(schema, files) of a parquet folder, files of equal schema together.

    The files of one write have one schema, so one footer is read per write (and one per
    file whose name does not tell its write).  The driver holds the file names, as Spark's own
    file index does.
    """
    writes: dict[str, list[str]] = {}
    for name in _data_files(spark, path):
        m = _WRITE_ID.match(name.rsplit("/", 1)[-1])
        writes.setdefault(m.group(1) if m else name, []).append(name)
    by: dict[str, tuple[T.StructType, list[str]]] = {}
    for files in writes.values():
        schema = spark.read.option("basePath", path).parquet(files[0]).schema
        by.setdefault(schema.json(), (schema, []))[1].extend(files)
    return list(by.values())


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder whose files differ in columns and column types.

    Files that only differ in columns are one scan with the schema of all; where types
    differ, each group of equal schema is its own scan, brought to the common schema by
    name.  Filters and column selection still reach every scan.
    """
    groups = schema_groups(spark, path)
    if not groups:  # an empty folder: Spark's own message
        return spark.read.parquet(path)
    schema = groups[0][0]
    for s, _ in groups[1:]:
        schema = common_schema(schema, s)
    want = {f.name: f.dataType for f in schema.fields}
    if all(want[f.name] == f.dataType for s, _ in groups for f in s.fields):
        return spark.read.schema(schema).parquet(path)
    out = None
    for s, files in groups:
        df = conform(spark.read.schema(s).option("basePath", path).parquet(*files), schema)
        out = df if out is None else out.unionByName(df)
    return out

