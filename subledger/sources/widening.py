"""Compatible schemas combined: a type lattice, and folders whose files differ in type read as one table.

Types widen along ``byte < short < int < long < decimal < double``, ``float < double``,
``date < timestamp_ntz < timestamp``; structs, arrays and maps widen part by part; any
other pair meets in ``string``. Names are compared without case, as tables do.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# whole numbers by the decimal digits they need
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
MAX_DIGITS = 38


def _decimal(t: T.DataType) -> T.DecimalType:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The smallest type of the lattice that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return wider_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType),
                         a.valueContainsNull or b.valueContainsNull)
    whole = [type(t) in _DIGITS for t in (a, b)]
    exact = [w or isinstance(t, T.DecimalType) for w, t in zip(whole, (a, b))]
    broken = [isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)]
    if all(whole):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if all(exact):
        x, y = _decimal(a), _decimal(b)
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return T.DecimalType(digits, scale) if digits <= MAX_DIGITS else T.DoubleType()
    if all(e or f for e, f in zip(exact, broken)):
        return T.DoubleType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return max(a, b, key=lambda t: _TIMES.index(type(t)))
    return T.StringType()


def wider_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both, the first's order and case first."""
    other = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        g = other.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, wider(f.dataType, g.dataType) if g else f.dataType, True))
    return T.StructType(fields + [T.StructField(g.name, g.dataType, True) for g in b.fields if g.name.lower() in other])


def _one(schemas: list[T.StructType]) -> T.StructType:
    return reduce(wider_schema, schemas)


def _plain(a: T.StructType, b: T.StructType) -> bool:
    """Whether common columns have equal types, so that one read serves both."""
    types = {f.name.lower(): f.dataType for f in a.fields}
    pairs = [(types.get(f.name.lower(), f.dataType), f.dataType) for f in b.fields]
    return all(x == y or T.NullType() in (x, y) for x, y in pairs)


def _schema(df: DataFrame, paths: list[str]) -> T.StructType:
    """The frame's schema; a partition column of which all paths hold no value says nothing of its type."""
    def empty(name: str) -> bool:
        return all(f"{name}=__HIVE_DEFAULT_PARTITION__" in p for p in paths)
    return T.StructType([T.StructField(f.name, T.NullType() if empty(f.name) else f.dataType) for f in df.schema.fields])


def _texts(schema: T.StructType) -> T.StructType:
    """Columns of no known type are read as text."""
    return T.StructType([T.StructField(f.name, T.StringType() if f.dataType == T.NullType() else f.dataType)
                         for f in schema.fields])


def folders(spark: SparkSession, base: str) -> list[str]:
    """The partition folders of ``base`` in order of name, or ``base`` itself."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    names = sorted(f.getPath().getName() for f in found if f.isDirectory() and "=" in f.getPath().getName())
    return [f"{base.rstrip('/')}/{n}" for n in names] or [base]


def _stretches(spark: SparkSession, base: str, paths: list[str]) -> list[list[str]]:
    """``paths`` cut where types change, found by halving: one footer per look, few looks if types change rarely."""
    seen: dict[int, T.StructType] = {}

    def look(i: int) -> T.StructType:
        if i not in seen:
            seen[i] = _schema(spark.read.option("basePath", base).parquet(paths[i]), paths[i:i + 1])
        return seen[i]

    cuts, todo = [], [(0, len(paths) - 1)]
    while todo:
        lo, hi = todo.pop()
        if lo >= hi or _plain(look(lo), look(hi)):
            continue
        if hi - lo == 1:
            cuts.append(hi)
        else:
            mid = (lo + hi) // 2
            todo += [(lo, mid), (mid, hi)]
    edges = [0, *sorted(cuts), len(paths)]
    return [paths[a:b] for a, b in zip(edges, edges[1:])]


def schema_groups(spark: SparkSession, base: str, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """(paths, merged schema) of the fewest groups within which no column changes its type.

    Stretches of folders of equal types are guessed from single footers, then all footers of a stretch
    are merged on the cluster. If that fails (types went back and forth in it) it is halved, and a
    folder that doesn't merge is read file by file. The driver reads few footers itself.
    """
    found: list[tuple[list[str], T.StructType]] = []
    todo = _stretches(spark, base, paths)[::-1]
    while todo:
        own = todo.pop()
        try:
            schema = _schema(spark.read.option("mergeSchema", "true").option("basePath", base).parquet(*own), own)
        except (PySparkException, Py4JJavaError) as ex:
            if "CANNOT_MERGE" not in str(ex):
                raise
            if len(own) > 1:
                half = len(own) // 2
                todo += [own[half:], own[:half]]
                continue
            files = sorted(r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                           .option("pathGlobFilter", "*.parquet").load(own[0]).select("path").collect())
            if files == own:
                raise
            todo += [[f] for f in files]
            continue
        for i, (others, s) in enumerate(found):
            if _plain(s, schema):
                found[i] = (others + own, wider_schema(s, schema))
                break
        else:
            found.append((own, schema))
    return found


def _as(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` in the wider type; values that can't be shown in it don't occur along the lattice."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = [(_as(c[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: _as(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast(want)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of a wider schema, missing ones NULL."""
    own = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[(_as(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType)
                        if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def read_widened(spark: SparkSession, base: str, paths: list[str] | None = None) -> DataFrame:
    """All Parquet files below ``base`` (or ``paths``) as one table of the widest types.

    Each group of files with equal types is read with its own schema, cast and united by name.
    """
    groups = schema_groups(spark, base, paths or folders(spark, base))
    schema = _texts(_one([s for _, s in groups]))
    parts = [conformed(spark.read.option("basePath", base).schema(_texts(s)).parquet(*own), schema) for own, s in groups]
    return reduce(DataFrame.unionByName, parts)
