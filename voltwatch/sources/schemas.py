"""A registry of the schemas in which parts of one table were written.

``root/_schemas/<version>/schema.json`` holds a schema, and an empty file beside it names each part written in it. Readers
learn every part's schema from a listing: no data file is opened, and parts of one schema are one scan. Parts of
several schemas are united by name: a column that a part lacks is null in its rows, and a column that came in several
types gets the narrowest type that holds them all, text if nothing else does.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import _fs

FOLDER, FILE = "_schemas", "schema.json"
#: From narrow to wide; a long and a float meet in a double.
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def version_of(schema: T.StructType) -> str:
    """Name of a schema: equal names, types and order give one version, whatever may be null."""
    plain = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return hashlib.sha256(json.dumps(plain).encode()).hexdigest()[:16]


def register(spark: SparkSession, root: str, schema: T.StructType, part: str) -> str:
    """Notes that ``part`` (a folder below ``root``) is written in ``schema``; call it before the part is written."""
    version = version_of(schema)
    fs, file = _fs(spark, f"{root}/{FOLDER}/{version}/{FILE}")
    if not fs.exists(file):
        fresh = _fs(spark, f"{root}/{FOLDER}/{version}/_{part.replace('/', ',')}.fresh")[1]
        out = fs.create(fresh)
        out.write(bytearray(schema.json().encode()))
        out.close()
        if not fs.rename(fresh, file):  # another writer was first
            fs.delete(fresh, False)
    fs.create(_fs(spark, f"{root}/{FOLDER}/{version}/{part.replace('/', ',')}")[1]).close()
    return version


def registered(spark: SparkSession, root: str) -> dict[str, str]:
    """Version of every noted part, from a listing."""
    fs, pattern = _fs(spark, f"{root}/{FOLDER}/*/*")
    out = {}
    for s in fs.globStatus(pattern) or []:
        name = s.getPath().getName()
        if name != FILE and not name.endswith(".fresh"):
            out[name.replace(",", "/")] = s.getPath().getParent().getName()
    return out


def load(spark: SparkSession, root: str, version: str) -> T.StructType:
    fs, file = _fs(spark, f"{root}/{FOLDER}/{version}/{FILE}")
    stream = fs.open(file)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return T.StructType.fromJson(json.loads(text))


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """The narrowest type that holds all; text where they have nothing else in common."""
    def wider(a: T.DataType, b: T.DataType) -> T.DataType:
        if a == b or isinstance(b, T.NullType):
            return a
        if isinstance(a, T.NullType):
            return b
        if isinstance(a, NUMBERS) and isinstance(b, NUMBERS):
            places = sorted((NUMBERS.index(type(a)), NUMBERS.index(type(b))))
            exact = places[1] != NUMBERS.index(T.FloatType) or places[0] <= NUMBERS.index(T.ShortType)
            return NUMBERS[places[1]]() if exact else T.DoubleType()
        if {type(a), type(b)} <= {T.DateType, T.TimestampType}:
            return T.TimestampType()
        return T.StringType()
    return reduce(wider, types)


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """U1 over several schemas: all rows, columns by name in the order in which they first come."""
    seen: dict[str, list[T.DataType]] = {}
    for f in frames:
        for c in f.schema.fields:
            seen.setdefault(c.name, []).append(c.dataType)
    wanted = {n: common_type(t) for n, t in seen.items()}
    cast = lambda f: f.select(*[(F.col(n) if n in f.columns else F.lit(None)).cast(t).alias(n) for n, t in wanted.items()])
    return reduce(lambda a, b: a.unionByName(b), [cast(f) for f in frames])


def read_parts(spark: SparkSession, root: str, parts: Sequence[str]) -> DataFrame:
    """The rows of the named parts: one scan a schema, whatever their number; parts that nobody noted are read with their
    files' own schemas."""
    of = registered(spark, root)
    groups: dict[str, list[str]] = {}
    for p in parts:
        groups.setdefault(of.get(p, ""), []).append(p)
    frames = []
    for version in sorted(groups):
        r = spark.read.option("basePath", root)
        r = r.schema(load(spark, root, version)) if version else r.option("mergeSchema", True)
        frames.append(r.parquet(*[f"{root}/{p}" for p in groups[version]]))
    return unite(frames)
