"""The sink: jagged records as Parquet in chunks, with 64-bit numbers narrowed to 32 bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 100  # records in a file


def _narrow(kind: T.DataType, c: Column) -> Column:
    if isinstance(kind, T.LongType):
        return c.cast("int")
    if isinstance(kind, T.DoubleType):
        return c.cast("float")
    if isinstance(kind, (T.IntegerType, T.FloatType, T.BooleanType, T.ShortType, T.ByteType, T.StringType, T.TimestampType)):
        return c
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _narrow(kind.elementType, x))
    if isinstance(kind, T.StructType):
        return F.struct(*[_narrow(f.dataType, c[f.name]).alias(f.name) for f in kind.fields])
    raise ValueError(f"no way to write {kind.simpleString()}")


def narrow(df: DataFrame, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """bigint -> int and double -> float, also within lists and records; ``keep`` stay as they are. Values that do not fit are an error (ANSI casts); other types than numbers, flags, text, times, lists and records are a ValueError."""
    return df.select(*[F.col(f.name) if f.name in keep else _narrow(f.dataType, F.col(f.name)).alias(f.name) for f in df.schema.fields])


def write_jagged(df: DataFrame, path: str, chunk: int = CHUNK, mode: str = "append", narrowed: bool = True) -> None:
    """Append records; no file has more than ``chunk`` of them."""
    (narrow(df) if narrowed else df).write.mode(mode).option("maxRecordsPerFile", chunk).parquet(path)
