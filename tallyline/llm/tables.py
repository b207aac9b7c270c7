"""Reading the given tables, and adding columns computed from whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.blocks import text_slices, tidy


#: Up to so many rows of ids or positions (8 to 40 bytes each) go to all tasks; beyond it the other side is shuffled.
BROADCAST_ROWS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def near(small: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """``small`` with a broadcast hint if its counted rows allow it; evaluates it, so give something cheap or saved.

    Where rows hold lists, ``counted`` is the table of their elements."""
    rows = small if counted is None else counted
    return F.broadcast(small) if rows.count() <= BROADCAST_ROWS else small


def without(df: DataFrame, names) -> DataFrame:
    """``df`` less the columns that a result would shadow; names compare as Spark compares them."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def aliased(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with columns ``c0, c1, ...`` that clash with nothing, and these names; see ``restored``."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.select(*[F.col(_quoted(c)).alias(n) for c, n in zip(df.columns, names)]), names


def restored(df: DataFrame, names: Sequence[str], columns: Sequence[str], *more: str) -> DataFrame:
    """The columns of an aliased table under their own names, and ``more`` after them."""
    return df.select(*[F.col(n).alias(c) for n, c in zip(names, columns)], *more)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: A key is hot if it has more rows than this and than one in ``HOT_KEYS`` of all; so at most ``HOT_KEYS`` are.
HOT_ROWS = 1024
HOT_KEYS = 1 << 16


def split_hot(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The hot rows, to be broadcast, and the others of a stored table of keys with their numbers of rows ``n``."""
    total = found.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_ROWS, total // HOT_KEYS)
    return F.broadcast(found.where(F.col("n") > limit).drop("n")), found.where(F.col("n") <= limit).drop("n")


def meet(rows: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` joined with a stored table of keys and numbers of rows, where no key's rows meet in one task if many."""
    hot, cold = split_hot(found)
    keys = list(keys)
    return rows.join(hot, keys).unionByName(rows.join(hot, keys, "left_anti").join(cold, keys))


def add_text_columns(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    maker: Callable[[], Callable[[np.ndarray, np.ndarray], list]],
    drop_text: bool = False,
) -> DataFrame:
    """``df`` with columns computed from its text column, slice by slice in Arrow batches.

    ``maker`` runs once per task and returns a function of the bytes and offsets of a slice of texts that gives
    one sequence per field. Columns of ``df`` with such a name are replaced. A null text counts as empty. With
    ``drop_text`` the texts do not travel back from the tasks' Python.
    """
    rest = without(df, [f.name for f in fields if f.name.lower() != text.lower()])
    given = rest.columns
    back = [c for c in given if not (drop_text and c == text)]
    schema = T.StructType([*[rest.schema[c] for c in back], *fields])
    types = [_arrow(f.dataType) for f in fields]
    names = [*back, *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = maker()
        for batch in tidy(batches):
            kept = [batch.column(given.index(c)) for c in back]
            for first, data, at in text_slices(batch.column(given.index(text))):
                added = [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(compute(data, at), types)]
                own = [c.slice(first, len(at) - 1) for c in kept]
                yield pa.RecordBatch.from_arrays([*own, *added], names=names)

    return rest.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "binary": pa.binary(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return simple[kind.simpleString()]


def fields(**kinds: str) -> list[T.StructField]:
    return [T.StructField(name, _plain(kind)) for name, kind in kinds.items()]


def _plain(kind: str) -> T.DataType:
    return {
        "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
        "string": T.StringType(), "binary": T.BinaryType(), "longs": T.ArrayType(T.LongType()),
        "ints": T.ArrayType(T.IntegerType()),
    }[kind]
