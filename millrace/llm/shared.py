"""What the operators of this subpackage share: staged tables, column names, Arrow UDFs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from millrace.sources.staging import filesystem, new_path, stage, work_dir

__all__ = ["ascii_bytes", "drop_names", "filesystem", "new_path", "set_aside", "stage", "struct_udf", "work_dir"]


def drop_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add (names compare without case)."""
    taken = {n.lower() for n in names}
    keep = [c for c in df.columns if c.lower() not in taken]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def set_aside(df: DataFrame, used: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with all columns but ``used`` renamed out of an operator's way, and the columns that undo it."""
    away = {c: f"__mr_aside_{i}" for i, c in enumerate(df.columns) if c not in used}
    renamed = df.select(*[F.col(f"`{c}`").alias(away.get(c, c)) for c in df.columns])
    return renamed, [F.col(f"`{away.get(c, c)}`").alias(c) for c in df.columns]


def struct_udf(fn: Callable[[list], list], schema: str, column: Column) -> Column:
    """A struct column from ``fn(values) -> one list per field``, called once per Arrow batch.

    Only ``column`` travels to Python. The UDF is marked nondeterministic so that Catalyst neither
    pushes a filter on its result below it nor evaluates it twice.
    """
    arrow = to_arrow_type(_parse_datatype_string(schema))

    def run(values: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(c, type=f.type) for c, f in zip(fn(values.to_pylist()), arrow)], fields=list(arrow))

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, schema).asNondeterministic()(column)


def ascii_bytes(text: Column) -> Column:
    """A text column's UTF-8 bytes, null as empty: spares workers a decode."""
    return F.coalesce(text, F.lit("")).cast("binary")
