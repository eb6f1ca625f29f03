"""Table statistics in one aggregate, value counts, and stage counts without an extra pass."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import is_blank
from millrace.sources.staging import stage

TYPE_NAMES = {
    T.StringType: "String", T.LongType: "Int64", T.IntegerType: "Int32", T.ShortType: "Int16", T.ByteType: "Int8",
    T.DoubleType: "Float64", T.FloatType: "Float32", T.BooleanType: "Boolean", T.DateType: "Date", T.TimestampType: "Datetime",
}
NUMERIC = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)


def type_name(kind: T.DataType) -> str:
    return TYPE_NAMES.get(type(kind), kind.simpleString())


def text_stats(df: DataFrame, text_column: str = "text") -> DataFrame:
    """One row: min, max, mean, median and total length in characters (nulls ignored), and blank or null texts."""
    return df.agg(*[c.alias(k) for k, c in _text_aggregates(F.col(f"`{text_column}`")).items()])


def _text_aggregates(c: Column) -> dict[str, Column]:
    n = F.length(c)
    return {
        "min_length": F.min(n).cast("long"), "max_length": F.max(n).cast("long"), "mean_length": F.avg(n), "median_length": F.median(n),
        "total_characters": F.coalesce(F.sum(n), F.lit(0)).cast("long"), "empty_or_null_count": F.count_if(is_blank(c)),
    }


def numeric_aggregates(c: Column, floating: bool) -> dict[str, Column]:
    """min and max (NaN counts for neither) and mean."""
    plain = F.when(~F.isnan(c), c) if floating else c
    return {"min": F.min(plain), "max": F.max(plain), "mean": F.avg(c)}


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(col, median): exact medians of numeric columns, nulls left out, NaN the largest; none for a column of nulls.

    By ranks, so that no task holds a column's values: values are counted map-side and sorted in ranges,
    each range adds what came before it, and the one or two values at the middle rank are read off.
    """
    each = F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns])
    counts = df.select(F.explode(each).alias("x")).where("x.v IS NOT NULL").groupBy("x.col", "x.v").agg(F.count(F.lit(1)).alias("n"))
    ranges = stage(counts.repartitionByRange("col", "v").withColumn("pid", F.spark_partition_id()), "ranges")
    runs = ranges.groupBy("col", "pid").agg(F.sum("n").alias("own"))
    # a row a range and column
    ahead = runs.select("col", "pid", (F.sum("own").over(Window.partitionBy("col").orderBy("pid")) - F.col("own")).alias("ahead"), F.sum("own").over(Window.partitionBy("col")).alias("all"))
    upto = F.col("ahead") + F.sum("n").over(Window.partitionBy("col", "pid").orderBy("v"))
    placed = ranges.join(ahead, ["col", "pid"]).withColumn("upto", upto)
    low, high = F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)
    middle = placed.where((F.col("upto") > low) & (F.col("upto") - F.col("n") <= high))
    return middle.groupBy("col").agg(((F.min("v") + F.max("v")) / 2).alias("median"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, counts) of each value, null among them; most frequent first, then by value."""
    return df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("counts")).orderBy(F.desc("counts"), F.asc("value"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return value_counts(df, column).limit(n)


def unique_values(c: Column) -> Column:
    """How many values there are, null among them."""
    return F.count_distinct(c) + F.max(F.coalesce(c.isNull().cast("int"), F.lit(0)))


def generate_stats(df: DataFrame, text_column: str = "text") -> dict[str, Any]:
    """The statistics report. One pass for all aggregates, one for the medians, and a grouped count for each string column."""
    others = [f for f in df.schema.fields if f.name != text_column]
    aggregates: dict[str, Column] = {"rows": F.count(F.lit(1))}
    if text_column in df.columns:
        aggregates |= {f"text.{k}": c for k, c in _text_aggregates(F.col(f"`{text_column}`")).items()}
    for i, f in enumerate(others):
        c = F.col(f"`{f.name}`")
        aggregates[f"{i}.null_count"] = F.count_if(c.isNull())
        if isinstance(f.dataType, NUMERIC):
            floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
            aggregates |= {f"{i}.{k}": a for k, a in numeric_aggregates(c, floating).items()}
    row = df.agg(*[c.alias(k) for k, c in aggregates.items()]).first().asDict()
    numeric = [f.name for f in others if isinstance(f.dataType, NUMERIC)]
    middle = {r["col"]: r["median"] for r in medians(df, numeric).collect()} if numeric else {}
    stats: dict[str, Any] = {"columns": df.columns, "total_columns": len(df.columns), "total_rows": row["rows"]}
    if text_column in df.columns:
        stats["text_stats"] = {k[5:]: v for k, v in row.items() if k.startswith("text.")}
    stats["column_stats"] = {}
    for i, f in enumerate(others):
        info: dict[str, Any] = {"dtype": type_name(f.dataType), "null_count": row[f"{i}.null_count"]}
        if isinstance(f.dataType, T.StringType):
            counted = stage(df.groupBy(F.col(f"`{f.name}`").alias("value")).agg(F.count(F.lit(1)).alias("counts")), "counts")
            info["unique_values"] = counted.count()
            info["top_values"] = [{f.name: r["value"], "counts": r["counts"]} for r in counted.orderBy(F.desc("counts"), F.asc("value")).limit(10).collect()]
        elif isinstance(f.dataType, NUMERIC):
            info |= {k: row[f"{i}.{k}"] for k in ("min", "max", "mean")} | {"median": middle.get(f.name)}
        stats["column_stats"][f.name] = info
    return stats


class StageCounts:
    """Row counts of a pipeline's stages, taken by the run itself and read after it."""

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        self._observed[name] = Observation(name)
        return df.observe(self._observed[name], F.count(F.lit(1)).alias("rows"))

    def read(self) -> dict[str, int]:
        """Counts by stage; call only after an action on the watched frame has ended."""
        return {name: o.get["rows"] for name, o in self._observed.items()}
