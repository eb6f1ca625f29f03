"""Reading and writing: Parquet with a text column, shards, JSON lines, text lines, and reports."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import number_of_characters, number_of_words
from millrace.operators.stats import generate_stats
from millrace.sources.staging import filesystem, write_file

#: Name of the column of scan order that ``read_parquet(..., order=True)`` adds.
ORDER = "__mr_scan"
WIKI_COLUMNS = ("filename", "title", "text", "number_of_characters", "number_of_words", "topic", "text_quality")


def _session(spark: SparkSession | None) -> SparkSession:
    return spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _require(df: DataFrame, column: str, path: Any) -> None:
    names = df.columns
    if column not in names:
        raise ValueError(f"no column {column!r} in {path}, which has {names}")


def read_parquet(path: str | Sequence[str], text_column: str = "text", spark: SparkSession | None = None, order: bool = False) -> DataFrame:
    """A Parquet table that must have ``text_column``; ``order`` adds file and row number as a struct.

    Raises FileNotFoundError for a path that isn't there, ValueError for a missing column.
    """
    paths = [path] if isinstance(path, str) else list(path)
    try:
        df = _session(spark).read.parquet(*map(str, paths))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no Parquet at {path}") from None
        raise
    _require(df, text_column, path)
    return df.withColumn(ORDER, F.struct("_metadata.file_path", "_metadata.row_index")) if order else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if its files are too few and small for a scan to use them.

    The rows of such a scan are exchanged once, round robin; at most a scan split a core is. A scan of
    as many splits as cores, or anything but files, stays as it is. Filters and column lists still
    reach the scan.
    """
    context = df.sparkSession.sparkContext
    files = df._jdf.inputFiles()  # left in the JVM, for there may be many
    if not 0 < len(files) < context.defaultParallelism:
        return df
    split = int(df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    sizes = []
    for uri in files:
        fs, path = filesystem(unquote(uri))
        sizes.append(fs.get_file_info(path).size or 0)
    return df.repartition(context.defaultParallelism) if sum(-(-n // split) for n in sizes) < context.defaultParallelism else df


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path``, a directory of part files; ``single_file`` for one part, of small results only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(str(path))


def write_stats(stats: dict[str, Any], path: str) -> None:
    """The report as JSON at a path or URI."""
    write_file(str(path), json.dumps(stats, indent=2, ensure_ascii=False, default=str))


def stats_path(path: str) -> str:
    """Where a table's report goes: its path, with .json for the suffix."""
    head, slash, name = str(path).rstrip("/").rpartition("/")
    return f"{head}{slash}{name.rpartition('.')[0] or name}.json"


def write_parquet_with_stats(df: DataFrame, path: str, text_column: str = "text") -> dict[str, Any]:
    """Write, then report on what was written, so the plan (and any model call in it) runs once."""
    write_parquet(df, path)
    stats = generate_stats(df.sparkSession.read.parquet(str(path)), text_column)
    write_stats(stats, stats_path(path))
    return stats


def read_wiki_jsonl(directory: str, spark: SparkSession | None = None, pattern: str = "wiki_*") -> DataFrame:
    """Articles of JSON-lines files in any depth below ``directory``; blank and broken lines are left out.

    A missing or null title or text is empty.
    """
    lines = _session(spark).read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(directory)
    fields = "title string, text string, _corrupt string"
    row = F.from_json("value", fields, {"columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("path"), row.alias("r")).where("r._corrupt IS NULL")
    text = F.coalesce("r.text", F.lit(""))
    return rows.select(
        F.element_at(F.split("path", "/"), -1).alias("filename"), F.coalesce("r.title", F.lit("")).alias("title"), text.alias("text"),
        number_of_characters(text).alias("number_of_characters"), number_of_words(text).alias("number_of_words"),
        F.lit("N-A").alias("topic"), F.lit(0).cast("long").alias("text_quality"),
    )


def shard_paths(directory: str, start: int, count: int) -> list[str]:
    """Names of ``count`` shards from number ``start``."""
    return [f"{directory}/{i:03d}_00000.parquet" for i in range(start, start + count)]


def read_shards(paths: Sequence[str], text_column: str = "text", spark: SparkSession | None = None) -> DataFrame:
    """All shards one after the other, repeats kept; they must have the same columns."""
    return read_parquet(paths, text_column, spark)


def is_written(path: str) -> bool:
    """Is a complete table at this path?"""
    fs, at = filesystem(str(path))
    return fs.get_file_info(f"{at}/_SUCCESS").is_file


def combine_shards(paths: Sequence[str], output: str, spark: SparkSession | None = None, skip_existing: bool = False) -> str:
    """One shard: its path as it is; more: their rows written to ``output``, unless it is there and may stay."""
    if len(paths) == 1:
        return str(paths[0])
    if skip_existing and is_written(output):
        return output
    frames = [read_parquet(p, spark=spark) for p in paths]
    for p, f in zip(paths, frames):
        if f.columns != frames[0].columns:
            raise ValueError(f"{p} has other columns: {f.columns}")
    write_parquet(read_shards(paths, spark=spark), output)
    return output


def read_lines(path: str, spark: SparkSession | None = None, text_column: str = "text") -> DataFrame:
    """Lines of text files as a text column."""
    return _session(spark).read.text(path).withColumnRenamed("value", text_column)


def read_ndjson(path: str, text_column: str = "text", spark: SparkSession | None = None, schema: str | None = None) -> DataFrame:
    reader = _session(spark).read
    df = (reader.schema(schema) if schema else reader).json(path)
    _require(df, text_column, path)
    return df


def from_texts(texts: Iterable[str | None], spark: SparkSession | None = None, text_column: str = "text") -> DataFrame:
    """A small in-memory table."""
    return _session(spark).createDataFrame([(t,) for t in texts], f"`{text_column}` string")
