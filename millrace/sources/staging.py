"""Tables written to the folder that all executors share, to end a lineage or to be read more than once."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from io import BufferedWriter, TextIOWrapper
from typing import TextIO

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_run_dirs: dict[str, str] = {}
_scratch: list[list[str]] = []


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it; runs on the driver and in workers."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def open_output(uri: str, newline: str = "\n") -> TextIO:
    """A text file to write piece by piece, from the driver."""
    fs, path = filesystem(uri)
    if "/" in path:
        fs.create_dir(path.rpartition("/")[0], recursive=True)
    return TextIOWrapper(BufferedWriter(fs.open_output_stream(path), 1 << 20), "utf-8", newline=newline)


def write_file(uri: str, text: str) -> None:
    """One small file, from the driver."""
    with open_output(uri, newline="") as out:
        out.write(text)


def read_file(uri: str) -> str:
    fs, path = filesystem(uri)
    with fs.open_input_stream(path) as f:
        return f.read().decode()


def work_dir(spark: SparkSession) -> str:
    """This application's folder inside ``spark.checkpoint.dir``, which every executor can reach.

    Only where that setting is absent and the master is local (tests) is a folder made here;
    on a cluster without it this raises.
    """
    app = spark.sparkContext.applicationId
    if app not in _run_dirs:
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir names no shared folder")
            root = "file://" + tempfile.mkdtemp(prefix="millrace-")
            spark.sparkContext.setCheckpointDir(root)
        _run_dirs[app] = f"{root.rstrip('/')}/millrace-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(remove, _run_dirs[app])
    return _run_dirs[app]


def remove(uri: str) -> None:
    """Delete a folder, if it is there."""
    fs, path = filesystem(uri)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _scratch:
        _scratch[-1].append(path)
    return path


@contextmanager
def scratch() -> Iterator[None]:
    """Paths made inside are deleted at the end: for work whose result is written elsewhere by then."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(path)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there.

    Losing an executor afterwards costs nothing that was staged.
    """
    path = new_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
