"""A data source of whole files, hidden names among them, and tables of file names.

Spark's own file scans pass over names that begin with a dot or an underscore. This one
lists a folder once, in the planner of the source, by name, and opens files of the
wanted extensions only, in tasks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Bytes and files of a task, and bytes handed on at once.
TASK_BYTES = 64 << 20
TASK_FILES = 2_000
BATCH_BYTES = 8 << 20
NAMES_A_TASK = 500

# Names of what a write that is under way has left, which is no data.
UNFINISHED = ("_temporary", ".spark-staging")


def suffix(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() if "." in name.lstrip(".") else ""


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; an error where it cannot be reached."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def reachable(path: str) -> bool:
    """Whether files below ``path`` can be read here, and not by Spark's readers alone."""
    try:
        opened(path)
    except (pa.ArrowInvalid, OSError, ValueError):
        return False
    return True


def list_files(path: str, suffixes: Sequence[str]) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the files at or below ``path`` with one of the suffixes, sorted."""
    system, place = opened(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(place, recursive=True))
    head = path[: len(path) - len(place)] if path.endswith(place) and "://" in path else ""
    return sorted(
        (head + f.path, f.size)
        for f in found
        if f.type == fs.FileType.File and suffix(f.path) in suffixes and not any(p.startswith(UNFINISHED) for p in f.path.split("/"))
    )


def is_hidden(path: str, root: str) -> bool:
    """Whether Spark's scans of ``root`` pass over ``path``."""
    inside = path.removeprefix(root.rstrip("/")) if path != root else path.rsplit("/", 1)[-1]
    return any(part[:1] in ("_", ".") for part in inside.split("/"))


@dataclass
class Share(InputPartition):
    """Files of one task."""

    paths: list[str]

    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.suffixes = options["path"], options["suffixes"].split(",")
        self.hidden = options.get("hidden") == "true"

    def partitions(self) -> list[Share]:
        shares: list[Share] = []
        size = TASK_BYTES
        for path, length in list_files(self.path, self.suffixes):
            if self.hidden and not is_hidden(path, self.path.removeprefix("file:")):
                continue
            if size + length > TASK_BYTES or len(shares[-1].paths) >= TASK_FILES:
                shares.append(Share([]))
                size = 0
            shares[-1].paths.append(path)
            size += length
        return shares

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        paths: list[str] = []
        contents: list[bytes] = []
        size = 0
        for path in partition.paths:
            system, place = opened(path)
            with system.open_input_stream(place) as stream:
                data = stream.read()
            paths.append(path)
            contents.append(data)
            size += len(data)
            if size > BATCH_BYTES:
                yield _rows(paths, contents)
                paths, contents, size = [], [], 0
        if paths:
            yield _rows(paths, contents)


def _rows(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"])


class WholeFiles(DataSource):
    """``path, content`` of the files at or below ``path`` with one of ``suffixes``."""

    @classmethod
    def name(cls) -> str:
        return "whole_files"

    def schema(self) -> str:
        return "path string, content binary"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def whole_files(spark: SparkSession, path: str, suffixes: Sequence[str], hidden_only: bool = False) -> DataFrame:
    """Whole files with one of the suffixes, or those of them that Spark's scans pass over."""
    spark.dataSource.register(WholeFiles)
    return spark.read.format("whole_files").option("suffixes", ",".join(suffixes)).option("hidden", str(hidden_only).lower()).load(path)


def write_files(files: DataFrame, root: str) -> None:
    """Write each row of ``files`` (``path, content``) to a file of that name below ``root``.

    A task that runs again writes the same files again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = opened(root)
        made: set[str] = set()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{place}/{path}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(target) as stream:
                    stream.write(content or b"")
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], names=["path"])

    files.select("path", "content").mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()


def without_column(spark: SparkSession, paths: Sequence[str], column: str, limit: int = 5) -> list[str]:
    """Some of the Parquet files ``paths`` that lack ``column``; their footers are read in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            lacking = []
            for path in batch.column(0).to_pylist():
                system, place = opened(path)
                if column not in pq.read_schema(place, filesystem=system).names:
                    lacking.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(lacking, pa.string())], names=["path"])

    if not paths:
        return []
    names = spark.createDataFrame(pa.table({"path": pa.array(paths, pa.string())}))
    tasks = -(-len(paths) // NAMES_A_TASK)
    lacking = names.repartition(tasks).mapInArrow(run, "path string")
    return [r["path"] for r in lacking.orderBy("path").limit(limit).collect()]
