"""Text scans of files: lines, JSON records, Parquet, binary documents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.functions import text as tx
from inkstrata.operators.ingest import HTML_SUFFIXES, MARKDOWN_SUFFIXES, decode_files, supported
from inkstrata.sources import listing

# What a corpus may consist of.
CORPUS_SUFFIXES = (".txt", ".jsonl", ".parquet")
QA_SCHEMA = "question STRING, context STRING, answers ARRAY<STRING>"


def _any_case(suffix: str) -> str:
    """Glob for a suffix in upper, lower or mixed case."""
    return "*" + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in suffix)


def _is_file(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(location).isFile()


def _checked(spark: SparkSession, path: str) -> None:
    """An error where only Spark's readers reach ``path`` and would pass over hidden names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    root = system.makeQualified(location).toString()
    listed = system.listFiles(location, True)
    while listed.hasNext():
        name = listed.next().getPath().toString()
        unfinished = any(part.startswith(listing.UNFINISHED) for part in name.split("/"))
        if _suffix(name) in CORPUS_SUFFIXES + MARKDOWN_SUFFIXES + HTML_SUFFIXES and listing.is_hidden(name, root) and not unfinished:
            raise ValueError(f"files with hidden names cannot be read from this file system, rename them: {name}")


def _check_texts(spark: SparkSession, paths: Sequence[str]) -> None:
    """An error for Parquet files without a ``text`` column."""
    names = [name for path in paths if listing.reachable(path) for name, _ in listing.list_files(path, (".parquet",))]
    without = listing.without_column(spark, names, "text")
    if without:
        raise ValueError(f"Parquet files without a text column: {without}")


_suffix = listing.suffix


def _placed(df: DataFrame, *columns) -> DataFrame:
    """Adds where a row came from; the three columns order rows as the files do."""
    return df.select(
        *columns,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_order"),
    )


SCAN_ORDER = ("file_path", "block_start", "row_order")


def _reader(spark: SparkSession, suffix: str, recursive: bool):
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", _any_case(suffix))
    return reader


def _lines(spark: SparkSession, path: str, suffix: str = ".txt", recursive: bool = False) -> DataFrame:
    scan = _placed(_reader(spark, suffix, recursive).text(path), tx.strip(F.col("value")).alias("text"))
    return scan.where(F.length("text") > 0)


def _json_texts(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    # a broken line fails the job; the scan itself reads the one field it needs
    reader = _reader(spark, ".jsonl", recursive).schema("text STRING").option("mode", "FAILFAST")
    return _placed(reader.json(path), "text").where(F.col("text") != "")


def _parquet_texts(spark: SparkSession, path: str | Sequence[str], recursive: bool = False) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    _check_texts(spark, paths)
    scan = _reader(spark, ".parquet", recursive).schema("text STRING").parquet(*paths)
    return _placed(scan.where(F.col("text") != ""), "text")


def _texts_of_file(path: str, content: bytes) -> list[str]:
    """Texts of one whole file, by the rules of the scans above."""
    import json

    if _suffix(path) == ".parquet":
        import pyarrow.parquet as pq

        if "text" not in (table := pq.read_table(pa.BufferReader(content))).column_names:
            raise ValueError(f"Parquet files without a text column: ['{path}']")
        return [str(text) for text in table.column("text").to_pylist() if text]
    lines = content.decode("utf-8").replace("\r\n", "\n").replace("\r", "\n").split("\n")
    if _suffix(path) == ".jsonl":
        found = [json.loads(line).get("text") for line in lines if line.strip()]
        return [str(text) for text in found if text]
    return [line.strip() for line in lines if line.strip()]


def _hidden_texts(spark: SparkSession, path: str, suffixes: Sequence[str]) -> DataFrame:
    """Texts of the files that the scans pass over, each read whole by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts = _texts_of_file(name, content)
                columns = [pa.array(texts, pa.string()), pa.array([name] * len(texts), pa.string()), pa.array([0] * len(texts), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(range(len(texts)), pa.int64())], names=["text", "file_path", "block_start", "row_order"])

    files = listing.whole_files(spark, path, suffixes, hidden_only=True)
    texts = files.mapInArrow(run, "text string, file_path string, block_start bigint, row_order bigint")
    # named as the scans name their files
    return texts.withColumn("file_path", F.when(F.col("file_path").startswith("/"), F.concat(F.lit("file://"), F.col("file_path"))).otherwise(F.col("file_path")))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Stripped, non-blank lines of text files."""
    return _lines(spark, path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """The ``text`` field of JSON lines where it is there and not empty."""
    return _json_texts(spark, path)


def read_parquet_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The ``text`` column, and no other, of Parquet files; empty texts dropped."""
    return _parquet_texts(spark, path)


def read_corpus(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All texts below the given files and folders, by extension.

    In a folder other files are passed over; named directly they are an error.
    """
    scans: list[DataFrame] = []
    for path in paths:
        if _is_file(spark, path):
            suffix = _suffix(path)
            if suffix not in CORPUS_SUFFIXES:
                raise ValueError(f"unsupported file type: {path}")
            scan = {".txt": _lines, ".jsonl": _json_texts, ".parquet": _parquet_texts}[suffix]
            scans.append(scan(spark, path))
        else:
            if not listing.reachable(path):
                _checked(spark, path)
            elif any(listing.is_hidden(name, path.removeprefix("file:")) for name, _ in listing.list_files(path, CORPUS_SUFFIXES)):
                scans.append(_hidden_texts(spark, path, CORPUS_SUFFIXES))
            scans += [
                _lines(spark, path, ".txt", recursive=True),
                _json_texts(spark, path, recursive=True),
                _parquet_texts(spark, path, recursive=True),
            ]
    corpus = scans[0]
    for scan in scans[1:]:
        corpus = corpus.unionByName(scan)
    return corpus


def read_eval_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation texts: Parquet files of a folder or one file; any other file by lines."""
    if not _is_file(spark, path):
        texts = _parquet_texts(spark, path, recursive=True)
        if not listing.reachable(path):
            _checked(spark, path)
        elif any(listing.is_hidden(name, path.removeprefix("file:")) for name, _ in listing.list_files(path, (".parquet",))):
            texts = texts.unionByName(_hidden_texts(spark, path, (".parquet",)))
        return texts
    return _parquet_texts(spark, path) if _suffix(path) == ".parquet" else _lines(spark, path)


def read_qa(spark: SparkSession, path: str) -> DataFrame:
    """Question records from JSON lines; missing answers are an empty list."""
    if _suffix(path) != ".jsonl" and _is_file(spark, path):
        raise ValueError(f"question sets are JSON lines: {path}")
    records = spark.read.schema(QA_SCHEMA).option("mode", "FAILFAST").json(path)
    return records.withColumn("answers", F.coalesce("answers", F.array().cast("array<string>")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Decoded document files: one file, or all supported files below a folder.

    Hidden names are read like others. On a file system that only Spark's readers
    reach, they are an error.
    """
    single = _is_file(spark, path)
    if single and not supported(path):
        raise ValueError(f"no converter for this extension: {path}")
    suffixes = MARKDOWN_SUFFIXES + HTML_SUFFIXES
    # the contents of other files are never read
    if listing.reachable(path):
        files = listing.whole_files(spark, path, suffixes)
    else:
        _checked(spark, path)
        wanted = "{" + ",".join(_any_case(suffix) for suffix in suffixes) + "}"
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", wanted).load(path)
        files = files.select(_bare(F.col("path")).alias("path"), "content")
    if single:
        # one named file must decode; in a folder the bad ones are passed over
        files = files.withColumn(
            "content",
            F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content")).otherwise(
                F.raise_error(F.concat(F.lit("not UTF-8: "), F.col("path")))
            ),
        )
    return decode_files(files)


def _bare(path):
    """A local path without its scheme, other locations as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


def _qualified(spark: SparkSession, path: str) -> str:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    # escaped, as the scan reports its files
    return system.makeQualified(location).toUri().toString()


def _file_locations(spark: SparkSession, path: str) -> list[str]:
    """Where a listed file lies, or the files of a Parquet table that is stored as a folder."""
    if _is_file(spark, path):
        return [_qualified(spark, path)]
    return spark.read.schema("text STRING").parquet(path).inputFiles()


def worker_files(spark: SparkSession, files: Sequence[str], num_workers: int) -> DataFrame:
    """Which worker reads which file: list position modulo the number of workers.

    A Parquet table that is stored as a folder has a row for each of its files.
    """
    workers = max(1, num_workers)
    listed = [(path, place, i, i % workers) for i, path in enumerate(files) for place in _file_locations(spark, path)]
    return spark.createDataFrame(listed, "file string, location string, position int, worker int")


def read_for_workers(spark: SparkSession, files: Sequence[str], num_workers: int) -> DataFrame:
    """Training texts of the listed files with the worker that owns each of them.

    What a writer stores as a folder named ``*.parquet`` is one file of the list;
    other folders are an error.
    """
    folders = [path for path in files if not _is_file(spark, path) and _suffix(path.rstrip("/")) != ".parquet"]
    if folders:
        raise ValueError(f"workers are given files, not folders: {folders}")
    assigned = worker_files(spark, files, num_workers).withColumn("location", _bare(F.col("location")))
    texts = read_parquet_text(spark, files).withColumn("location", _bare(F.col("file_path")))
    # names of files, which the scan has on the driver as well
    return texts.join(F.broadcast(assigned), "location").select(
        "file", "position", "worker", "text", "block_start", "row_order"
    )
