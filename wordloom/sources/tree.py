"""File trees listed by Spark tasks: no name is hidden, contents are read only where asked for.

Spark's own file sources skip names that begin with ``_`` or ``.``.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources.files import FILE_TYPES, decoded, has_type

ENTRIES = "path string, folder boolean, length bigint, modified timestamp"
# Bytes of files that one task should read, and that it hands on at a time.
TASK_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
LISTED = 10_000
FILES_FOR_A_TASK = 100_000


def _located(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what stands before a path in an address."""
    address = re.sub("^file:/+", "/", uri)
    system, path = fs.FileSystem.from_uri(address)
    return system, path, address.removesuffix("/").removesuffix(path.removesuffix("/"))


def _leads_back(link: str, root: str) -> bool:
    """Whether a link names a folder that the walk from ``root`` to it came through."""
    target, above = os.path.realpath(link), os.path.dirname(link)
    while len(above) >= len(root):
        if os.path.realpath(above) == target:
            return True
        above = os.path.dirname(above)
    return False


def _entries(system: fs.FileSystem, folder: str, root: str) -> Iterator[tuple]:
    if not isinstance(system, fs.LocalFileSystem):
        for found in system.get_file_info(fs.FileSelector(folder)):
            yield found.path, found.type == fs.FileType.Directory, found.size or 0, found.mtime
        return
    with os.scandir(folder) as listing:
        for entry in listing:
            if entry.is_dir():
                if not (entry.is_symlink() and _leads_back(entry.path, root)):
                    yield entry.path, True, 0, None
            elif entry.is_file() and os.access(entry.path, os.R_OK):
                facts = entry.stat()
                # Microseconds by whole numbers: a float of seconds has too few digits.
                modified = datetime.fromtimestamp(facts.st_mtime_ns // 10**9, timezone.utc)
                yield entry.path, False, facts.st_size, modified.replace(microsecond=facts.st_mtime_ns // 1000 % 10**6)


def list_files(spark: SparkSession, folder: str, work: str, file_types: Iterable[str] = FILE_TYPES) -> DataFrame:
    """``path, length, modified`` of every readable file of the tree with a wanted type.

    Names that begin with ``_`` or ``.`` count like any other, of folders too.
    Each level of the tree is one job, whose tasks list the folders of that
    level; ``work`` is a folder that driver and executors share, where the
    levels are stored, so that a lost executor costs a few listings.  Links are
    followed unless they lead back to a folder on the way to them; files and
    links without a target, and files that may not be read, are left out.
    """
    _, root, before = _located(folder)
    cores = spark.sparkContext.defaultParallelism
    own = f"{work.rstrip('/')}/listing-{uuid.uuid4().hex}"
    types = pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC"))])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = _located(folder)[0]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)

        for of in batches:
            for name in of.column("path").to_pylist():
                for row in _entries(system, name, root):
                    rows.append(row)
                    if len(rows) == LISTED:
                        yield batch()
                        rows = []
        if rows:
            yield batch()

    level, folders, depth, found = spark.createDataFrame([(root,)], "path string"), 1, 0, []
    while folders:
        level.repartition(min(folders, 4 * cores), "path").mapInArrow(listed, ENTRIES).write.parquet(f"{own}/{depth}")
        found.append(f"{own}/{depth}")
        entries = spark.read.schema(ENTRIES).parquet(found[-1])
        level = entries.where("folder").select("path")
        folders, depth = level.count(), depth + 1
    files = spark.read.schema(ENTRIES).parquet(*found).where(~F.col("folder") & has_type(F.col("path"), file_types))
    return files.select(F.concat(F.lit(before), "path").alias("path"), "length", "modified")


def read_files(files: DataFrame, folder: str, charset: str = "UTF-8") -> DataFrame:
    """``path, length, bytes, text`` of the listed files of a tree, the length as it was listed.

    Files are dealt to tasks so that each has about ``TASK_BYTES``; a task
    hands them on by ``BATCH_BYTES``.  A file that is gone since the listing has
    no row.  Malformed UTF-8 becomes U+FFFD; other charsets are decoded strictly.
    """
    spark = files.sparkSession
    _, _, before = _located(folder)
    size, count = files.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    tasks = max(min(count, 2 * spark.sparkContext.defaultParallelism), size // TASK_BYTES, count // FILES_FOR_A_TASK, 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = _located(folder)[0]
        paths, lengths, contents, held = [], [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": paths, "length": pa.array(lengths, pa.int64()), "bytes": pa.array(contents, pa.binary())})

        for of in batches:
            for path, length in zip(of.column("path").to_pylist(), of.column("length").to_pylist()):
                try:
                    with system.open_input_stream(path.removeprefix(before), compression=None) as stream:
                        content = stream.read()
                except FileNotFoundError:
                    continue
                paths.append(path)
                lengths.append(length)
                contents.append(content)
                held += len(content)
                if held >= BATCH_BYTES:
                    yield batch()
                    paths, lengths, contents, held = [], [], [], 0
        if paths:
            yield batch()

    rows = files.select("path", "length").repartition(int(tasks), "path").mapInArrow(read, "path string, length bigint, bytes binary")
    return rows.select("path", "length", "bytes", decoded(F.col("bytes"), charset).alias("text"))


def scan_tree(
    spark: SparkSession, folder: str, work: str, file_types: Iterable[str] = FILE_TYPES, charset: str = "UTF-8"
) -> DataFrame:
    """``scan_files`` with the hidden names: ``path, bytes, text`` of every file of a wanted type."""
    return read_files(list_files(spark, folder, work, file_types), folder, charset).drop("length")


def write_files(files: DataFrame, folder: str) -> None:
    """Write rows ``name, text`` as files below the folder; a null text deletes the file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root, _ = _located(folder)
        n = 0
        for of in batches:
            for name, text in zip(of.column("name").to_pylist(), of.column("text").to_pylist()):
                path = f"{root}/{name}"
                if text is None:
                    # A task that runs again finds it gone already.
                    if system.get_file_info(path).type != fs.FileType.NotFound:
                        system.delete_file(path)
                    continue
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(path, compression=None) as stream:
                    stream.write(text.encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    files.select("name", "text").mapInArrow(write, "n bigint").agg(F.sum("n")).first()
