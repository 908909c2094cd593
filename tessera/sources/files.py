"""File-tree sources: listing and reading on the executors, lazily.

Spark's own file sources skip names that start with ``_`` or ``.``, at every
depth, and keep the file list on the driver.  A mail tree holds such names
(``_sent_mail``), so the tree is a data source of its own (``file_tree``):

* building a DataFrame over it runs nothing.  When the scan is planned, the
  upper folders are listed until there are ``FOLDERS`` of them; each is a
  partition, whose task walks what lies below it.  File names never pass through
  the driver, and nothing is written down;
* a link to a folder above itself is not entered again: a walk knows the real
  folders it is in, so linked loops end.

Contents are read by bytes, not by number of files: the listing tasks keep a
running total of file lengths and cut it into packs of ``PACK_BYTES`` or
``PACK_FILES``, a larger file being a pack of its own; packs are dealt evenly over
the partitions of the read, which holds ``BATCH_BYTES`` of contents and one more
content at a time.

Executors reach the files through ``pyarrow.fs``: a shared mount (plain or
``file:`` paths) or any store it has a client for (``s3:``, ``gs:``,
``hdfs:``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LISTED = "path string, modificationTime timestamp, length bigint"
#: Folders to walk that the scan is planned for, and levels listed to find them.
FOLDERS, LEVELS = 256, 6
#: A pack of files that one read takes: bytes, or number of files.
PACK_BYTES, PACK_FILES = 8 << 20, 64
#: Contents that are handed on at once; a larger one goes alone.
BATCH_BYTES = 1 << 20


def bare_path(path: Column) -> Column:
    """A path without its scheme and authority: ``file:/a`` and ``hdfs://n:1/a`` → ``/a``."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?(?=/)", "")


def open_store(uri: str):
    """``(file system, path in it, prefix that turns such a path into a URI)``."""
    import re

    from pyarrow import fs
    if uri.startswith("file:"):
        uri = re.sub(r"^file:/+", "/", uri)
    store, path = fs.FileSystem.from_uri(uri)
    return store, path, uri[:len(uri) - len(path)] if uri.endswith(path) else ""


def _real(store, path: str) -> str:
    """The folder's real path where the store has links, else its path."""
    import os

    from pyarrow import fs
    return os.path.realpath(path) if isinstance(store, fs.LocalFileSystem) else path


def _entries(store, path: str):
    """``(files, folders)`` directly in a folder."""
    from pyarrow import fs
    infos = store.get_file_info(fs.FileSelector(path, recursive=False))
    return ([i for i in infos if i.type == fs.FileType.File],
            [i.path for i in infos if i.type == fs.FileType.Directory])


def _walk(store, path: str, above: tuple[str, ...], deep: bool) -> Iterator[list]:
    """The files of a folder and, if ``deep``, of all folders below it."""
    stack = [(path, above)]
    while stack:
        folder, above = stack.pop()
        real = _real(store, folder)
        if real in above:
            continue  # a link back to where the walk is
        files, folders = _entries(store, folder)
        yield files
        if deep:
            stack += [(f, (*above, real)) for f in reversed(folders)]


class _Part(InputPartition):
    """Folders of one task: ``(URI, real folders above, whether to go below)``."""

    def __init__(self, folders: list):
        self.folders = folders


class TreeReader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def partitions(self) -> list:
        store, path, prefix = open_store(self.root)
        level, here = [(path, ())], []
        for _ in range(LEVELS):
            if not level or len(level) >= FOLDERS:
                break
            below = []
            for folder, above in level:
                real = _real(store, folder)
                if real in above:
                    continue
                here.append((prefix + folder, above, False))
                below += [(f, (*above, real)) for f in _entries(store, folder)[1]]
            level = below
        each = -(-len(here) // FOLDERS) or 1
        return ([_Part(here[i:i + each]) for i in range(0, len(here), each)]
                + [_Part([(prefix + folder, above, True)]) for folder, above in level])

    def read(self, partition: _Part) -> Iterator:
        import pyarrow as pa
        schema = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")),
                            ("length", pa.int64())])
        for uri, above, deep in partition.folders:
            store, path, prefix = open_store(uri)
            for files in _walk(store, path, above, deep):
                for lo in range(0, len(files), 10_000):
                    part = files[lo:lo + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([prefix + i.path for i in part], pa.string()),
                         pa.array([i.mtime for i in part], pa.timestamp("us", "UTC")),
                         pa.array([i.size for i in part], pa.int64())], schema=schema)


class TreeSource(DataSource):
    """Every file below a folder, whatever its name: ``path, modificationTime, length``."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options["path"])


def _pack(pack_bytes: int, pack_files: int):
    """File rows -> one row per pack, by a running total of their lengths."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        held: list[dict] = []
        total, kind = 0, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([held], pa.list_(kind))], names=["files"])

        for batch in batches:
            kind = pa.struct(batch.schema)
            for row in batch.to_pylist():
                n = row["length"] or 0
                if held and (total + n > pack_bytes or len(held) >= pack_files):
                    yield out()
                    held, total = [], 0
                held.append(row)
                total += n
        if held:
            yield out()
    return run


def _read_contents(batches: Iterator) -> Iterator:
    import pyarrow as pa
    names = ("path", "modificationTime", "length")
    kinds = (pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.binary())
    local = None  # one client for all plain paths

    def opened(uri):
        nonlocal local
        if not uri.startswith("/"):
            store, path, _ = open_store(uri)
            return store.open_input_stream(path)
        local = local or open_store("/")[0]
        return local.open_input_stream(uri)

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          names=[*names, "content"])

    for batch in batches:
        for pack in batch.column("files").to_pylist():
            held, size = [], 0
            for row in pack:
                with opened(row["path"]) as f:
                    data = f.read()
                if held and size + len(data) > BATCH_BYTES:
                    yield out(held)
                    held, size = [], 0
                held.append((*(row[n] for n in names), data))
                size += len(data)
            if held:
                yield out(held)


def walk_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modificationTime, length)`` of every file at any depth, whatever its name."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TreeSource)
    return spark.read.format("file_tree").load(root)


def packs(files: DataFrame, pack_bytes: int | None = None, pack_files: int | None = None) -> DataFrame:
    """File rows as rows ``files`` (arrays) of about equal bytes, dealt evenly."""
    out = files.mapInArrow(_pack(pack_bytes or PACK_BYTES, pack_files or PACK_FILES), f"files array<struct<{LISTED}>>")
    return out.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_binary_files(spark: SparkSession, root: str, with_content: bool = True) -> DataFrame:
    """``(path, modificationTime, length[, content])`` of every file under ``root``.

    ``path`` is bare: without scheme and authority.  Building it runs no job.
    """
    files = walk_files(spark, root)
    if with_content:
        files = packs(files).mapInArrow(_read_contents, f"{LISTED}, content binary")
    return files.withColumn("path", bare_path(F.col("path")))


def list_files_recursive(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length)`` of all files at all depths below ``root``."""
    return read_binary_files(spark, root, with_content=False).select("path", "length")


def inline_source(spark: SparkSession, values, schema: str, num_slices: int | None = None) -> DataFrame:
    """A small driver-side collection as a DataFrame spread over ``num_slices``."""
    df = spark.createDataFrame(values, schema)
    return df.repartition(num_slices) if num_slices else df
