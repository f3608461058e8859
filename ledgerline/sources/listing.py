"""All files below a folder, those without content included, which file scans leave out.

A data source that reads no file: each folder just below the root (an archive has one a period) is
listed by a task of its own, the files of the root by one more. It reaches stores that Arrow opens:
mounted folders, S3, GCS, HDFS.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerline.functions.keys import file_id_of

FORMAT = "ledgerline_files"


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class Folder(InputPartition):
    def __init__(self, path: str, deep: bool):
        super().__init__(path)
        self.path, self.deep = path, deep


class FolderReader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def _found(self, path: str, deep: bool):
        from pyarrow import fs

        store, inner = _opened(path)
        prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
        for entry in store.get_file_info(fs.FileSelector(inner, recursive=deep)):
            yield f"{prefix}{entry.path}", entry

    def partitions(self) -> list[Folder]:
        from pyarrow import fs

        below = [path for path, entry in self._found(self.root, False) if entry.type == fs.FileType.Directory]
        return [Folder(self.root, False), *(Folder(path, True) for path in sorted(below))]

    def read(self, partition: Folder) -> Iterator[tuple]:
        from pyarrow import fs

        for path, entry in self._found(partition.path, partition.deep):
            if entry.type == fs.FileType.File:
                yield path, entry.size


class FileListing(DataSource):
    """``(path, size)`` of every file below the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, size bigint"

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(self.options["path"])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``files(path, size)`` below a folder, empty files included. Files whose names begin with a dot or an underscore go.

    Python lists names; no content is read, and no row of a filing passes it.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package
    spark.dataSource.register(FileListing)
    return spark.read.format(FORMAT).load(folder).filter(~F.substring_index("path", "/", -1).rlike(r"^[._]"))


def filings_in(files: DataFrame) -> DataFrame:
    """``(file_id, n_files, size)`` of the text files in ``files(path, size)``: one row a filing, also of one without content.

    Files of one name in one period folder of several archives share a key; ``n_files`` tells.
    """
    texts = files.filter(F.col("path").endswith(".txt"))
    return texts.groupBy(file_id_of(F.col("path")).alias("file_id")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size")
    )
