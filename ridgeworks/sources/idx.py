"""IDX files (unsigned-byte images and labels), or folders of them, as a Spark data source."""

from __future__ import annotations

import gzip
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ridgeworks.functions.pixels import to_list_array

# fixed value: type code of unsigned bytes in an IDX header
UNSIGNED_BYTE = 0x08
ROWS_PER_BATCH = 4096


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _files(path: str) -> list[str]:
    """The file itself, or the files of a folder by name; hidden ones are left out."""
    where, inner = place_of(path)
    if where.get_file_info(inner).type != fs.FileType.Directory:
        return [path]
    found = [x.base_name for x in where.get_file_info(fs.FileSelector(inner)) if x.type == fs.FileType.File]
    found = [f"{path.rstrip('/')}/{name}" for name in sorted(found) if name[0] not in "._"]
    if not found:
        raise ValueError(f"{path} holds no IDX file")
    return found


def _open(path: str):
    where, inner = place_of(path)
    raw = where.open_input_file(inner)
    return gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw


def _header(stream) -> tuple[int, list[int]]:
    """(header bytes, sizes of the dimensions)."""
    zero, kind, dimensions = struct.unpack(">HBB", stream.read(4))
    if zero != 0 or kind != UNSIGNED_BYTE or dimensions < 1:
        raise ValueError("not an IDX file of unsigned bytes")
    sizes = struct.unpack(f">{dimensions}I", stream.read(4 * dimensions))
    return 4 + 4 * dimensions, list(sizes)


class RecordRange(InputPartition):
    """Records of one file; ``row`` is the row number of the first of them."""

    def __init__(self, path: str, labels: str | None, first: int, count: int, row: int):
        self.path, self.labels, self.first, self.count, self.row = path, labels, first, count, row


def _sizes(path: str) -> list[int]:
    with _open(path) as stream:
        return _header(stream)[1]


def _records(path: str, first: int, count: int) -> Iterator[np.ndarray]:
    """Records first, first + 1, ... in blocks of at most ROWS_PER_BATCH rows."""
    with _open(path) as stream:
        start, sizes = _header(stream)
        width = math.prod(sizes[1:])
        stream.seek(start + first * width)
        for row in range(0, count, ROWS_PER_BATCH):
            n = min(ROWS_PER_BATCH, count - row)
            data = np.frombuffer(stream.read(n * width), np.uint8)
            if len(data) != n * width:
                raise ValueError(f"{path} ends early")
            yield data.reshape(n, width)


class IdxReader(DataSourceReader):
    """Fixed-width records, so any byte range of an uncompressed file is a partition of its own.

    A label file given beside an image file is read over the same range of records. Row numbers go on
    from one file of a folder to the next; labels then lie in a folder with as many files.
    """

    def __init__(self, options):
        self.path, self.labels = options["path"], options.get("labels")
        self.partition_bytes = int(options.get("partitionBytes", 64 * 1024 * 1024))

    def partitions(self):
        files = _files(self.path)
        labels = _files(self.labels) if self.labels else [None] * len(files)
        if len(labels) != len(files):
            raise ValueError(f"{self.labels} does not hold one label file for each of {len(files)} files")
        found, before, common = [], 0, None
        for path, beside in zip(files, labels, strict=True):
            rows, *shape = _sizes(path)
            common = shape if common is None else common
            if shape != common:
                raise ValueError(f"records of {path} differ in shape from those before")
            if beside and _sizes(beside) != [rows]:
                raise ValueError(f"{beside} does not hold one label for each of {rows} records")
            step = rows if path.endswith(".gz") else self.partition_bytes // max(1, math.prod(shape))
            step = max(1, step)
            found += [RecordRange(path, beside, i, min(step, rows - i), before + i) for i in range(0, rows, step)]
            before += rows
        return found

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        span = partition.first, partition.count
        vectors = len(_sizes(partition.path)) > 1
        labels = _records(partition.labels, *span) if partition.labels else None
        row = partition.row
        for data in _records(partition.path, *span):
            columns = {"row_id": pa.array(np.arange(row, row + len(data), dtype=np.int64))}
            row += len(data)
            if labels is not None:
                columns["label"] = pa.array(next(labels).reshape(-1).astype(np.int32))
            if vectors:
                columns["features"] = to_list_array(data.astype(np.int32), pa.int32())
            else:
                columns["label"] = pa.array(data.reshape(-1).astype(np.int32))
            yield pa.RecordBatch.from_pydict(columns)


class IdxSource(DataSource):
    """``spark.read.format("idx").load(path)``; one dimension gives labels, more give vectors."""

    @classmethod
    def name(cls):
        return "idx"

    def schema(self):
        if len(_sizes(_files(self.options["path"])[0])) == 1:
            return "row_id long, label int"
        return f"row_id long,{' label int,' if self.options.get('labels') else ''} features array<int>"

    def reader(self, schema):
        return IdxReader(self.options)


def read_idx(
    spark: SparkSession, path: str, labels: str | None = None, partition_bytes: int | None = None
) -> DataFrame:
    """One IDX file or a folder of them, or images with their labels, each a file or a folder."""
    spark.dataSource.register(IdxSource)
    reader = spark.read.format("idx")
    if labels:
        reader = reader.option("labels", labels)
    if partition_bytes:
        reader = reader.option("partitionBytes", partition_bytes)
    return reader.load(path)


def read_idx_images(spark: SparkSession, images: str, labels: str, **options) -> DataFrame:
    """(row_id, label, features) from an image file and its label file; nothing is joined."""
    return read_idx(spark, images, labels, **options)
