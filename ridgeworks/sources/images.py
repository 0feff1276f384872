"""Class-per-directory image trees to feature vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from ridgeworks.functions.pixels import resample, to_list_array
from ridgeworks.operators.indexing import seeded_order
from ridgeworks.session import plain_path, stored

# fixed value: image files lie in directories class_0, class_1, ...; the last directory counts
CLASS_DIRECTORY = r"(?:^|/)class_(\d+)/[^/]*$"
# why a file is not an example
OUTSIDE, UNREADABLE = "outside a class directory", "not an image"
PIXELS = ["height", "width", "nChannels", "data"]
# bytes of decoded pixels a task works on at a time
IMAGE_BYTES = 32 * 1024 * 1024


def class_of(origin: Column, pattern: str = CLASS_DIRECTORY) -> Column:
    """Label from the directory name; null outside a class directory."""
    return F.nullif(F.regexp_extract(origin, pattern, 1), F.lit("")).cast("int")


def name_below(origin: Column, root: str) -> Column:
    """The path of a file below ``root``, both without scheme and host: the same wherever the tree lies."""
    depth = len(root.rstrip("/").split("/"))
    parts = F.split(F.regexp_replace(origin, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", ""), "/")
    name = F.array_join(F.slice(parts, F.lit(depth + 1), F.size(parts)), "/")
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))  # Spark gives origins in URL form


def tree_files(spark: SparkSession, path: str, pattern: str = CLASS_DIRECTORY) -> DataFrame:
    """Every file below ``path``: (name, origin, label, reason, height, width, nChannels, data).

    ``name`` is the path below the root. ``reason`` says why a file is not an example, else it is null: it
    lies outside a class directory or does not decode as an image. Files without a byte are no rows of any of
    Spark's file sources, nor of this one.
    """
    reader = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", False)
    rows = reader.load(path).select("image.*")
    label = class_of(F.col("origin"), pattern)
    readable = (F.col("height") > 0) & (F.col("width") > 0) & (F.col("nChannels") > 0)
    reason = F.when(label.isNull(), OUTSIDE).when(~readable, UNREADABLE)
    return rows.select(
        name_below(F.col("origin"), plain_path(spark, path)).alias("name"),
        "origin",
        label.alias("label"),
        reason.alias("reason"),
        *PIXELS,
    )


def read_image_tree(spark: SparkSession, path: str, pattern: str = CLASS_DIRECTORY) -> DataFrame:
    """(name, origin, label, height, width, nChannels, data) of the files that are examples."""
    return tree_files(spark, path, pattern).where(F.col("reason").isNull()).drop("reason")


def _threshold(x: np.ndarray) -> np.ndarray:
    return np.where(x < 0.5, 0.0, np.where(x > 0.5, 1.0, x))


def image_vectors(images: DataFrame, shape: tuple[int, int] | None = None, layer: int = 0) -> DataFrame:
    """The columns of ``images`` with features in place of the pixels: one colour layer, binarised.

    Layer 0 is red: pixel bytes are stored blue-green-red(-alpha), grey images have one layer. With
    ``shape`` they are down-sampled to it and binarised again. Rows are flattened row by row. Where ``images``
    has a reason why a file is not an example, the features are null.
    """
    kept = [x for x in images.columns if x not in PIXELS]
    rejects = "reason" in kept

    def vectors_of(data: pa.Array, rows: list[int], size: tuple[int, int, int]) -> np.ndarray:
        height, width, channels = size
        place = 0 if channels == 1 else 2 - layer
        raw = [np.frombuffer(data[row].as_buffer(), np.uint8) for row in rows]
        pixels = _threshold(np.stack(raw).reshape(-1, height, width, channels)[:, :, :, place] / 255.0)
        if shape is not None:
            pixels = _threshold(resample(pixels, *shape))
        return pixels.reshape(len(rows), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[tuple[int, int, int] | None, list[int]] = {}
            sizes = zip(*[batch.column(c).to_pylist() for c in PIXELS[:-1]], strict=True)
            bad = batch.column("reason").is_valid().to_pylist() if rejects else [False] * batch.num_rows
            for row, size in enumerate(sizes):
                by_size.setdefault(None if bad[row] else size, []).append(row)
            for size, rows in by_size.items():
                step = max(1, IMAGE_BYTES // (8 * size[0] * size[1])) if size else len(rows)
                for start in range(0, len(rows), step):
                    some = rows[start : start + step]
                    if size is None:
                        found = pa.nulls(len(some), pa.list_(pa.float64()))
                    else:
                        found = to_list_array(vectors_of(batch.column("data"), some, size))
                    taken = [batch.column(x).take(pa.array(some)) for x in kept]
                    yield pa.RecordBatch.from_arrays([*taken, found], names=[*kept, "features"])

    schema = StructType([images.schema[x] for x in kept]).add("features", ArrayType(DoubleType()))
    return images.mapInArrow(run, schema)


class ImageTree:
    """A tree of image files, decoded once: ``vectors`` of the examples, ``rejects`` with the reason.

    Rows are kept as Parquet in the shared checkpoint folder, so counts and sweeps decode nothing again.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        shape: tuple[int, int] | None = (40, 60),
        layer: int = 0,
        pattern: str = CLASS_DIRECTORY,
    ):
        self.rows = stored(image_vectors(tree_files(spark, path, pattern), shape, layer), "image-vectors")
        self.vectors = self.rows.where(F.col("reason").isNull()).select("name", "origin", "label", "features")
        self.rejects = self.rows.where(F.col("reason").isNotNull()).select("name", "label", "reason")

    def counts(self) -> tuple[int, int]:
        """Examples and rejected files."""
        good = F.col("reason").isNull().cast("long")
        images, files = self.rows.agg(F.coalesce(F.sum(good), F.lit(0)), F.count("*")).first()
        return images, files - images


def image_features(
    spark: SparkSession, path: str, shape: tuple[int, int] | None = (40, 60), seed: int = 0
) -> DataFrame:
    """Image tree to shuffled training rows (row_id, label, features); decoded once."""
    vectors = ImageTree(spark, path, shape).vectors
    order = seeded_order(vectors.select("name"), "name", seed, "row_id")
    return vectors.join(order, "name").select("row_id", "label", "features")
