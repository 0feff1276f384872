"""From a tree of image files to a lambda sweep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeworks.plans.sweep import Columns, ridge_sweep
from ridgeworks.sources.images import ImageTree

COLUMNS = Columns("name", "label", "features")


def image_sweep(
    spark: SparkSession,
    path: str,
    shape: tuple[int, int] | None = (40, 60),
    seed: int = 0,
    counts: bool = False,
    **options,
) -> DataFrame:
    """Decode, binarise and down-sample the images once, then sweep over them.

    Splitting by the hash of the file's path below the root is the same as shuffling by it and splitting by
    position, without moving a pixel, and a copy of the tree is split as the tree is. With ``counts`` the
    result also has the numbers of images and of rejected files (``ImageTree.rejects`` names them).
    """
    tree = ImageTree(spark, path, shape)
    sweep = ridge_sweep(tree.vectors, split="hash", seed=seed, columns=COLUMNS, **options)
    if not counts:
        return sweep
    images, rejected = (F.lit(x).cast("long") for x in tree.counts())
    return sweep.select("*", images.alias("images"), rejected.alias("rejected"))
