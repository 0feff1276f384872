"""A Merkle manifest of a dataset: a tree of digests per source, a tree over the sources, and proofs for all rows.

Only every few levels are stored, as aligned subtrees: one row holds the at most ``ARITY ** STEPS``
neighbouring nodes below one node of the next stored level. Building hashes each subtree up to its top and
forgets what lies between. A proof needs that again, so extraction goes from the root down: each stored
subtree meets the path of its top, the levels between are hashed anew, the siblings of every stored node are
emitted, and the levels are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeworks.llm.common import written

# children of a node, and levels from one stored level to the next
ARITY, STEPS = 3, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<before: string, after: string>>"
_PATHS = pa.list_(pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))


def leaf_digest(values: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the values one after the other: ``-`` for null, else byte count, ``:``, value."""
    texts = [x.cast("string") for x in values]
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(
        path, leaf, lambda done, step: F.sha2(F.concat(step["before"], done, step["after"]).cast("binary"), 256)
    )


def siblings(path: Column) -> Column:
    """All siblings of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def above(digests: list[str]) -> list[str]:
    """The next level: every run of ARITY neighbours, the last one maybe shorter, becomes one digest."""
    return [sha256("".join(digests[i : i + ARITY]).encode()).hexdigest() for i in range(0, len(digests), ARITY)]


def subtree_paths(digests: list[str], levels: int) -> list[list[dict]]:
    """For every node of an aligned subtree its siblings on ``levels`` levels, as texts before and after."""
    found: list[list[dict]] = [[] for _ in digests]
    width = 1
    for _ in range(levels):
        sides = []
        for first in range(0, len(digests), ARITY):
            run = digests[first : first + ARITY]
            sides += [dict(before="".join(run[:i]), after="".join(run[i + 1 :])) for i in range(len(run))]
        for i, path in enumerate(found):
            path.append(sides[i // width])
        digests, width = above(digests), width * ARITY
    return found


def _digests(batch: pa.RecordBatch) -> Iterator[tuple[list[str], int]]:
    """The digests of each subtree of a batch and its number of levels."""
    nodes = batch.column(batch.schema.get_field_index("nodes"))
    every = nodes.flatten().field("digest").to_pylist()
    first = 0
    levels = batch.column(batch.schema.get_field_index("levels")).to_pylist()
    for size, level in zip(nodes.value_lengths().to_pylist(), levels, strict=True):
        yield every[first : first + size], level
        first += size


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tops = []
        for digests, levels in _digests(batch):
            for _ in range(levels):
                digests = above(digests)
            tops += digests
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(batch.schema.get_field_index(x)) for x in ("tree", "block", "after")], pa.array(tops, pa.string())],
            ["tree", "idx", "total", "digest"],
        )


def _regenerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [subtree_paths(digests, levels) for digests, levels in _digests(batch)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, _PATHS)], [*batch.schema.names, "own"])


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with idx, their number from 0 within their ``tree``, and total, the rows of that tree; and the
    largest total.

    Rows are range-partitioned by tree, order and place, so that neither a tree with a third of all rows
    nor a row repeated that often weighs on one task; places within a part count on from those before it.
    """
    keys = ["tree", *order, "salt"]
    sorted_rows = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*keys)
    placed = sorted_rows.sortWithinPartitions(*keys).drop("salt").withColumn("place", F.monotonically_increasing_id())
    placed = written(placed.withColumn("part", F.shiftright("place", 33)), "merkle-order")
    parts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")
    earlier = F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = F.coalesce(earlier, F.lit(0)) - F.col("first")
    offsets = parts.select("tree", "part", shift.alias("shift"), F.sum("size").over(tree).alias("total"))
    offsets = written(offsets, "merkle-offsets")
    most = offsets.agg(F.max("total")).first()[0] or 0
    joined = placed.join(offsets, ["tree", "part"]).withColumn("idx", F.col("place") + F.col("shift"))
    return joined.drop("place", "part", "shift"), most


class Forest:
    """Trees of digests. ``rows`` has tree binary, digest string, the columns of ``order`` and any others.

    ``bands`` are the stored levels from the leaves up, one row per aligned subtree; ``roots`` has
    (tree, band, digest), where ``band`` is the last stored level below the root.
    """

    def __init__(self, rows: DataFrame, order: list[str], steps: int = STEPS):
        self.steps = steps
        nodes, most = numbered(rows, order)
        self.bands: list[DataFrame] = []
        roots = []
        while True:
            self.bands.append(written(self._subtrees(nodes), "merkle-level"))
            columns = self.bands[-1].select("tree", "block", "after", "levels", "nodes")
            schema = "tree binary, idx long, total long, digest string"
            nodes = written(columns.mapInArrow(_climb, schema), "merkle-tops")
            done = nodes.filter("total = 1").select("tree", F.lit(len(self.bands) - 1).alias("band"), "digest")
            roots.append(done)
            nodes = nodes.filter("total > 1")
            most = -(-most // ARITY**steps)
            if most <= 1:
                break
        self.roots = reduce(DataFrame.unionByName, roots)

    def _subtrees(self, nodes: DataFrame) -> DataFrame:
        """(tree, block, levels, after, nodes): neighbours with one common node ``levels`` levels up, and the
        number of nodes of the tree on that level."""
        width = ARITY**self.steps
        held = F.struct("idx", *[x for x in nodes.columns if x not in ("tree", "idx", "total")])
        grouped = nodes.groupBy("tree", F.floor(F.col("idx") / width).cast("long").alias("block"), "total").agg(
            F.sort_array(F.collect_list(held)).alias("nodes")
        )
        few = F.lit(0)  # levels: 0 for one node, 1 up to ARITY, 2 up to ARITY squared ...
        for level in range(1, self.steps + 1):
            few = F.when(F.col("total") > ARITY ** (level - 1), level).otherwise(few)
        after = F.ceil(F.col("total") / width).cast("long")
        return grouped.select("tree", "block", few.cast("int").alias("levels"), after.alias("after"), "nodes")

    def paths(self, tops: DataFrame) -> DataFrame:
        """Every leaf with its path: (tree, path, the other columns of ``tops`` and those of its row).

        ``tops`` has (tree, band, path) of every root, the path being what lies above it, and columns that go
        down to all leaves of its tree.
        """
        out = None
        down = [x for x in tops.columns if x != "band"]
        for band in range(len(self.bands) - 1, -1, -1):
            given = tops.filter(F.col("band") == band).select(*down, F.lit(0).cast("long").alias("block"))
            if out is not None:
                given = given.unionByName(out.withColumnRenamed("idx", "block"))
            met = self.bands[band].join(given, ["tree", "block"]).select(*down, "levels", "nodes")
            schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in met.schema) + f", own array<{PATH}>"
            both = met.mapInArrow(_regenerate, schema)
            both = both.select(*down, F.explode(F.arrays_zip("nodes", "own")).alias("x"))
            kept = [F.concat("x.own", "path").alias("path") if x == "path" else F.col(x) for x in down]
            out = both.select(*kept, "x.nodes.*" if band == 0 else "x.nodes.idx")
            if band:
                out = written(out, "merkle-paths")
        return out


class Manifest:
    """Digests of all rows of a dataset, a root per source and one root over all.

    A row's leaf is ``leaf_digest`` of ``fields``. Leaves of a source ascend by ``order`` (null first, equal
    ones by leaf; repeated rows are leaves of their own, in any order, as they are alike); sources ascend by
    their UTF-8 bytes, null first and apart from the empty one. Texts of any length are one leaf; columns
    other than ``fields`` do not matter, whatever their names. A table without rows has no root and no
    proofs. ``carry`` gives columns that go with the leaves to their proofs.
    """

    def __init__(
        self,
        docs: DataFrame,
        fields: tuple[str, ...] = FIELDS,
        source: str = "source",
        order: str = "doc_id",
        carry: dict[str, Column] | None = None,
        steps: int = STEPS,
    ):
        key = F.col(source).cast("string").cast("binary")
        tree = F.when(key.isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"\x01"), key))
        leaf = leaf_digest([F.col(f"`{x}`") for x in fields])
        held = [x.alias(f"carry_{name}") for name, x in (carry or {}).items()]
        self.carried = {f"carry_{name}": name for name in carry or {}}
        ordered = F.col(order).cast("long").alias("id")
        leaves = written(docs.select(tree.alias("tree"), ordered, leaf.alias("digest"), *held), "merkle-leaves")
        self.sources = Forest(leaves, ["id", "digest"], steps)
        self._subroots = written(self.sources.roots, "merkle-subroots")
        own = self._subroots.select(F.lit(b"").alias("tree"), F.col("tree").alias("own"), "digest", "band")
        self.top = Forest(own.withColumnRenamed("band", "own_band"), ["own"], steps)
        self._root = written(self.top.roots, "merkle-root")

    @staticmethod
    def _source(tree: str) -> Column:
        return F.when(F.octet_length(tree) > 0, F.expr(f"substring({tree}, 2)").cast("string")).alias("source")

    def root(self) -> DataFrame:
        """(root), one row unless the dataset is empty."""
        return self._root.select(F.col("digest").alias("root"))

    def subroots(self) -> DataFrame:
        """(source, subroot) of every source."""
        return self._subroots.select(self._source("tree"), F.col("digest").alias("subroot"))

    def proofs(self) -> DataFrame:
        """(id, source, idx, leaf, subroot, root, path, and the carried columns) of every row.

        ``idx`` is the leaf's number in its source; ``path`` has for every level, up to the root over all
        sources, the texts of the sibling digests before and after the node. ``fold(leaf, path)`` is the root.
        """
        start = self._root.select("tree", "band", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
        over = self.top.paths(start)
        tops = over.select(
            F.col("own").alias("tree"),
            F.col("own_band").alias("band"),
            "path",
            F.col("digest").alias("subroot"),
            "root",
        )
        carried = [F.col(held).alias(name) for held, name in self.carried.items()]
        leaf = F.col("digest").alias("leaf")
        found = self.sources.paths(written(tops, "merkle-sources"))
        return found.select("id", self._source("tree"), "idx", leaf, "subroot", "root", "path", *carried)
