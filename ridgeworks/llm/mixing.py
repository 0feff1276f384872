"""Mixing sources to target weights in fixed-length blocks of words.

Every source's words are laid out on a line and cut into blocks. Output shards draw multinomial counts of
blocks from the sources; the slots of a source are mapped through a pseudorandom permutation of its block
numbers, and blocks meet the documents they cover by a join on (source, block).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ridgeworks.llm.common import LAST_ID, WORD, join_groups, whole, written

BLOCK = 256
SHARD = 65_536
SEED = 7
# rows of one source that are numbered in one group
GROUP = 4_000
# fixed values: weights of the sources in code point order, again from the first after the last
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_TIMES = 2.0


def word_count(text: Column) -> Column:
    """Number of words of a text, null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_times: float = MOST_TIMES,
) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size), one row per source.

    Sources are ranked by code point, null last. Targets are in proportion to the weights and add up to
    ``total_share`` of all sizes; one above ``most_times`` its source's size stops there and the excess
    goes to the others by weight, again and again. Each round is one aggregate of the source table.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    ranked = written(
        ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))), "sources"
    )
    cap = F.col("source_size") * most_times
    whole_size = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, known = 0.0, None
    while True:
        full = F.col("weight") * level >= cap
        stopped, rest, free = ranked.agg(
            F.sum(F.when(full, cap).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(~full, 1)),
        ).first()
        if not free or free == known:
            break
        level, known = (whole_size * total_share - stopped) / rest, free
    return ranked.select("source", "source_size", "rank", F.least(cap, F.col("weight") * level).alias("target"))


def lay_out(docs: DataFrame, ranks: DataFrame) -> DataFrame:
    """``docs`` (source, doc_id, text_key, size) with rank and ``start``, the words of its source before it.

    Rows alike in all four columns are counted first and laid out side by side, so a repeated row is one row
    until each copy gets its place. The others are dealt over hash groups of at most about GROUP by all of id,
    text and size: one id, or null, on many texts is many groups. Running totals are taken in each group and
    the groups' totals are added up, so no source is ever sorted in one task. The order is that of the hash of
    the id, then id, size and text, and therefore the same on every run.
    """
    groups = max(1, docs.count() // GROUP)
    alike = docs.groupBy("source", "doc_id", "text_key", "size").agg(F.count("*").alias("copies"))
    dealt = F.pmod(F.xxhash64("doc_id", "text_key", "size", F.lit(SEED)), F.lit(groups))
    placed = alike.select("*", dealt.alias("part"), (F.col("size") * F.col("copies")).alias("words"))
    parts = placed.groupBy("source", "part").agg(F.sum("words").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("part_size").over(before), F.lit(0)))
    named = ranks.select(F.col("source").alias("named"), "rank")
    parts = parts.join(named, F.col("source").eqNullSafe(F.col("named")))
    parts = parts.select("named", F.col("part").alias("dealt"), "ahead", "rank")
    within = (
        Window.partitionBy("source", "part")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "size", "text_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = placed.withColumn("inside", F.coalesce(F.sum("words").over(within), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("named")) & (F.col("part") == F.col("dealt"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    each = inside.join(parts, same).select("*", copy)
    start = F.col("ahead") + F.col("inside") + F.col("copy") * F.col("size")
    return each.select("doc_id", "text_key", "size", "rank", start.alias("start"))


def _dealt(random: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """How ``n`` slots fall on the sources: multinomial by the slots each has left, and never more."""
    taken = np.zeros_like(left)
    while n:
        rest = left - taken
        more = np.minimum(random.multinomial(n, rest / rest.sum()), rest)
        taken += more
        n -= int(more.sum())
    return taken


def shard_counts(slots: np.ndarray, shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, count) of every source in one output shard.

    The shards form a tree; at each node the slots on it are dealt to its two halves, by a generator
    that the node's place seeds. So every shard finds its own counts without the others', they add up
    to ``slots`` exactly, and a rerun draws the same.
    """
    first = np.zeros_like(slots)
    low, high = 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        total = int(slots.sum())
        part = _dealt(np.random.default_rng([seed, low, high]), slots, total * (middle - low) // (high - low))
        if shard < middle:
            slots, high = part, middle
        else:
            first, slots, low = first + part, slots - part, middle
    return first, slots


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of every index under a pseudorandom permutation of range(n): four Feistel rounds on the
    next even number of bits, applied again until the value is below n."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    found = index.astype(np.uint64)
    todo = np.arange(len(found))
    while len(todo):
        value = found[todo]
        left, right = value >> shift, value & mask
        for turn in range(4):
            mixed = right * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 0x100000001B3 + turn) % 2**64)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, left ^ (mixed & mask)
        found[todo] = left << shift | right
        todo = todo[found[todo] >= n]
    return found.astype(np.int64)


def draw_blocks(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, place, rank, block) of every slot of the mix.

    ``sources`` has rank, source_size and target. A source of m blocks gets the share of m that its target
    has in its size, rounded; slot j takes block j mod m of the permutation number j div m, so a block is
    taken at most once more than another. The closure carries two numbers per source.
    """
    spark = sources.sparkSession
    rows = sources.filter(F.col("source_size") > 0).orderBy("rank").select("rank", "source_size", "target").collect()
    ranks = np.array([x[0] for x in rows], dtype=np.int64)
    sizes = [-(-x[1] // block) for x in rows]
    slots = np.array([round(x[2] * m / x[1]) for x, m in zip(rows, sizes, strict=True)], dtype=np.int64)
    shards = max(1, -(-int(slots.sum()) // shard))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                first, counts = shard_counts(slots, shards, number, seed)
                who = np.repeat(np.arange(len(ranks)), counts)
                found = np.empty(len(who), dtype=np.int64)
                at = 0
                for i in np.flatnonzero(counts).tolist():
                    j = np.arange(first[i], first[i] + counts[i])
                    turn = j // sizes[i]
                    part = np.empty(len(j), dtype=np.int64)
                    for t in np.unique(turn).tolist():
                        own = turn == t
                        key = (seed * 1_000_003 + int(ranks[i])) * 1_009 + t
                        part[own] = permuted(j[own] % sizes[i], sizes[i], key)
                    found[at : at + len(j)] = part
                    at += len(j)
                order = np.random.default_rng([seed, number]).permutation(len(who))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(who), number)),
                        pa.array(np.arange(len(who))),
                        pa.array(ranks[who][order] if len(who) else np.zeros(0, np.int64)),
                        pa.array(found[order]),
                    ],
                    ["shard", "place", "rank", "block"],
                )

    numbers = spark.range(0, shards, numPartitions=min(shards, 20_000))
    return numbers.mapInArrow(run, "shard long, place long, rank long, block long")


class Mix:
    """A mix of all rows of ``docs`` by source, in blocks of ``block`` words.

    Sizes are word counts; null text has none, a null source is a source of its own (the last), repeated
    rows are laid out one after the other. Sources without words take no part, an empty table gives an
    empty mix. The same table gives the same mix on every run.
    """

    def __init__(
        self,
        docs: DataFrame,
        doc_id: str = "doc_id",
        text: str = "text",
        source: str = "source",
        block: int = BLOCK,
        weights: tuple[float, ...] = WEIGHTS,
        total_share: float = TOTAL_SHARE,
        most_times: float = MOST_TIMES,
        seed: int = SEED,
    ):
        self.docs, self.doc_id, self.text, self.source, self.block = docs, doc_id, text, source, block
        sized = written(
            docs.select(
                F.col(source).alias("source"),
                F.col(doc_id).cast("long").alias("doc_id"),
                F.xxhash64(text, source).alias("text_key"),
                word_count(F.col(text)).alias("size"),
            ),
            "sizes",
        )
        sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        self.sources = written(source_targets(sizes, weights, total_share, most_times), "targets")
        self.rows = written(lay_out(sized, self.sources), "layout")
        self.drawn = draw_blocks(self.sources, block, seed=seed)

    def times(self) -> DataFrame:
        """(rank, block, times) of every block that the mix takes.

        Blocks come of a few shard numbers, which is all that Spark knows of their size; without the hint it
        would broadcast what grows with the documents.
        """
        return self.drawn.groupBy("rank", "block").agg(F.count("*").alias("times")).hint("merge")

    def pieces(self) -> DataFrame:
        """Parts of documents in blocks: doc_id, text_key, rank, start, block, low, high (words of the row)."""
        start, end = F.col("start"), F.col("start") + F.col("size")
        first = F.call_function("div", start, F.lit(self.block).cast("long"))
        last = F.call_function("div", end - 1, F.lit(self.block).cast("long"))
        laid = self.rows.filter(F.col("size") > 0).select("*", F.explode(F.sequence(first, last)).alias("block"))
        return laid.select(
            "doc_id",
            "text_key",
            "rank",
            "start",
            "block",
            (F.greatest(start, F.col("block") * self.block) - start).alias("low"),
            (F.least(end, (F.col("block") + 1) * self.block) - start).alias("high"),
        )

    def blocks(self) -> DataFrame:
        """The mix itself: shard, place and the piece of a document that stands there."""
        return self.drawn.hint("merge").join(self.pieces(), ["rank", "block"])

    def taken(self) -> DataFrame:
        """doc_id, text_key, size, source_size, target and taken (words, repeats counted) of every row."""
        words = self.pieces().join(self.times(), ["rank", "block"])
        sums = words.groupBy("rank", "start", "doc_id").agg(
            F.sum((F.col("high") - F.col("low")) * F.col("times")).alias("taken")
        )
        sums = sums.select(F.col("rank").alias("at_rank"), F.col("start").alias("at_start"), "taken")
        same = [F.col("rank") == F.col("at_rank"), F.col("start") == F.col("at_start"), F.col("size") > 0]
        known = self.rows.join(sums, same, "left").select(
            "rank", "doc_id", "text_key", "size", F.coalesce("taken", F.lit(0)).alias("taken")
        )
        return known.join(self.sources, "rank").select(
            "doc_id", "text_key", "source", "size", "source_size", "target", "taken"
        )

    def texts(self) -> DataFrame:
        """The columns of ``docs``, one row for each stretch of words that the mix takes of a row.

        The text becomes the stretch, n_chars (where there is such a column) its length. A stretch taken
        twice comes twice. Neighbouring blocks of one copy stay together, so a row taken whole comes with
        its whole text; a row of which the mix takes nothing does not come.
        """
        words = self.pieces().join(self.times(), ["rank", "block"])
        lists = words.groupBy("doc_id", "text_key", "rank", "start").agg(
            F.array_sort(F.collect_list(F.struct("low", "high", "times"))).alias("parts")
        )
        id_key = F.coalesce("doc_id", F.lit(LAST_ID)).alias("id_key")
        lists = lists.select(id_key, "text_key", "start", "parts")
        copy = Window.partitionBy("id_key", "text_key")
        lists = lists.withColumn("copy", F.row_number().over(copy.orderBy("start"))).drop("start")
        rows = self.docs.select(
            whole(self.docs).alias("row"),
            F.col(self.text).alias("content"),
            F.coalesce(F.col(self.doc_id).cast("long"), F.lit(LAST_ID)).alias("id_key"),
            F.xxhash64(self.text, self.source).alias("text_key"),
        )
        rows = rows.withColumn("copy", F.row_number().over(copy.orderBy(F.xxhash64("row"))))
        cut = F.arrow_udf(_cut, "array<string>")
        joined = rows.join(lists, ["id_key", "text_key", "copy"])
        joined = joined.select("row", F.explode(cut("content", "parts")).alias("stretch"))
        return joined.select(
            *[
                F.col("stretch").alias(name)
                if name == self.text
                else F.length("stretch").cast(kind).alias(name)
                if name == "n_chars"
                else F.col(f"row.`{name}`").alias(name)
                for name, kind in self.docs.dtypes
            ]
        )


def stretches(text: str, parts: list[dict]) -> list[str]:
    """The stretches of a text that its parts (low, high, times; in order) make up, copy by copy."""
    starts = [x.start() for x in re.finditer(WORD, text)]
    starts[0] = 0
    starts.append(len(text))
    found = []
    for copy in range(1, max(x["times"] for x in parts) + 1):
        low = high = None
        for part in parts:
            if part["times"] < copy:
                continue
            if part["low"] != high:
                if high is not None:
                    found.append(text[starts[low] : starts[high]])
                low = part["low"]
            high = part["high"]
        found.append(text[starts[low] : starts[high]])
    return found


def _cut(contents: pa.Array, parts: pa.Array) -> pa.Array:
    both = zip(contents.to_pylist(), parts.to_pylist(), strict=True)
    return pa.array([stretches(text, part) for text, part in both], pa.list_(pa.string()))
