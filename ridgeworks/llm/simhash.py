"""Near-duplicates by SimHash: deletion-variant signatures of segments find fingerprints few bits apart.

A fingerprint is cut into just so many segments that one of them differs by at most one bit in any
pair within the distance. Every segment is indexed under its one-wildcard variants (the segment with
one bit blanked); two fingerprints that share a variant are candidates and are verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeworks.llm.common import LAST_ID, join_groups, keep_winners, raw_texts, whole, written
from ridgeworks.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# a variant that more fingerprints share is searched through common neighbours, not by pairs
CROWD = 32


def fingerprint(text: bytes, words: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a UTF-8 text: bit i is set if it is set in over half the shingle hashes.

    A-Z are lower-cased, words are what ASCII white space separates, a shingle is ``words`` words
    joined by spaces, repeats included. A shorter text is one shingle, a text without words gives 0.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(parts) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp long) of every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, words) for x in raw_texts(batch.column(2))], dtype=np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])

    asked = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text")
    )
    return asked.mapInArrow(run, "doc_id long, text_key long, fp long")


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): one row per segment and blanked bit; the key holds the segment, the bit and the rest."""
    count = max_bits // 2 + 1
    width = 64 // count
    rows = []
    for segment in range(count):
        low = segment * width
        size = width if segment < count - 1 else 64 - low
        mask = F.lit((1 << size) - 1 if size < 64 else -1).cast("long")
        value = F.shiftrightunsigned(F.col("fp"), low).bitwiseAND(mask)
        rows += [
            F.xxhash64(
                F.lit(segment), F.lit(bit), value.bitwiseAND(F.lit(~(1 << bit) if bit < 63 else LAST_ID).cast("long"))
            )
            if size > 58
            else value.bitwiseAND(F.lit(~(1 << bit)).cast("long"))
            + F.lit((segment * size + bit) << size).cast("long")
            for bit in range(size)
        ]
    return fps.select("fp", F.explode(F.array(*rows)).alias("key"))


def _near(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def links(fps: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Edges (u, v) between distinct fingerprints; their closure is that of all links.

    ``fps`` has distinct long values fp. Variants shared by 2 to ``crowd`` fingerprints are joined and
    verified: at most ``crowd`` candidates per row. A variant that more of them share would give
    pairs with the square of their number; its members are listed under themselves and under each
    value one bit away instead (65 rows each). Two of them within two bits always meet under such a
    value, and all that meet there are within two bits, so each is linked to the least one. That is
    exact too, and linear in the size of the crowd.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("max_bits must be 0, 1 or 2: the way for crowded variants holds up to two bits")
    if max_bits == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    crowd = max(crowd, 2)  # within one bit a variant is the whole value but a bit: two share it at most
    indexed = variants(fps, max_bits)
    counts = written(
        indexed.groupBy("key").agg(F.count("*").alias("members")).filter(F.col("members") > 1), "variants"
    )
    total = counts.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    shared = written(join_groups(indexed, counts, "key", "members", total), "shared-variants")
    few = shared.filter(F.col("members") <= crowd)
    left, right = few.select("key", F.col("fp").alias("u")), few.select("key", F.col("fp").alias("v"))
    pairs = left.join(right, "key").filter((F.col("u") < F.col("v")) & _near(F.col("u"), F.col("v"), max_bits))
    crowded = shared.filter(F.col("members") > crowd).select("fp").distinct()
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_bit(i))) for i in range(64)])
    met = crowded.select("fp", F.explode(around).alias("value"))
    least = met.groupBy("value").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = least.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v"))
    return pairs.select("u", "v").unionByName(stars.filter(F.col("u") != F.col("v"))).distinct()


def _bit(i: int) -> int:
    return 1 << i if i < 63 else -(1 << 63)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(doc_id, text_key, fp long, component_id) of every row of ``docs``.

    ``component_id`` is the least doc_id reachable through links of at most ``max_bits`` differing
    bits, the row's own included; null ids are passed over, a component of null ids has a null one.
    Rows without words have fingerprint 0 and are linked like any other. Repeated rows give repeated
    rows, an empty table an empty result.
    """
    return placed_rows(docs, doc_id, text, words, max_bits).select("doc_id", "text_key", "fp", "component_id")


def placed_rows(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``near_duplicates`` with root, the fingerprint that stands for the component, one for each."""
    made = written(fingerprints(docs, doc_id, text, words), "fingerprints")
    by_fp = written(
        made.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies")),
        "distinct-fingerprints",
    )
    stars = written(components(links(by_fp.select("fp"), max_bits)), "components")
    roots = stars.select(F.col("root").alias("node"), "root").distinct()
    linked = written(
        by_fp.join(stars.unionByName(roots).withColumnRenamed("node", "fp"), "fp"), "linked-fingerprints"
    )
    groups = linked.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("members"))
    placed = join_groups(linked, groups, "root", "members", linked.count())
    placed = placed.select("fp", "copies", "root", "component_id")
    alone = by_fp.join(linked.select("fp"), "fp", "left_anti")
    alone = alone.select("fp", "copies", F.col("fp").alias("root"), F.col("least_id").alias("component_id"))
    classes = written(placed.unionByName(alone), "fingerprint-classes")
    joined = join_groups(made, classes, "fp", "copies", made.count())
    return joined.select("doc_id", "text_key", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the least id of their component, one row each, all columns.

    Components are told apart by their root: ids may be null in many of them, or stand in several.
    """
    found = placed_rows(docs, doc_id, text, **options)
    id_key = F.coalesce("doc_id", F.lit(LAST_ID))
    best = F.min(F.struct(id_key.alias("id_key"), "text_key")).alias("best")
    winners = found.groupBy("root").agg(best).select("best.*")
    rows = docs.select(
        whole(docs).alias("row"),
        F.xxhash64(text).alias("text_key"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("id_key"),
    )
    return keep_winners(rows, winners, ["id_key", "text_key"])
