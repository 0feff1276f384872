"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeworks.session import shared_path

# fixed values: what the contracts call white space, as a pattern of Java and Python
WORD = r"[^\x20\x09-\x0D]+"

LAST_ID = 2**63 - 1


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` run once, kept as Parquet in the shared checkpoint folder and read back.

    A lost executor costs the tasks that read the table, never the work that made it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hand memory that a Python worker has freed back to the system: between tasks it stays alive beside
    whatever the executor does next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def whole(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that no helper column can clash with them."""
    return F.struct(*[df[f"`{name}`"] for name in df.columns])


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text of an Arrow column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: pa.Array, limit: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows with about ``limit`` bytes of text, so that memory is bounded."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        reach = limit + (int(ends[first - 1]) if first else 0)
        end = max(first + 1, int(np.searchsorted(ends, reach, side="right")))
        yield first, end
        first = end


def split_rows(table: np.ndarray) -> list[bytes]:
    """The bytes of every row."""
    data, width = table.tobytes(), table.shape[1] * table.itemsize
    return [data[i : i + width] for i in range(0, len(data), width)]


class Bags:
    """Words of many texts: the different ones, and for each text their places, one after the other."""

    def __init__(self, texts: list[list[str]]):
        self.words = list(set().union(*texts))
        place = dict(zip(self.words, range(len(self.words)), strict=True))
        self.lengths = np.array([len(x) for x in texts], dtype=np.int64)
        self.places = np.fromiter(
            map(place.__getitem__, chain.from_iterable(texts)), np.int64, int(self.lengths.sum())
        )
        self.full = np.flatnonzero(self.lengths)
        self.starts = (np.cumsum(self.lengths) - self.lengths)[self.full]


class Memory:
    """What a Python worker remembers of what it worked out, for about two times ``size`` keys at most.

    When it is full it becomes the older half and starts afresh; what is asked for again moves over.
    """

    def __init__(self, size: int, longest: int = 64):
        self.size, self.longest = size, longest
        self.recent: dict = {}
        self.older: dict = {}

    def look_up(self, keys, find) -> dict:
        """Key -> value for all ``keys``; ``find`` gives the values of a list of keys not known."""
        recent, older = self.recent, self.older
        found, new = {}, []
        for key in keys:
            value = recent.get(key)
            if value is None:
                value = older.get(key)
            if value is None:
                new.append(key)
            else:
                found[key] = value
        if new:
            found.update(zip(new, find(new), strict=True))
        if len(recent) >= self.size:
            self.older, self.recent = recent, {}
        self.recent.update(found)
        for key in new:
            if len(key) > self.longest:
                del self.recent[key]
        return found


# groups of a join that are broadcast whole; above it only the largest are
FEW_GROUPS = 200_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per ``key`` when a key may hold a third of all rows.

    ``size`` of ``groups`` is the number of rows of the key and ``total`` their sum. Up to FEW_GROUPS
    groups, counted first, are broadcast. Beyond that both sides are shuffled, but for the fewer than
    1000 keys that hold more than a thousandth of the rows each: those are broadcast and their rows never
    shuffle; no other key is large enough to weigh on a task. The result is the same either way.
    """
    if groups.count() <= FEW_GROUPS:
        return rows.join(F.broadcast(groups), key)
    hot = F.col(size) * 1000 > total
    few = F.broadcast(groups.filter(hot))
    cold = rows.join(F.broadcast(groups.filter(hot).select(key)), key, "left_anti")
    return rows.join(few, key).unionByName(cold.join(groups.filter(~hot), key))


def keep_winners(rows: DataFrame, winners: DataFrame, keys: list[str]) -> DataFrame:
    """The ``row`` struct of one row for every row of ``winners``; repeated rows come down to one.

    ``keys`` holds the document id, so that no key has more rows than a document is repeated.
    """
    chosen = rows.join(winners.select(*keys).distinct(), keys, "left_semi")
    first = F.min_by("row", F.xxhash64("row")).alias("row")
    return chosen.groupBy(*keys).agg(first).select("row.*")


def identifier(name: str) -> str:
    return re.sub(r"\W", "_", name)
