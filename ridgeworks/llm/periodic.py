"""Maximal periodic runs of words, found in overlapping tiles per octave of periods and stitched afterwards.

Octave Q holds the periods Q to 2Q - 1. A run of period q and four periods at least matches itself, moved by
q, over 3Q words or more, so two neighbouring blocks of Q words that begin at multiples of Q match as well.
Places where that is so are found with exact names of all windows of Q words (a pair of names of Q words
names 2Q words; windows that occur fewer than three times in a document can be in no run and get none). The
tiles around these places are rows of a table: each is solved alone, by Z-functions in both directions from
the boundary between the two blocks. What it finds are fragments of runs, cut at the tile's edges; they are
shuffled by document and period and stitched where they touch.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeworks.llm.common import slices, written

# a run has at least so many periods and so many words
PERIODS, SHORTEST = 4, 6
# words of a tile without its margins: so many blocks, and no fewer words than this
BLOCKS, CORE = 8, 1024
# bytes of text that are split into words at once
PIECE = 1 << 20
# comparisons of block names that are held at once
COMPARED = 1 << 21

_SPACE = b" \t\n\v\f\r"

_CUT = (
    "key long, doc_id long, n_words long, tiled boolean, text string, octave int, first long, "
    "ids array<int>, marks array<int>, periods array<int>"
)
_CUT_ARROW = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("tiled", pa.bool_())]
    + [("text", pa.string()), ("octave", pa.int32()), ("first", pa.int64())]
    + [(x, pa.list_(pa.int32())) for x in ("ids", "marks", "periods")]
)
RUNS = "array<struct<start: long, period: long, length: long>>"


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes that end at white space."""
    first = 0
    while len(text) - first > size:
        end = first + size
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[first:end]
        first = end
    yield text[first:]


def word_numbers(texts: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
    """Every text as numbers of its words, and the words by number; long texts are split in parts."""
    numbers: dict[bytes, int] = {}
    found = []
    for text in texts:
        parts = []
        for piece in pieces(text):
            words = piece.split()
            for word in set(words).difference(numbers):
                numbers[word] = len(numbers)
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        found.append(parts[0] if len(parts) == 1 else np.concatenate(parts))
    return found, list(numbers)


def _named(keys: np.ndarray) -> np.ndarray:
    """A number for every distinct key, -1 for keys that stand fewer than three times."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    names[counts[names] < 3] = -1
    return names


def _least_factors(limit: int) -> np.ndarray:
    """The least prime factor of every number below ``limit``."""
    least = np.arange(limit)
    for prime in range(2, int(limit**0.5) + 1):
        if least[prime] == prime:
            part = least[prime * prime :: prime]
            part[part == np.arange(prime * prime, limit, prime)] = prime
    return least


def _repeats_less(names: np.ndarray, places: np.ndarray, periods: np.ndarray, block: int) -> np.ndarray:
    """Whether the words from a block before each place to a block and a period after it have a period that
    divides the given one; then no run with that smallest period is there."""
    least = _least_factors(2 * block)
    rest, found = periods.copy(), np.zeros(len(periods), dtype=bool)
    while (rest > 1).any():
        some = np.flatnonzero((rest > 1) & ~found)
        if not len(some):
            break
        factor = least[rest[some]]
        small = periods[some] // factor
        last = block + periods[some] - small
        first = places[some] - block
        same = np.ones(len(some), dtype=bool)
        for step in (0 * last, 0 * last + block, np.minimum(2 * block, last), last):
            here = names[first + step]
            same &= (here >= 0) & (here == names[first + step + small])
        found[some] = same
        rest[some] //= factor
    return found


def boundaries(numbers: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(octave, places, periods): where two neighbouring blocks match what stands a period further on.

    Places count over all documents one after the other. No run is missed: every run of a period in the
    octave has such a place less than two blocks from its start, from its end, and from the next one.
    """
    sizes = np.array([len(x) for x in numbers], dtype=np.int64)
    total = int(sizes.sum())
    if not total:
        return
    words = np.concatenate(numbers).astype(np.int64)
    names = _named(np.repeat(np.arange(len(sizes)), sizes) * (int(words.max()) + 1) + words)
    block = 1
    while PERIODS * block <= sizes.max() and (names >= 0).any():
        padded = np.concatenate([names, np.full(2 * block, -1)])
        heads = names[::block]
        good = np.flatnonzero((heads[1:] >= 0) & (heads[:-1] >= 0)) + 1
        shifts = np.arange(block, 2 * block)
        step = max(1, COMPARED // block)
        for part in (good[i : i + step] for i in range(0, len(good), step)):
            reach = part[:, None] * block + shifts
            same = padded[reach] == heads[part][:, None]
            same &= padded[reach - block] == heads[part - 1][:, None]
            row, shift = np.nonzero(same)
            places, periods = part[row] * block, shift + block
            keep = ~_repeats_less(padded, places, periods, block)
            if keep.any():
                yield block, places[keep], periods[keep]
        where = np.flatnonzero(names[: total - block] >= 0) if block < total else np.zeros(0, dtype=np.int64)
        where = where[names[where + block] >= 0]
        wider = np.full(total, -1)
        if len(where):
            wider[where] = _named(names[where] * total + names[where + block])
        names, block = wider, 2 * block


def tiles(numbers: list[np.ndarray]) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(document, octave, first word, word numbers, boundaries, periods) of every tile that holds a boundary.

    A tile is a stretch of max(8Q, 1024) words with 2Q more before it and 4Q after it, so that what
    matches around a boundary overlaps with what the next tile sees of it.
    """
    starts = np.cumsum([0] + [len(x) for x in numbers])
    for block, places, periods in boundaries(numbers):
        core = max(BLOCKS * block, CORE)
        doc = np.searchsorted(starts, places, side="right") - 1
        local = places - starts[doc]
        cell = local // core
        cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(cell) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(places)], strict=True):
            own, low = int(doc[a]), int(cell[a]) * core
            first = max(0, low - 2 * block)
            ids = numbers[own][first : low + core + 4 * block]
            yield own, block, first, ids, local[a:b] - first, periods[a:b]


def z_function(words: list[int], limit: int) -> list[int]:
    """For each of the first ``limit`` places the number of words there that the beginning has as well."""
    n = len(words)
    z = [0] * min(limit, n)
    low = high = 0
    for i in range(1, len(z)):
        k = min(high - i, z[i - low]) if i < high else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        z[i] = k
        if i + k > high:
            low, high = i, i + k
    return z


def extents(words: list[int], place: int, block: int) -> tuple[list[int], list[int]]:
    """By period below 2Q: how many words before ``place``, and from it on, equal those a period later."""
    right = z_function(words[place:], 2 * block)
    before = words[place - 1 :: -1] if place else []
    ahead = words[: place + 2 * block][::-1]
    both = z_function([*before, -1, *ahead], len(before) + 1 + len(ahead))
    left = [0] * (2 * block)
    for period in range(1, min(2 * block, len(words) - place + 1)):
        left[period] = both[len(before) + 1 + len(ahead) - place - period]
    return left, right + [0] * (2 * block - len(right))


def _primes(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] * (n > 1)


def solve(words: list[int], block: int, places: list[int], periods: list[int]) -> list[tuple[int, int, int]]:
    """(period, first, end) of the stretches of a tile whose words equal those a period later.

    Only stretches over a boundary are listed, and only with their smallest period. The Z-functions see
    2Q words on either side, and twice as many as long as what they find ends where they do.
    """
    found, done, size = [], {}, len(words)
    for place, period in zip(places, periods, strict=True):
        if done.get(period, -1) > place:
            continue
        reach = 2 * block
        while True:
            low, high = max(0, place - reach), min(size, place + reach + 2 * block)
            left, right = extents(words[low:high], place - low, block)
            cut = (low > 0 and left[period] == place - low) or (
                high < size and place + period + right[period] == high
            )
            if not cut:
                break
            reach *= 2
        before, after = left[period], right[period]
        done[period] = place + after
        smaller = [period // p for p in _primes(period)]
        if not any(left[d] >= before and right[d] + d >= after + period for d in smaller):
            found.append((period, place - before, place + after))
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document, with its words, and one for every tile."""
    key = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for first, end in slices(texts):
            part = [x or b"" for x in texts.slice(first, end - first).cast(pa.binary()).to_pylist()]
            numbers, words = word_numbers(part)
            rows = [[] for _ in range(6)]
            held, tiled = 0, set()
            for own, block, start, numbered, places, periods in tiles(numbers):
                tiled.add(own)
                for column, value in zip(rows, (key + own, block, start, numbered, places, periods), strict=True):
                    column.append(value)
                held += len(numbered)
                if held > 1 << 20:
                    yield _tile_rows(rows)
                    rows, held = [[] for _ in range(6)], 0
            if rows[0]:
                yield _tile_rows(rows)
            joined = [b" ".join(map(words.__getitem__, x.tolist())) for x in numbers]
            count = len(part)
            columns = [
                pa.array(range(key, key + count), pa.int64()),
                ids.slice(first, count),
                pa.array([len(x) for x in numbers], pa.int64()),
                pa.array([i in tiled for i in range(count)], pa.bool_()),
                pa.array(joined, pa.binary()).cast(pa.string()),
            ]
            columns += [pa.nulls(count, x.type) for x in list(_CUT_ARROW)[5:]]
            yield pa.RecordBatch.from_arrays(columns, schema=_CUT_ARROW)
            key += count


def _tile_rows(rows: list[list]) -> pa.RecordBatch:
    keys, octaves, starts, *lists = rows
    count = len(keys)
    columns = [pa.array(keys, pa.int64()), *[pa.nulls(count, x.type) for x in list(_CUT_ARROW)[1:5]]]
    columns += [pa.array(octaves, pa.int32()), pa.array(starts, pa.int64())]
    for parts in lists:
        ends = np.cumsum([0] + [len(x) for x in parts], dtype=np.int32)
        columns.append(pa.ListArray.from_arrays(ends, np.concatenate(parts).astype(np.int32)))
    return pa.RecordBatch.from_arrays(columns, schema=_CUT_ARROW)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for i in range(batch.num_rows):
            key, block, first, *lists = (x[i].as_py() for x in batch.columns)
            found += [(key, period, first + a, first + b) for period, a, b in solve(lists[0], block, *lists[1:])]
        columns = list(zip(*found, strict=True)) or [()] * 4
        names = ["key", "period", "first", "end"]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)


def stitched(fragments: DataFrame) -> DataFrame:
    """(key, runs): the runs of each document by start, then period, from (key, period, first, end) fragments.

    Fragments of one document and period that touch or overlap are parts of one run.
    """
    before = Window.partitionBy("key", "period").orderBy("first", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") > reached, 1).otherwise(0)
    island = F.sum("opens").over(before.rowsBetween(Window.unboundedPreceding, 0))
    joined = (
        fragments.distinct()
        .withColumn("opens", opens)
        .withColumn("island", island)
        .groupBy("key", "period", "island")
        .agg(F.min("first").alias("start"), (F.max("end") - F.min("first") + F.col("period")).alias("length"))
    )
    long_enough = F.col("length") >= F.greatest(F.lit(SHORTEST), PERIODS * F.col("period"))
    run = F.struct("start", "period", "length")
    return joined.filter(long_enough).groupBy("key").agg(F.array_sort(F.collect_list(run)).alias("runs"))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that repeat those of a run's first period."""
    for batch in batches:
        made = []
        for text, runs in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if not runs:
                made.append(text)
                continue
            words = text.split(b" ")
            keep = np.ones(len(words), dtype=bool)
            for run in runs:
                keep[run["start"] + run["period"] : run["start"] + run["length"]] = False
            made.append(b" ".join(compress(words, keep.tolist())))
        columns = [*batch.columns[:2], pa.array(made, pa.binary()).cast(pa.string()), batch.column(3)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "collapsed", "runs"])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """(doc_id, n_words, collapsed, runs) of every row: its runs of words and its text without the repeats.

    Words are what ASCII white space separates, numbered from 0. A run (start, period, length) is a stretch
    of max(6, 4 x period) words or more with that smallest period, which no neighbouring word extends.
    ``collapsed`` holds the words, joined by single spaces, that no run contains after its first period.
    ``runs`` go by start, then period, and are empty where there are none. Null and empty texts have no
    words; null and repeated ids and repeated rows are rows of their own; an empty table gives an empty one.

    Documents are written once with their tiles. Only tiles, fragments and the texts that have tiles are
    shuffled; a very long document is as many tiles as its length asks for.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    cut = written(rows.mapInArrow(_cut, _CUT), "periodic-cut")
    tiled = cut.filter(F.col("octave").isNotNull())
    spread = tiled.select("key", "octave", "first", "ids", "marks", "periods")
    spread = spread.repartition("key", "octave", "first")
    fragments = spread.mapInArrow(_solved, "key long, period long, first long, end long")
    texts = cut.filter(F.col("octave").isNull())
    none = F.array().cast(RUNS).alias("runs")
    plain = texts.filter(~F.col("tiled")).select("doc_id", "n_words", F.col("text").alias("collapsed"), none)
    asked = texts.filter("tiled").join(stitched(fragments), "key", "left")
    asked = asked.select("doc_id", "n_words", "text", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
    schema = f"doc_id long, n_words long, collapsed string, runs {RUNS}"
    return plain.unionByName(asked.mapInArrow(_collapsed, schema))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the longest run, runs_sha256, collapsed_sha256."""
    longest = F.array_max(
        F.transform("runs", lambda x: F.struct(x["length"].alias("l"), (-x["start"]).alias("s"), (-x["period"]).alias("p")))
    )
    lines = F.transform(
        "runs",
        lambda x: F.concat(F.concat_ws(",", *[x[n].cast("string") for n in ("start", "length", "period")]), F.lit("\n")),
    )
    return found.select("*", longest.alias("longest")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.l").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(1000 * F.col("longest.l") / -F.col("longest.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def looped(doc_id: Column, text: Column) -> Column:
    """The text, for one document in ten (by crc32 of its id) with its words repeated from some word on.

    With h the crc32 of the id as text (a null id counts as the empty text) and g = h div 10, word i >= a of
    n becomes word a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    n = F.size(words).cast("long")
    g = F.floor(h / 10).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    times = F.ceil((n - a) / p).cast("int")
    block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), again), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)
