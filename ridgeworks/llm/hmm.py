"""Hidden Markov language model: Baum-Welch counts summed over partitions, exact scaled forward scores.

Every text is a sequence of tokens: its words with A-Z in lower case, then one end. A word of at least
1 / SHARE of all training tokens is a symbol of its own (so there are at most SHARE of them), all others
share one symbol; which of them it is has the probability of its smoothed corpus count, the same in
every state. Counts of words cover the whole corpus and live in a table; rare words of a text meet
their counts by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeworks.llm.common import raw_texts, slices, written

STATES = 8
# passes over all training texts
ITERATIONS = 5
SHARE = 500_000
# tokens worked on at once in a task
BLOCK = 400_000
# different words a task counts before it hands them on
FLUSH = 400_000
# what the unigram adds to every state's counts, in tokens for each symbol
PRIOR = 1.0
# no word holds white space
END = b"\n"


def tokens(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text between ASCII white space, A-Z in lower case, then the end."""
    found = text.lower().split()
    found.append(END)
    return found


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, c long) over all rows of the one column of ``texts``; counted in tasks first."""

    def rows(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in raw_texts(batch.column(0)):
                seen.update(tokens(text))
                if len(seen) >= FLUSH:
                    yield rows(seen)
                    seen = Counter()
        yield rows(seen)

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Packed:
    """Sequences of symbols, the longest first, laid out step by step for work on all at once."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(x) for x in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.steps = int(lengths[0])
        self.active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(self.steps), side="right")
        self.offsets = np.concatenate([[0], np.cumsum(self.active)])
        self.who = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(self.who)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = self.offsets[step] + self.who
        self.symbols = np.empty(len(place), dtype=np.int64)
        self.symbols[place] = np.concatenate([sequences[i] for i in self.order])
        self.doc = np.empty_like(place)
        self.doc[place] = self.who
        self.cuts = self.offsets.tolist()

    def forward(self, start, move, emit):
        """Scaled forward variables, their scales, and log10 of every sequence's probability."""
        alpha = emit[self.symbols]
        scale = np.empty(len(alpha), alpha.dtype)
        for step in range(self.steps):
            a, b = self.cuts[step], self.cuts[step + 1]
            now = alpha[a:b]
            if step:
                now *= alpha[before : before + b - a] @ move
            else:
                now *= start
            total = now.sum(axis=1)
            scale[a:b] = total
            now /= total[:, None]
            before = a
        logs = np.bincount(self.doc, np.log10(scale.astype(float)), minlength=len(self.order))
        found = np.empty(len(logs))
        found[self.order] = logs
        return alpha, scale, found

    def expected(self, start, move, emit):
        """Expected counts of first states, of moves, and of (symbol, state)."""
        alpha, scale, _ = self.forward(start, move, emit)
        beta = np.ones_like(alpha)
        later = emit[self.symbols] / scale[:, None]
        back = np.ascontiguousarray(move.T)
        for step in range(self.steps - 1, 0, -1):
            a, b = self.cuts[step], self.cuts[step + 1]
            later[a:b] *= beta[a:b]
            before = self.cuts[step - 1]
            beta[before : before + b - a] = later[a:b] @ back
        later[: self.cuts[1]] = 0
        first = self.cuts[1]
        step = np.repeat(np.arange(1, self.steps), self.active[1:])
        previous = self.offsets[step - 1] + self.doc[first:]
        moves = (alpha[previous].T @ later[first:]) * move
        alpha *= beta
        found = alpha[:first].sum(axis=0)
        shares = np.ascontiguousarray(alpha.T)
        counts = np.stack([np.bincount(self.symbols, x, minlength=len(emit)) for x in shares], axis=1)
        return found, moves, counts


def blocks(sequences: list[np.ndarray], limit: int = BLOCK) -> Iterator[list[int]]:
    """Places of sequences of like length, about ``limit`` tokens at a time."""
    held, size = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: len(sequences[i])):
        held.append(i)
        size += len(sequences[i])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def improved(start, move, counts, unigram):
    """Probabilities from expected counts, the unigram and a little of everything added."""
    start, move = start + 0.1, move + 0.1
    counts = counts + PRIOR * len(unigram) * unigram[:, None]
    return start / start.sum(), move / move.sum(axis=1, keepdims=True), counts / counts.sum(axis=0)


def starting_point(unigram: np.ndarray, states: int = STATES):
    """A fixed random point about the unigram of the whole corpus; no text is read for it."""
    emit = unigram[:, None] * np.random.default_rng(0).gamma(1.0, 1.0, (len(unigram), states))
    return (
        np.full(states, 1 / states),
        np.full((states, states), 0.02 / states) + 0.98 * np.eye(states),
        emit / emit.sum(axis=0),
    )


class HiddenMarkov:
    """Fitted on the rows of ``docs`` that are not ``held_out``; scores all of them.

    Counts of all words come first. Then every text is written once as its symbols, with its rare words
    beside them. ``iterations`` passes of Baum-Welch, from a fixed random point, go over all training texts:
    each task adds up its expected counts and ships one row per symbol it met. A null text is empty: only its
    end is a token. Without training texts every text has probability one.
    """

    def __init__(
        self,
        docs: DataFrame,
        held_out: Column,
        doc_id: str = "doc_id",
        text: str = "text",
        states: int = STATES,
        iterations: int = ITERATIONS,
    ):
        self.states = states
        asked = docs.select(
            F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text")
        )
        self.counts = written(word_counts(asked.filter(~F.col("held_out")).select("text")), "word-counts")
        c = F.col("c")
        n, v = self.counts.agg(F.coalesce(F.sum(c), F.lit(0)), F.count("*")).first()
        self.n, self.v = n, v
        often = self.counts.filter(c * SHARE >= n).orderBy(c.desc(), "word").toArrow().to_pydict()
        held = np.array(often["c"], dtype=np.int64)
        self.rest_n, self.rest_v = n - int(held.sum()), v - len(held)
        # the most frequent words have the smallest symbols, which are stored in the fewest bits
        self.often = dict(zip(often["word"], range(1, len(held) + 1), strict=True))
        self.often_counts = np.concatenate([[0], held])
        unigram = np.concatenate([[self.rest_n + 1.0], held + 1.0])
        unigram /= unigram.sum()

        self.rows = written(self._encoded(asked), "hmm-rows")
        training = self.rows.filter(~F.col("held_out")).select("symbols")
        self.model = starting_point(unigram, states)
        for _ in range(iterations if n else 0):
            self.model = self._pass(training, unigram)

    def _encoded(self, asked: DataFrame) -> DataFrame:
        """Every row with its symbols (little-endian 32-bit integers) and its rare words.

        A row is told from others by the task and place it was read at; the table is written once.
        """
        shared = asked.sparkSession.sparkContext.broadcast((self.often, self.often_counts))
        under = math.log10(self.n + self.v + 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            often, counts = shared.value
            logs = np.log10(counts + 1.0) - under
            get = often.get
            row = TaskContext.get().partitionId() << 34
            for batch in (x.slice(a, b - a) for x in batches for a, b in slices(x.column(2))):
                symbols, rare = [], []
                for text in raw_texts(batch.column(2)):
                    words = tokens(text)
                    found = np.array([get(x, 0) for x in words], dtype="<u4")
                    symbols.append(found)
                    own = Counter([words[i] for i in np.flatnonzero(found == 0).tolist()])
                    rare.append([{"word": w, "n": n} for w, n in own.items()])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(symbols))),
                        batch.column(0),
                        batch.column(1),
                        pa.array([len(x) for x in symbols], pa.int64()),
                        pa.array([int(np.count_nonzero(x)) for x in symbols], pa.int64()),
                        pa.array([float(logs[x[x > 0]].sum()) for x in symbols], pa.float64()),
                        pa.array([x.tobytes() for x in symbols], pa.binary()),
                        pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "base", "symbols", "rare"],
                )
                row += len(symbols)

        schema = (
            "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, symbols binary, "
            "rare array<struct<word: binary, n: long>>"
        )
        return asked.mapInArrow(run, schema)

    def _pass(self, training: DataFrame, unigram: np.ndarray):
        """One step of Baum-Welch over all training texts."""
        shared = training.sparkSession.sparkContext.broadcast([x.astype(np.float32) for x in self.model])
        states = self.states
        columns = [f"s{k}" for k in range(states)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            sums = [np.zeros(states), np.zeros((states, states)), np.zeros((len(model[2]), states))]
            for batch in (x.slice(a, b - a) for x in batches for a, b in slices(x.column(0), 32 << 20)):
                found = sequences_of(batch.column(0))
                for part in blocks(found):
                    for total, own in zip(sums, Packed([found[i] for i in part]).expected(*model), strict=True):
                        total += own
            met = np.flatnonzero(sums[2].sum(axis=1))
            ids = np.concatenate([[-1 - states], -1 - np.arange(states), met])
            rows = np.concatenate([sums[0][None, :], sums[1], sums[2][met]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *[pa.array(rows[:, k].copy()) for k in range(states)]],
                ["symbol", *columns],
            )

        schema = "symbol long, " + ", ".join(f"{x} double" for x in columns)
        sums = training.mapInArrow(run, schema).groupBy("symbol").agg(*[F.sum(x).alias(x) for x in columns])
        found = sums.toArrow().to_pydict()
        ids = np.array(found["symbol"], dtype=np.int64)
        rows = np.array([found[x] for x in columns], dtype=float).reshape(states, -1).T
        counts, move = np.zeros((len(unigram), states)), np.zeros((states, states))
        counts[ids[ids >= 0]] = rows[ids >= 0]
        moves = (ids < 0) & (ids >= -states)
        move[-1 - ids[moves]] = rows[moves]
        return improved(rows[ids == -1 - states].sum(axis=0), move, counts, unigram)

    def scores(self) -> DataFrame:
        """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

        ``score`` is log10 of the model's probability of the token sequence, ``base_score`` that of
        the add-one unigram. Rare words go to their counts by a join and are added to their own row again.
        """
        shared = self.rows.sparkSession.sparkContext.broadcast(self.model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in (x.slice(a, b - a) for x in batches for a, b in slices(x.column(6), 32 << 20)):
                found = sequences_of(batch.column(6))
                score = np.empty(len(found))
                for part in blocks(found):
                    score[part] = Packed([found[i] for i in part]).forward(*model)[2]
                yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(score)], [*held, "score"])

        held = ["row", "doc_id", "held_out", "n_tokens", "known", "base"]
        schema = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double"
        scored = self.rows.select(*held, "symbols").mapInArrow(run, schema)
        c = F.coalesce("c", F.lit(0))
        rare = self.rows.select("row", F.inline("rare")).join(self.counts, "word", "left")
        under, rest_under = math.log10(self.n + self.v + 1), math.log10(self.rest_n + self.rest_v + 1)
        sums = rare.groupBy("row").agg(
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"),
            F.sum(F.col("n") * (F.log10(c + 1.0) - under)).alias("rare_base"),
            F.sum(F.col("n") * (F.log10(c + 1.0) - rest_under)).alias("rare_score"),
        )
        return scored.join(sums, "row", "left").select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(self.n).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
        )


def sequences_of(column: pa.Array) -> list[np.ndarray]:
    """Symbols of every text of a binary column."""
    return [np.frombuffer(x, dtype="<u4") for x in column.to_pylist()]
