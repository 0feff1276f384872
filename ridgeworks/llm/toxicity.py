"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

A word is the hashed embedding of itself and the mean of those of its n-grams. Filters of several widths run
over the words of the whole text, each keeps its highest response (so one phrase in a long text is enough), and
a logistic layer weighs them. The filters of one word start on different groups of words: a text in which many
groups respond has several suspect words, however long it is. The score is shifted, language by language, so
that the threshold which parts the labelled rows best lies at 0.7. The language is one that a model reads from
the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeworks.llm.common import Bags, give_back, slices, written
from ridgeworks.llm.langid import NO_LANGUAGE, LanguageModel, WordScorer, best_language, most_likely, summed, words_of

# labelled rows of either label that the classifier is fitted on, expected number; chosen by hash
SAMPLE_ROWS = 3000
# hash buckets of words; those of n-grams follow
WORDS = 1 << 18
BUCKETS = WORDS + (1 << 17)
# words are dealt to this many groups, each with a dimension and a filter of its own; one dimension is for n-grams
GROUPS = 15
WIDTH = GROUPS + 1
# filters of each width in words
FILTERS = {1: WIDTH, 2: 4, 3: 4}
GRAMS = (4, 5)
# an odd number near 2^64 over the golden ratio
MULTIPLIER = 0x9E3779B97F4A7C15
EPOCHS = 2
BATCH = 64
RATE = 0.02
# texts that a bucket's log odds count as seen before, at the usual rate
EVIDENCE = 10.0
THRESHOLD = 0.7
# labelled rows of either label that a language needs for a threshold of its own
FEWEST = 15
# logits of rows outside the sample are counted in steps of this, up to a limit
STEP = 1 / 256
LIMIT = 60.0
# parts of the labelled rows; the thresholds of each come from a network that has not seen it
PARTS = 3
# words whose scores a Python worker remembers
CACHE = 250_000
# letters of the longest word that is remembered
LONGEST = 64
# bytes of text that are cut into words and scored at once
SLICE = 2 << 20
# the embeddings come to the driver and go to the tasks in half precision: 12 MB whatever the corpus
STORED = np.float16


class Features:
    """Hash buckets of a list of words, one after the other: of the word, then of its n-grams of bytes.

    The edges of a word are marked. An n-gram is read as a number and hashed by multiplication.
    """

    def __init__(self, words: list[str]):
        raw = [f"<{word}>".encode() for word in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        firsts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        grams = {n: np.maximum(sizes - n + 1, 0) for n in GRAMS}
        self.lengths = 1 + sum(grams.values())
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.buckets = np.empty(int(self.lengths.sum()), dtype=np.int64)
        self.buckets[self.starts] = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % WORDS
        place = self.starts + 1
        for n, counts in grams.items():
            step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            at = np.repeat(firsts, counts) + step
            value = np.full(len(at), n, dtype=np.uint64)
            for j in range(n):
                value = (value << np.uint64(8)) | data[at + j]
            value *= np.uint64(MULTIPLIER)
            self.buckets[np.repeat(place, counts) + step] = WORDS + (value >> np.uint64(32)) % (BUCKETS - WORDS)
            place = place + counts
        # the word counts as much as all its n-grams
        self.shares = np.repeat((1 / np.maximum(self.lengths - 1, 1)).astype(np.float32), self.lengths)
        self.shares[self.starts] = 1

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the words at these places, one after the other, their shares, and how many each has."""
        lengths = self.lengths[words]
        shift = np.repeat(self.starts[words] - (np.cumsum(lengths) - lengths), lengths)
        at = shift + np.arange(lengths.sum())
        return self.buckets[at], self.shares[at], lengths

    def embed(self, table: np.ndarray, step: int = 1 << 15) -> np.ndarray:
        """Embedding of each word, its own and the mean of its n-grams', ``step`` words at a time."""
        out = np.zeros((len(self.lengths), table.shape[1]), table.dtype)
        for first in range(0, len(out), step):
            starts = self.starts[first : first + step]
            end = starts[-1] + self.lengths[first : first + step][-1]
            rows = table[self.buckets[starts[0] : end]] * self.shares[starts[0] : end, None]
            np.add.reduceat(rows, starts - starts[0], axis=0, out=out[first : first + step])
        return out


def _highest(responses: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Highest response of each text and the first place that has it."""
    best = np.maximum.reduceat(responses, starts, axis=0)
    same = responses == np.repeat(best, lengths, axis=0)
    at = np.where(same, np.arange(len(responses))[:, None], len(responses))
    return best, np.minimum.reduceat(at, starts, axis=0)


class Network:
    """Embeddings, one weight per (span, offset, dimension, filter), and the logistic layer."""

    def __init__(self, odds: np.ndarray):
        """``odds``: log odds of each bucket; a word's start in its group's dimension, an n-gram's in the last."""
        random = np.random.default_rng(3)
        self.table = random.normal(0, 0.02, (BUCKETS, WIDTH)).astype(np.float32)
        own = np.where(np.arange(BUCKETS) < WORDS, np.arange(BUCKETS) % GROUPS, GROUPS)
        self.table[np.arange(BUCKETS), own] = odds
        self.filters = []
        for span, count in FILTERS.items():
            weights = random.normal(0, 0.02, (span, WIDTH, count)).astype(np.float32)
            weights += np.eye(WIDTH, dtype=np.float32) if span == 1 else np.float32(0.5 / span)
            self.filters.append(weights)
        count = sum(FILTERS.values())
        self.bias = np.full(count, -1.0, dtype=np.float32)
        self.weights = np.full(count, 0.5, dtype=np.float32)
        self.offset = np.float32(-1.0)

    def arrays(self) -> list[np.ndarray]:
        return [self.table, *self.filters, self.bias, self.weights]

    def train(self, bags: Bags, features: Features, labels: np.ndarray, rows: np.ndarray) -> None:
        """Adagrad over shuffled batches of ``rows``; either label weighs as much in sum."""
        random = np.random.default_rng(5)
        firsts = np.cumsum(bags.lengths) - bags.lengths
        ones = labels[rows].sum()
        weigh = np.where(labels == 1, 0.5 / max(1, ones), 0.5 / max(1, len(rows) - ones)) * len(rows)
        past = [np.full(x.shape, 1e-3, np.float32) for x in self.arrays()]
        past_offset = 1e-3
        usable = rows[bags.lengths[rows] > 0]
        for _ in range(EPOCHS):
            order = random.permutation(usable)
            for first in range(0, len(order), BATCH):
                chosen = order[first : first + BATCH]
                places = [bags.places[firsts[i] : firsts[i] + bags.lengths[i]] for i in chosen]
                words, own = np.unique(np.concatenate(places), return_inverse=True)
                lengths = bags.lengths[chosen]
                starts = np.cumsum(lengths) - lengths
                buckets, shares, counts = features.of(words)
                spread = self.table[buckets] * shares[:, None]
                vectors = np.add.reduceat(spread, np.cumsum(counts) - counts, axis=0)
                x = np.concatenate([vectors[own], np.zeros((max(FILTERS), WIDTH))]).astype(np.float32)
                tail = starts + lengths  # a window may not reach into the next text
                pooled, spots = [], []
                for span, weights in zip(FILTERS, self.filters, strict=True):
                    responses = x[: len(own)] @ weights[0]
                    for j in range(1, span):
                        part = x[j : j + len(own)] @ weights[j]
                        for back in range(1, j + 1):
                            part[tail[lengths >= back] - back] = 0
                        responses += part
                    best, at = _highest(responses, starts, lengths)
                    pooled.append(best)
                    spots.append(at)
                hidden = np.concatenate(pooled, axis=1) + self.bias
                live = hidden > 0
                out = np.where(live, hidden, 0) @ self.weights + self.offset
                error = ((1 / (1 + np.exp(-out)) - labels[chosen]) * weigh[chosen] / len(chosen)).astype(np.float32)
                grad_hidden = error[:, None] * self.weights * live
                grads = [np.zeros_like(a) for a in self.arrays()[1:]]
                grads[-1][:] = np.where(live, hidden, 0).T @ error
                grads[-2][:] = grad_hidden.sum(axis=0)
                grad_x = np.zeros_like(x)
                column = 0
                for k, (span, weights) in enumerate(zip(FILTERS, self.filters, strict=True)):
                    g = grad_hidden[:, column : column + FILTERS[span]]
                    column += FILTERS[span]
                    for j in range(span):
                        at = spots[k] + j
                        inside = (at < tail[:, None]) & (g != 0)
                        doc, filt = np.nonzero(inside)
                        spot, value = at[doc, filt], g[doc, filt]
                        np.add.at(grads[k], (j, slice(None), filt), value[:, None] * x[spot])
                        np.add.at(grad_x, spot, value[:, None] * weights[j][:, filt].T)
                hit = np.flatnonzero(grad_x[: len(own)].any(axis=1))
                grad_words = np.zeros((len(words), WIDTH), np.float32)
                np.add.at(grad_words, own[hit], grad_x[hit])
                touched = np.flatnonzero(grad_words.any(axis=1))
                for w in touched.tolist():
                    rows, shares, _ = features.of(words[w : w + 1])
                    grad = grad_words[w] * shares[:, None]
                    past[0][rows] += grad**2
                    self.table[rows] -= RATE * grad / np.sqrt(past[0][rows])
                for array, grad, sums in zip(self.arrays()[1:], grads, past[1:], strict=True):
                    sums += grad**2
                    array -= RATE * grad / np.sqrt(sums)
                past_offset += float(error.sum()) ** 2
                self.offset -= np.float32(RATE * error.sum() / np.sqrt(past_offset))


class Scorer:
    """Logits of texts from what every filter position gives for their words."""

    def __init__(self, table, filters, bias, weights, offset):
        self.table, self.filters, self.bias, self.weights, self.offset = table, filters, bias, weights, offset
        self.spans = [len(x) for x in filters]
        # every (span, offset) side by side: a word's responses are one product
        self.stacked = np.concatenate([part for x in filters for part in x], axis=1)
        self.counts = [x.shape[2] for x in filters]

    def responses(self, features: Features) -> np.ndarray:
        """What every filter position gives for each word."""
        return (features.embed(self.table) @ self.stacked).astype(np.float32)

    def pooled(self, bags: Bags, table: np.ndarray) -> np.ndarray:
        """Logit of each text from the responses of its words."""
        out = np.full((len(bags.lengths), len(self.bias)), 0.0, dtype=np.float32)
        if len(bags.places):
            lengths = bags.lengths[bags.full]
            tail = bags.starts + lengths
            column, first, n = 0, 0, len(bags.places)
            for span, count in zip(self.spans, self.counts, strict=True):
                responses = table[:, column : column + count][bags.places]
                for j in range(1, span):
                    column += count
                    if n > j:
                        part = table[:, column : column + count][bags.places[j:]]
                        for back in range(1, j + 1):
                            spots = tail[lengths >= back] - back
                            part[spots[spots < n - j]] = 0
                        responses[: n - j] += part
                column += count
                out[bags.full, first : first + count] = np.maximum.reduceat(responses, bags.starts, axis=0)
                first += count
        hidden = np.maximum(out + self.bias, 0)
        hidden[bags.lengths == 0] = 0
        return hidden @ self.weights + self.offset


class Reader:
    """Language and logit of texts. What the two models give for a word is one row of two arrays, found by one
    look-up; when the arrays are full, the words of the texts at hand begin them anew."""

    def __init__(self, model: tuple, langs: list[str], tables: tuple):
        table, *rest = model
        self.network, self.words, self.langs = Scorer(table.astype(np.float32), *rest), WordScorer(*tables), langs
        self.places: dict[str, int] = {}
        self.scores = np.empty((CACHE, self.words.logs.shape[1]))
        self.responses = np.empty((CACHE, self.network.stacked.shape[1]), np.float32)

    def _look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.places.get, words, repeat(-1)), np.int64, len(words))
        scores, responses = self.scores[at], self.responses[at]
        new = np.flatnonzero(at < 0)
        if len(new):
            asked = [words[i] for i in new.tolist()]
            scores[new] = self.words.vectors(asked)
            responses[new] = self.network.responses(Features(asked))
            if len(self.places) + len(new) > CACHE:
                self.places, new = {}, np.arange(len(words))
                asked = words
            short = np.fromiter(map(len, asked), np.int64, len(asked)) <= LONGEST
            new = new[short][:CACHE]
            first, end = len(self.places), len(self.places) + len(new)
            self.scores[first:end], self.responses[first:end] = scores[new], responses[new]
            self.places.update(zip([words[i] for i in new.tolist()], range(first, end), strict=True))
        return scores, responses

    def read(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and logit of every text; null as empty. Without words the logit is that of no response."""
        bags = Bags([words_of(x or "") for x in texts])
        scores, responses = self._look_up(bags.words)
        names = [NO_LANGUAGE] * len(texts)
        if self.langs:
            names, _ = most_likely(summed(bags, scores), bags, self.langs)
        return names, self.network.pooled(bags, responses).astype(float)


def texts_with(bags: Bags, features: Features, labels: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """By part, label and bucket: how many texts hold the bucket."""
    held = np.zeros((PARTS, 2, BUCKETS))
    ends = np.cumsum(bags.lengths)
    for first, end, label, part in zip(ends - bags.lengths, ends, labels.tolist(), parts.tolist(), strict=True):
        seen, _, _ = features.of(np.unique(bags.places[first:end]))
        held[part, label][np.unique(seen)] += 1
    return held


def log_odds(held: np.ndarray, share: float) -> np.ndarray:
    """Log odds of either label for the texts that hold a bucket, against those of all, of which ``share`` have 1."""
    odds = np.log((held[1] + EVIDENCE * share) / (held[0] + EVIDENCE * (1 - share)))
    return odds - np.log(share / (1 - share))


def best_threshold(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The middle of the gap with the highest F1; of equal ones, the widest gap. Each stands for ``counts`` rows."""
    counts = np.ones(len(logits)) if counts is None else counts
    order = np.argsort(logits)
    logits, labels, counts = logits[order], labels[order], counts[order]
    above = (labels * counts)[::-1].cumsum()[::-1]
    rows = counts[::-1].cumsum()[::-1]
    f1 = 2 * above[1:] / (rows[1:] + above[0])
    gaps = np.diff(logits)
    ok = np.flatnonzero(gaps > 0)
    if not len(ok):
        return float(logits[0])
    best = ok[np.lexsort((-gaps[ok], -np.round(f1[ok], 9)))[0]]
    return float((logits[best] + logits[best + 1]) / 2)


def thresholds(names: np.ndarray, logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> dict[str, float]:
    """The threshold of all rows, under "", and of each language that has FEWEST rows of either label."""
    limits = {"": best_threshold(logits, labels, counts)}
    for name in np.unique(names).tolist():
        at = names == name
        ones = (labels[at] * counts[at]).sum()
        if name != NO_LANGUAGE and min(ones, counts[at].sum() - ones) >= FEWEST:
            limits[name] = best_threshold(logits[at], labels[at], counts[at])
    return limits


def trained(bags: Bags, features: Features, marks: np.ndarray, rows: np.ndarray, held: np.ndarray) -> Scorer:
    """A network fitted on ``rows``, of which ``held`` counts those of either label by bucket."""
    network = Network(log_odds(held, marks[rows].mean()))
    network.train(bags, features, marks, rows)
    return Scorer(network.table, network.filters, network.bias, network.weights, network.offset)


def fit(
    texts: list[list[str]], marks: np.ndarray, parts: np.ndarray, langs: list[str], scorer: WordScorer
) -> tuple[Scorer, np.ndarray, list[str]] | None:
    """The network fitted on all rows, the logit and the language of each; nothing if there is one label only.

    A row's logit comes from a network fitted on the other parts.
    """
    if len(np.unique(marks)) < 2:
        return None
    bags = Bags(texts)
    features = Features(bags.words)
    held = texts_with(bags, features, marks, parts)
    network = trained(bags, features, marks, np.arange(len(marks)), held.sum(axis=0))
    logits = network.pooled(bags, network.responses(features)).astype(float)
    for part in range(PARTS):
        learn, check = np.flatnonzero(parts != part), parts == part
        if check.any() and len(np.unique(marks[learn])) == 2:
            other = trained(bags, features, marks, learn, np.delete(held, part, axis=0).sum(axis=0))
            logits[check] = other.pooled(bags, other.responses(features))[check]
    return network, logits, best_language(bags, langs, scorer)[0]


class ToxicityModel:
    """Fitted on the labelled rows of ``docs``; null labels are left out, of several for one id the highest holds.

    The network is trained on about ``sample_rows`` labelled ids of either label, chosen by a hash of the id
    and one text each (that with the least hash), so the sample is bounded however often an id occurs. The
    language model comes of all rows of ``learn`` (by default ``docs``). Every text is scored once, by
    language and logit; what is joined with labels is that, never a text. The thresholds come of all labelled
    rows at their natural rate: those of the sample with logits from networks fitted on two thirds of it, the
    others, which the network has not seen, with its own, counted by language, logit and label.

    Null and empty texts have the score of no word; a null id has no label; repeated rows are scored alike;
    with one label only, or none, or an empty table, every score is 0.
    """

    def __init__(
        self, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, learn: DataFrame | None = None
    ):
        """``docs`` has doc_id, text and lang, ``labels`` has doc_id and label (0 or 1)."""
        spark = docs.sparkSession
        label = F.max(F.col("label").cast("int")).alias("label")
        known = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        labels = written(known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(label), "toxic-labels")
        counts = {row[0]: row[1] for row in labels.groupBy("label").agg(F.count("*")).collect()}
        share = F.lit(0)
        for value, count in counts.items():
            share = F.when(F.col("label") == value, F.lit(int(min(1.0, sample_rows / count) * 2**30))).otherwise(share)
        draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(2**30))
        # about 2 x sample_rows ids, whatever the number of labels: small enough for every task
        chosen = written(labels.filter(draw < share), "toxic-chosen")
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
        asked = texts.join(F.broadcast(chosen), "doc_id")
        first = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
        self.sample = sample = written(asked.groupBy("doc_id", "label").agg(first), "toxic-sample")
        self.language = LanguageModel(docs if learn is None else learn)
        langs, tables = self.language.langs, self.language.tables
        shared = spark.sparkContext.broadcast({"tables": tables})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts, marks, parts = [], [], []
            for batch in batches:
                texts += [words_of(x or "") for x in batch.column(0).to_pylist()]
                marks += batch.column(1).to_pylist()
                parts += batch.column(2).to_pylist()
            words = WordScorer(*shared.value["tables"])
            found = fit(texts, np.array(marks, np.int64), np.array(parts, np.int64), langs, words)
            if not found:
                return
            network, logits, names = found
            kept = [*network.filters, network.bias, network.weights, np.float32([network.offset])]
            kept.insert(0, network.table.astype(STORED))
            blobs = [pa.array([x.tobytes()], pa.binary()) for x in kept]
            blobs += [pa.array([names], pa.list_(pa.string())), pa.array([list(logits)]), pa.array([marks], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(blobs, [f"c{i}" for i in range(len(blobs))])

        count = 4 + len(FILTERS)
        schema = ", ".join([f"c{i} binary" for i in range(count)])
        schema += f", c{count} array<string>, c{count + 1} array<double>, c{count + 2} array<long>"
        part = F.pmod(F.xxhash64("doc_id", F.lit(19)), F.lit(PARTS)).cast("int")
        rows = sample.select("text", "label", part.alias("part"), "doc_id").repartition(1).sortWithinPartitions("doc_id")
        found = rows.select("text", "label", "part").mapInArrow(run, schema).collect()
        self.model = None
        if found:
            flat = [np.frombuffer(x, np.float32) for x in found[0][1:count]]
            self.model = (
                np.frombuffer(found[0][0], STORED).reshape(BUCKETS, WIDTH),
                [x.reshape(span, WIDTH, n) for (span, n), x in zip(FILTERS.items(), flat, strict=False)],
                flat[-3],
                flat[-2],
                flat[-1][0],
            )
            rows = self._counted(docs, labels.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti"))
            names, logits, marks = ([*found[0][count + i]] for i in range(3))
            names = np.array(names + [x["lang"] for x in rows])
            logits = np.array(logits + [x["step"] * STEP for x in rows], dtype=float)
            marks = np.array(marks + [x["label"] for x in rows], dtype=float)
            sizes = np.concatenate([np.ones(len(names) - len(rows)), [x["n"] for x in rows]])
            self.limits = thresholds(names, logits, marks, sizes)
        self.spark, self.docs = spark, docs

    def _counted(self, docs: DataFrame, labels: DataFrame) -> list:
        """Score every text, keep (doc_id, lang, logit) of each row; (lang, step, label, n) of the labelled ones:
        how many have a language, a logit in steps and a label."""
        shared = docs.sparkSession.sparkContext.broadcast(
            {"model": self.model, "langs": self.language.langs, "tables": self.language.tables}
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = shared.value
            if "reader" not in held:
                held["reader"] = Reader(held["model"], held["langs"], held["tables"])
            for batch in batches:
                for first, end in slices(batch.column(1), SLICE):
                    part = batch.slice(first, end - first)
                    names, logits = held["reader"].read(part.column(1).to_pylist())
                    columns = [part.column(0), pa.array(names, pa.string()), pa.array(logits)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "logit"])
            give_back()

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
        self.logits = written(rows.mapInArrow(run, "doc_id long, lang string, logit double"), "toxic-logits")
        within = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("logit")))
        steps = self.logits.select("doc_id", "lang", F.round(within / STEP).cast("long").alias("step"))
        # an id on very many rows is few rows here
        steps = steps.groupBy("doc_id", "lang", "step").agg(F.count("*").alias("n"))
        return steps.join(labels, "doc_id").groupBy("lang", "step", "label").agg(F.sum("n").alias("n")).collect()

    def scores(self) -> DataFrame:
        """(doc_id, score) of every row of ``docs``, from the logits that the thresholds come of."""
        if self.model is None:
            return self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.0).alias("score"))
        border = F.lit(float(self.limits[""]))
        for name, limit in sorted(self.limits.items()):
            if name:
                border = F.when(F.col("lang") == name, float(limit)).otherwise(border)
        logit = F.col("logit") - border + float(np.log(THRESHOLD / (1 - THRESHOLD)))
        return self.logits.select("doc_id", (1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), logit))))).alias("score"))

    def score(self, text: Column) -> Column:
        """Score of a text column, from 0 to 1: THRESHOLD where the text's language has its threshold."""
        if self.model is None:
            return F.when(text.isNull(), F.lit(0.0)).otherwise(F.lit(0.0))
        language = self.language
        shared = self.spark.sparkContext.broadcast(
            {"model": self.model, "limits": self.limits, "langs": language.langs, "tables": language.tables}
        )

        def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            held = shared.value  # the same object for all tasks of a Python worker
            if "reader" not in held:
                held["reader"] = Reader(held["model"], held["langs"], held["tables"])
            limits = held["limits"]
            shift = np.log(THRESHOLD / (1 - THRESHOLD))
            for column in columns:
                parts = [np.zeros(0)]
                for first, end in slices(column, SLICE):
                    names, logits = held["reader"].read(column[first:end].to_pylist())
                    border = np.array([limits.get(x, limits[""]) for x in names])
                    logits = logits - border + shift
                    parts.append(1 / (1 + np.exp(-np.clip(logits, -700, 700))))
                yield pa.array(np.concatenate(parts))

        return F.arrow_udf(run, "double")(text)
