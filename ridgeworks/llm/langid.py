"""Language identification: known words by their log frequency, others by ever shorter n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ridgeworks.functions.pixels import to_list_array
from ridgeworks.llm.common import Bags, Memory, give_back, join_groups, slices, split_rows, written

LONGEST = 5
# every worker holds the words that are at least this share of the words of any language, with their counts in
# all (for ``predict`` the n-grams too, by length); no language brings more than 1 / SHARE of each
SHARE = 1 / 200_000
# words whose scores a Python worker remembers, twice that many at most
CACHE = 200_000
# different words a task counts, or words and texts that it pairs, before it hands them on
FLUSH = 100_000
# bytes of text that are cut into words at once
SLICE = 4 << 20
# letters of any script
LETTERS = r"[^\W\d_]+"
NO_LANGUAGE = "und"


_words = re.compile(LETTERS).findall


def words_of(text: str) -> list[str]:
    """Words of letters only, in lower case."""
    return _words(text.lower())


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its two edges marked."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def count_words(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each word stands in the texts (lang, text) of each language.

    Tasks count first; what is shuffled is one row for each word that a task has met.
    """

    def counted(seen: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for code, counter in seen.items():
            columns = [
                pa.array([code] * len(counter), pa.string()),
                pa.array(list(counter), pa.string()),
                pa.array(list(counter.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for first, end in slices(batch.column(1), SLICE):
                codes, texts = (x.slice(first, end - first).to_pylist() for x in batch.columns)
                for code, text in zip(codes, texts, strict=True):
                    if code not in seen:
                        seen[code] = Counter()
                    seen[code].update(words_of(text))
                    if len(seen[code]) >= FLUSH:
                        yield from counted({code: seen.pop(code)})
        yield from counted(seen)
        seen.clear()
        give_back()

    found = rows.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame) -> DataFrame:
    """(lang, length, gram, n): how often each n-gram stands in the words (lang, gram, n).

    Equal endings of words, cut to the longest n-gram, come together first; the n-grams are their beginnings.
    """
    marked = words.select("lang", F.concat(F.lit("<"), "gram", F.lit(">")).alias("marked"), "n")
    placed = marked.select("*", F.explode(F.sequence(F.lit(1), F.length("marked"))).alias("at"))
    longest = F.substring("marked", F.col("at"), F.lit(LONGEST)).alias("longest")
    longest = placed.select("lang", longest, "n").groupBy("lang", "longest").agg(F.sum("n").alias("n"))
    shorter = [F.when(F.length("longest") >= n, F.substring("longest", 1, n)) for n in range(1, LONGEST + 1)]
    each = longest.select("lang", F.explode(F.array(*shorter)).alias("gram"), "n").filter(F.col("gram").isNotNull())
    counts = each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return counts.select("lang", F.length("gram").alias("length"), "gram", "n")


class LanguageModel:
    """Fitted on all rows of ``labelled``: (text, lang), rows with a null lang or text left out.

    Words and n-grams are counted over the whole table. Workers hold the words above ``share`` of any
    language, each with its counts in all languages, so what they hold is bounded by languages / share
    whatever the corpus. ``identify`` looks up all other words, and the n-grams of those never seen, by joins:
    its results do not depend on ``share``.
    """

    def __init__(self, labelled: DataFrame, text: str = "text", lang: str = "lang", share: float = SHARE):
        rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
        rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        self.share = share
        self.words = written(count_words(rows), "lang-words")
        self.word_totals = dict(sorted(map(tuple, self.words.groupBy("lang").agg(F.sum("n")).collect())))
        self.langs = list(self.word_totals)

    @cached_property
    def grams(self) -> DataFrame:
        """(lang, length, gram, n) of all n-grams."""
        return written(count_grams(self.words), "lang-grams")

    def _held(self, known: DataFrame) -> tuple[list[dict[str, int]], np.ndarray]:
        """What workers hold of (lang, length, gram, n): places by length and gram, and log frequencies."""
        totals = known.groupBy("lang", "length").agg(F.sum("n").alias("total"))
        often = known.join(F.broadcast(totals), ["lang", "length"]).filter(F.col("n") >= F.col("total") * self.share)
        held = known.join(often.select("length", "gram").distinct(), ["length", "gram"], "left_semi")
        place = {code: i for i, code in enumerate(self.langs)}
        sums = np.zeros((LONGEST + 1, max(1, len(place))))
        for row in totals.collect():
            sums[row["length"], place[row["lang"]]] = row["total"]
        found = held.select("lang", "length", "gram", "n").orderBy("length", "gram", "lang").toArrow().to_pydict()
        index: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        rows_of, columns_of, levels = [], [], []
        for code, length, gram in zip(found["lang"], found["length"], found["gram"], strict=True):
            own = index[length]
            if gram not in own:
                own[gram] = len(levels)
                levels.append(length)
            rows_of.append(own[gram])
            columns_of.append(place[code])
        counts = np.zeros((len(levels), max(1, len(place))))
        counts[rows_of, columns_of] = found["n"]
        levels = np.array(levels, dtype=np.int64)
        return index, np.log((counts + 0.5) / (sums[levels] + 1.0)) if len(levels) else counts

    @cached_property
    def tables(self) -> tuple[list[dict[str, int]], np.ndarray]:
        """Words and n-grams that workers hold for ``predict``."""
        return self._held(self.words.withColumn("length", F.lit(0)).unionByName(self.grams))

    def _logs(self, counts: DataFrame, key: str, totals: dict[str, int]) -> DataFrame:
        """(key, vector): log frequency in every language from (key, lang, n)."""
        parts = []
        for code in self.langs:
            n = F.coalesce(F.sum(F.when(F.col("lang") == code, F.col("n"))), F.lit(0))
            parts.append(F.log((n + 0.5) / F.lit(totals.get(code, 0) + 1.0)))
        return counts.groupBy(key).agg(F.array(*parts).alias("vector"))

    def _means(self, rows: DataFrame, key: str) -> DataFrame:
        """(key, vector): the mean of the vectors of each key."""
        return rows.groupBy(key).agg(F.array(*[F.avg(F.get("vector", F.lit(i))) for i in range(len(self.langs))]).alias("vector"))

    def _backed_off(self, words: DataFrame) -> DataFrame:
        """(word, vector) of words never seen: the mean over their n-grams of the longest length that has any
        known ones; zeros if no length has."""
        totals: dict[int, dict[str, int]] = {}
        for code, length, total in self.grams.groupBy("lang", "length").agg(F.sum("n")).collect():
            totals.setdefault(length, {})[code] = total
        found, left = [], words.select("word", F.concat(F.lit("<"), "word", F.lit(">")).alias("marked"))
        for length in range(LONGEST, 0, -1):
            some = left.filter(F.length("marked") >= length)
            places = F.sequence(F.lit(1), F.length("marked") - (length - 1))
            some = some.select("word", "marked", F.explode(places).alias("at"))
            each = some.select("word", F.substring("marked", F.col("at"), F.lit(length)).alias("gram"))
            counts = self.grams.filter(F.col("length") == length)
            vectors = self._logs(counts, "gram", totals.get(length, {}))
            groups = written(each.groupBy("gram").agg(F.count("*").alias("size")).join(vectors, "gram"), "lang-unseen-grams")
            total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
            found.append(written(self._means(join_groups(each, groups, "gram", "size", total), "word"), "lang-unseen"))
            left = written(left.join(found[-1], "word", "left_anti"), "lang-left")
            if left.isEmpty():
                break
        zeros = F.array(*[F.lit(0.0)] * len(self.langs)).alias("vector")
        return reduce(DataFrame.unionByName, found, left.select("word", zeros))

    def identify(self, docs: DataFrame, row: Column, text: Column) -> DataFrame:
        """(row, found struct(lang_pred, score)) of every row of ``docs``.

        Texts are read once. The sums of the words that workers hold are kept by row; every other word is
        written once per four megabytes of text with the rows that have it, meets its counts or, if it was never seen, those of
        its n-grams by joins, and what it adds comes back to its rows by their number. ``row`` is what is
        known of a row afterwards: keep it small. Null text, text without a letter and a model without
        languages give ``und`` and 0; null and repeated ids, repeated rows and texts are rows of their own; an
        empty table gives an empty one.
        """
        spark = docs.sparkSession
        if not self.langs:
            none = F.struct(F.lit(NO_LANGUAGE).alias("lang_pred"), F.lit(0.0).alias("score"))
            return docs.select(row.alias("row"), none.alias("found"))
        index, logs = self._held(self.words.withColumn("length", F.lit(0)))
        shared = spark.sparkContext.broadcast((index[0], logs))
        asked = docs.select(row.alias("row"), text.alias("text"))
        kind = asked.schema["row"].dataType
        # the row itself goes through as it is; its type in Arrow is the one it comes with
        schema = StructType().add("text_id", "long").add("row", kind)
        for name, of in (("sums", "array<double>"), ("words", "long"), ("word", "string"), ("texts", "array<long>"), ("counts", "array<int>")):
            schema.add(name, DataType.fromDDL(of))
        cut = written(asked.mapInArrow(cut_words(shared), schema), "lang-cut")
        pairs = cut.filter(F.col("word").isNotNull()).select("word", "texts", "counts")
        sizes = written(pairs.groupBy("word").agg(F.sum(F.size("texts")).alias("size")), "lang-rest")
        total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        counts = self.words.withColumnRenamed("gram", "word").join(sizes.select("word"), "word", "left_semi")
        seen = written(self._logs(counts, "word", self.word_totals), "lang-seen")
        unseen = written(sizes.join(seen, "word", "left_anti").select("word"), "lang-never-seen")
        vectors = seen if unseen.isEmpty() else seen.unionByName(self._backed_off(unseen))
        scores = written(sizes.join(vectors, "word"), "lang-scores")
        met = join_groups(pairs, scores, "word", "size", total)
        each = met.select("vector", F.explode(F.arrays_zip("texts", "counts")).alias("x"))
        added = F.array(*[F.sum(F.get("vector", F.lit(i)) * F.col("x.counts")) for i in range(len(self.langs))])
        added = each.groupBy(F.col("x.texts").alias("text_id")).agg(added.alias("added"))
        rows = cut.filter(F.col("word").isNull()).select("text_id", "row", "sums", "words")
        rows = rows.join(added, "text_id", "left")
        both = F.zip_with("sums", "added", lambda x, y: x + y)
        rows = rows.select("row", "words", F.when(F.col("added").isNull(), F.col("sums")).otherwise(both).alias("sums"))
        rows = rows.select("*", F.array_max("sums").alias("most"))
        shares = F.aggregate("sums", F.lit(0.0), lambda x, y: x + F.exp(y - F.col("most")))
        names = F.array(*[F.lit(x) for x in self.langs])
        name = F.get(names, F.array_position("sums", F.col("most")).cast("int") - 1)
        some = F.col("words") > 0
        found = F.struct(
            F.when(some, name).otherwise(F.lit(NO_LANGUAGE)).alias("lang_pred"),
            F.when(some, 1.0 / shares).otherwise(F.lit(0.0)).alias("score"),
        )
        return rows.select("row", found.alias("found"))

    def predict(self, spark: SparkSession, text: Column) -> Column:
        """struct(lang_pred, score) of a text column, from nothing but the text and the words that workers
        hold: rarer words count as never seen. ``identify`` has the counts of those too.

        The score is the posterior of the language over all words of the text, languages equally likely
        before. Null text, text without a letter and a model without languages give ``und`` and 0.
        """
        shared = spark.sparkContext.broadcast({"langs": self.langs, "tables": self.tables})

        def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = shared.value  # the same object for all tasks of a Python worker
            if "scorer" not in model:
                model["scorer"] = WordScorer(*model["tables"])
            for column in columns:
                parts = [
                    predictions(column[first:end].to_pylist(), model["langs"], model["scorer"])
                    for first, end in slices(column)
                ]
                yield pa.concat_arrays(parts) if parts else pa.array([], PREDICTION)

        return F.arrow_udf(run, "struct<lang_pred: string, score: double>")(text)


def cut_words(shared):
    """Task function of ``identify``: (row, text) to a row for each text, with the sums of its words that
    workers hold, and a row for each other word, with the texts that have it and how often."""

    def text_rows(first: int, rows: pa.Array, sums: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
        n = len(rows)
        columns = [pa.array(range(first, first + n), pa.int64()), rows, to_list_array(sums), pa.array(lengths)]
        columns += [pa.nulls(n, x) for x in (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, CUT)

    def word_rows(kind: pa.DataType, words: list[str], starts: np.ndarray, texts: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        n = len(words)
        columns = [pa.nulls(n, x) for x in (pa.int64(), kind, pa.list_(pa.float64()), pa.int64())]
        offsets = pa.array(np.append(starts, len(texts)).astype(np.int32))
        columns.append(pa.array(words, pa.string()))
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(texts, pa.int64())))
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())))
        return pa.RecordBatch.from_arrays(columns, CUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, logs = shared.value
        logs = np.concatenate([logs, np.zeros((1, logs.shape[1]))])  # the last row: not held
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, end in slices(batch.column(1), SLICE):
                bags = Bags([words_of(x or "") for x in batch.column(1).slice(first, end - first).to_pylist()])
                own = np.array([index.get(x, -1) for x in bags.words], dtype=np.int64)
                sums = np.zeros((end - first, logs.shape[1]))
                if len(bags.places):
                    sums[bags.full] = np.add.reduceat(logs[own[bags.places]], bags.starts, axis=0)
                yield text_rows(key, batch.column(0).slice(first, end - first), sums, bags.lengths)
                rare = np.flatnonzero(own[bags.places] < 0)
                texts = np.repeat(np.arange(len(bags.lengths)), bags.lengths)[rare]
                pairs, counts = np.unique(bags.places[rare] * len(bags.lengths) + texts, return_counts=True)
                places, texts = np.divmod(pairs, max(1, len(bags.lengths)))
                for low in range(0, len(places), FLUSH):
                    part = slice(low, low + FLUSH)
                    starts = np.flatnonzero(np.diff(places[part], prepend=-1))
                    words = [bags.words[x] for x in places[part][starts].tolist()]
                    yield word_rows(batch.column(0).type, words, starts, texts[part] + key, counts[part])
                key += end - first
            del batch
        give_back()

    return run


CUT = ["text_id", "row", "sums", "words", "word", "texts", "counts"]
PREDICTION = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


def best_language(bags: Bags, langs: list[str], scorer: WordScorer) -> tuple[list[str], np.ndarray]:
    """Language of each bag of words and its posterior."""
    if not langs:
        return [NO_LANGUAGE] * len(bags.lengths), np.zeros(len(bags.lengths))
    return most_likely(scorer.totals(bags), bags, langs)


def most_likely(sums: np.ndarray, bags: Bags, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """Language of each bag of words and its posterior, from the sums of its words' scores."""
    shares = np.exp(sums - sums.max(axis=1, keepdims=True))
    found = bags.lengths > 0
    names = [langs[i] if ok else NO_LANGUAGE for i, ok in zip(sums.argmax(axis=1), found, strict=True)]
    return names, np.where(found, shares.max(axis=1) / shares.sum(axis=1), 0.0)


def predictions(texts: list[str | None], langs: list[str], scorer: WordScorer) -> pa.Array:
    """(lang_pred, score) of every text."""
    names, score = best_language(Bags([words_of(x or "") for x in texts]), langs, scorer)
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], fields=list(PREDICTION))


def code_points(texts: list[str]) -> np.ndarray:
    """Of all texts, one after the other."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)


class Grams:
    """The n-grams of one length that have a place, found for many words at once by a hash; what is found is
    compared letter by letter."""

    def __init__(self, places: dict[str, int], length: int):
        self.length, self.factor = length, 0x9E3779B97F4A7C15
        codes = code_points(list(places))
        firsts = np.arange(len(places)) * length
        keys = self._keys(codes, firsts)
        while len(np.unique(keys)) < len(keys):
            self.factor += 2
            keys = self._keys(codes, firsts)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.codes = codes.reshape(-1, length)[order]
        self.places = np.fromiter(places.values(), np.int64, len(places))[order]
        # by the first 20 bits of a hash: most n-grams of a rare word end here
        self.some = np.zeros(1 << 20, dtype=bool)
        self.some[self.keys >> np.uint64(44)] = True

    def _keys(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        keys = np.zeros(len(at), dtype=np.uint64)
        for j in range(self.length):
            keys += codes[at + j]
            keys *= np.uint64(self.factor)
        return keys

    def find(self, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the spots ``at`` where a known n-gram starts, and its place."""
        keys = self._keys(codes, at)
        some = np.flatnonzero(self.some[keys >> np.uint64(44)])
        at, keys = at[some], keys[some]
        row = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = np.ones(len(at), dtype=bool)
        for j in range(self.length):
            same &= self.codes[row, j] == codes[at + j]
        return at[same], self.places[row[same]]


class WordScorer:
    """Log frequency of a word in every language, from the word itself or else from its n-grams."""

    def __init__(self, index: list[dict[str, int]], logs: np.ndarray):
        self.words = index[0]
        self.levels = [Grams(index[n], n) for n in range(len(index) - 1, 0, -1) if index[n]]
        self.logs = np.concatenate([logs, np.zeros((1, logs.shape[1]))])  # the last row: nothing is known
        self.memory = Memory(CACHE)

    def _find(self, words: list[str]) -> list[bytes]:
        return split_rows(self.vectors(words))

    def _backed_off(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers, ascending, and places of the known n-grams of each word with its edges marked, of the
        longest length that has any; a word without any has none."""
        codes = code_points([f"<{word}>" for word in words])
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        who = np.repeat(np.arange(len(words)), sizes)
        left = np.cumsum(sizes)[who] - np.arange(len(codes))
        spots, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        wanted = np.ones(len(words), dtype=bool)
        for level in self.levels:
            at, own = level.find(codes, np.flatnonzero(wanted[who] & (left >= level.length)))
            wanted[who[at]] = False
            spots.append(at)
            places.append(own)
        spots = np.concatenate(spots)
        order = np.argsort(spots)
        return who[spots[order]], np.concatenate(places)[order]

    def vectors(self, words: list[str], step: int = 1 << 15) -> np.ndarray:
        """Scores of every word: its own, or the mean over its known n-grams of the longest length that
        has any, or none; ``step`` words at a time."""
        out = np.empty((len(words), self.logs.shape[1]))
        for first in range(0, len(words), step):
            some = words[first : first + step]
            own = np.fromiter(map(self.words.get, some, repeat(-1)), np.int64, len(some))
            rest = np.flatnonzero(own < 0)
            who, places = self._backed_off([some[i] for i in rest.tolist()])
            alone = np.ones(len(some), dtype=bool)
            alone[rest[who]] = False
            alone = np.flatnonzero(alone)
            who, places = np.concatenate([alone, rest[who]]), np.concatenate([own[alone], places])
            places = places[np.argsort(who, kind="stable")]
            lengths = np.bincount(who, minlength=len(some))
            sums = np.add.reduceat(self.logs[places], np.cumsum(lengths) - lengths, axis=0)
            out[first : first + step] = sums / lengths[:, None]
        return out

    def totals(self, bags: Bags) -> np.ndarray:
        """Sum of the scores of each text's words."""
        known = self.memory.look_up(bags.words, self._find)
        table = np.frombuffer(b"".join(map(known.__getitem__, bags.words))).reshape(len(bags.words), self.logs.shape[1])
        return summed(bags, table)


def summed(bags: Bags, table: np.ndarray) -> np.ndarray:
    """Sum of the rows of each text's words in ``table``."""
    sums = np.zeros((len(bags.lengths), table.shape[1]))
    if len(bags.places):
        sums[bags.full] = np.add.reduceat(table[bags.places], bags.starts, axis=0)
    return sums
