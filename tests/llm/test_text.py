"""Encoding, chat formatting, language, language model and toxicity against brute force and held-out rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeworks.llm import bpe, chat, hmm, langid, queries, toxicity

RANKS = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN)


def as_library(texts):
    return [np.array(LIBRARY.encode_ordinary(x), dtype="<u4").tobytes() for x in texts]


def test_every_code_point_is_split_as_the_library_does():
    random.seed(0)
    codes = [c for c in [*range(0x3100), *random.sample(range(0x3100, 0x110000), 20000)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} '{chr(c)}" for c in codes]
    assert CODEC.encode(texts) == as_library(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t'sé1,. 　漢\x1c\x85", max_size=60), max_size=5))
def test_encoding_agrees_with_the_library(texts):
    found = CODEC.encode(texts)
    assert found == as_library(texts)
    assert [CODEC.decode(x) for x in found] == [x.encode() for x in texts]


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=90))
def test_one_piece_and_many_pieces_merge_alike(piece):
    alone = np.array(bpe.merge_piece(piece, RANKS), dtype="<u4").tobytes()
    assert alone == np.array(LIBRARY._encode_single_piece(piece), dtype="<u4").tobytes()
    if len(piece) > 1:
        assert bpe.merge_pieces([piece, piece[::-1], b"ab"], CODEC.singles, CODEC.table)[0] in (
            alone,
            *([] if piece not in RANKS else [np.array(bpe.merge_piece(piece, RANKS), dtype="<u4").tobytes()]),
        )


def test_bpe_query(spark, small, odd, nothing, folder_of, documents):
    for df in (odd, documents):
        encoded = bpe.encode_texts(df, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
        found = sorted(map(str, bpe.digests(encoded).collect()))
        expected = []
        for row in df.collect():
            ids = as_library([row.text or ""])[0]
            sums = [hashlib.sha256(x).hexdigest() for x in (ids, (row.text or "").encode())]
            expected.append(f"Row(doc_id={row.doc_id}, n_tokens={len(ids) // 4}, ids_sha256='{sums[0]}', decoded_sha256='{sums[1]}')")
        assert found == sorted(expected)
    assert queries.op3_byte_bpe(spark, folder_of(documents=nothing)).count() == 0


def test_chat_query(spark, small):
    found = {x.conv_id: x for x in queries.op6_chat_format(spark, small).collect()}
    turns = {}
    for row in spark.read.parquet(f"{small}/conversations.parquet").collect():
        turns.setdefault(row.conv_id, []).append((row.turn, row.role, row.text or ""))
    turns[-7] = [(0, "user", queries.EXTRA), (1, "assistant", queries.EXTRA)]
    assert found.keys() == turns.keys()
    for key, rows in turns.items():
        rows.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        assert found[key].n_turns == len(rows)
        assert found[key].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert found[key].loss_chars == len(loss)
        assert found[key].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert found[key].formatted_chars >= len(loss)


PARTS = st.lists(st.sampled_from(["\\", "###", "# ", ": ", "</turn>", "<", "\n", "a", "é"]), max_size=8).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(PARTS, PARTS), max_size=6))
def test_turns_are_read_back(turns):
    output, spans, rewriting = chat.turn_spans(chat.plain_template, turns)
    assert rewriting is None and output == chat.plain_template(turns)
    assert [(x["role"], x["text"]) for x in chat.read_back(output, spans)] == turns


def test_rewriting_templates_are_found():
    def counting(turns):
        return f"{len(turns)} turns\n" + chat.plain_template(turns)

    def from_third(turns):
        return chat.plain_template(turns if len(turns) < 3 else [("system", "moved"), *turns])

    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert chat.turn_spans(counting, turns)[2] == 0
    output, spans, rewriting = chat.turn_spans(from_third, turns)
    assert rewriting == 2 and len(spans) == 2 and output.startswith("### system")


def test_chat_of_odd_rows(spark):
    rows = [(1, None, "user", "x"), (1, 0, None, None), (1, 0, None, None), (None, 5, "assistant", "ä\n"), (2, 1, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    found = {x.conv_id: x for x in chat.format_conversations(df).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [("user", "x"), ("", ""), ("", "")]
    assert found[None].formatted[found[None].turns[0].low : found[None].turns[0].high] == "ä\n"
    assert found[2].n_turns == 1
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_language_query(spark, small, documents):
    truth = {x.doc_id: x for x in documents.collect()}
    rows = queries.op2_language_id(spark, small).collect()
    assert sorted(x.doc_id for x in rows) == sorted(truth)
    held = [x for x in rows if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert [x.doc_id for x in held] == [x.doc_id for x in rows if x.held_out]
    assert np.mean([x.lang_pred == truth[x.doc_id].lang for x in held]) > 0.9
    assert all(0 <= x.score <= 1 for x in rows)


def test_language_of_odd_rows(spark, odd, nothing, folder_of):
    model = langid.LanguageModel(odd)
    found = odd.select("doc_id", "text", model.predict(spark, F.col("text")).alias("p")).collect()
    for row in found:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.p.lang_pred == "und") == (not letters)
    assert {x.p.lang_pred for x in found if x.text and x.text.startswith("Le")} == {"fr"}
    bare = langid.LanguageModel(nothing)
    assert {x[0].lang_pred for x in odd.select(bare.predict(spark, F.col("text"))).collect()} == {"und"}
    assert queries.op2_language_id(spark, folder_of(documents=nothing)).count() == 0


def test_unseen_words_back_off_to_shorter_grams(spark):
    df = spark.createDataFrame([("nation station ration", "a"), ("katze hund maus", "b")], "text string, lang string")
    model = langid.LanguageModel(df)
    asked = spark.createDataFrame([("oration",), ("katzen",), ("qqqq",)], "text string")
    found = [x[0] for x in asked.select(model.predict(spark, F.col("text")).alias("p")).select("p.lang_pred").collect()]
    assert found[:2] == ["a", "b"]


def brute_languages(learn, texts):
    """(lang, posterior) of each text: own counts of words that were seen, else the mean over the n-grams of the
    longest length that has a known one."""
    langs = sorted({lang for _, lang in learn})
    words = {x: Counter(w for t, lang in learn if lang == x for w in langid.words_of(t)) for x in langs}
    grams = {
        (x, n): Counter({}) for x in langs for n in range(1, langid.LONGEST + 1)
    }
    for x in langs:
        for word, count in words[x].items():
            for n in range(1, langid.LONGEST + 1):
                for gram in langid.grams(word, n):
                    grams[x, n][gram] += count

    def logs(tables, key):
        return np.array([math.log((t[key] + 0.5) / (sum(t.values()) + 1)) for t in tables])

    def score(word):
        if any(word in words[x] for x in langs):
            return logs([words[x] for x in langs], word)
        for n in range(langid.LONGEST, 0, -1):
            tables = [grams[x, n] for x in langs]
            known = [g for g in langid.grams(word, n) if any(g in t for t in tables)]
            if known:
                return np.mean([logs(tables, g) for g in known], axis=0)
        return np.zeros(len(langs))

    found = []
    for text in texts:
        own = langid.words_of(text or "")
        sums = sum((score(w) for w in own), np.zeros(len(langs)))
        best = int(np.argmax(sums))
        found.append((langs[best], 1 / np.exp(sums - sums[best]).sum()) if own else ("und", 0.0))
    return found


@pytest.mark.parametrize("share", [langid.SHARE, 0.02, 0.9])
def test_languages_do_not_depend_on_what_workers_hold(spark, documents, share, monkeypatch):
    monkeypatch.setattr(langid, "FLUSH", 50)
    rows = [(x.doc_id, (x.text or "")[:400], x.lang) for x in documents.collect()]
    learn = [(t, lang) for i, t, lang in rows if i % 3 and lang]
    extra = ["zzyzx qqqq", "\u4e2d\u6587 x", "", None, "Stationen und Nationen", "12 !", "zzyzx qqqq"]
    texts = [t for i, t, _ in rows if i % 3 == 0][:40] + extra
    model = langid.LanguageModel(spark.createDataFrame(learn, "text string, lang string"), share=share)
    asked = spark.createDataFrame(list(enumerate(texts)), "i long, text string").withColumn("row", F.lit(1))
    got = {x.row.i: x.found for x in model.identify(asked, F.struct("i", F.lit(None).cast("long").alias("none")), F.col("text")).collect()}
    for i, (lang, score) in enumerate(brute_languages(learn, texts)):
        assert got[i].score == pytest.approx(score, abs=1e-9)
        assert got[i].lang_pred == lang or abs(score - 1 / 4) < 1e-9


def test_encoder_holds_the_stretches_of_few_bytes(spark, tmp_path, monkeypatch):
    """No task cuts more than a megabyte of texts, or one text, at once, and it gives back what it freed."""
    rows = [(i, f"{i} words of their own " * 400 if i % 100 else None) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    size = sum(len(text or "") for _, text in rows)
    assert size > 4 << 20
    notes, encode = str(tmp_path / "notes"), bpe.Codec.encode

    class Noted(bpe.Codec):
        def encode(self, texts):
            with open(notes, "a") as out:
                print(sum(map(len, texts)), file=out)
            return encode(self, texts)

    def back():
        with open(notes, "a") as out:
            print("back", file=out)

    monkeypatch.setattr(bpe, "Codec", Noted)
    monkeypatch.setattr(bpe, "give_back", back)
    encoded = bpe.encode_texts(docs, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    found = {x.doc_id: bytes(x.decoded) for x in encoded.collect()}
    assert found == {i: (text or "").encode() for i, text in rows}
    lines = open(notes).read().split()
    assert lines[-1] == "back" and sum(map(int, lines[:-1])) == size
    assert max(map(int, lines[:-1])) <= 1 << 20


def test_identify_of_odd_rows(spark, odd, nothing):
    many = odd.unionByName(spark.createDataFrame([(None, "Le chat unique", "fr", "c", 0.0, "")] * 30, odd.schema))
    model = langid.LanguageModel(many, share=0.2)
    found = model.identify(many, F.struct("doc_id", "text"), F.col("text")).collect()
    assert sorted(str((x.row.doc_id, x.row.text)) for x in found) == sorted(str((x.doc_id, x.text)) for x in many.collect())
    for x in found:
        letters = any(c.isalpha() for c in x.row.text or "")
        assert (x.found.lang_pred == "und") == (not letters) and 0 <= x.found.score <= 1
    assert model.identify(nothing, F.col("doc_id"), F.col("text")).count() == 0
    bare = langid.LanguageModel(nothing).identify(odd, F.col("doc_id"), F.col("text")).collect()
    assert len(bare) == odd.count() and {tuple(x.found) for x in bare} == {("und", 0.0)}


def test_counts_below_the_share_count(spark):
    rows = [("both " * 6 + "only " * 2 + "filler " * 12, "a"), ("both " * 5 + "other " * 3 + "filler " * 13, "b")]
    df = spark.createDataFrame(rows, "text string, lang string")
    texts = [("both",), ("only only",), ("other both",), ("both",), ("filler only other",), ("",), (None,)]
    asked = spark.createDataFrame(texts, "text string")
    totals = {"a": 20, "b": 21}
    counts = [Counter(text.split()) for text, _ in rows]
    model = langid.LanguageModel(df, share=0.29)  # "both" is above it in a and below it in b, the rest but "filler" below
    got = {x.text: x.found for x in model.identify(asked, F.col("text"), F.col("text")).withColumnRenamed("row", "text").collect()}
    for (text,) in texts:
        words = (text or "").split()
        sums = [sum(math.log((own[w] + 0.5) / (total + 1)) for w in words) for own, total in zip(counts, totals.values(), strict=True)]
        best = int(np.argmax(sums))
        assert got[text].lang_pred == (("a", "b")[best] if words else "und")
        expected = 1 / sum(math.exp(x - sums[best]) for x in sums) if words else 0.0
        assert got[text].score == pytest.approx(expected, abs=1e-9)


def brute_counts(rows):
    return Counter(w for text in rows for w in [*(text or "").encode().lower().split(), b"\n"])


def check_language_model(docs, found):
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    counts = brute_counts(t for i, t in rows if not held[i])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, text in rows:
        words = [*(text or "").encode().lower().split(), b"\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        expected.append((str(i), held[i], len(words), sum(counts[w] > 0 for w in words), n, round(base, 5)))
    got = [(str(x.doc_id), x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 5)) for x in found]
    assert sorted(got) == sorted(expected)
    return rows


def test_language_model_query(spark, small, documents):
    found = queries.op9_language_model(spark, small).collect()
    check_language_model(documents, found)
    held = [x for x in found if x.held_out]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)


def test_language_model_of_odd_rows(spark, odd, nothing, folder_of):
    found = queries.op9_language_model(spark, folder_of(documents=odd)).collect()
    check_language_model(odd, found)
    assert all(math.isfinite(x.score) and x.score <= 0 for x in found)


def test_language_model_of_nothing(spark, nothing, folder_of):
    assert queries.op9_language_model(spark, folder_of(documents=nothing)).count() == 0


def test_rare_words_are_joined(spark, odd, monkeypatch):
    """With few symbols most words go through the join; base scores stay the same."""
    monkeypatch.setattr(hmm, "SHARE", 12)
    docs = odd.filter("doc_id not in (6, 7)")
    held = queries.remainder(F.col("doc_id"), 7) == 2
    model = hmm.HiddenMarkov(docs, held)
    assert 0 < len(model.often) < model.v
    found = model.scores().collect()
    check_language_model(docs, found)
    # what the words that share a symbol have between them is one
    c = [x.c for x in model.counts.collect() if x.word not in model.often]
    total = sum(x + 1 for x in c) + 1
    assert total == model.rest_n + model.rest_v + 1


def test_language_model_learns_from_every_training_text(spark, documents):
    """The model is that of whole passes from the fixed point; rows with a null id are no other rows."""
    docs = documents.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    held = F.coalesce(F.col("doc_id"), F.lit(0)) % 5 == 4
    model = hmm.HiddenMarkov(docs, held)
    texts = [x.text for x in docs.filter(~held).collect()]
    counts = brute_counts(texts)
    unigram = np.array([1.0] + [counts[x] + 1.0 for x in model.often])
    unigram[0] += sum(counts.values()) - sum(counts[x] for x in model.often)
    unigram /= unigram.sum()
    sequences = [np.array([model.often.get(x, 0) for x in hmm.tokens((t or "").encode())]) for t in texts]
    expected = hmm.starting_point(unigram)
    for _ in range(hmm.ITERATIONS):
        single = [x.astype(np.float32) for x in expected]
        expected = hmm.improved(*hmm.Packed(sequences).expected(*single), unigram)
    for found, own in zip(model.model, expected, strict=True):
        assert found == pytest.approx(own, rel=0.01, abs=1e-5)


def test_forward_and_expected_counts_against_enumeration():
    random_ = np.random.default_rng(0)
    k, m = 3, 4
    start, move, emit = random_.random(k), random_.random((k, k)), random_.random((m, k))
    start, move, emit = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)
    sequences = [random_.integers(0, m, n) for n in (1, 4, 3, 5)]
    packed = hmm.Packed(sequences)
    logs = packed.forward(start, move, emit)[2]
    firsts, moves, counts = np.zeros(k), np.zeros((k, k)), np.zeros((m, k))
    for own, log in zip(sequences, logs, strict=True):
        total, paths = 0.0, []
        for path in np.ndindex(*[k] * len(own)):
            p = start[path[0]] * emit[own[0], path[0]]
            for a, b, symbol in zip(path, path[1:], own[1:], strict=False):
                p *= move[a, b] * emit[symbol, b]
            total += p
            paths.append((path, p))
        assert log == pytest.approx(math.log10(total))
        for path, p in paths:
            firsts[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                moves[a, b] += p / total
            for state, symbol in zip(path, own, strict=True):
                counts[symbol, state] += p / total
    for found, expected in zip(packed.expected(start, move, emit), (firsts, moves, counts), strict=True):
        assert found == pytest.approx(expected)


def test_toxicity_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.op4_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) for x in rows)
    marks = {x.doc_id: x.toxic for x in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(marks[x.doc_id], x.predicted) for x in rows if x.held_out and x.doc_id in marks]
    hit = sum(a and b for a, b in held)
    assert hit / sum(a for a, _ in held) > 0.9
    assert hit / max(1, sum(b for _, b in held)) > 0.9


def test_words_are_scored_many_at_once(monkeypatch):
    """A word never seen has the mean of its known n-grams of the longest length that has any."""
    random.seed(4)
    letters = "abcé漢\U00020000"
    index, n = [{} for _ in range(langid.LONGEST + 1)], 0
    for length, own in enumerate(index):
        for _ in range(40):
            word = "".join(random.choices(letters, k=random.randint(1, 8)))
            gram = word if length == 0 else random.choice(langid.grams(word * 3, length))
            if gram not in own:
                own[gram], n = n, n + 1
    logs = np.random.default_rng(0).random((n, 3))
    words = ["".join(random.choices(letters + "xyz", k=random.randint(1, 9))) for _ in range(3000)] + [*index[0], "zzz"]
    expected = []
    for word in words:
        own = [index[0][word]] if word in index[0] else []
        for length in range(langid.LONGEST, 0, -1):
            own = own or [index[length][x] for x in langid.grams(word, length) if x in index[length]]
        expected.append(np.add.reduce(logs[own], axis=0) / len(own) if own else np.zeros(3))
    monkeypatch.setattr(langid, "grams", None)  # no word is cut by itself
    scorer = langid.WordScorer(index, logs)
    for step in (1, 7, 1 << 15):
        assert scorer.vectors(words, step) == pytest.approx(np.array(expected))
    assert scorer.vectors([]).shape == (0, 3)
    assert langid.WordScorer([{} for _ in index], np.zeros((0, 2))).vectors(["a", ""]).tolist() == [[0, 0], [0, 0]]


def test_a_text_is_cut_once_for_all_networks(monkeypatch):
    counted = []
    count = toxicity.texts_with
    monkeypatch.setattr(toxicity, "texts_with", lambda *x: counted.append(count(*x)) or counted[-1])
    marks, parts = np.array([1, 0, 1, 0, 1, 0]), np.array([0, 0, 1, 1, 2, 2])
    texts = [["bad", "x"], ["good", "x"], ["bad", "bad"], ["good"], ["bad", "y"], []]
    scorer = langid.WordScorer([{} for _ in range(langid.LONGEST + 1)], np.zeros((0, 1)))
    network, logits, _ = toxicity.fit(texts, marks, parts, [], scorer)
    assert len(counted) == 1 and np.isfinite(logits).all()
    bucket = toxicity.Features(["bad"]).buckets[0]
    assert counted[0][:, :, bucket].tolist() == [[0, 1], [0, 1], [0, 1]]


def test_thresholds_come_of_all_labelled_rows(spark, monkeypatch):
    counted, held = [], []
    count, choose = toxicity.ToxicityModel._counted, toxicity.thresholds

    def own_count(self, spark, rows):
        counted.append(rows.count())
        return count(self, spark, rows)

    def own_choose(names, logits, labels, sizes):
        held.append((sizes.sum(), (labels * sizes).sum()))
        return choose(names, logits, labels, sizes)

    monkeypatch.setattr(toxicity.ToxicityModel, "_counted", own_count)
    monkeypatch.setattr(toxicity, "thresholds", own_choose)
    rows = [(i, f"{'vile' if i % 40 == 0 else 'good'} word {i % 7} here", "en", int(i % 40 == 0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, label int")
    model = toxicity.ToxicityModel(df, df.select("doc_id", "label"), sample_rows=30)
    assert held == [(2000, 50)] and counted[0] > 1900
    assert sum(model.language.word_totals.values()) == 2000 * 3
    found = df.select("label", (model.score(F.col("text")) >= 0.7).cast("int").alias("p"))
    assert found.filter("label <> p").count() == 0


def test_one_id_on_very_many_rows(spark):
    """The sample has one text an id; of conflicting labels the highest holds; two runs agree."""
    rows = [(i, f"{'vile' if i % 2 else 'good'} word {i % 7} here", "en", i % 2) for i in range(200)]
    rows += [(7, f"vile copy {i} here", "en", 1) for i in range(3000)] + [(None, "vile word", "en", 1)] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, label int").repartition(5, "text")
    more = spark.createDataFrame([(8, 1), (8, 0), (9, None), (11, 0)], "doc_id long, label int")
    labels = df.select("doc_id", "label").unionByName(more)
    found = []
    for _ in range(2):
        model = toxicity.ToxicityModel(df, labels, sample_rows=1000)
        sample = {x.doc_id: x.label for x in model.sample.collect()}
        assert len(sample) == model.sample.count() == 200 and sample[8] == sample[11] == 1 and sample[10] == 0
        found.append(sorted(map(str, model.scores().collect())))
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_weighted_threshold():
    logits, labels = np.array([0.0, 1.0, 2.0, 3.0]), np.array([0, 1, 0, 1])
    assert toxicity.best_threshold(logits, labels) == 0.5
    assert toxicity.best_threshold(logits, labels, np.array([1, 1, 1000, 10])) == 2.5


def test_toxicity_without_labels(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, label int")
    model = toxicity.ToxicityModel(odd, none)
    assert {x[0] for x in odd.select(model.score(F.col("text"))).collect()} == {0.0}
    some = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (8, 0), (4, None), (9, 0), (5, 0)], "doc_id long, label int")
    scores = [x[0] for x in odd.select(toxicity.ToxicityModel(odd, some).score(F.col("text"))).collect()]
    assert len(scores) == odd.count() and all(0 <= x <= 1 for x in scores)
    assert nothing.select(toxicity.ToxicityModel(nothing, none).score(F.col("text"))).count() == 0
