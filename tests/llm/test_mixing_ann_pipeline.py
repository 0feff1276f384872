"""Mixing, nearest neighbours and the pipeline against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridgeworks.llm import ann, mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """source -> target by the contract: weights 3, 1, 2 in turn, 150 % of all, at most twice the size."""
    names = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [None] * (None in sizes)
    weights = {x: (3, 1, 2)[i % 3] for i, x in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [x for x in names if x not in full]
        level = (total - sum(2 * sizes[x] for x in full)) / max(1, sum(weights[x] for x in free))
        more = {x for x in free if weights[x] * level > 2 * sizes[x]}
        if not more:
            return {x: 2 * sizes[x] if x in full else weights[x] * level for x in names}
        full |= more


def check_mix(df, rows, block):
    size_of = {}
    for row in df.collect():
        size_of[row.source] = size_of.get(row.source, 0) + len(WORD.findall(row.text or ""))
    expected = targets(size_of)
    taken = {}
    for row in rows:
        assert row.source_size == size_of[row.source]
        assert row.target == pytest.approx(expected[row.source])
        assert 0 <= row.taken <= 2 * row.size
        taken[row.source] = taken.get(row.source, 0) + row.taken
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 2 * block
    assert sorted(x.size for x in rows) == sorted(len(WORD.findall(x.text or "")) for x in df.collect())


def test_mix_of_documents(documents):
    rows = mixing.Mix(documents).taken().collect()
    check_mix(documents, rows, mixing.BLOCK)
    again = mixing.Mix(documents.repartition(7)).taken().collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mix_of_odd_rows(odd, nothing, spark, folder_of):
    check_mix(odd, mixing.Mix(odd, block=16).taken().collect(), 16)
    assert mixing.Mix(nothing).taken().count() == 0
    assert mixing.Mix(nothing).texts().count() == 0
    assert queries.op7_mixing(spark, folder_of(documents=odd)).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_layout_of_null_ids_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 50)
    rows = [(None, f"word{i} is one of many", "a") for i in range(400)] + [(7, "the same five words again", "a")] * 400
    rows += [(i, f"text {i}", "b") for i in range(100, 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.Mix(df, block=16)
    check_mix(df, mix.taken().collect(), 16)
    # every source is covered end to end, without gaps or overlaps
    for rank in (row.rank for row in mix.sources.collect()):
        spans = sorted((x.start, x.start + x.size) for x in mix.rows.filter(F.col("rank") == rank).collect())
        assert spans[0][0] == 0
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sum(len(WORD.findall(x.text)) for x in mix.texts().collect()) == sum(x.taken for x in mix.taken().collect())


def test_blocks_and_texts_hold_what_is_taken(odd, documents):
    for df, block in ((odd, 16), (documents, 64)):
        mix = mixing.Mix(df, block=block)
        taken = sum(x.taken for x in mix.taken().collect())
        assert sum(x.high - x.low for x in mix.blocks().collect()) == taken
        texts = mix.texts()
        assert texts.columns == df.columns
        rows = texts.collect()
        assert sum(len(WORD.findall(x.text)) for x in rows) == taken
        whole = {}
        for x in df.collect():
            whole.setdefault(x.doc_id, []).append(x.text or "")
        assert all(any(x.text in text for text in whole[x.doc_id]) for x in rows)


def test_stretches():
    text = " a  b c\td e "
    parts = [dict(low=0, high=2, times=1), dict(low=2, high=4, times=2), dict(low=4, high=5, times=1)]
    assert mixing.stretches(text, parts) == [text, "c\td "]
    assert mixing.stretches(text, parts[1:]) == ["c\td e ", "c\td "]


def test_shard_counts_add_up():
    slots = np.array([1000, 0, 37, 5], dtype=np.int64)
    for shards in (1, 2, 7):
        found = [mixing.shard_counts(slots, shards, s) for s in range(shards)]
        assert sum(c for _, c in found).tolist() == slots.tolist()
        before = np.zeros_like(slots)
        for first, counts in found:
            assert first.tolist() == before.tolist()
            before += counts
        sizes = [int(c.sum()) for _, c in found]
        assert max(sizes) - min(sizes) <= shards


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 5000])
def test_permutation(n):
    found = mixing.permuted(np.arange(n), n, 12345)
    assert sorted(found.tolist()) == list(range(n))
    assert n < 10 or found.tolist() != list(range(n))


def exact(ids, x, queries_, nearest):
    out = {}
    for i in np.flatnonzero(queries_):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        best = sorted((d[j], ids[j]) for j in range(len(ids)) if ids[j] != ids[i])[:nearest]
        out[ids[i]] = best
    return out


def test_recall_against_brute_force(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids = [x.vec_id for x in rows]
    x = np.array([x.embedding for x in rows], dtype=float)
    best = exact(ids, x, np.array(ids) % 100 == 0, 10)
    found = {}
    for row in queries.op1_nearest_neighbours(spark, folder).collect():
        found.setdefault(row.query_id, []).append(row)
    hits = 0
    for query, rows_ in found.items():
        rows_.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows_] == list(range(1, len(rows_) + 1))
        assert [(r.score, r.vec_id) for r in rows_] == sorted((r.score, r.vec_id) for r in rows_)
        hits += len({r.vec_id for r in rows_} & {i for _, i in best[query]})
        for r in rows_:
            assert r.score == pytest.approx(np.sqrt(((x[ids.index(query)] - x[ids.index(r.vec_id)]) ** 2).sum()), abs=1e-12)
    assert hits / sum(len(v) for v in best.values()) >= 0.9


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 4)
    monkeypatch.setattr(ann, "QUERIES", 1)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, None), (2, [0.0, 0.0, 0.0]), (3, [nan, 1.0, 0.0]), (4, [inf, 0.0, 1.0])]
    rows += [(5, [1.0, None, 0.0]), (6, []), (7, [1.0, 2.0])] + [(100 + i, [1.0, 0.0, 0.0]) for i in range(30)]
    rows += [(200, [1.0, 0.1, 0.0]), (200, [1.0, 0.1, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1))
    found = ann.search(df, F.col("vec_id") % 100 == 0, probes=6, tables=2).collect()
    by = {}
    for row in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert set(by) == {0, 100, 200}
    assert by[0] == [(100 + i, 0.0) for i in range(10)]
    assert by[100] == [(0, 0.0)] + [(101 + i, 0.0) for i in range(9)]
    assert [i for i, _ in by[200]] == [0] + [100 + i for i in range(9)]
    assert ann.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_queries_find_all_there_is_to_find(spark):
    random = np.random.default_rng(1)
    few = [(100 * i, random.normal(size=64).tolist()) for i in range(8)]
    cone = np.zeros(32)
    cone[0] = 1.0
    many = [(1 + i + i // 99, (cone + random.normal(size=32) * 0.01).tolist()) for i in range(500)]
    df = spark.createDataFrame([*few, *many, (10_000, (-cone).tolist())], "vec_id long, embedding array<double>")
    found = {}
    for row in ann.search(df, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(row.query_id, []).append((row.score, row.vec_id))
    for rows, asked in ((few, [i for i, _ in few]), ([*many, (10_000, (-cone).tolist())], [10_000])):
        ids, x = [i for i, _ in rows], np.array([v for _, v in rows])
        best = exact(ids, x, np.isin(ids, asked), 10)
        for query in asked:
            assert [i for _, i in sorted(found[query])] == [i for _, i in best[query]]


def test_an_id_with_many_rows(spark):
    random = np.random.default_rng(2)
    rows = [(0, [1.0] + [0.0] * 15)] + [(i, [1.0, 0.02 * i] + [0.0] * 14) for i in range(2, 30)]
    same = [(1, [1.0, 0.01] + [0.0] * 14)] * 25
    near = [(1, [1.0, 0.001, *(random.normal(size=14) * 1e-4).tolist()]) for _ in range(25)]
    for repeated in (same, near, same + near):
        df = spark.createDataFrame(rows + repeated, "vec_id long, embedding array<double>")
        found = ann.search(df, F.col("vec_id") == 0).orderBy("rank").collect()
        assert [x.vec_id for x in found] == list(range(1, 11))


def test_pseudo_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 48))
    turned = ann.rotations(x, 3)
    assert turned.shape == (5, 64)
    assert np.linalg.norm(turned, axis=1) == pytest.approx(np.linalg.norm(x, axis=1))


def test_pipeline_stages(spark, small, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, small), name)
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
            assert {x.doc_id for x in kept[name]} <= {x.doc_id for x in before.collect()}
    first = {x.doc_id: x.text for x in documents.collect()}
    lang = {x.doc_id for x in kept["language_id"]}
    assert lang >= {i for i, t in first.items() if any(c.isalpha() for c in t or "")} - {
        i for i in first if i not in lang and len(WORD.findall(first[i] or "")) < 3
    }
    exact_ids = {}
    for i in lang:
        exact_ids[first[i]] = max(i, exact_ids.get(first[i], -1))
    assert sorted(x.doc_id for x in kept["exact_dedup"]) == sorted(exact_ids.values())
    from tests.llm.test_dedup import brute_components, brute_fingerprint

    pairs = [(i, brute_fingerprint(first[i])) for i in exact_ids.values()]
    assert sorted(x.doc_id for x in kept["simhash_near_dedup"]) == sorted(set(brute_components(pairs)))
    mixed = sum(len(WORD.findall(x.text)) for x in kept["mix_sources"])
    total = sum(len(WORD.findall(first[x.doc_id])) for x in kept["simhash_near_dedup"])
    assert mixed == pytest.approx(1.5 * total, rel=0.05)
    assert len(kept["byte_bpe"]) == len(kept["mix_sources"])
    assert all(len(x.ids) == 4 * x.n_tokens for x in kept["byte_bpe"])


def test_pipeline_of_odd_and_no_rows(spark, odd, nothing):
    for df in (odd, nothing):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, ""), name)
        assert df is odd or docs.count() == 0
    assert docs.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_rows_with_a_null_id_take_no_part(spark):
    rows = [(i, [float(i), 1.0, float(i % 3)]) for i in range(30)] + [(None, [float(i), 1.0, 0.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = F.col("vec_id").isNull() | (F.col("vec_id") % 10 == 0)
    found, expected = (sorted(map(tuple, ann.search(x, asked).collect())) for x in (df, df.filter("vec_id IS NOT NULL")))
    assert found == expected and {x[0] for x in found} == {0, 10, 20} and len(found) == 30
