"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from ridgeworks.llm import periodic, queries


def brute_runs(words):
    """(start, length, period) of all runs, by comparing the words with themselves for every period."""
    n = len(words)
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=int)
    found = []
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[0], (ids[q:] == ids[:-q]).astype(int), [0]])
        edges = np.flatnonzero(np.diff(same)).reshape(-1, 2)
        for a, b in edges.tolist():
            length = b - a + q
            if length < max(6, 4 * q):
                continue
            piece = ids[a : a + length]
            if any((piece[d:] == piece[:-d]).all() for d in range(1, q)):
                continue
            found.append((a, length, q))
    return sorted(found, key=lambda x: (x[0], x[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    keep = np.ones(n, dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
    kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
    lines = "".join(f"{s},{x},{q}\n" for s, x, q in runs)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)) + tuple(
        hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept)
    )


def local_runs(docs):
    """What the tiles of some documents give, stitched in the test."""
    numbers, _ = periodic.word_numbers([d.encode() for d in docs])
    found = [{} for _ in docs]
    for own, block, first, ids, places, periods in periodic.tiles(numbers):
        for q, a, b in periodic.solve(ids.tolist(), block, places.tolist(), periods.tolist()):
            found[own].setdefault(q, []).append((first + a, first + b))
    runs = []
    for parts in found:
        mine = []
        for q, spans in parts.items():
            spans.sort()
            low, high = spans[0]
            for a, b in [*spans[1:], (1 << 60, 1 << 60)]:
                if a > high:
                    if high - low + q >= max(6, 4 * q):
                        mine.append((low, high - low + q, q))
                    low, high = a, b
                high = max(high, b)
        runs.append(sorted(mine, key=lambda x: (x[0], x[2])))
    return runs


def random_text(rng):
    alphabet = "ab" if rng.random() < 0.5 else "abcdefghij"
    words = []
    for _ in range(rng.randint(0, 6)):
        root = [rng.choice(alphabet) for _ in range(rng.randint(1, rng.choice([3, 12, 90])))]
        words += root * rng.randint(1, 9) + root[: rng.randint(0, len(root))]
    return " ".join(words)


@pytest.mark.parametrize("core", [4, 64, 1024])
def test_tiles_find_every_run(monkeypatch, core):
    monkeypatch.setattr(periodic, "CORE", core)
    monkeypatch.setattr(periodic, "BLOCKS", 1 if core == 4 else 8)
    rng = random.Random(core)
    docs = [random_text(rng) for _ in range(150)]
    nested = " ".join((["a"] * 9 + ["b"]) * 7)
    thue = ["a"]
    for _ in range(9):
        thue += ["b" if x == "a" else "a" for x in thue]
    docs += [nested, "a " * 3000, "a b " * 1500, " ".join(thue), nested + " " + nested + " a", "", "a", "a a a a a", "a a a a a a"]
    for doc, found in zip(docs, local_runs(docs), strict=True):
        assert found == brute_runs(doc.split()), doc[:200]


def test_pieces_cut_at_white_space():
    text = b"one two\tthree  four\nfive" * 40
    for size in (1, 5, 64, 10**6):
        assert [w for p in periodic.pieces(text, size) for w in p.split()] == text.split()


def query_rows(spark, df, folder_of):
    return sorted(map(tuple, queries.op13_periodic_runs(spark, folder_of(documents=df)).collect()), key=str)


def test_odd_rows(spark, odd, folder_of):
    rows = [(i, "x y z " * i, "en", "a", 0.0, "") for i in range(40)]
    rows += [(None, "a b " * 50, "en", "a", 0.0, "")] * 3 + [(None, None, None, None, None, None)]
    df = odd.unionByName(spark.createDataFrame(rows, odd.schema))
    expected = sorted((brute_row(x.doc_id, x.text) for x in df.collect()), key=str)
    assert query_rows(spark, df, folder_of) == expected


def test_documents(spark, small, documents):
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, small).collect()), key=str)
    assert got == sorted((brute_row(x.doc_id, x.text) for x in documents.collect()), key=str)
    assert any(x[1] for x in got)


def test_long_text_and_empty_table(spark, nothing):
    rng = random.Random(1)
    root = [f"w{rng.randint(0, 500)}" for _ in range(3001)]
    words = [f"v{i}" for i in range(777)] + root * 9 + ["end"]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "same " * 40000)], "doc_id long, text string")
    found = {x.doc_id: x for x in periodic.periodic_runs(df).collect()}
    assert [tuple(x) for x in found[1].runs] == [(777, 3001, 27009)]
    assert found[1].collapsed.split() == words[: 777 + 3001] + ["end"]
    assert [tuple(x) for x in found[2].runs] == [(0, 1, 40000)] and found[2].collapsed == "same"
    assert periodic.periodic_runs(nothing).count() == 0
