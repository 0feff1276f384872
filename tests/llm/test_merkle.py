"""The Merkle manifest against one built on lists, level by level."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ridgeworks.llm import merkle, queries


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row, change=lambda x: x):
    values = [row[x] for x in merkle.FIELDS]
    values[-1] = None if values[-1] is None else change(values[-1])
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in values))


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_path(levels, place):
    path = []
    for nodes in levels[:-1]:
        first = place // 3 * 3
        path.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + 3])))
        place //= 3
    return path


def brute_rows(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    sources = sorted(by_source, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for source in sources:
        mine = by_source[source]
        mine.sort(key=lambda x: (x["doc_id"] is not None, x["doc_id"] or 0, brute_leaf(x)))
        trees[source] = brute_levels([brute_leaf(x) for x in mine])
    top = brute_levels([trees[x][-1][0] for x in sources])
    found = []
    for seat, source in enumerate(sources):
        for place, row in enumerate(by_source[source]):
            path = brute_path(trees[source], place) + brute_path(top, seat)
            id_text = "" if row["doc_id"] is None else str(row["doc_id"])
            even = zlib.crc32(id_text.encode()) % 2 == 0
            done = brute_leaf(row, lambda x: x.replace("\n", "")) if even else brute_leaf(row)
            for before, after in path:
                done = digest(before + done + after)
            proof = digest("".join(a + b for a, b in path))
            found.append((row["doc_id"], brute_leaf(row), trees[source][-1][0], top[-1][0], proof, done, done == top[-1][0]))
    return sorted(found, key=str)


@pytest.fixture
def odd_docs(odd):
    more = odd.withColumn("n_chars", F.length("text").cast("long"))
    lines = more.withColumn("text", F.concat("text", F.lit("\nline\n"))).withColumn("source", F.lit(""))
    return more.unionByName(lines).unionByName(lines).unionByName(more.filter("doc_id = 6").withColumn("source", F.lit("only")))


def test_odd_rows(spark, odd_docs, folder_of):
    rows = [x.asDict() for x in odd_docs.collect()]
    got = queries.op11_merkle_manifest(spark, folder_of(documents=odd_docs)).collect()
    assert sorted(map(tuple, got), key=str) == brute_rows(rows)


@pytest.mark.parametrize("steps", [1, 2, 4])
def test_stored_levels_do_not_matter(spark, steps):
    df = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), (F.col("id") % 40).cast("string"))).alias("source"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(1).cast("long").alias("n_chars"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
    )
    made = merkle.Manifest(df, steps=steps)
    assert len(made.sources.bands) == {1: 5, 2: 3, 4: 2}[steps]
    found = made.proofs().withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    expected = {x[0]: x for x in brute_rows([x.asDict() for x in df.collect()])}
    assert len(found) == 300 and {x.folded for x in found} == {made.root().first().root}
    for row in found:
        assert (row.leaf, row.subroot, row.root) == expected[row.id][1:4]
        assert digest("".join(a + b for a, b in row.path)) == expected[row.id][4]
    subroots = {x.source: x.subroot for x in made.subroots().collect()}
    assert len(subroots) == 1 + len({x.source for x in df.collect() if x.source}) and None in subroots


def test_repeated_rows_and_no_rows(spark, nothing):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(None, "same", None, "a", 4)] * 100 + [(1, "x", "en", None, 1)], columns)
    found = merkle.Manifest(df).proofs()
    assert found.count() == 101
    places = [x.idx for x in found.filter("source = 'a'").collect()]
    assert sorted(places) == list(range(100))
    assert found.filter(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    empty = merkle.Manifest(nothing.withColumn("n_chars", F.lit(0)))
    assert empty.root().count() == 0 and empty.proofs().count() == 0 and empty.subroots().count() == 0


def test_tampering_is_found(spark, documents):
    made = merkle.Manifest(documents, carry={"other": F.sha2(F.col("text").cast("binary"), 256)})
    row = made.proofs().filter("size(path) > 2").first()
    assert merkle_fold(row.leaf, row.path) == row.root != merkle_fold(row.other, row.path)


def merkle_fold(leaf, path):
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf
