"""Exact, line and SimHash deduplication against brute force and SQL."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ridgeworks.llm import exact_dedup, queries, simhash
from ridgeworks.llm.components import components
from ridgeworks.llm.line_dedup import drop_boilerplate
from tests.compare import connect, differences


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, small, name):
    assert differences(spark, connect(small), queries.QUERIES[name], queries.ORACLES[name], small) == []


def test_exact_dedup_of_odd_rows(spark, odd):
    found, _ = exact_dedup.deduplicate(odd, exact_dedup.DigestIndex(spark))
    rows = found.collect()
    assert len(rows) == odd.count()
    by_text = {}
    for row in odd.collect():
        by_text.setdefault(row.text or "", []).append(row.doc_id)
    for row in rows:
        ids = next(x for t, x in by_text.items() if hashlib.sha256(t.encode()).digest() == bytes(row.digest))
        assert row.group_size == len(ids)
        assert row.keep_id == max((x for x in ids if x is not None), default=None)
    kept = [(bytes(x.digest), x.doc_id) for x in rows if x.kept]
    assert len(kept) == len({x for x, _ in kept}) == len(by_text)
    stays = exact_dedup.distinct_rows(odd, exact_dedup.DigestIndex(spark))
    assert stays.columns == odd.columns
    assert sorted(x.text or "" for x in stays.collect()) == sorted(by_text)


def test_index_remembers_earlier_batches(spark, odd):
    index = exact_dedup.DigestIndex(spark)
    first, _ = exact_dedup.deduplicate(odd.filter("doc_id <= 3"), index, batch="one")
    first = sorted(map(str, first.collect()))
    size = index.read().count()
    again, _ = exact_dedup.deduplicate(odd.filter("doc_id <= 3"), index, batch="one")
    assert sorted(map(str, again.collect())) == first
    assert index.read().count() == size
    second, winners = exact_dedup.deduplicate(odd, index, batch="two")
    rows = {x.doc_id: x for x in second.collect()}
    assert not rows[1].kept and rows[1].keep_id == 2 and rows[6].kept
    assert index.read().select("digest").distinct().count() == index.read().count() == odd.fillna("").select("text").distinct().count()
    opened = exact_dedup.DigestIndex(spark, path=index.path)
    assert opened.read().count() == index.read().count()


def test_index_is_not_shuffled(spark, odd):
    index = exact_dedup.DigestIndex(spark)
    exact_dedup.deduplicate(odd, index)
    new = spark.range(5).select(exact_dedup.text_digest(F.col("id").cast("string")).alias("digest"))
    plan = new.hint("merge").join(index.read().hint("merge"), "digest", "left_anti")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1


def test_empty_tables(spark, nothing):
    assert exact_dedup.distinct_rows(nothing, exact_dedup.DigestIndex(spark)).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each(nothing).count() == 0
    pages = spark.createDataFrame([], "url string, html string")
    assert drop_boilerplate(pages).count() == 0


def test_line_dedup_of_odd_pages(spark):
    pages = spark.createDataFrame(
        [(i, "http://User@A.org:80/x", f"<p>menu</p><p>menu</p>own {i}<!-- x --><script>no</script>") for i in range(5)]
        + [(9, None, "menu"), (10, "no host", None), (11, "http://a.org/", ""), (11, "http://a.org/", "")],
        "page_id long, url string, html string",
    ).withColumn("host", F.lit("clash"))
    rows = drop_boilerplate(pages, ratio=0.5).select("row.page_id", "host", "n_lines", "n_dropped", "clean_text").collect()
    got = sorted((tuple(x) for x in rows), key=str)
    assert got == sorted(
        [(i, "a.org", 3, 2, f"own {i}") for i in range(5)]
        + [(9, "", 1, 0, "menu"), (10, "", 0, 0, ""), (11, "a.org", 0, 0, ""), (11, "a.org", 0, 0, "")],
        key=str,
    )


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """pairs: (id, fingerprint); all links of at most two bits, closed."""
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [min((p[0] for k, p in enumerate(pairs) if find(k) == find(i) and p[0] is not None), default=None) for i in range(len(pairs))]


def check_simhash(df):
    rows = df.select("doc_id", "text").collect()
    pairs = [(x.doc_id, brute_fingerprint(x.text)) for x in rows]
    expected = sorted(((i, f"{fp:016x}", c) for (i, fp), c in zip(pairs, brute_components(pairs), strict=True)), key=str)
    found = simhash.near_duplicates(df).collect()
    assert sorted(((x.doc_id, f"{x.fp % 2**64:016x}", x.component_id) for x in found), key=str) == expected


def test_simhash_of_odd_rows(odd):
    check_simhash(odd)
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    classes = simhash.near_duplicates(odd).select("component_id").distinct().count()
    assert kept.count() == classes


def test_unlinked_rows_are_kept_whatever_their_ids(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(9)]
    rows = [(None, x) for x in texts[:6]] + [(7, texts[6]), (7, texts[7]), (8, texts[8]), (8, texts[8])]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string")
    kept = simhash.one_of_each(df).collect()
    assert sorted(map(str, kept)) == sorted({str(x) for x in df.collect()})


def test_simhash_of_documents(documents):
    check_simhash(documents)


@pytest.mark.parametrize("crowd", [1, 4, 32])
@pytest.mark.parametrize("max_bits", [1, 2])
def test_links_are_complete(spark, crowd, max_bits):
    random.seed(crowd)
    values = set()
    for _ in range(12):
        centre = random.getrandbits(64)
        for _ in range(25):
            values.add(centre ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 3))))
    values |= {0, 1, 2**63, 2**63 + 1, 2**64 - 1}
    signed = [x - 2**64 if x >= 2**63 else x for x in values]
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = simhash.links(fps, max_bits, crowd)
    for row in edges.collect():
        assert ((row.u ^ row.v) % 2**64).bit_count() <= max_bits
    root = {x.node: x.root for x in components(edges).collect()}
    for a in signed:
        for b in signed:
            if ((a ^ b) % 2**64).bit_count() <= max_bits:
                assert root.get(a, a) == root.get(b, b)


def test_links_refuse_more_bits(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)] + [(7, 7), (300, 301), (301, 300)]
    found = {x.node: x.root for x in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    expected = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 180)} | {301: 300}
    assert found == expected
