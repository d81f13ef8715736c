"""N-gram Jaccard join against all pairs."""

import itertools

import numpy as np
import pytest
from brute import components, corpus, shingles, table

from tableops.llm import ngram_join
from tableops.llm.ngram_join import choose_matches, jaccard_components, least_overlap
from tableops.scratch import Tables


def expected(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = components(sets, links)
    return sorted((i, len(sets[i]), root[i]) for i in sets)


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_all_pairs(spark, seed, k, percent):
    rows = corpus(seed)
    got = jaccard_components(table(spark, rows), k, percent).collect()
    assert sorted(map(tuple, got)) == expected(rows, k, percent)


def test_chain_within_large_group(spark):
    base = [f"x{i}" for i in range(200)]
    rows = [(i, " ".join(base[i : i + 100])) for i in range(0, 90, 2)]  # neighbours link, ends do not
    got = jaccard_components(table(spark, rows), 4, 85).collect()
    assert sorted(map(tuple, got)) == expected(rows, 4, 85) and len({r.component_id for r in got}) == 1


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (7, "q r s t u")]
    df = table(spark, rows).selectExpr("*", "1 AS rep", "2 AS token", "3 AS id", "4 AS component", "5 AS n")
    got = sorted(map(tuple, jaccard_components(df, 4, 85).collect()), key=str)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5), (7, 2, 7)], key=str)


def test_empty_table(spark):
    assert jaccard_components(table(spark, [])).collect() == []


def test_longer_prefix_where_postings_are_long():
    rare, common = np.ones(200), np.full(200, 1000.0)
    assert least_overlap(7, 85) == 6
    assert choose_matches(rare, 200, 85) > choose_matches(np.ones(2), 2, 85)
    assert 1 <= choose_matches(common, 200, 85) <= 8


def test_wide_bitmaps_drop_far_pairs_and_keep_near_ones(spark):
    rng = np.random.default_rng(17)
    sets, pairs = [], []
    for n in (1, 5, 300, 511, 520, 2000, 20000):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        for edits in (0, n // 20, n // 12, n // 2, n):  # 12: just linked; 2 and 1: far
            other = np.concatenate([base[edits:], rng.integers(0, 2**63, edits + n // 50).astype(np.uint64)])
            at = 2 * len(pairs)
            sets += [(at, base), (at + 1, other)]
            shared = len(np.intersect1d(base, other))
            pairs.append((at, at + 1, 100 * shared >= 85 * (len(base) + len(other) - shared), n, edits))
    rows = [(i, len(g), ngram_join._parities(g, ngram_join._wide_bits(len(g))).tolist()) for i, g in sets]
    assert {len(x) == len(y) for (_, _, x), (_, _, y) in zip(rows[::2], rows[1::2])} == {True, False}
    with Tables(spark) as tables:
        given = spark.createDataFrame([p[:2] for p in pairs], "a long, b long")
        near = ngram_join._near(given, spark.createDataFrame(rows, "doc_id long, n int, wide array<long>"), 85, tables)
        kept = {r.a for r in near.collect()}
    assert kept >= {a for a, _, linked, _, _ in pairs if linked}
    assert not kept & {a for a, _, _, n, edits in pairs if 300 <= n <= 2000 and edits >= n // 2}


def test_each_posting_is_shuffled_once_and_far_pairs_are_not_read(spark, monkeypatch):
    put, plans, counts = Tables.put, {}, {}

    def kept(self, df, name, **options):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        table = put(self, df, name, **options)
        counts.setdefault(name, table.count())
        return table

    monkeypatch.setattr(Tables, "put", kept)
    # Each two share their rare start only; four documents hold each of the longer ends.
    ends = [" ".join(f"e{i}x{j}" for j in range(300)) for i in range(5)]
    starts = itertools.combinations(range(5), 2)
    texts = [" ".join(f"s{i}{j}x{n}" for n in range(80)) + " " + ends[x] for i, j in starts for x in (i, j)]
    found = jaccard_components(table(spark, list(enumerate(texts))), 4, 85)
    assert {r.component_id for r in found.collect()} == set(range(20))
    assert plans["postings"].count("Exchange hashpartitioning(token") == 1
    assert counts["stars"] > 0 and counts["whole"] == 0
