"""Fingerprints, next documents and the search within a Hamming radius, against plain Python."""

import hashlib
import random
import re

from brute import components, corpus, table

from tableops.llm.simhash import compare_edited, fingerprints, hamming_components, with_next, within_radius
from tableops.scratch import Tables


def edited(rows):
    rows = sorted(rows)
    out = {}
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        t, following = t or "", following or ""
        q = len(t) // 4
        e = t[: len(t) - q] + following[:q]
        out[i] = len(t), hashlib.sha256(e.encode()).hexdigest(), e, following
    return out


def test_contract(spark):
    rows = corpus(7, 90)
    df = table(spark, rows).selectExpr("*", "1 AS fingerprint", "2 AS which", "3 AS version", "4 AS chunk")
    got = {r.doc_id: r for r in compare_edited(df).collect()}
    want = edited(rows)
    assert set(got) == set(want)
    texts = {t for _, t in rows} | {w[2] for w in want.values()}
    prints = fingerprints(spark.createDataFrame([(t or "",) for t in texts], "text string").distinct(), ["text"]).collect()
    prints = {r.text: r.fingerprint & (1 << 64) - 1 for r in prints}
    for i, t in rows:
        n_chars, sha, e, following = want[i]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n_chars, sha)
        own = prints[t or ""]
        assert r.fingerprint == f"{own:016x}" and r.edited_fingerprint == f"{prints[e]:016x}"
        assert r.near_edited == 1 - (own ^ prints[e]).bit_count() / 64
        assert r.near_next == 1 - (own ^ prints[following]).bit_count() / 64


def test_votes(spark):
    text = "One two three two three four"
    words = text.lower().split()
    terms = [f"{a} {b}" for a, b in zip(words, words[1:])]
    hashes = spark.createDataFrame([(t,) for t in terms], "t string").selectExpr("t", "xxhash64(t) h").collect()
    votes = [sum((1 if r.h >> k & 1 else -1) * len(r.t) for r in hashes) for k in range(64)]
    want = sum((v > 0) << k for k, v in enumerate(votes))
    got = fingerprints(spark.createDataFrame([(1, text)], "k int, text string"), ["k"]).first().fingerprint
    assert got & (1 << 64) - 1 == want


def test_edges(spark):
    assert compare_edited(table(spark, [])).collect() == []
    alone = compare_edited(table(spark, [(3, "a b c d e f g h")])).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"a b c d e f a b").hexdigest()
    rows = [(1, "x y"), (1, "x y"), (1, "x y"), (None, "z"), (2, None)]
    got = compare_edited(table(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 3), (1, 3), (1, 3), (2, 0)]


def test_next_across_ranges(spark):
    ids = sorted(random.Random(2).sample(range(10**12), 300))
    df = table(spark, [(i, f"text {i}") for i in ids]).repartition(5)
    got = {r.doc_id: (r.next_id, r.next_text) for r in with_next(df.select("doc_id", "text"), 16).collect()}
    assert got == {a: (b, f"text {b}") for a, b in zip(ids, ids[1:] + ids[:1])}


def clusters(seed):
    r = random.Random(seed)
    values = set()
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 5, 25])):
            values.add(x)
            for _ in range(r.randrange(4)):
                x ^= 1 << r.randrange(64)
    return sorted(v - (1 << 64) if v >> 63 else v for v in values)


def test_radius_and_components(spark):
    for seed in (1, 2):
        values = clusters(seed)
        df = spark.createDataFrame([(v,) for v in values] * 2, "fingerprint long")
        pairs = {(a, b) for a in values for b in values if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
        assert {tuple(r) for r in within_radius(df, df).collect()} == pairs
        with Tables(spark) as tables:
            got = {r.id: r.component for r in hamming_components(df, tables).collect()}
        want = components(values, pairs)
        assert {v: got.get(v, v) for v in values} == want


def test_plan_is_native(spark):
    plan = compare_edited(table(spark, [(1, "a b"), (2, "c d")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
