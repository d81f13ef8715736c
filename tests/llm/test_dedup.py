"""Exact and line deduplication against plain Python."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from brute import LOWER, corpus, table

from tableops.llm.exact_dedup import build, exact_duplicates, look_up
from tableops.llm.line_dedup import LineRuns, deduplicate_lines, line_hashes
from tableops.scratch import Tables

SPACE = " \t\n\x0b\x0c\r"


def test_perfect_hash():
    digests = np.random.default_rng(1).integers(0, 2**63, (5000, 4)).astype(np.uint64)
    levels, slots = build(digests)
    assert sorted(slots) == list(range(5000))
    assert (look_up(levels, digests) == slots).all()
    levels, slots = build(digests[:0])
    assert len(slots) == 0 and (look_up(levels, digests) == -1).all()


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return sorted(
        (i, min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids
    )


def test_exact(spark):
    rows = corpus(4, 120) + [(5000 + i, "hot   group") for i in range(60)] + [(7, "hot group"), (7, "hot group")]
    df = table(spark, rows).selectExpr("*", "1 AS digest", "2 AS winner", "3 AS shard")
    got = sorted((*r[:4], r.digest.hex()) for r in exact_duplicates(df).collect())
    assert got == exact(rows)
    assert exact_duplicates(table(spark, [])).collect() == []
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_duplicates(table(spark, [(None, "a"), (3, "a"), (None, "b")])).collect()}
    assert got == {(None, 3, 2), (3, 3, 2), (None, None, 1)}


def lines(rows, least=10):
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    holder = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holder[key(line)] = min(holder.get(key(line), i), i)
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(key(x)) < least or holder[key(x)] == i]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_lines(spark):
    r = random.Random(5)
    pool = ["ÄÖÜ äöü lange Zeile", "short", "exactly10!", "  The Same Line Here\t", "the same line here", "nine char", "", "x" * 5000]
    rows = [(i, "\n".join(r.choice(pool) + r.choice(["", "", f" {i}"]) for _ in range(r.randrange(9)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "the same line here\nthe same line here")] + [(300, "the same line here")] * 2
    df = table(spark, rows).selectExpr("*", "1 AS version", "2 AS pos", "3 AS batch", "4 AS dropped", "5 AS h1")
    for batches, fanout in ((1, 2), (4, 2), (5, 3)):
        got = deduplicate_lines(df, 10, batches, fanout).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
        assert sorted(map(tuple, got)) == lines(rows)
    assert deduplicate_lines(table(spark, [])).collect() == []
    got = deduplicate_lines(table(spark, [(None, "some long line"), (1, "some long line")])).collect()
    assert {(r.doc_id, r.kept_text) for r in got} == {(None, ""), (1, "some long line")}


def test_runs_are_compacted(spark):
    docs = table(spark, [(i, f"a line that is number {i % 7}") for i in range(32)])
    with Tables(spark) as tables:
        runs = LineRuns(tables, fanout=2)
        repeated = [runs.add(line_hashes(docs.where(f"doc_id DIV 4 = {b}"), 10)).count() for b in range(8)]
        assert repeated == [0, 1, 4, 4, 4, 4, 4, 4]
        assert [len(level) for level in runs.levels] == [0, 0, 0, 1]
        assert sum(run.count() for run in runs.runs()) == 7


def test_line_plan_is_native(spark):
    plan = deduplicate_lines(table(spark, [(1, "a line of text")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
