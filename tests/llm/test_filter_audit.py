"""Filter audit against a plain loop over all orders."""

import re
from itertools import permutations

import numpy as np
import pytest
from brute import corpus, table
from pyspark.sql import functions as F

from tableops.llm.filter_audit import audit_documents, audit_filters, gray_walk


def fails(text, earlier):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": earlier,
    }


def brute(rows, labels):
    """rows of (doc_id, text, source); all 120 orders, one filter after the other."""
    big = 1 << 63
    first = {}
    for i, text, _ in rows:
        i = big if i is None else i
        first[text or ""] = min(i, first.get(text or "", big))
    marked = [(source or "", fails(text, (big if i is None else i) > first[text or ""]), i) for i, text, source in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    found = {}
    for part in {m[0] for m in marked}:
        mine = [m for m in marked if m[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[1][f]]
                before, left = left, [m for m in left if not m[1][f]]
                total[f] += len(gone)
                found[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(m[1][f] for m in mine) - len(gone),
                    sum(m[1][f] and sum(m[1].values()) == 1 for m in mine),
                    sum(m[2] in good for m in gone),
                    sum(m[2] in toxic for m in gone),
                ]
                assert len(before) == len(left) + len(gone)
        for key in [k for k in found if k[0] == part]:
            found[key].append(total[key[1][key[2] - 1]])
    return found


def as_dict(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit(spark):
    rows = [(i, t, f"s{(i or 0) % 3}" if i != 6 else None) for i, t in corpus(4, 120)]
    rows += [(None, "no id", "s1"), (None, "no id", "s1"), (5, "two rows", "s2"), (5, "two rows", "s2"), (9, "two rows", "s2")]
    rows += [(2000, "UPPER CASE " * 40, "s0"), (2001, "costs $5 | " + " ".join(map(str, range(80))), "s0"), (2002, "x y " * 100_000, "s0")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 300, 4)] + [(None, 1, 1), (8, 1, None), (8, 0, 1), (5, 1, 1)]
    docs = table(spark, [(i, t, "en", s) for i, t, s in rows]).selectExpr("*", "1 AS part", "true AS first", "'x' AS digest", "2 AS good", "3 AS A")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'y' AS text", "1 AS source")
    assert as_dict(audit_documents(docs, marks)) == brute(rows, labels)


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_documents(table(spark, []), labels).collect() == []
    assert len(audit_documents(table(spark, [(1, None)]), labels).collect()) == 600


def test_other_filters(spark):
    rows = spark.range(100).selectExpr("id", "CAST(NULL AS STRING) AS part")
    found = audit_filters(rows, F.col("part"), {"x": F.col("id") % 2 == 0, "y": F.col("id") < 10}, {"lost": F.col("id") == 2})
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.lost, r.shapley) for r in found.collect()}
    assert got == {
        ("", "xy", 1): (50, 50, 0, 45, 1, 95),
        ("", "xy", 2): (45, 5, 5, 5, 0, 15),
        ("", "yx", 1): (90, 10, 0, 5, 1, 15),
        ("", "yx", 2): (45, 45, 5, 45, 0, 95),
    }
    with pytest.raises(ValueError):
        audit_filters(rows, F.col("part"), {}, {})


def test_walk():
    cells = np.random.default_rng(1).integers(0, 9, (32, 3))
    states = gray_walk(cells)
    for active in range(32):
        assert (states[active] == sum((cells[c] for c in range(32) if not c & active), np.zeros(3, int))).all()
