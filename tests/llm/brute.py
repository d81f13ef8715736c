"""Plain Python versions of the operators' contracts, and small awkward tables."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def table(spark, rows):
    """documents with the given (doc_id, text) rows, or longer ones."""
    full = [(*r, *(None, None, len(r[1] or ""))[len(r) - 2 :])[:5] for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def words(text):
    return [w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def shingles(text, k):
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def corpus(seed=0, n=60):
    """Random texts with exact copies, near copies of several degrees, shared passages, awkward ones and hot lines."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünder", "naïve", "日本", "é", "THE", "the"]
    rows, texts = [], []
    passage = " ".join(r.choice(vocabulary) for _ in range(70))
    for i in range(n):
        kind = r.random()
        w = [r.choice(vocabulary) for _ in range(r.choice([1, 3, 5, 40, 120, 300]))]
        if texts and kind < 0.2:
            text = r.choice(texts)
        elif texts and kind < 0.55:
            w = r.choice(texts).split(" ")
            for _ in range(r.choice([1, 1, 2, 4, 9])):
                j = r.randrange(len(w))
                w[j : j + r.choice([0, 1])] = [r.choice(vocabulary)]
            text = " ".join(w)
        else:
            lines = [w[j : j + 11] for j in range(0, len(w), 11)]
            text = "\n".join(" ".join(x) for x in lines)
            if kind < 0.75:
                text += "\n" + passage
            if kind > 0.8:
                text = "All rights are reserved here.\n" + text
        texts.append(text)
        rows.append((i * 3, text))
    return rows + [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "One two"), (1004, "one  TWO\x0b"), (1005, "a b \x1c c")]
