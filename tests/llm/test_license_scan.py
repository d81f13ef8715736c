"""Notice search against all word-bounded spans by edit distance, and base places by counting."""

import random
import re

import pytest
from brute import corpus, table

from tableops.llm.license_scan import BASE, NOTICES, Notice, allowed_errors, pieces, scan_notices, scanner

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, (text or "").translate(LOWER))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def base(text):
    w, found = words(text), []
    for notice in BASE:
        p = notice.phrase.split(" ")
        found += [(i, notice.label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return w, found


def near(text, notices=NOTICES):
    """Labels of all spans of whole words within the allowed distance."""
    w, labels = words(text), set()
    for n in notices:
        size, k = len(n.phrase), allowed_errors(n.phrase)
        for i in range(len(w)):
            for j in range(i + 1, len(w) + 1):
                span = " ".join(w[i:j])
                if len(span) > size + k:
                    break
                if len(span) >= size - k and distance(span, n.phrase) <= k:
                    labels.add(n.label)
    return labels


def damaged(r, phrase, errors):
    letters = list(phrase)
    for _ in range(errors):
        i = r.randrange(len(letters))
        letters[i : i + r.choice([0, 1, 1])] = r.choice(["", "é", "x", " ", "-", "日"])
    return "".join(letters)


def texts(seed, n):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        parts = [r.choice(["it", "The", "été", "licence", "license", "mit", "cc", "by", "by-nc", "apache", "gnu", "日本", "(c)", "2.0"]) for _ in range(r.randrange(12))]
        for _ in range(r.randrange(3)):
            notice = r.choice(NOTICES).phrase
            parts.insert(r.randrange(len(parts) + 1), damaged(r, r.choice([notice, notice.upper(), notice.title()]), r.choice([0, 0, 1, 1, 2, 3, 4])))
        rows.append(r.choice([" ", "\n", "-", ", "]).join(parts))
    return rows


def test_pieces():
    for n in NOTICES:
        k = allowed_errors(n.phrase)
        cut = pieces(n.phrase, k)
        assert len(cut) == k + 1 and "".join(p for _, p in cut) == n.phrase
        assert all(n.phrase[o:].startswith(p) for o, p in cut)


def test_scan(spark):
    rows = list(enumerate(texts(1, 700))) + [(i + 5000, t) for i, t in corpus(2, 40)]
    rows += [(9, "MIT License, mit-license"), (9, "MIT License, mit-license"), (None, "CC BY-NC 4.0"), (10, "xmit license mit licensey")]
    rows += [(11, "é" * 50_000 + " mit licénse " + "icense" * 20_000), (12, "cc by " * 30_000), (13, "permit license"), (14, "mit\n\nlicense")]
    docs = table(spark, rows).selectExpr("*", "1 AS n_words", "'x' AS labels", "2 AS spans")
    found = scan_notices(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, text in dict(rows).items():
        got, (w, places) = by_id[i], base(text)
        at = [p for p, _ in places]
        assert (got.n_words, got.n_base, got.first_word, got.last_word) == (len(w), len(places), min(at, default=None), max(at, default=None))
        assert got.base_labels == sorted({label for _, label in places})
        if len(text or "") < 5000:
            assert got.labels == sorted(near(text) | set(got.base_labels)), text
        assert got.score == (1 if places else max([1 - s.errors / len(s.notice) for s in got.spans], default=0))
        for s in got.spans:
            span = " ".join(words(text[s.start : s.end]))
            assert distance(span, s.notice) <= s.errors <= allowed_errors(s.notice)
            assert s.label in got.labels
            assert not re.fullmatch(WORD, text[s.start - 1 : s.start].translate(LOWER)) and not re.fullmatch(WORD, text[s.end : s.end + 1].translate(LOWER))
    assert by_id[11].labels == ["mit"] and by_id[10].labels == ["mit"] and by_id[None].labels == ["cc-by", "cc-by-nc"]
    assert scan_notices(table(spark, [])).collect() == []


def test_own_notices(spark):
    mine = [Notice("all rights reserved by the author", "closed")]
    found = scan_notices(table(spark, [(1, "All right reserved by teh Author."), (2, "all rights")]), mine).collect()
    assert [(r.labels, r.n_base) for r in found] == [(["closed"], 0), ([], 0)]
    assert found[0].spans[0].start == 0 and found[0].spans[0].end == 32
    with pytest.raises(ValueError):
        scanner((Notice("é b", "x"),))
