"""Vector packing: limits, gapless sequences, checksums and padding."""

import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
from brute import corpus, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tableops.llm.packing import cut_pieces, load, pack, pack_documents, pack_parts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(" ab\n\t\r\x0b\xa0 é日1'.,s<|endoftext>", max_size=40))
def test_same_ids(text):
    for t in (text, text + "<|endoftext|>" + text):
        ids = LIBRARY.encode(t, add_special_tokens=False).ids
        assert load(PATH).encode(t) == array("I", ids).tobytes()


def test_same_ids_with_every_token_and_white_space():
    bpe, tokens = load(PATH), [LIBRARY.id_to_token(i) for i in range(LIBRARY.get_vocab_size())]
    texts = {LIBRARY.decode([i], skip_special_tokens=False) for i, t in enumerate(tokens) if t}
    spaced = [t for t in texts if t != t.strip() or any(c.isspace() for c in t)]
    for t in spaced:
        for around in ("a{} b", "a {}b", "{0} {0}", " {} \xa0 {}", "x\xa0{} {}\n", "{} \xa0 \xa0 {}"):
            text = around.format(t, t)
            assert bpe.encode(text) == array("I", LIBRARY.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)
    several = sorted(texts)
    for low in range(0, len(several), 25):
        for join in (" ", " \xa0 ", "\xa0", "  "):
            text = join.join(several[low : low + 25])
            assert bpe.encode(text) == array("I", LIBRARY.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)
    assert bpe.encode("a \xa0 \xa0 b") == array("I", LIBRARY.encode("a \xa0 \xa0 b", add_special_tokens=False).ids).tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(" \xa0\u2003\u3000\t\n\x85ab", max_size=30))
def test_same_ids_of_white_space(text):
    assert load(PATH).encode(text) == array("I", LIBRARY.encode(text, add_special_tokens=False).ids).tobytes()


@given(st.lists(st.tuples(st.integers(0, 30), st.booleans()), min_size=1, max_size=6), st.integers(1, 20), st.integers(1, 20))
def test_cut(parts, limit, max_loss):
    lengths, bears = [n for n, _ in parts], [b for _, b in parts]
    flags = [b for n, b in parts for _ in range(n)]
    at = 0
    for start, stop, loss in cut_pieces(lengths, bears, limit, max_loss):
        assert start == at < stop and loss == sum(flags[start:stop]) <= max_loss and stop - start <= limit
        assert stop == len(flags) or stop - start == limit or (loss == max_loss and flags[stop])
        at = stop
    assert at == sum(lengths)


def _examples(spark, n):
    rows = [(i, [("the question is long " * (i % 7), False), ("answer " * (1 + i % 5), True)]) for i in range(n)]
    rows += [(None, None), (1, []), (2, [None, (None, True), ("x", None)]), (3, [("a b c " * 400, True), ("d e " * 300, False)])]
    return rows, spark.createDataFrame(rows, "doc_id long, parts array<struct<text:string,loss:boolean>>").selectExpr("*", "'q' AS text", "1 AS loss")


def test_each_limit_binds_alone(spark):
    rows, df = _examples(spark, 300)
    ends = []
    for limits in ({"limit": 200, "max_segments": 1000, "max_loss": 1000}, {"limit": 4096, "max_segments": 5, "max_loss": 4096}, {"limit": 4096, "max_segments": 1000, "max_loss": 60}):
        got = pack_parts(df, PATH, **limits).collect()
        sums = defaultdict(lambda: [0, 0, 0])
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == sums[r.sequence_id][0]
            sums[r.sequence_id] = [a + b for a, b in zip(sums[r.sequence_id], (r.length, 1, r.loss))]
        bounds = [limits["limit"], limits["max_segments"], limits["max_loss"]]
        assert all(a <= b for s in sums.values() for a, b in zip(s, bounds))
        full = [sum(s[k] > 0.9 * bounds[k] for s in sums.values()) for k in range(3)]
        ends.append([f > 0.8 * len(sums) for f in full])
        tokens = 0
        for _, parts in rows:
            made = [LIBRARY.encode(p[0] or "", add_special_tokens=False).ids for p in parts or [] if p]
            tokens += sum(map(len, made)) + 1
        assert sum(r.length for r in got) == tokens
        want = sum(len(LIBRARY.encode(p[0] or "", add_special_tokens=False).ids) for _, parts in rows for p in parts or [] if p and p[1])
        ended = sum(1 for _, parts in rows if not [p for p in parts or [] if p] or [p for p in parts if p][-1][1])
        assert sum(r.loss for r in got) == want + ended
    assert ends == [[True, False, False], [False, True, False], [False, False, True]]


def test_bins_keep_all_limits():
    r = np.random.default_rng(3)
    sizes = np.stack([r.integers(1, 900, 500), np.ones(500, np.int64), r.integers(0, 300, 500)], axis=1)
    capacity = np.array([2048, 5, 700])
    bins = pack(sizes, capacity)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert all((sizes[b].sum(axis=0) <= capacity).all() for b in bins)
    assert len(bins) <= 1.1 * max((sizes.sum(axis=0) / capacity).max(), 1)
    assert pack(sizes[:0], capacity) == []


def test_pieces(spark):
    rows = corpus(6, 150) + [(9, "again"), (9, "again"), (None, "no id"), (2000, "long text here " * 3000)]
    df = table(spark, rows).selectExpr("*", "1 AS part", "2 AS row", "3 AS offset", "4 AS length")
    got = pack_documents(df, PATH, end_id=1, limit=512, max_segments=6).collect()
    want = sorted(array("I", [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 1]).tobytes() for _, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        if r.doc_id != 9:
            by_doc[r.doc_id].append(r)
    texts = dict(rows)
    for i, pieces in by_doc.items():
        ids = array("I", [*LIBRARY.encode(texts[i] or "", add_special_tokens=False).ids, 1]).tobytes()
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) // 4
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[4 * r.start : 4 * at])
        assert at == len(ids) // 4
    assert sum(r.doc_id == 9 for r in got) == sum(i == 9 for i, _ in rows)
    assert sum(r.length for r in got) == sum(len(x) // 4 for x in want)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 512 and len(pieces) <= 6
    assert pack_documents(table(spark, []), PATH).collect() == []
