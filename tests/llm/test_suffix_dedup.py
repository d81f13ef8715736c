"""Repeated passages against every window of every document."""

import tracemalloc

import numpy as np
import pyarrow as pa
from brute import corpus, table, words

from tableops.llm.suffix_dedup import _cut, _suffixes, _with_equal_neighbour, drop_repeats, find_repeats, sliding, window_minima


def expected(rows, least):
    first, seen, out = {}, {}, []
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        for s in range(len(w) - least + 1):
            first.setdefault(tuple(w[s : s + least]), (i, s))
    for i, t in rows:
        w = words(t)
        starts = [s for s in range(len(w) - least + 1) if first[tuple(w[s : s + least])] != (i, s)]
        for s in starts:
            kept = first[tuple(w[s : s + least])][0]
            if out and out[-1][0] == i and s <= out[-1][2]:
                out[-1][2] = s + least
            else:
                out.append([i, s, s + least, kept])
    return sorted(map(tuple, out))


def test_all_windows(spark):
    for seed, least in ((1, 50), (2, 20), (3, 50)):
        rows = corpus(seed, 80)
        rows.append((77777, "go " * 400))
        df = table(spark, rows).selectExpr("*", "1 AS head", "2 AS heads", "3 AS version", "4 AS found", "5 AS pos")
        got = sorted(map(tuple, find_repeats(df, least).collect()))
        assert got == expected(rows, least) and len(got) > 5


def test_dropping(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"eins  zwei{i}\n{passage}\tdrei{i} é") for i in range(6)] + [(9, passage), (10, "é " + passage)]
    rows += [(0, None)]
    df = table(spark, rows).selectExpr("*", "1 AS found", "2 AS version")
    got = drop_repeats(df).collect()
    want = {*{(i, f"eins  zwei{i}\ndrei{i} é") for i in range(1, 6)}, (9, ""), (10, "é "), (0, None), (0, rows[0][1])}
    assert {(x.doc_id, x.text) for x in got} == want and len(got) == len(rows)
    assert all(x.n_chars == len(x.text) for x in got if x.text is not None) and got[0].found == 1


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, "short"), (5, long), (5, long), (None, long)]
    got = find_repeats(table(spark, rows)).collect()
    assert [tuple(r) for r in got] == [(None, 0, 80, 5)]
    assert find_repeats(table(spark, [])).collect() == []


def test_minima():
    r = np.random.default_rng(1)
    for n in (0, 5, 34, 35, 36, 200):
        values = r.integers(0, 50, n).astype(np.uint64)
        want = [min(values[i : i + 35]) for i in range(n - 34)]
        assert sliding(values, 35, np.minimum, np.uint64(2**64 - 1)).tolist() == want
    assert len(window_minima(np.arange(49).astype(np.uint64), 50)) == 0


def test_neighbours_across_batches():
    import pyarrow as pa

    heads = [1, 2, 2, 3, 4, 4, 4, 5, 6, 6, 7]
    batches = []
    for cut in ([0, 2, 3, 5, 6, 11], [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11], [0, 11]):
        batches = [
            pa.RecordBatch.from_pydict({"head": heads[a:b], "doc_id": list(range(a, b))}) for a, b in zip(cut, cut[1:])
        ]
        got = {x for b in _with_equal_neighbour(iter(batches)) for x in b.column("doc_id").to_pylist()}
        assert got == {0, 1, 2, 4, 5, 6, 8, 9, 10}


def _peak_mb(run, batches):
    tracemalloc.start()
    for _ in run(iter(batches)):
        pass
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_memory_of_a_worker():
    """What a task holds besides its batch of 8 MB: with slices of 1 MB 58 MB for suffixes and 32 MB for cutting."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 400)) for _ in range(3500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": np.arange(len(texts)), "text": texts})
    assert _peak_mb(_suffixes(50), [batch]) < 20
    found = pa.array([[{"start_word": 10, "end_word": 60}]] * len(texts), pa.list_(pa.struct([("start_word", pa.int32()), ("end_word", pa.int32())])))
    batch = pa.RecordBatch.from_arrays([*batch.columns[:1], batch.column("doc_id"), batch.column("text"), found], ["doc_id", "version", "text", "found"])
    assert _peak_mb(_cut, [batch]) < 15
    cut = pa.Table.from_batches(_cut(iter([batch])))
    assert cut.column("__kept").to_pylist() == [" ".join((w := t.split(" "))[:10] + w[60:]) for t in texts]
