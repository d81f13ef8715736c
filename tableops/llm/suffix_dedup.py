"""Repeated passages by a sparse suffix array over words.

Only suffixes at minimisers are kept: positions whose 16-word hash is the smallest of a window that fits into every passage
of min_words, so any two copies of such a passage keep a suffix at the same place of it. The suffixes of all documents are
sorted by the hashes of their first words in ranges that may cut a run of equal ones, and neighbours are compared; a
suffix that agrees with no neighbour in its first words is in no repeated passage. The others are extended to both
sides: a window of min_words around the suffix belongs to it if the suffix is the window's smallest, and windows that occur in
an earlier document, or earlier in the same one, are the repeated text. Overlapping ones are joined to passages.

Windows are counted by hash with partial sums, so a passage in a third of all documents costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableops.llm.common import broadcast_if_small, id_and_text, inner_id, outer_id, with_text
from tableops.llm.words import batch_words, buffers, gram_hashes, signed
from tableops.scratch import Tables

HEAD_WORDS = 16  # words of a suffix that neighbours are compared in


def sliding(values: np.ndarray, width: int, pick: np.ufunc, pad: np.uint64) -> np.ndarray:
    """The pick (minimum or maximum) of each ``width`` neighbouring values, in two running picks over blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, pad, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:n], ahead[width - 1 : width - 1 + n])


def window_minima(hashes: np.ndarray, min_words: int) -> np.ndarray:
    """For each window of min_words words the smallest hash of its heads."""
    heads = gram_hashes(hashes, HEAD_WORDS)
    return sliding(heads, min_words - HEAD_WORDS + 1, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))


def kept_suffixes(hashes: np.ndarray, min_words: int) -> np.ndarray:
    """Positions whose head is the smallest of some window of min_words words."""
    if len(hashes) < min_words:
        return np.zeros(0, np.int64)
    heads, width = gram_hashes(hashes, HEAD_WORDS), min_words - HEAD_WORDS + 1
    minima = window_minima(hashes, min_words)
    around = np.concatenate([np.zeros(width - 1, np.uint64), minima, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(sliding(around, width, np.maximum, np.uint64(0)) == heads)


def _suffixes(min_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for words in batch_words(batch.column("text")):
                head, after, rows, at = [], [], [], []
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    if b - a < min_words:
                        continue
                    places = kept_suffixes(words.hash[a:b], min_words)
                    heads = gram_hashes(words.hash[a:b], HEAD_WORDS)
                    following = np.concatenate([heads[HEAD_WORDS:], np.zeros(HEAD_WORDS, np.uint64)])
                    head.append(heads[places])
                    after.append(following[places])
                    rows.append(np.full(len(places), ids[words.row + i]))
                    at.append(places.astype(np.int32))
                if rows:
                    columns = [signed(np.concatenate(head)), signed(np.concatenate(after)), np.concatenate(rows), np.concatenate(at)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["head", "after", "doc_id", "pos"])

    return run


def _with_equal_neighbour(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes those whose head equals a neighbour's; the first and last of a range always stay."""
    heads, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)  # rows that may still have a neighbour to come
    before: int | None = None  # the head before them

    def chosen(heads: np.ndarray, ids: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([ids[keep], heads[keep]]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["doc_id", "head"])

    for batch in batches:
        heads = np.concatenate([heads, batch.column("head").to_numpy()])
        ids = np.concatenate([ids, batch.column("doc_id").to_numpy()])
        if len(heads) < 2:
            continue
        same = heads[1:] == heads[:-1]
        keep = np.concatenate([[before is None or before == heads[0]], same]) | np.concatenate([same, [False]])
        yield chosen(heads[:-1], ids[:-1], keep[:-1])
        before, heads, ids = int(heads[-2]), heads[-1:], ids[-1:]
    if len(heads):
        yield chosen(heads, ids, np.ones(1, bool))


def _windows(min_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows around kept suffixes: the first of each in a text, and later ones of the same text marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["win", "doc_id", "version", "start", "again"]
        for batch in batches:
            ids, versions = batch.column("doc_id").to_numpy(), batch.column("version").to_numpy()
            for words in batch_words(batch.column("text")):
                out = []
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    row = words.row + i
                    wanted = np.array(batch.column("heads")[row].values.to_numpy(), np.int64).view(np.uint64)
                    starts = np.flatnonzero(np.isin(window_minima(words.hash[a:b], min_words), wanted))
                    if not len(starts):
                        continue
                    wins = signed(gram_hashes(words.hash[a:b], min_words)[starts])
                    again = np.ones(len(starts), bool)
                    again[np.unique(wins, return_index=True)[1]] = False
                    size = len(starts)
                    out.append((wins, np.full(size, ids[row]), np.full(size, versions[row]), starts.astype(np.int32), again))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names)

    return run


def _passages(min_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            lists = batch.column("found")
            for doc_id, version, i in zip(batch.column("doc_id").to_pylist(), batch.column("version").to_pylist(), range(len(lists))):
                found = lists[i].values
                starts, kept = found.field("start").to_numpy(), found.field("kept_id").to_numpy()
                first = np.flatnonzero(np.concatenate([[True], starts[1:] > starts[:-1] + min_words]))
                ends = starts[np.append(first[1:], len(starts)) - 1] + min_words
                rows += zip([doc_id] * len(first), [version] * len(first), starts[first].tolist(), ends.tolist(), kept[first].tolist())
            if rows:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "start_word", "end_word", "kept_id"])

    return run


def repeated_passages(docs: DataFrame, tables: Tables, min_words: int = 50) -> DataFrame:
    """(doc_id, version, start_word, end_word, kept_id) of passages to drop; docs is id_and_text(...). A stored table."""
    docs = docs.withColumn("version", F.xxhash64("text"))
    suffixes = docs.select("doc_id", "text").mapInArrow(_suffixes(min_words), "head long, after long, doc_id long, pos int")
    suffixes = tables.put(suffixes, "suffixes").repartitionByRange("head", "after", "doc_id", "pos")
    suffixes = suffixes.sortWithinPartitions("head", "after", "doc_id", "pos").select("head", "doc_id")
    heads = suffixes.mapInArrow(_with_equal_neighbour, "doc_id long, head long")
    heads = tables.put(heads.groupBy("doc_id").agg(F.collect_set("head").alias("heads")), "heads")
    ids = broadcast_if_small(tables.put(heads.select("doc_id"), "ids"))  # leaves out the other texts before the shuffle
    windows = docs.join(ids, "doc_id", "left_semi").join(heads, "doc_id").select("doc_id", "version", "text", "heads")
    windows = tables.put(windows.mapInArrow(_windows(min_words), "win long, doc_id long, version long, start int, again boolean"), "windows")
    once = windows.where("NOT again")
    first = once.groupBy("win").agg(F.min("doc_id").alias("kept_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    others = once.join(first, "win").where("doc_id > kept_id").select("doc_id", "version", "start", "kept_id")
    inside = windows.where("again").select("doc_id", "version", "start", F.col("doc_id").alias("kept_id"))
    found = others.unionByName(inside).groupBy("doc_id", "version")
    found = found.agg(F.array_sort(F.collect_set(F.struct("start", "kept_id"))).alias("found"))
    schema = "doc_id long, version long, start_word int, end_word int, kept_id long"
    return tables.put(found.mapInArrow(_passages(min_words), schema), "passages", keep=True)


def find_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(doc_id, start_word, end_word, kept_id) of every passage to drop, in rows of docs (doc_id, text); runs jobs.

    A passage is a run of words of which every min_words neighbouring ones occur in a document with a smaller id, or
    earlier in the same text; kept_id is the smallest document that holds its first min_words words. Words are as in
    tableops.llm.words. Shorter, empty and null texts have no passages. Rows that share an id are one document and do not
    repeat each other; equal rows give their passages once. A null doc_id counts as the largest id and comes back as null.
    An empty table gives an empty result; other columns are ignored.
    """
    with Tables(docs.sparkSession) as tables:
        found = repeated_passages(id_and_text(docs), tables, min_words)
    return found.select(outer_id("doc_id").alias("doc_id"), "start_word", "end_word", outer_id("kept_id").alias("kept_id"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their passages, slice by slice: a batch is never held twice."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for words in batch_words(batch.column("text")):
            texts = []
            for i, a in enumerate(words.first[:-1]):
                row = words.row + i
                found = batch.column("found")[row].as_py() or []
                whole = data[offsets[row] : offsets[row + 1]].tobytes()
                count, kept, at = words.first[i + 1] - a, [], 0
                for start, end in sorted((f["start_word"], f["end_word"]) for f in found):
                    kept.append(whole[at : words.start[a + start] - words.begin[i]])
                    at = words.start[a + end] - words.begin[i] if end < count else len(whole)
                texts.append(b"".join([*kept, whole[at:]]).decode())
            columns = [*(batch.column(c).slice(words.row, len(words)) for c in ("doc_id", "version")), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["__id", "__version", "__kept"])


def drop_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """docs with all their columns and without the passages of find_repeats.

    A passage goes from its first word to the word after it, so the white space that follows goes with it. Texts without
    a passage, null ones among them, stay as they are.
    """
    inner = id_and_text(docs)
    with Tables(docs.sparkSession) as tables:
        found = repeated_passages(inner, tables, min_words).groupBy("doc_id", "version")
        found = tables.put(found.agg(F.collect_list(F.struct("start_word", "end_word")).alias("found")), "found")
        ids = broadcast_if_small(tables.put(found.select("doc_id").distinct(), "ids"))
        texts = inner.join(ids, "doc_id", "left_semi").withColumn("version", F.xxhash64("text")).join(found, ["doc_id", "version"])
        texts = texts.select("doc_id", "version", "text", "found").mapInArrow(_cut, "__id long, __version long, __kept string")
        texts = tables.put(texts.dropDuplicates(["__id", "__version"]), "texts", keep=True)
    rows = docs.withColumns({"__id": inner_id(), "__version": F.xxhash64(F.coalesce("text", F.lit("")))})
    rows = rows.join(texts, ["__id", "__version"], "left")
    return with_text(rows, F.coalesce("__kept", "text")).select(*docs.columns)
