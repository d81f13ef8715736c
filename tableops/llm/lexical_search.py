"""Ranked lexical search: the best documents of each item by summed term impacts, with the Best Position Algorithm.

One pass over the texts counts the items' terms in each document and the totals that the weights need. The counted documents are
then searched block by block, each task its own: a block has one list per term, sorted by impact, and a table with each
document's place in each list for direct accesses. Lists are read from the top, a few places of each list at a time; a
document that is read for the first time gets its full score, and its places in all lists are marked, by direct accesses. The
best position of a list is the end of its unbroken run of marked places, which may lie far behind the last place read. No
document that was not seen scores more than the sum of the impacts at the best positions: once that sum is strictly below
the score of the last of the best documents, which earlier blocks of the task already raise, the block is done. Each task
returns its best documents of each item, which are merged in two steps.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableops.llm.common import id_and_text, outer_id
from tableops.llm.words import SYMBOLS, batch_words, buffers
from tableops.scratch import Tables

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ITEMS_PER_RUN = 10_000  # items searched at once; their terms go to every task
BLOCK_POSTINGS = 2_000_000  # terms with their counts in a block of documents: about 100 MB
CELLS = 16_000_000  # of a table of places (64 MB): documents of a block are cut to keep it
GROUP_TERMS = 2_048  # terms of the items that are searched together
FIRST_READ = 16  # places of each list that are read first; doubled each time
_PARTS_PER_MERGE = 256


@dataclass(frozen=True)
class Vocabulary:
    """The items' terms by ascending hash: bytes of all of them, where each begins, and the hashes."""

    hash: np.ndarray
    data: np.ndarray
    begin: np.ndarray

    @classmethod
    def of(cls, terms: list[str]) -> tuple[Vocabulary, dict[str, int]]:
        """The vocabulary, and the number of each term in it."""
        column = pa.array(terms, pa.string())
        hashes = np.concatenate([w.hash for w in batch_words(column, SYMBOLS)] or [np.zeros(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        if len(np.unique(hashes)) < len(terms):
            raise ValueError("Two terms share a hash")
        data, begin = buffers(pa.array([terms[i] for i in order], pa.string()))
        return cls(hashes[order], data, begin), {terms[t]: i for i, t in enumerate(order.tolist())}

    def find(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of the term that each word is, or -1; bytes are compared, in lower case."""
        at = np.searchsorted(self.hash, hashes)
        found = np.flatnonzero(self.hash[np.minimum(at, len(self.hash) - 1)] == hashes)
        sizes = end[found] - start[found]
        found = found[sizes == np.diff(self.begin)[at[found]]]
        sizes = end[found] - start[found]
        first = np.cumsum(sizes) - sizes
        step = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        mine = data[np.repeat(start[found], sizes) + step]
        mine = mine + 32 * ((mine >= ord("A")) & (mine <= ord("Z"))).astype(np.uint8)
        same = mine == self.data[np.repeat(self.begin[at[found]], sizes) + step]
        found = found[np.logical_and.reduceat(same, first)] if len(found) else found
        terms = np.full(len(hashes), -1, np.int32)
        terms[found] = at[found]
        return terms


def _counted(vocabulary: Vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number of terms of each document that has any, and its counts of the vocabulary's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary.hash)
        for batch in batches:
            ids, (data, offsets) = batch.column("doc_id").to_numpy(), buffers(batch.column("text"))
            for words in batch_words(batch.column("text"), SYMBOLS):
                n = np.diff(words.first)
                part = data[offsets[words.row] : offsets[words.row] + words.begin[-1]]
                terms = vocabulary.find(words.hash, part, words.start, words.end)
                row = np.repeat(np.arange(len(words), dtype=np.int64), n)
                keys, counts = np.unique((row * size + terms)[terms >= 0], return_counts=True)
                kept = np.flatnonzero(n)
                bounds = np.searchsorted(keys, np.append(kept, len(n)) * size).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v.astype(np.int32))) for v in (keys % size, counts)]
                columns = [pa.array(ids[words.row + kept]), pa.array(n[kept].astype(np.int64)), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return run


class ImpactLists:
    """Lists of one block: documents by descending impact for each term, and the place of each document in each list."""

    def __init__(self, docs: int, terms: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        order = np.lexsort((doc, -impact, term))
        self.docs, self.doc, self.impact = docs, doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(terms + 1))
        self.place = np.full((terms, docs), -1, np.int32)
        self.place[term[order], self.doc] = np.arange(len(order)) - self.begin[term[order]]

    def best(self, terms: np.ndarray, top: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the ``top`` best for the sum of these terms that score ``floor`` or more; also those seen.

        By descending score, then ascending document.
        """
        begin = self.begin[terms]
        size = self.begin[terms + 1] - begin
        terms, begin, size = terms[size > 0], begin[size > 0], size[size > 0]
        seen = np.zeros(self.docs, bool)
        first = np.cumsum(size) - size
        marked = np.zeros(int(size.sum()), bool)  # places of all lists
        position = np.zeros(len(terms), np.int64)  # best position: places before it are all marked
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST_READ
        while (position < size).any():
            reads = [self.doc[b + depth : b + min(s, depth + step)] for b, s in zip(begin.tolist(), size.tolist()) if depth < s]
            fresh = np.unique(np.concatenate(reads)) if reads else docs[:0]
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            places = self.place[terms[:, None], fresh]  # direct accesses
            held = places >= 0
            gained = np.where(held, self.impact[begin[:, None] + np.maximum(places, 0)], 0).sum(axis=0)
            marked[(first[:, None] + places)[held]] = True
            docs, scores = np.concatenate([docs, fresh]), np.concatenate([scores, gained])
            order = np.lexsort((docs, -scores))[:top]
            docs, scores = docs[order], scores[order]
            depth, step = depth + step, 2 * step
            for i, (f, s) in enumerate(zip(first.tolist(), size.tolist())):
                rest = marked[f + position[i] : f + s]
                position[i] = s if rest.all() else position[i] + int(np.argmin(rest))
            open_ = position < size
            limit = int(self.impact[begin + position - 1][open_].sum())
            if limit < max(floor, int(scores[-1]) if len(scores) == top else 0):
                break
        kept = scores >= floor
        return docs[kept], scores[kept], int(seen.sum())


def _groups(items: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Numbers of items that are searched together, and their terms: GROUP_TERMS, or one item's."""
    group: list[int] = []
    terms: set[int] = set()
    for i, mine in enumerate(items):
        if group and len(terms | set(mine.tolist())) > GROUP_TERMS:
            yield group, np.array(sorted(terms), np.int64)
            group, terms = [], set()
        group.append(i)
        terms |= set(mine.tolist())
    if terms:
        yield group, np.array(sorted(terms), np.int64)


def _search(items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best documents of a task's rows for each item, as (item, doc_id, score, part)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(b.column("terms").values) for b in held) >= BLOCK_POSTINGS:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]  # doc_id and score
        groups = list(_groups(items))
        for block in blocks(batches):
            if not block.num_rows:
                continue
            ids = block.column("doc_id").to_numpy()
            ranks = np.argsort(ids, kind="stable")  # a document's number in the block follows its id
            number = np.empty(len(ids), np.int64)
            number[ranks] = np.arange(len(ids))
            ids = ids[ranks]
            terms, counts = (block.column(c).combine_chunks() for c in ("terms", "counts"))
            sizes = np.diff(terms.offsets.to_numpy())
            term, tf = (np.asarray(c.flatten()).astype(np.int64) for c in (terms, counts))
            length = [10 + 90 * n * n_docs // n_terms for n in block.column("n").to_pylist()]  # whole numbers of any size
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(np.array(length, np.int64), sizes)))
            doc = np.repeat(number, sizes)
            for group, used in groups:
                local = np.full(len(weights), -1, np.int64)
                local[used] = np.arange(len(used))
                few = max(1, CELLS // len(used))
                for low in range(0, len(ids), few):
                    mine = (local[term] >= 0) & (doc >= low) & (doc < low + few)
                    lists = ImpactLists(min(few, len(ids) - low), len(used), doc[mine] - low, local[term[mine]], impact[mine])
                    for i in group:
                        old_ids, old = best[i]
                        floor = max(1, int(old[-1])) if len(old) == top else 1
                        docs, scores, _ = lists.best(local[items[i]], top, floor)
                        every, sums = np.concatenate([old_ids, ids[low + docs]]), np.concatenate([old, scores])
                        order = np.lexsort((every, -sums))[:top]
                        best[i] = every[order], sums[order]
        found = [i for i, (docs, _) in enumerate(best) if len(docs)]
        if found:
            item = np.repeat(np.array(found, np.int64), [len(best[i][0]) for i in found])
            docs, scores = (np.concatenate([best[i][k] for i in found]) for k in (0, 1))
            part = np.full(len(item), TaskContext.get().partitionId() // _PARTS_PER_MERGE, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (item, docs, scores, part)], ["item", "doc_id", "score", "part"])

    return run


def _first(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def term_weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def search(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` highest-scoring rows of docs (doc_id, text) for each of items (item_id, text).

    Terms are runs of 0-9, A-Z, a-z and characters beyond ASCII, with A-Z lower-cased. A document scores the sum of the
    impacts of the item's distinct terms; N documents have any term, L terms in all, n this one; m = 10 + 90 n N div L, and an
    impact is w * (10**9 tf div (1000 tf + 8 m)) with w = floor(1000 ln((2 N + 2) / (2 df + 1))). Scores of 0 are left out; equal
    scores go by doc_id. Every row is a document, repeated ones too; a null doc_id comes after all others and comes back as
    null; null text has no terms. Rows of ``items`` that share an id are one item with the terms of all. An item without terms, and
    empty tables, give no rows; other columns are ignored. Runs jobs: one pass over the texts per ITEMS_PER_RUN items.
    """
    spark, docs = docs.sparkSession, id_and_text(docs)
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    items = items.select("item_id", F.regexp_extract_all(lower, F.lit(TERM), F.lit(0)).alias("terms"))
    items = items.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).where(F.size("terms") > 0)
    schema = items.schema["item_id"].dataType.simpleString()
    with Tables(spark) as tables:
        items = tables.put(items, "items")
        runs = max(1, -(-items.count() // ITEMS_PER_RUN))
        found = []
        for run in range(runs):
            chosen = items.where(F.pmod(F.xxhash64("item_id"), F.lit(runs)) == run).collect()
            vocabulary, number = Vocabulary.of(sorted({t for r in chosen for t in r.terms}))
            if not number:
                continue
            counted = tables.put(docs.mapInArrow(_counted(vocabulary), "doc_id long, n long, terms array<int>, counts array<int>"), "counted")
            n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
            holders = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # of the vocabulary
            weights = np.array([term_weight(n_docs, holders.get(t, 0)) for t in range(len(number))], np.int64)
            terms = [np.array([number[t] for t in r.terms], np.int64) for r in chosen]
            ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(chosen)], f"item long, item_id {schema}")
            rows = counted.mapInArrow(_search(terms, weights, n_docs, n_terms, top), "item long, doc_id long, score long, part long")
            rows = _first(_first(rows, ["item", "part"], top), ["item"], top)
            found.append(tables.put(rows.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "found", keep=True))
    ranked = found[0] if found else spark.createDataFrame([], f"item_id {schema}, rank int, doc_id long, score long")
    for more in found[1:]:
        ranked = ranked.unionByName(more)
    return ranked.withColumn("doc_id", outer_id("doc_id"))
