"""N-gram Jaccard self-join of documents with adaptive multi-match prefixes.

Shingle sets are ordered by one global order, rare shingles first. Two sets with a Jaccard similarity of at least t that
have n shingles or more share at least l tokens of their prefixes of n - ceil(t n) + l tokens, for every l. Each document
chooses its own l: a longer prefix costs more postings but asks for more shared tokens, so fewer pairs are verified. A pair
needs an overlap o that follows from both sizes, so its prefixes of n - o + l tokens, l being the smaller of both choices,
share l tokens: shared tokens beyond these prefixes do not count, and a pair with l of them is verified. A token that
both hold at places i and j bounds the overlap by min(i, j) + 1 + the smaller rest; a bound below o drops the match, and
so do bitmaps of the sets' parities that differ in more bits than the sets may differ in shingles. Before whole sets are
brought together, wider bitmaps, about a bit a shingle, are compared in the same way.

The order comes from bounded sketches of the documents that hold each word and of all shingles: a shingle is no more frequent
than its rarest word, and the shingles of a large group of near copies stand out from those that its members have each of
their own. The sketches never estimate too low, so a shingle with a word that only one document holds needs no posting; all
else that they decide is cost, not the result. Equal sets are one class from the start. Then each class is checked against the one class with which it
shares most, among those that hold its prefix tokens foremost (which have the fewest tokens of their own): that joins groups of near copies by a number of checks
that grows with the group, not with its square. The exact pass that follows looks at pairs of different components only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableops.llm.common import NO_ID, broadcast_if_small, id_and_text, inner_id, outer_id
from tableops.llm.components import connected_components
from tableops.llm.sketch import Shape, count_min
from tableops.llm.words import batch_words, gram_hashes, mix, signed, text_grams
from tableops.scratch import Tables

WORDS, SHINGLES = Shape(21, 2), Shape(21, 1)
MAX_MATCHES = 8  # longest prefix extension that is considered
CHECK_COST = 1 / 16  # cost of verifying a candidate, per shingle of the document, in postings read
_SETS = "doc_id long, n long, d1 long, d2 long, need int, prefix array<long>, place array<int>, bits array<long>, wide array<long>"
_PARITY_BITS, _MOST_BITS = 256, 1 << 13


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n has in common with any set at ``percent`` or more."""
    return -(-percent * n // 100)


def choose_matches(counts: np.ndarray, n: int, percent: int) -> int:
    """Number of prefix tokens to require. counts: estimated other holders of the tokens in prefix order.

    Reading a prefix costs its postings; at most 1 / l of the postings can be candidates that share l tokens of it.
    """
    overlap = least_overlap(n, percent)
    longest = min(MAX_MATCHES, overlap)
    postings = np.cumsum(counts)[n - overlap : n - overlap + longest]
    return int(np.argmin(postings + CHECK_COST * n * postings / np.arange(1, longest + 1))) + 1


def _words_and_shingles(k: int) -> Callable[[pa.RecordBatch], Iterator[list[np.ndarray]]]:
    def run(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        for words in batch_words(batch.column("text")):
            bounds = list(zip(words.first[:-1], words.first[1:]))
            distinct = np.concatenate([np.unique(words.hash[a:b]) for a, b in bounds])
            short = [gram_hashes(words.hash[a:b], int(b - a)) for a, b in bounds if 0 < b - a < k]
            yield [distinct, np.concatenate([gram_hashes(words.hash, k), *short])]

    return run


def _ranked_sets(column: pa.Array, k: int, counts: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, shingles sorted by hash, bound of the documents that hold each)."""
    for words in batch_words(column):
        seen = WORDS.estimates(counts[0], words.hash)
        grams, bound = gram_hashes(words.hash, k), seen[: max(0, len(seen) - k + 1)]
        for i in range(1, k):
            bound = np.minimum(bound, seen[i : i + len(bound)])
        bound = np.minimum(bound, SHINGLES.estimates(counts[1], grams))
        for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            if b - a >= k:
                distinct, at = np.unique(grams[a : b - k + 1], return_index=True)
                yield words.row + i, distinct, bound[a : b - k + 1][at]
            else:  # all words as one shingle, or none
                yield words.row + i, gram_hashes(words.hash[a:b], max(1, b - a)), seen[a:b].min(keepdims=True) if a < b else seen[:0]


def _parities(grams: np.ndarray, bits: int = _PARITY_BITS) -> np.ndarray:
    """Whether an odd number of shingles falls on each bit: sets differ in at least as many shingles as these bits do."""
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _wide_bits(n: int) -> int:
    """Bits of the wider bitmap of a set of n: the power of two from n on, within bounds."""
    return min(max(1 << (n - 1).bit_length(), _PARITY_BITS), _MOST_BITS)


def _bits_apart(x: Column, y: Column) -> Column:
    """Bits in which two bitmaps differ; the halves of one twice as long are put on each other. Null for other lengths."""

    def halved(v: Column) -> Column:
        half = F.shiftright(F.size(v), 1)
        return F.zip_with(F.slice(v, F.lit(1), half), F.slice(v, half + 1, half), lambda p, q: p.bitwiseXOR(q))

    def apart(v: Column, w: Column) -> Column:
        return F.aggregate(F.zip_with(v, w, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, c: total + c)

    of_x, of_y = F.size(x), F.size(y)
    return F.when(of_x == of_y, apart(x, y)).when(of_x == 2 * of_y, apart(halved(x), y)).when(2 * of_x == of_y, apart(x, halved(y)))


def _prefixes(k: int, percent: int, counts: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("doc_id").to_numpy(zero_copy_only=False), []
            for row, grams, seen in _ranked_sets(batch.column("text"), k, counts.value):
                n = len(grams)
                if not n:
                    rows.append((ids[row], 0, 0, 0, 0, [], [], [], []))
                    continue
                order = np.argsort(np.log2(seen).astype(np.int8), kind="stable")  # grams are sorted, so ties go by hash
                need = choose_matches(seen[order], n, percent)
                prefix = order[: n - least_overlap(n, percent) + need]
                place = np.flatnonzero(seen[prefix] > 1).astype(np.int32)
                digest = np.bitwise_xor.reduce(mix(grams)), np.sum(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
                parities = _parities(grams), _parities(grams, _wide_bits(n))
                rows.append((ids[row], n, *signed(np.array(digest)).tolist(), need, signed(grams[prefix[place]]), place, *parities))
            if rows:
                columns = [list(c) for c in zip(*rows)]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 2]
                names = ["doc_id", "n", "d1", "d2", "need", "prefix", "place", "bits", "wide"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def _whole_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, sets = batch.column("doc_id").to_numpy(zero_copy_only=False), [], []
            for words in batch_words(batch.column("text")):
                for row, grams in text_grams(words, k):
                    rows.append(ids[row])
                    sets.append(signed(np.unique(grams)))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "grams"])

    return run


def _least_shared(percent: int) -> Column:
    """Shingles that sets of n_a and n_b have in common at least, at ``percent`` or more."""
    return F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent) - F.lit(1e-9))


def _near(pairs: DataFrame, rows: DataFrame, percent: int, tables: Tables) -> DataFrame:
    """The pairs but those whose wider bitmaps, in ``rows``, differ in more bits than the sets may differ in shingles."""
    ids = tables.put(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    rows = rows.select("doc_id", "n", "wide").join(broadcast_if_small(ids), "doc_id", "left_semi").distinct()
    both = pairs
    for x in "ab":
        both = both.join(rows.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"wide_{x}")), x)
    near = _bits_apart(F.col("wide_a"), F.col("wide_b")) <= F.col("n_a") + F.col("n_b") - 2 * _least_shared(percent)
    return tables.put(both.where(F.coalesce(near, F.lit(True))).select("a", "b").distinct(), "near")


def _verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame, k: int, percent: int, tables: Tables) -> DataFrame:
    """Pairs (a, b) whose Jaccard similarity reaches the limit; only documents that may be near are read into sets."""
    pairs = _near(pairs, rows, percent, tables)
    ids = tables.put(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    wanted = docs.join(broadcast_if_small(ids), "doc_id", "left_semi")
    sets = tables.put(wanted.mapInArrow(_whole_sets(k), "id long, grams array<long>"), "whole")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
    shared, total = F.size(F.array_intersect("ga", "gb")), F.size("ga") + F.size("gb")
    links = tables.put(both.where(100 * shared >= percent * (total - shared)).select("a", "b"), "links")
    tables.drop_last("whole")
    return links


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text); runs jobs.

    A set holds the distinct k-word shingles, or all words as one if there are fewer; documents without words or text have
    an empty set, no link, and a component of their own. Documents with 100 * intersection >= percent * union are linked;
    component_id is the smallest doc_id that links reach. Repeated rows give repeated rows; rows that share an
    id are one document with the links of all of them. A null doc_id counts as the largest id and comes back as null. An
    empty table gives an empty result; other columns are ignored.
    """
    docs, spark = id_and_text(docs), docs.sparkSession
    with Tables(spark) as tables:
        counts = count_min(docs, [WORDS, SHINGLES], _words_and_shingles(k))
        shared = spark.sparkContext.broadcast(counts)  # 24 MB at any size
        sets = tables.put(docs.mapInArrow(_prefixes(k, percent, shared), _SETS), "sets")

        classes = sets.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"))
        member = sets.select("doc_id", "n", "d1", "d2").distinct().join(classes, ["d1", "d2", "n"])
        member = tables.put(member.select("doc_id", "rep", "n"), "member")

        reps = tables.put(member.where("doc_id = rep").select("doc_id", "n").distinct(), "reps")
        entries = sets.join(broadcast_if_small(reps), ["doc_id", "n"], "left_semi")
        entries = entries.select(F.col("doc_id").alias("id"), F.col("n").cast("int").alias("n"), "need", F.inline(F.arrays_zip("prefix", "place")))
        # Holders are counted by a window, so that each posting is shuffled once; most tokens have one holder.
        same = Window.partitionBy("token")
        entries = entries.withColumnRenamed("prefix", "token").withColumns({"holders": F.count("*").over(same), "pivot": F.min_by("id", "place").over(same)})
        postings = tables.put(entries.where("holders > 1").drop("holders"), "postings")

        stars = postings.where("id <> pivot").groupBy("id", "pivot", "need").agg(F.count("*").alias("c")).where("c >= need")
        stars = stars.groupBy(F.col("id").alias("b")).agg(F.max_by("pivot", F.struct("c", -F.col("pivot"))).alias("a"))
        links = _verified(tables.put(stars, "stars"), docs, sets, k, percent, tables)
        joined = tables.put(connected_components(links, tables), "joined")

        known = postings.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = known.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
        parts = ["id", "n", "need", "place", "component", "bits"]
        known = known.join(mixed.select("token"), "token").join(sets.select(F.col("doc_id").alias("id"), "n", "bits"), ["id", "n"])
        known = tables.put(known.select("token", *parts), "known")
        a, b = (known.select("token", *[F.col(c).alias(f"{c}_{side}") for c in parts]) for side in "ab")
        overlap = _least_shared(percent)
        bound = F.least("place_a", "place_b") + 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) - 1
        matches = F.least("need_a", "need_b")
        within = [F.col(f"place_{x}") <= F.col(f"n_{x}") - overlap + matches - 1 for x in "ab"]
        apart = (F.col("id_a") < F.col("id_b")) & (F.col("component_a") != F.col("component_b"))
        differ = [F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i)))) for i in range(_PARITY_BITS // 64)]
        alike = sum(differ[1:], differ[0]) <= F.col("n_a") + F.col("n_b") - 2 * overlap
        pairs = a.join(b, (a.token == b.token) & apart & within[0] & within[1] & (bound >= overlap) & alike)
        pairs = pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), matches.alias("matches"))
        pairs = pairs.groupBy("a", "b", "matches").agg(F.count("*").alias("c")).where("c >= matches")
        pairs = tables.put(pairs.select("a", "b").distinct(), "pairs")
        copies = member.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        links = links.union(_verified(pairs, docs, sets, k, percent, tables)).union(copies)
        found = tables.put(connected_components(links, tables), "found", keep=True)
        sizes = tables.put(sets.select("doc_id", "n"), "sizes", keep=True)
    result = sizes.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return result.select(
        outer_id("doc_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component", "doc_id"), F.lit(NO_ID)).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with all their columns, whose doc_id is the smallest of its component in jaccard_components."""
    found = jaccard_components(docs, k, percent)
    with Tables(docs.sparkSession) as tables:
        others = found.where("NOT doc_id <=> component_id").select(inner_id().alias("__id")).distinct()
        others = broadcast_if_small(tables.put(others, "others", keep=True))
    return docs.withColumn("__id", inner_id()).join(others, "__id", "left_anti").select(*docs.columns)
