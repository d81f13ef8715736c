"""SimHash fingerprints and the search for fingerprints within a Hamming radius, in DataFrame operations only.

Terms are pairs of neighbouring words (the word itself in a text of one word), weighted by their length up to MAX_WEIGHT,
as long words are rarer; each occurrence votes. The 64 signed votes are 32 sums: a sum holds the votes of bits k and
k + 32 in the halves of a long, which serves texts of a total weight below 2**32.

Fingerprints within radius r agree on at least b - r of b blocks of bits, so one table per choice of b - r blocks, keyed by
these blocks' bits, brings every such pair together.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableops.llm.common import NO_ID, id_and_text, outer_id
from tableops.llm.components import connected_components
from tableops.scratch import Tables

BITS, MAX_WEIGHT = 64, 32
_HALVES = 0x0000000100000001
_SPACE = "[\\x20\\x09-\\x0D]+"


def terms(text: Column) -> Column:
    """Array of terms; empty without words."""

    def pairs(words: Column) -> Column:
        two = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
        return F.when(F.size(words) > 1, two).otherwise(words)

    words = F.array_remove(F.split(F.lower(text), _SPACE), "")
    return F.get(F.transform(F.array(words), pairs), F.lit(0))  # words are split once, not per pair


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Columns ``keys`` and ``fingerprint`` (long), one row per distinct keys; a text without words has fingerprint 0."""
    votes = texts.select(*keys, F.explode_outer(terms(F.col(text))).alias("__term"))
    h, weight = F.xxhash64("__term"), F.least(F.length("__term"), F.lit(MAX_WEIGHT)).cast("long")
    votes = votes.select(*keys, h.alias("__h"), F.coalesce(weight, F.lit(0)).alias("__w"))
    sums = [
        F.sum(F.shiftrightunsigned("__h", k).bitwiseAND(F.lit(_HALVES)) * F.col("__w")).alias(f"__s{k}") for k in range(BITS // 2)
    ]
    votes = votes.groupBy(*keys).agg(F.sum("__w").alias("__all"), *sums)

    def bit(count: Column, k: int) -> Column:
        return F.when(2 * count > F.col("__all"), F.shiftleft(F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long"))

    low = [bit(F.col(f"__s{k}").bitwiseAND(F.lit(0xFFFFFFFF)), k) for k in range(BITS // 2)]
    high = [bit(F.shiftrightunsigned(f"__s{k}", 32), k + 32) for k in range(BITS // 2)]
    return votes.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), low + high).alias("fingerprint"))


def hamming(a: str | Column, b: str | Column) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)) if isinstance(a, str) else a.bitwiseXOR(b))


def likeness(a: str, b: str) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - hamming(a, b).cast("double") / BITS


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of the permuted tables: every choice of blocks - radius blocks, as signed longs."""
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    ones = [((1 << bounds[i + 1]) - 1) ^ ((1 << bounds[i]) - 1) for i in range(blocks)]
    masks = [sum(choice) for choice in combinations(ones, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def block_tables(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(table, key, fingerprint) of distinct fingerprints."""
    entry = [
        F.struct(F.lit(i).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(block_masks(radius, blocks))
    ]
    prints = prints.where("fingerprint IS NOT NULL").select("fingerprint").distinct()
    return prints.select("fingerprint", F.inline(F.array(*entry)))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(query, fingerprint): all pairs of distinct fingerprints of both tables (fingerprint) that are within radius."""
    left = block_tables(queries, radius, blocks).withColumnRenamed("fingerprint", "query")
    pairs = left.join(block_tables(prints, radius, blocks), ["table", "key"])
    return pairs.where(hamming("query", "fingerprint") <= radius).select("query", "fingerprint").distinct()


def hamming_components(prints: DataFrame, tables: Tables, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(id, component) of fingerprints that are linked to another one; component is the smallest fingerprint reached.

    Each bucket of a table is first linked to its smallest fingerprint, which takes as many checks as it has entries. Pairs
    are formed afterwards in buckets that still hold several components, between different components only.
    """
    entries = tables.put(block_tables(prints, radius, blocks), "blocks")
    pivots = entries.groupBy("table", "key").agg(F.min("fingerprint").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    entries = tables.put(entries.join(pivots.drop("n"), ["table", "key"]), "shared")
    near = (F.col("fingerprint") != F.col("pivot")) & (hamming("fingerprint", "pivot") <= radius)
    stars = entries.where(near).select(F.col("fingerprint").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = tables.put(stars, "stars")
    joined = tables.put(connected_components(stars, tables), "joined")
    known = entries.join(joined, F.col("fingerprint") == F.col("id"), "left")
    known = known.select("table", "key", "fingerprint", F.coalesce("component", "fingerprint").alias("component"))
    mixed = known.groupBy("table", "key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    known = tables.put(known.join(mixed.select("table", "key"), ["table", "key"]), "known")
    other = known.select("table", "key", F.col("fingerprint").alias("b"), F.col("component").alias("other"))
    pairs = known.withColumnRenamed("fingerprint", "a").join(other, ["table", "key"])
    pairs = pairs.where((F.col("component") < F.col("other")) & (hamming("a", "b") <= radius)).select("a", "b").distinct()
    return tables.put(connected_components(tables.put(stars.union(pairs), "links"), tables), "found")


def with_next(docs: DataFrame, chunks: int) -> DataFrame:
    """doc_id, version, place, text, and next_id, next_version, next_text of the next document by id; after the last, the first.

    version is the hash of the text and orders rows that share an id; place tells equal rows apart. Ids are cut into ranges at quantiles; each range is a
    window, and the last row of a range takes the first row of the next range from a table of one row per range.
    """
    docs = docs.withColumn("version", F.xxhash64("text"))
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / chunks for i in range(1, chunks)], 0.2 / chunks))) if chunks > 1 else []
    before = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("doc_id").cast("double"))) if cuts else F.lit(0)
    docs = docs.withColumn("chunk", before)
    least = docs.groupBy("chunk").agg(F.min_by(F.struct("doc_id", "version", "text"), F.struct("doc_id", "version")).alias("head"))
    order = Window.orderBy("chunk")  # one short row per range
    number = least.select("chunk").select(
        F.col("chunk").alias("of"), F.coalesce(F.lag("chunk").over(order), F.max("chunk").over(Window.partitionBy())).alias("before")
    )
    heads = least.join(number, least.chunk == number.of).select(F.col("before").alias("chunk"), "head")
    within = Window.partitionBy("chunk").orderBy("doc_id", "version")
    following = F.lead(F.struct("doc_id", "version", "text")).over(within)
    rows = docs.withColumns({"following": following, "place": F.row_number().over(within)}).join(heads, ["chunk"], "left")
    rows = rows.select("doc_id", "version", "place", "text", F.coalesce("following", "head").alias("after"))
    return rows.select(
        "doc_id",
        "version",
        "place",
        "text",
        F.col("after.doc_id").alias("next_id"),
        F.col("after.version").alias("next_version"),
        F.col("after.text").alias("next_text"),
    )


def compare_edited(docs: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """One row per row of docs (doc_id, text): fingerprints of the text and of its edited form; runs jobs.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many, or all, of the next
    document by id; after the last comes the first, and a lone document follows itself. Rows that share an id are ordered by
    the hash of their text. Columns: doc_id, n_chars, edited_sha256, fingerprint and
    edited_fingerprint (16 hex digits), near_edited and near_next (share of equal bits), class_id: the smallest doc_id
    whose fingerprint is reached by steps within the radius. Null text counts as empty; texts without words have fingerprint 0.
    A null doc_id counts as the largest id and comes back as null. An empty table gives an empty result.
    """
    docs, spark = id_and_text(docs), docs.sparkSession
    me = ["doc_id", "version", "place"]
    with Tables(spark) as tables:
        rows = with_next(docs, int(spark.conf.get("spark.sql.shuffle.partitions")))
        n = F.length("text")
        quarter = F.floor(n / 4).cast("int")
        edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
        both = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), edited.alias("t")))
        texts = rows.withColumns({"n_chars": n.cast("long"), "edited_sha256": F.sha2(edited, 256)})
        texts = texts.select(*me, "next_id", "next_version", "n_chars", "edited_sha256", F.inline(both))
        keys = [*me, "next_id", "next_version", "n_chars", "edited_sha256", "which"]
        prints = tables.put(fingerprints(texts, keys, "t"), "prints", keep=True)
        own = prints.where("which = 0")
        classes = hamming_components(own, tables, radius, blocks)
        names = own.join(classes, own.fingerprint == classes.id, "left")
        names = names.withColumn("component", F.coalesce("component", "fingerprint"))
        least = names.groupBy("component").agg(F.min("doc_id").alias("class_id"))
        by_print = names.select("fingerprint", "component").distinct().join(least, "component").select("fingerprint", "class_id")
        by_print = tables.put(by_print, "by_print", keep=True)
    own, changed = prints.where("which = 0"), prints.where("which = 1")
    changed = changed.select(*me, F.col("fingerprint").alias("edited_fingerprint"))
    following = own.groupBy(F.col("doc_id").alias("next_id"), F.col("version").alias("next_version"))
    following = following.agg(F.max("fingerprint").alias("next_fingerprint"))
    result = own.join(changed, me).join(following, ["next_id", "next_version"]).join(by_print, "fingerprint")

    def text(column: str) -> Column:
        return F.lower(F.lpad(F.hex(column), 16, "0")).alias(column)

    return result.select(
        outer_id("doc_id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        text("fingerprint"),
        text("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
        outer_id("class_id").alias("class_id"),
    )
