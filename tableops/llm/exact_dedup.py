"""Exact deduplication with a minimal perfect hash over the digests of earlier documents.

The history's distinct digests are dealt into shards of about SHARD_KEYS. Each shard gets a minimal perfect hash: level by
level, digests that are alone at their position of a bit array stay there and the others go on to the next level; the rank
of a digest's bit is its slot. Slots hold the whole digest and the id of the document that stays. A batch's distinct digests
are looked up in their shard and compared with the slot byte by byte: members are repeats, and the others are grouped
among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableops.llm.common import id_and_text, outer_id
from tableops.llm.words import mix
from tableops.scratch import Tables

SHARD_KEYS = 1 << 16
_ROOM = 2  # positions per digest of a level
_INDEX = "shard long, levels array<binary>, digests binary, winners binary"
_FOUND = "digest binary, winner long, copies long, member boolean"


def _positions(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    """Of digests (n, 4) at a level; every level uses other bits of the whole digest."""
    salt = np.uint64((level * 2 + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    mixed = mix(digests[:, 0] ^ salt)
    for word in range(1, digests.shape[1]):
        mixed = mix(mixed + digests[:, word])
    return (mixed % np.uint64(size)).astype(np.int64)


def build(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays per level, and the slot of each of the distinct digests: 0 to n - 1, each once."""
    slots, levels, base = np.zeros(len(digests), np.int64), [], 0
    rest = np.arange(len(digests))
    while len(rest):
        size = max(64, _ROOM * len(rest))
        at = _positions(digests[rest], len(levels), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, bool)
        bits[at[alone]] = True
        slots[rest[alone]] = base + np.cumsum(bits)[at[alone]] - 1
        base += int(alone.sum())
        levels.append(bits)
        rest = rest[~alone]
    return levels, slots


def look_up(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """Slot of each digest; -1 where no level has its bit. A digest that was not built may get any slot."""
    slots, base = np.full(len(digests), -1, np.int64), 0
    rest = np.arange(len(digests))
    for level, bits in enumerate(levels):
        at = _positions(digests[rest], level, len(bits))
        here = bits[at]
        slots[rest[here]] = base + np.cumsum(bits)[at[here]] - 1
        base += int(bits.sum())
        rest = rest[~here]
    return slots


def _matrix(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, digests)), np.uint64).reshape(len(digests), 4)


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(rows["digest"])
    levels, slots = build(digests)
    order = np.argsort(slots)
    packed = [len(b).to_bytes(8, "little") + np.packbits(b).tobytes() for b in levels]
    winners = rows["winner"].to_numpy(np.int64)[order]
    columns = {"shard": [rows["shard"].iloc[0]], "levels": [packed], "digests": [digests[order].tobytes()], "winners": [winners.tobytes()]}
    return pd.DataFrame(columns)


def _look_up_shard(rows: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({"digest": [], "winner": [], "copies": [], "member": []})
    winners, member = rows["winner"].to_numpy(np.int64).copy(), np.zeros(len(rows), bool)
    if len(index):
        packed, digests = index["levels"].iloc[0], _matrix(rows["digest"])
        levels = [
            np.unpackbits(np.frombuffer(b, np.uint8, offset=8), count=int.from_bytes(b[:8], "little")).astype(bool) for b in packed
        ]
        kept = np.frombuffer(index["digests"].iloc[0], np.uint64).reshape(-1, 4)
        slots = look_up(levels, digests)
        hit = np.flatnonzero(slots >= 0)
        hit = hit[(kept[slots[hit]] == digests[hit]).all(axis=1)]
        member[hit] = True
        winners[hit] = np.frombuffer(index["winners"].iloc[0], np.int64)[slots[hit]]
    return pd.DataFrame({"digest": rows["digest"], "winner": winners, "copies": rows["copies"], "member": member})


def text_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of each text after every run of white space has become one space."""
    normal = F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", " ")
    return docs.select("doc_id", F.unhex(F.sha2(normal, 256)).alias("digest"))


def _groups(digests: DataFrame) -> DataFrame:
    return digests.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.count("*").alias("copies"))


def split_off_repeats(history: DataFrame, batch: DataFrame, tables: Tables) -> DataFrame:
    """(digest, winner, copies) of both tables' distinct digests; history and batch have (doc_id, digest).

    A digest of the history keeps the history's winner. Digests are grouped before they are shuffled, so a digest that a third
    of the rows share is one row per task.
    """
    old, new = tables.put(_groups(history), "old"), tables.put(_groups(batch), "new")
    shards = max(1, -(-max(old.count(), new.count()) // SHARD_KEYS))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")
    index = old.select("digest", "winner", shard).groupBy("shard").applyInPandas(_build_shard, _INDEX)
    index = tables.put(index, "index")
    found = new.select("*", shard).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_look_up_shard, _FOUND)
    found = tables.put(found, "found")
    again = found.where("member").select("digest", F.col("copies").alias("again"))
    known = old.join(again, "digest", "left").select("digest", "winner", (F.col("copies") + F.coalesce("again", F.lit(0))).alias("copies"))
    return known.unionByName(found.where("NOT member").drop("member"))


def exact_duplicates(docs: DataFrame, history_share: float = 0.5) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row of docs (doc_id, text); runs jobs.

    Texts are equal when they are identical after each run of space and 0x09-0x0D has become one space; null counts as empty.
    The smallest doc_id of a group stays. The documents up to the given share of ids are the history, the rest the batch.
    Rows that share the smallest id all stay. A null doc_id counts as the largest id and comes back as null. An empty table
    gives an empty result; other columns are ignored.
    """
    docs = id_and_text(docs)
    with Tables(docs.sparkSession) as tables:
        digests = tables.put(text_digests(docs), "digests", keep=True)
        middle = digests.approxQuantile("doc_id", [history_share], 0.01)
        old = F.col("doc_id").cast("double") <= F.lit(middle[0] if middle else 0.0)
        groups = tables.put(split_off_repeats(digests.where(old), digests.where(~old), tables), "groups", keep=True)
    return digests.join(groups, "digest").select(
        outer_id("doc_id").alias("doc_id"),
        outer_id("winner").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("doc_id") == F.col("winner")).alias("kept"),
        "digest",
    )
