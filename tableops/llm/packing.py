"""Packing token sequences by vector bin packing.

A document's ids are cut into pieces of at most ``limit`` tokens; full pieces are sequences of their own. The other pieces are
dealt at random, by hash, into groups of about GROUP_PIECES, and each group is packed by itself: the open sequence
takes the piece that fits and has the largest dot product with what the sequence has left of tokens, segments and
loss-bearing tokens, until nothing fits. Groups have a bounded size and leave one sequence each that is not full.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableops.llm.common import id_and_text, inner_id, outer_id
from tableops.scratch import Tables

GROUP_PIECES = 4096
_CACHE_SIZE, _CACHE_CHARS = 1 << 18, 40  # words per generation, of which a Python worker has two: 120 MB at most
# Fixed value: the pattern of the byte-level vocabulary, as its library splits texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long, loss long"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss long"


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves, others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Ids of a byte-level BPE vocabulary file, as little-endian 32-bit bytes.

    A text is looked up word by word, cut before each single space. That is right where no token can hold such a space but as
    its first character: words that are not in the cache are encoded by themselves, and texts with runs of spaces, or with
    a token of the vocabulary that does hold an inner space (other white space may follow one), are encoded whole. Ids of such
    a vocabulary are the ranks of its merges, which lets the faster of two libraries do it; special tokens inside a text keep
    their ids.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters, split = byte_letters(), content["pre_tokenizer"]
        if content["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in content["model"]["vocab"].items() if t not in self.special}
        inner = {t.decode("utf-8", "ignore") for t in ranks if b" " in t[1:] and t.strip(b" ")}
        self.whole = [*self.special, *{t for t in inner if not any(o != t and o in t for o in inner)}]
        self.library = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.words: dict[str, bytes] = {}  # ids of a word after one space
        self.older = self.words

    def _ids(self, text: str) -> bytes:
        return array("I", self.library.encode(text, allowed_special="all")).tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.older.get(word) or array("I", self.library.encode_ordinary(" " + word)).tobytes()
        if len(word) <= _CACHE_CHARS:
            if len(self.words) >= _CACHE_SIZE:
                self.older, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if "  " in text or text[-1:] == " " or any(s in text for s in self.whole):
            return self._ids(text)
        first, *rest = text.split(" ")
        get, make = self.words.get, self._word
        return b"".join([self._ids(first), *[get(w) or make(w) for w in rest]])


@lru_cache(2)
def load(path: str) -> ByteBpe:
    """One encoder per Python worker and vocabulary."""
    return ByteBpe(path)


def pack(sizes: np.ndarray, capacity: np.ndarray) -> list[list[int]]:
    """Bins of row numbers. sizes: (items, dimensions), each row within capacity; every row is in one bin.

    Each open bin takes the fitting item with the largest dot product of its size with the bin's room, both as shares of the
    capacity; ties go to the earlier row.
    """
    share = sizes / capacity
    order = np.lexsort((np.arange(len(sizes)), *-share.T[::-1]))  # large items first, so ties and scans are short
    sizes, share = sizes[order], share[order]
    bins, free = [], np.ones(len(sizes), bool)
    alive = np.arange(len(sizes))
    while len(alive):
        room, members = capacity.astype(np.int64).copy(), []
        left = alive
        while len(left):
            left = left[(sizes[left] <= room).all(axis=1)]
            if not len(left):
                break
            best = left[np.argmax(share[left] @ (room / capacity))]
            members.append(int(best))
            room = room - sizes[best]
            left = left[left != best]
        free[members] = False
        bins.append([int(order[i]) for i in members])
        alive = alive[free[alive]]
    return bins


def cut_pieces(lengths: list[int], bears: list[bool], limit: int, max_loss: int) -> Iterator[tuple[int, int, int]]:
    """(start, stop, loss-bearing tokens) of the longest pieces in a row that keep both limits; lengths and loss of the parts."""
    total = sum(lengths)
    if all(bears):
        size = min(limit, max_loss)
        for start in range(0, total, size):
            stop = min(start + size, total)
            yield start, stop, stop - start
        return
    upto = np.concatenate([[0], np.cumsum(np.repeat(np.array(bears, bool), lengths))])  # loss before each token
    start = 0
    while start < total:
        stop = min(start + limit, total, int(np.searchsorted(upto, upto[start] + max_loss, "right")) - 1)
        yield start, stop, int(upto[stop] - upto[start])
        start = stop


def _cut(path: str, end_id: int, limit: int, max_loss: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, end = load(path), array("I", [end_id]).tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for doc_id, parts in zip(batch.column("doc_id").to_pylist(), batch.column("parts").to_pylist()):
                made = [(bpe.encode(p["text"]), p["loss"]) for p in parts]
                ids = b"".join([*[i for i, _ in made], end])
                total = len(ids) // 4
                lengths = [len(i) // 4 for i, _ in made]
                lengths[-1:] = [total - sum(lengths[:-1])]  # the end id belongs to the last part
                for start, stop, loss in cut_pieces(lengths, [b for _, b in made] or [True], limit, max_loss):
                    part = ids[4 * start : 4 * stop]
                    rows.append((doc_id, row, start, stop - start, zlib.crc32(part), total, loss))
                row += 1
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _PIECES.split(", ")])

    return run


def _pack_group(limit: int, max_segments: int, max_loss: int):
    capacity = np.array([limit, max_segments, max_loss], np.int64)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "row"], ignore_index=True)
        sizes = np.stack([rows["length"], np.ones(len(rows), np.int64), rows["loss"]], axis=1).astype(np.int64)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, members in enumerate(pack(sizes, capacity)):
            lengths = sizes[members, 0]
            sequence[members], offset[members] = number, np.cumsum(lengths) - lengths
        sequence += int(rows["part"].iloc[0]) << 32
        placed = rows.assign(sequence_id=sequence, offset=offset)
        return placed[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss"]]

    return run


def pack_parts(
    examples: DataFrame, path: str, end_id: int = 1, limit: int = 2048, max_segments: int = 128, max_loss: int = 2048
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss) of every piece of an example; runs jobs.

    examples has doc_id and parts, an array of (text, loss): the prompt and the answer of an instruction, or the turns of a
    conversation, of which some bear loss. An example is the ids of its parts by the vocabulary file ``path``, each part encoded
    by itself, and then end_id, which belongs to the last part. Null parts, texts and loss flags count as none, empty and no
    loss; an example without parts is its end id, which then bears loss. Sequences have at most ``limit`` tokens, max_segments
    pieces and max_loss loss-bearing tokens, and no gaps; examples are cut where a piece would go beyond limit or max_loss, and
    ``loss`` counts a piece's loss-bearing tokens. Repeated rows are packed as often as they occur. A null doc_id comes back as
    null. An empty table gives an empty result; other columns are ignored. Every executor needs the vocabulary file.
    """
    if min(limit, max_segments, max_loss) < 1:
        raise ValueError("All limits must be at least 1")
    part = lambda p: F.struct(F.coalesce(p["text"], F.lit("")).alias("text"), F.coalesce(p["loss"], F.lit(False)).alias("loss"))
    parts = F.transform(F.filter(F.col("parts"), lambda p: p.isNotNull()), part)
    examples = examples.select(inner_id().alias("doc_id"), F.coalesce(parts, F.array().cast("array<struct<text:string,loss:boolean>>")).alias("parts"))
    with Tables(examples.sparkSession) as tables:
        pieces = tables.put(examples.mapInArrow(_cut(path, end_id, limit, max_loss), _PIECES), "pieces")
        groups = max(1, -(-pieces.count() // GROUP_PIECES))
        part = F.pmod(F.xxhash64("doc_id", "start", "row"), F.lit(groups)).alias("part")
        placed = pieces.select("*", part).groupBy("part").applyInPandas(_pack_group(limit, max_segments, max_loss), _PLACED)
        placed = tables.put(placed, "placed", keep=True)
    return placed.withColumn("doc_id", outer_id("doc_id"))


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 1, limit: int = 2048, max_segments: int = 128, max_loss: int = 2048
) -> DataFrame:
    """pack_parts of docs (doc_id, text), each one part all of whose ids bear loss; null text counts as empty."""
    whole = F.array(F.struct("text", F.lit(True).alias("loss"))).alias("parts")
    return pack_parts(id_and_text(docs).select(outer_id("doc_id").alias("doc_id"), whole), path, end_id, limit, max_segments, max_loss)
