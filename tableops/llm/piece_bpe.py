"""SentencePiece BPE by backtracking, without running its merges over the text.

A sequence of pieces is the encoding of a text when every two neighbours are: when merging their joined characters anew
gives these two pieces again. So the encoder walks left to right, takes the longest piece that an Aho-Corasick automaton
finds, falls back to shorter ones while the neighbours do not fit, and steps back when none fits. A bitfield remembers
positions from which the rest cannot be reached, so each is tried once. The library is used to read the vocabulary
file only.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from tableops.llm.common import id_and_text

SPACE = "▁"  # fixed value: the library's mark for a space
_CACHE_SIZE, _CACHE_CHARS = 1 << 19, 40  # words per generation, of which a Python worker has two: 260 MB at most


def _one_mark_per_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("tableops-one-mark-per-byte", _one_mark_per_byte)


class PieceBpe:
    """Encoder and decoder of one BPE vocabulary with byte fallback, an identity normaliser and a leading space."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        self.unknown, self.end = library.unk_id(), library.eos_id()
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}  # lower merges first
        self.decoded, self.control = [""] * size, set()
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.decoded[i] = chr(value) if value < 0x80 else chr(0xDC00 + value)
            elif library.is_unknown(i):
                self.decoded[i] = " ⁇ "
            elif library.is_control(i):
                self.control.add(i)
            else:
                self.ids[piece], self.rank[piece] = i, -library.get_score(i)
                self.decoded[i] = piece.replace(SPACE, " ")
        self.spaced = {i for piece, i in self.ids.items() if piece.startswith(SPACE)}
        # Within a text, a cut between two characters that no piece has side by side is always a cut between pieces.
        self.neighbours = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.cut_at_spaces = not any(b == SPACE and a != SPACE for a, b in self.neighbours)
        self.automaton = ahocorasick.Automaton()
        usable = {p for p in self.ids if self.merge(p) == [p]}  # others never come out of merging
        for piece in usable:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.width = max(map(len, usable), default=1)
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if n == 1 or p[:n] in usable), None) for p in usable}
        self.fits = lru_cache(1 << 18)(self._fits)
        self.atom = lru_cache(1 << 16)(self._atom)
        self.words: dict[str, tuple[int, ...]] = {}  # ids of a word after one space
        self.older = self.words
        self.digits = [str(i) for i in range(size)]

    def merge(self, text: str) -> list[str]:
        """Pieces by merging: the neighbours with the best piece first, the leftmost of equals. For short texts."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, float("inf")) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == float("inf"):
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _fits(self, left: str, right: str) -> bool:
        return self.merge(left + right) == [left, right]

    def _longest(self, text: str, at: int) -> str:
        # Only as far as a piece can reach: the search copies the string that it is given.
        for end, piece in self.automaton.iter_long(text[at : at + self.width]):
            if end + 1 == len(piece):
                return piece
            break
        return text[at]  # a character of its own, to be spelled in bytes if it is no piece

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text by backtracking."""
        pieces: list[str] = []
        at, size = 0, len(text)
        dead = bytearray(size // 8 + 1)  # bitfield of positions from which no way leads on
        piece = self._longest(text, 0) if text else ""
        while at < size:
            while True:
                stop = at + len(piece)
                if not dead[stop >> 3] >> (stop & 7) & 1 and (not pieces or self.fits(pieces[-1], piece)):
                    pieces.append(piece)
                    at = stop
                    piece = self._longest(text, at) if at < size else ""
                    break
                shorter = self.shorter.get(piece)
                if shorter is None:  # nothing fits here: step back and never come here again
                    dead[at >> 3] |= 1 << (at & 7)
                    piece = pieces.pop()
                    at -= len(piece)
                    break
                piece = shorter
        return pieces

    def _spell(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]

    def _atom(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self._spell, self.backtrack(text))))

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a chunk, which is cut further where no piece can reach across."""
        if not chunk[1:].isalpha():
            cuts = [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in self.neighbours]
            if cuts:
                bounds = [0, *cuts, len(chunk)]
                return tuple(chain.from_iterable([self.atom(chunk[a:b]) for a, b in zip(bounds, bounds[1:])]))
        return self._atom(chunk)

    def _word(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word) or self._chunk(SPACE + word)
        if len(word) <= _CACHE_CHARS:
            if len(self.words) >= _CACHE_SIZE:
                self.older, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def _chunks(self, text: str) -> list[tuple[int, ...]]:
        text = text.replace(SPACE, " ")
        if not text:
            return []
        if not self.cut_at_spaces:
            return [self._chunk(SPACE + text.replace(" ", SPACE))]
        words = text.split(" ")
        get, make = self.words.get, self._word
        if "" not in words:
            return [get(w) or make(w) for w in words]
        ids, spaces = [], SPACE  # runs of spaces stay together, before the word that follows them
        for word in words[:-1]:
            if word:
                ids.append(get(word) or make(word) if spaces == SPACE else self._chunk(spaces + word))
                spaces = ""
            spaces += SPACE
        return [*ids, self._chunk(spaces + words[-1])]

    def encode(self, text: str) -> list[int]:
        """The library's ids with the end id and without sampling."""
        return [*chain.from_iterable(self._chunks(text)), self.end]

    def encode_with_digits(self, text: str) -> tuple[list[int], str]:
        """encode(text), and its ids in decimal joined by spaces."""
        ids, digits = self.encode(text), self.digits
        return ids, " ".join([digits[i] for i in ids])

    def decode(self, ids: Sequence[int]) -> str:
        """Text of any ids: control pieces are silent, the space of a leading piece goes, broken bytes give U+FFFD each."""
        text = "".join(map(self.decoded.__getitem__, ids))
        try:
            text.isascii() or text.encode()
        except UnicodeEncodeError:  # bytes to be joined to characters, though not across a control piece
            runs = [[]]
            for i in ids:
                runs.append([]) if i in self.control else runs[-1].append(self.decoded[i])
            encoded = ["".join(run).encode("utf-8", "surrogateescape") for run in runs]
            text = "".join(run.decode("utf-8", "tableops-one-mark-per-byte") for run in encoded)
        first = next((i for i in ids if self.decoded[i]), None)
        return text[1:] if first in self.spaced else text


@lru_cache(2)
def load(path: str) -> PieceBpe:
    """One encoder per Python worker and vocabulary."""
    return PieceBpe(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, id_text, decoded) of every row of docs (doc_id, text), lazily; no shuffle.

    ids: the encoding of the whole text with the end id; id_text: the ids in decimal joined by one space; decoded: the
    text of the ids. Null text counts as empty and gives the end id alone. A null doc_id stays the largest long
    (common.NO_ID). Other columns are ignored. ``path`` is the vocabulary file, which every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):  # ids need several times the room of their text
                part = batch.slice(start, 64)
                made = [bpe.encode_with_digits(text) for text in part.column("text").to_pylist()]
                columns = [
                    part.column("doc_id"),
                    pa.array([ids for ids, _ in made], pa.list_(pa.int32())),
                    pa.array([digits for _, digits in made], pa.string()),
                    pa.array([bpe.decode(ids) for ids, _ in made], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "id_text", "decoded"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>, id_text string, decoded string")
