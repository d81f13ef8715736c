"""Short licence notices in whole texts, also with a few wrong, missing or additional characters.

A notice that may have k errors is cut into k + 1 pieces, one of which any such match must hold unchanged (pigeonhole). One
Aho-Corasick automaton finds the pieces of all notices in a slice of texts at once; each hit gives a window of bounded
length, and windows of one notice that overlap become one. The regex library's bounded-error matching then decides and
reports the span. A place without any error holds all pieces of a notice one after the other, so the places of base notices are
read from the same hits exactly.

A text is compared as its words joined by one space: runs of 0-9, a-z (A-Z in lower case) and all characters beyond ASCII.
Notices match whole words only.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableops.llm.words import LOWER, SYMBOLS, buffers, slices, split_words

ERROR_SHARE, MAX_ERRORS = 0.1, 3  # errors per character of a notice; more than three would cost the matcher much time


@dataclass(frozen=True)
class Notice:
    """A phrase of lower-case words with one space between them. Places of base notices are counted."""

    phrase: str
    label: str
    base: bool = False


# The base phrases and their labels.
BASE = (
    Notice("gnu general public license", "gpl", True),
    Notice("apache license", "apache", True),
    Notice("cc by", "cc-by", True),
    Notice("mit license", "mit", True),
)
# Telling parts of the standard texts of public licences.
NOTICES = BASE + (
    Notice("gnu affero general public license", "agpl"),
    Notice("gnu lesser general public license", "lgpl"),
    Notice("this program is free software you can redistribute", "gpl"),
    Notice("licensed under the apache license version 2", "apache"),
    Notice("permission is hereby granted free of charge", "mit"),
    Notice("redistribution and use in source and binary forms", "bsd"),
    Notice("permission to use copy modify and or distribute", "isc"),
    Notice("terms of the mozilla public license", "mpl"),
    Notice("eclipse public license", "epl"),
    Notice("creative commons attribution", "cc-by"),
    Notice("cc by nc", "cc-by-nc"),
    Notice("cc by nd", "cc-by-nd"),
    Notice("cc by sa", "cc-by-sa"),
    Notice("cc0 1 0 universal", "cc0"),
    Notice("free and unencumbered software", "unlicense"),
)

_NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
_SPAN = pa.struct([("label", pa.string()), ("notice", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int32())])
_TYPES = [*[pa.int64()] * 5, pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), pa.list_(_SPAN)]
_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
    "score double, spans array<struct<label:string,notice:string,start:long,end:long,errors:int>>"
)


def allowed_errors(phrase: str) -> int:
    return min(MAX_ERRORS, int(len(phrase) * ERROR_SHARE))


def pieces(phrase: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of errors + 1 pieces of about the same length."""
    cuts = [len(phrase) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Automaton over the pieces of all notices, and a bounded-error pattern for each notice."""

    def __init__(self, notices: Sequence[Notice]) -> None:
        import ahocorasick
        import regex

        self.notices, self.errors = notices, [allowed_errors(n.phrase) for n in notices]
        self.automaton, self.patterns, self.offsets = ahocorasick.Automaton(), [], []
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (notice, k) in enumerate(zip(notices, self.errors)):
            if not notice.phrase.isascii() or len(notice.phrase) < 2 * (k + 1):
                raise ValueError(f"A notice needs ASCII words and pieces of two characters: {notice.phrase!r}")
            self.offsets.append([a for a, _ in pieces(notice.phrase, k)])
            for offset, piece in pieces(notice.phrase, k):
                found[piece].append((i, offset))
            self.patterns.append(regex.compile(f"(?e)(?<= )(?:{regex.escape(notice.phrase, literal_spaces=True)}){{e<={k}}}(?= )"))
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def hits(self, plain: str) -> dict[int, dict[int, np.ndarray]]:
        """Of each notice and piece offset, where the notice would start if the piece stands in its place."""
        starts: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for end, (size, uses) in self.automaton.iter(plain):
            for i, offset in uses:
                starts[i][offset].append(end + 1 - size - offset)
        return {i: {o: np.array(v, np.int64) for o, v in s.items()} for i, s in starts.items()}

    def exact(self, plain: str, i: int, hits: dict[int, np.ndarray]) -> list[int]:
        """Places of notice i without an error, ascending."""
        size, places = len(self.notices[i].phrase), None
        for offset in self.offsets[i]:
            mine = hits.get(offset, np.zeros(0, np.int64))
            places = mine if places is None else np.intersect1d(places, mine)
        return [p for p in np.unique(places).tolist() if plain[p - 1] == " " == plain[p + size]]

    def near(self, plain: str, i: int, hits: dict[int, np.ndarray], text_at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(start, end, errors) of the matches of notice i, from left to right and not overlapping."""
        k, size = self.errors[i], len(self.notices[i].phrase)
        reach = 4 * k  # an error is a character of four bytes at most
        rows = np.concatenate([np.searchsorted(text_at, s + offset, "right") - 1 for offset, s in hits.items()])
        rows, starts = np.unique(np.stack([rows, np.concatenate(list(hits.values()))]), axis=1)
        cut = np.flatnonzero((np.diff(rows) > 0) | (np.diff(starts) > size + 2 * reach + 2))
        firsts, lasts = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(rows) - 1]])
        limits = [*text_at.tolist(), len(plain)]
        for row, low, high in zip(rows[firsts].tolist(), starts[firsts].tolist(), starts[lasts].tolist()):
            a, b = max(limits[row] + 1, low - reach), min(limits[row + 1], high + size + reach)  # within one text
            left = "" if plain[a] == " " else " " if plain[a - 1] == " " else "\n"
            right = " " if plain[b : b + 1] == " " else "\n"
            body = plain[a:b]
            if body.isascii():
                text, place = left + body + right, None
            else:  # compare characters, not bytes; a cut one at either end is none that a match could hold
                body = body.encode("latin-1").decode("utf-8", "surrogateescape")
                text = left + body + right
                place = np.cumsum([0, *[len(c.encode("utf-8", "surrogateescape")) for c in body]])
            for match in self.patterns[i].finditer(text):
                at = [x - len(left) for x in match.span()]
                at = at if place is None else [int(place[x]) for x in at]
                yield a + at[0], a + at[1], sum(match.fuzzy_counts)


@lru_cache(2)
def scanner(notices: tuple[Notice, ...]) -> Scanner:
    """One per Python worker and list of notices."""
    return Scanner(notices)


def plain_text(part: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """Texts of a slice as bytes: a line feed, then a space before and after each word. Also where texts and words begin there."""
    sizes = end - start
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))  # of each word
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    word_at = at[:-1] + np.arange(1, len(sizes) + 1) + 2 * text + 1
    out = np.full(int(at[-1]) + len(sizes) + 2 * (len(first) - 1), ord(" "), np.uint8)
    text_at = at[first[:-1]] + first[:-1] + 2 * np.arange(len(first) - 1)
    out[text_at] = ord("\n")
    steps = np.arange(int(at[-1]))
    out[steps + np.repeat(word_at - at[:-1], sizes)] = LOWER[part[steps + np.repeat(start - at[:-1], sizes)]]
    return out.tobytes().decode("latin-1"), text_at, word_at


def _scan(notices: tuple[Notice, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = scanner(notices)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            data, offsets = buffers(texts)
            for low, high in slices(offsets):
                begin, part = offsets[low : high + 1] - offsets[low], data[offsets[low] : offsets[high]]
                start, end, first = split_words(part, begin, SYMBOLS)
                plain, text_at, word_at = plain_text(part, start, end, first)
                places, spans = defaultdict(list), defaultdict(list)
                hits = search.hits(plain)
                letters = np.cumsum((part & 0xC0) != 0x80) if hits else None
                for i, mine in hits.items():
                    notice = notices[i]
                    if notice.base:
                        for p in search.exact(plain, i, mine):
                            word = int(np.searchsorted(word_at, p))
                            row = int(np.searchsorted(text_at, p, "right")) - 1
                            places[row].append((word - int(first[row]), notice.label))
                    for p, q, errors in search.near(plain, i, mine, text_at):
                        row = int(np.searchsorted(text_at, p, "right")) - 1
                        a, b = int(np.searchsorted(word_at, p)), int(np.searchsorted(word_at, q)) - 1
                        before = letters[begin[row] - 1] if begin[row] else 0
                        place = int(letters[start[a]] - 1 - before), int(letters[end[b] - 1] - before)
                        spans[row].append((*place, notice.label, notice.phrase, errors))
                rows = []
                for row in range(high - low):
                    base, near = places.get(row, []), sorted(spans.get(row, []))
                    labels = {label for _, label in base}
                    score = max([float(bool(base)), *[1 - e / len(phrase) for _, _, _, phrase, e in near]])
                    at = [word for word, _ in base]
                    listed = [{"label": x, "notice": p, "start": s, "end": e, "errors": k} for s, e, x, p, k in near]
                    every = sorted(labels | {s[2] for s in near})
                    numbers = (int(first[row + 1] - first[row]), len(base), min(at, default=None), max(at, default=None))
                    rows.append((*numbers, sorted(labels), every, score, listed))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES[1:])]
                yield pa.RecordBatch.from_arrays([ids.slice(low, high - low), *columns], _NAMES)

    return run


def scan_notices(docs: DataFrame, notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of each row of docs (doc_id, text).

    n_base counts the places of base notices without any error, first_word and last_word are the first and last word, from 0,
    where one starts (null without any). base_labels and labels are sorted arrays, the latter with those of matches with up
    to a tenth of a notice's characters wrong, three at most. spans lists all matches as character ranges of the text (start,
    end), their notice and errors: those of one notice don't overlap. score is 1 for a base place, else the best share of
    right characters, 0 without a match. Null text is empty: no words, no labels. Repeated rows and null ids come back as they
    are. An empty table gives an empty result; other columns are ignored. No shuffle; lazy. A text is one task's, whole.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return docs.mapInArrow(_scan(tuple(notices)), _SCHEMA)
