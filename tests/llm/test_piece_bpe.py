"""BPE by backtracking against the library, and decoding of any ids."""

import public_tokenizers
import pytest
import sentencepiece
from brute import table
from hypothesis import given, settings
from hypothesis import strategies as st

from tableops.llm.common import NO_ID
from tableops.llm.piece_bpe import encode_documents, load

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "aabehinorst THE.,\n\t▁éñ日😀z019!-_\x00"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(ALPHABET, max_size=80), st.text(st.characters(exclude_categories=["Cs"]), max_size=30)))
def test_same_ids_and_text(text):
    sp, bpe = sentencepiece.SentencePieceProcessor(model_file=PATH), load(PATH)
    ids = [*sp.encode(text), sp.eos_id()]
    assert bpe.encode(text) == ids and bpe.decode(ids) == sp.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(3, 258)), max_size=12))
def test_decode_any_ids(ids):
    assert load(PATH).decode(ids) == sentencepiece.SentencePieceProcessor(model_file=PATH).decode(ids)


def test_backtracking_equals_merging():
    bpe = load(PATH)
    for text in ("▁entrenching", "aaaaaaaaaaaaa", "▁thndwhstouer", "xyxyxyzzzz"):
        assert bpe.backtrack(text) == bpe.merge(text)


def test_table(spark, library):
    rows = [(1, "The quick"), (1, "The quick"), (2, None), (3, ""), (None, "x  y"), (4, "long " * 30000 + "z" * 3000)]
    df = table(spark, rows).selectExpr("*", "1 AS ids", "2 AS decoded")
    got = sorted((r.doc_id, list(r.ids), r.id_text, r.decoded) for r in encode_documents(df, PATH).collect())
    want = []
    for i, text in rows:
        ids = [*library.encode(text or ""), 2]
        want.append((NO_ID if i is None else i, ids, " ".join(map(str, ids)), library.decode(ids)))
    assert got == sorted(want)
    assert encode_documents(table(spark, []), PATH).collect() == []
