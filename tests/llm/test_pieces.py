import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import pieces as P

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    path = P.default_model()
    with open(path, "rb") as file:
        return P.Pieces(file.read()), sentencepiece.SentencePieceProcessor(model_file=path)


def encoded(pieces, text):
    return pieces.encode_words(pieces.split(text))[0].tolist()


CASES = [
    "", " ", "  a", "a  b ", "a\tb\n\nc", "▁x", "\x00a", "é\U0001f600　x", "<s>", "<0x41>", "   " * 40,
    "a" * 1000, "ab" * 700, " " * 900, "x" + " " * 33 + "\U0001f600" * 9, "aaaaaaa bbbbbbbb", "====" * 90, "İK�",
]


@pytest.mark.parametrize("text", CASES)
def test_same_ids_and_text_as_the_library(both, text):
    pieces, library = both
    ids = encoded(pieces, text)
    assert ids == library.encode(text)
    assert pieces.decode(np.array(ids, np.int32)) == library.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeth nio.,=-0123\n▁"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_random_texts(both, text):
    pieces, library = both
    ids = encoded(pieces, text)
    assert ids == library.encode(text)
    assert pieces.decode(np.array(ids, np.int32)) == library.decode(ids)


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("ab ▁=the"), min_size=200, max_size=400))
def test_queue_and_rounds_agree(both, text):
    pieces, library = both
    symbols = pieces.symbols(P.SPACE + text.replace(" ", P.SPACE))
    want = library.encode(text)
    assert pieces.ids(P.merge_by_heap(pieces, symbols.tolist())) == want
    assert pieces.ids(P.merge_in_rounds(pieces, symbols, np.zeros(len(symbols), np.int64))[0].tolist()) == want


def test_documents_against_the_library(spark, both):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in P.encode_texts(docs, P.default_model()).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = both[1].encode(row.text)
        assert got[row.doc_id].ids == ids
        assert got[row.doc_id].decoded == both[1].decode(ids)


def test_nulls_empty_tables_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "a b", "y"), (1, None, "x")], "doc_id long, text string, ids string")
    rows = sorted(P.token_digests(P.encode_texts(docs, P.default_model())).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [(r.doc_id, r.n_tokens) for r in rows] == [(1, 0), (1, 0), (None, 2)]
    assert P.encode_texts(docs.where(F.lit(False)), P.default_model()).count() == 0
