import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from adloom.llm.piece_counts import MODEL, counter, piece_counts, zipf_score


@pytest.fixture(scope="module")
def library():
    """The library's own unigram encoder over the same pieces and scores."""
    model = model_pb2.ModelProto()
    with open(public_tokenizers.path(MODEL), "rb") as source:
        model.ParseFromString(source.read())
    model.trainer_spec.model_type = model_pb2.TrainerSpec.UNIGRAM
    rank = 0
    for piece in model.pieces:
        piece.score = 0.0
        if piece.type == model_pb2.ModelProto.SentencePiece.NORMAL:
            piece.score, rank = zipf_score(rank), rank + 1
    return SentencePieceProcessor(model_proto=model.SerializeToString())


def test_whole_table_against_the_library(documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = piece_counts(documents).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.n_pieces == len(library.encode(texts[r.doc_id])) and r.n_chars == len(texts[r.doc_id])


@pytest.mark.parametrize(
    "text",
    ["", " ", "  a  b ", "\n\n x\t", "héé 漢字 🎉 x", "▁▁a b", "a▁b▁", "ﷺ word", "x" * 300, "漢" * 10, "aaaa bbbb", "é́ \x01"],
)
def test_texts(library, text):
    assert counter(public_tokenizers.path(MODEL))(text) == len(library.encode(text))


def test_ties_and_full_cache(library, documents):
    from adloom.llm.piece_counts import PieceCounter, load_vocabulary

    small = PieceCounter(load_vocabulary(public_tokenizers.path(MODEL)), most_words=3)
    for r in documents.limit(20).collect():
        assert small(r.text) == len(library.encode(r.text))
    flat = PieceCounter({"a": -1.0, "b": -1.0, "ab": -2.0, "▁": -1.0})
    # Equal scores: the longest last piece wins.
    assert flat("ab") == 2


def test_awkward_rows(awkward, no_docs):
    got = {r.doc_id: r.n_pieces for r in piece_counts(awkward).collect()}
    assert got[4] == got[5] == 0 and got[11] > 0
    assert piece_counts(awkward).count() == awkward.count()
    assert piece_counts(no_docs).count() == 0
