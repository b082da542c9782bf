import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from adloom.llm.token_ids import (
    END_ID,
    TOKENIZER,
    IdFile,
    IdFileWriter,
    bits_for,
    encoder,
    pack,
    read_token_ids,
    token_file_table,
    unpack,
    write_token_ids,
)


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 16, 17, 24, 31, 32])
def test_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = pack(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert (unpack(data, n, bits) == ids).all()


def test_bits():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 49_408)] == [1, 1, 2, 8, 9, 16]


def test_file_random_access(tmp_path):
    path = str(tmp_path / "a.idpk")
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 5000, n).astype(np.uint32) for n in (0, 5, 100, 1, 64, 333)]
    with open(path, "wb") as sink:
        writer = IdFileWriter(sink, 13, block_ids=64)
        for i, ids in enumerate(docs):
            writer.add(None if i == 0 else i, ids)
        writer.close()
    every = np.concatenate(docs)
    file = IdFile(path)
    for low, high in [(0, 0), (0, 1), (63, 65), (100, 400), (0, len(every))]:
        assert (file.ids(low, high) == every[low:high]).all()
    got = list(file.documents(span=100))
    assert [g[0] for g in got] == [None, 1, 2, 3, 4, 5]
    assert all((g[2] == d).all() for g, d in zip(got, docs, strict=True))
    (tmp_path / "b.idpk").write_bytes((tmp_path / "a.idpk").read_bytes()[:-9])
    with pytest.raises(ValueError):
        IdFile(str(tmp_path / "b.idpk"))


def expected(rows):
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table_against_the_library(spark, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    got = sorted(tuple(r) for r in token_file_table(spark, documents).collect())
    assert got == expected(rows)


def test_awkward_rows(spark, awkward):
    got = token_file_table(spark, awkward).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:]) and len(ids) == awkward.count()
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got][:-1]]).tolist()
    want = {(a, c, d) for a, _, c, d in expected([(r.doc_id, r.text) for r in awkward.collect()])}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want


def test_no_rows(spark, no_docs, tmp_path):
    assert token_file_table(spark, no_docs).count() == 0


def test_ids_come_back(spark, documents, tmp_path):
    manifest = write_token_ids(documents.where("doc_id < 40"), str(tmp_path))
    assert manifest.agg({"n_docs": "sum"}).first()[0] == 40
    row = read_token_ids(manifest).where("doc_id = 7").first()
    text = documents.where("doc_id = 7").first().text
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    assert row.ids == [*library.encode(text, add_special_tokens=False).ids, END_ID]


@pytest.mark.parametrize(
    "text",
    ["", "a", "Word, word. WORD", "it's they'll. x's, don't.", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "\x02 a\x02b \x02",
     "é É. İ. İ ﬁ, ½.", "a.b, ... ,, 5. 12,", " x y\x1cz\x85w", "漢字。, é."],
)
def test_words_give_the_ids_of_the_text(text):
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    got = encoder(public_tokenizers.path(TOKENIZER))([text.encode()])[0].tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


def test_writer_needs_no_seek(tmp_path):
    class Forward(io.BytesIO):
        def seek(self, *_):
            raise OSError

    writer = IdFileWriter(Forward(), 16)
    writer.add(1, np.arange(10, dtype=np.uint32))
    writer._flush(writer.held)
