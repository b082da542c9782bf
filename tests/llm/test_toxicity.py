import zlib

import numpy as np
import pytest

from adloom.llm import toxicity
from adloom.llm.toxicity import Decoder, fit, gram_counts, language_model, restore, score


@pytest.fixture(scope="module")
def decoder(documents):
    return Decoder(language_model(gram_counts([r.text for r in documents.collect()] + ["stupid idiot loser trash"] * 50)))


@pytest.mark.parametrize(
    "written, read",
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("$tup1d", "stupid"), ("l0ser", "loser"),
     ("tr@sh", "trash"), ("iiidddiooot", "idiot"), ("STUP1D", "stupid")],
)
def test_decoding(decoder, written, read):
    assert restore(f"the {written} and", decoder).split() == ["the", read, "and"]


def test_plain_text_stays(decoder):
    for text in ["", "a", "The end. Of it!", "well, 1999 and 12.5", "shout!! $$$ ### here***", "a b"]:
        assert restore(text, decoder) == text


@pytest.mark.parametrize(
    "written, read",
    [("i d 1 o t", "idiot"), ("1 d 1 0 t", "idiot"), ("l 0 s 3 r", "loser"), ("m 0 r 0 n", "moron"),
     ("i  d  i  o  t", "idiot"), ("i. d. i. o. t", "idiot")],
)
def test_spelled_words_in_plain_text(written, read):
    """Nothing else in the text looks disguised."""
    decoder = Decoder(language_model(gram_counts(["you are such an idiot loser moron and that is all"] * 50)))
    assert restore(f"you are such an {written} and that is all", decoder).split() == f"you are such an {read} and that is all".split()


def test_every_spot_passes_the_first_test():
    rng = np.random.default_rng(3)
    signs = list("aabBcé1203@$!|+(<€£*._-  \n") + ["漢", "🎉", "²", "ß", "\u3000", "İ", "i"]
    patterns = (toxicity._SPELLED, toxicity._REPEATED, toxicity._MIXED)
    found = 0
    for n in rng.integers(2, 12, 40_000):
        text = "".join(rng.choice(signs, n))
        spots = [m.group() for m in toxicity._DISGUISED.finditer(text)]
        if any(toxicity._SPELLED.fullmatch(s) or any(p.search(s) for p in patterns[1:]) for s in spots):
            found += 1
            assert toxicity._suspicious(toxicity._codes(text)), text
    assert found > 10_000


def test_brute_force_over_all_readings(decoder):
    """Viterbi against every path of the lattice."""

    def total(letters, costs):
        state, sum_ = 0, costs
        for letter in [*letters, 0]:
            gram = state * toxicity.LETTERS + letter
            if letter or state % toxicity.LETTERS:
                sum_ += decoder.logp[gram]
            state = gram % toxicity.LETTERS ** (toxicity.ORDER - 1)
        return sum_

    for text in ["l0s3r", "a$1b", "s-t0p"]:
        paths = [((), 0.0)]
        for options in decoder._lattice(text):
            paths = [(p + tuple(o[1:]), c + o[0]) for p, c in paths for o in options]
        best = max(paths, key=lambda p: total(*p))[0]
        words = "".join(chr(96 + x) if x else " " for x in best).split()
        assert decoder(text).split() == words


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lan", "mer", "tos", "vin")]
    docs, labels = [], []
    for i in range(600):
        text = list(rng.choice(words, 60))
        toxic = i % 4 == 0
        if toxic:
            for at in rng.integers(0, 60, 4):
                text[at] = rng.choice(["scoundrel", "wretch"])
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    labels += [(1000, 1, 1), (None, 0, 1), (5, 0, None)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, labelled):
    docs, labels = labelled
    model = fit(docs, labels)
    rows = score(docs, model).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    hidden = spark.createDataFrame(
        [(1, "balan scoundre1 s.c.o.u.n.d.r.e.l fimer w r e t c h"), (2, "balan fimer gutos")], "doc_id long, text string"
    )
    assert [r.predicted for r in score(hidden, model).orderBy("doc_id").collect()] == [1, 0]


def test_awkward_rows(awkward, labelled):
    model = fit(*labelled)
    rows = score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.accepted(awkward, model).schema == awkward.schema


def test_no_labels_and_no_docs(spark, no_docs, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = score(awkward, fit(awkward, labels)).collect()
    assert {r.predicted for r in rows} == {0}
    assert score(no_docs, fit(no_docs, labels)).count() == 0


def test_documents_held_out(spark, sf_dir, documents):
    big = sf_dir.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    rows = score(docs, fit(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.toxic).mean() > 0.97
    assert rows.predicted[rows.toxic == 1].mean() > 0.85


@pytest.mark.parametrize("scale, accuracy, recall", [("0.001", 0.94, 1.0), ("0.01", 0.95, 0.6)])
def test_held_out_recall_with_few_labels(spark, sf_dir, scale, accuracy, recall):
    small = sf_dir.replace("0.001", scale)
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    rows = score(docs, fit(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.toxic).mean() > accuracy
    assert rows.predicted[rows.toxic == 1].mean() >= recall


def test_weights_grow_with_the_evidence():
    texts = np.array([[k, 0] for k in range(1, 12)] + [[0, 5], [10, 100]])
    weights = toxicity.lexicon(texts, texts, np.array([1000, 10_000]), np.array([10, 100]))
    assert (np.diff(weights[:11]) > 0).all() and weights[0] > 0
    assert weights[11] == weights[12] == 0
    # A text has no share in what it is weighed by.
    counts = toxicity.Counts(np.array([5], np.uint64), np.array([[1, 0]]), np.array([[1, 0]]), np.array([50, 50]), np.array([4, 4]))
    rows = np.array([[5, 0, 0, 0, 0]], np.uint64)
    assert counts.sums_without(rows, 1)[1] == 0


def test_words_stay_whole_at_block_ends(monkeypatch):
    from adloom.llm import toxicity

    text = "some idiots and the rest, " * 40 + "x" * 90 + " Ende über"
    monkeypatch.setattr(toxicity, "_BLOCK", 1 << 20)
    whole = toxicity.word_features(text)
    for size in (1, 7, 16, 50, 333):
        monkeypatch.setattr(toxicity, "_BLOCK", size)
        pieces = list(toxicity._blocks([text]))
        assert "".join(pieces) == text
        assert (toxicity.word_features(text) == whole).all()
