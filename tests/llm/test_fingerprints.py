import hashlib

import numpy as np

from adloom.llm.fingerprints import PhraseParser, fingerprint, fingerprints, from_text, likeness, to_text


def phrases(text):
    found, phrase = set(), ""
    for sign in text:
        phrase += sign
        if phrase not in found:
            found.add(phrase)
            phrase = ""
    return found


def check(df, rows, exact_order=True):
    got = df.collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        assert by_text.setdefault((r.n_chars, r.fingerprint), r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    return got


def test_whole_table_against_brute_force(documents):
    rows = sorted(((r.doc_id, r.text) for r in documents.collect()), reverse=True)
    got = {r.doc_id: r for r in check(fingerprints(documents), rows)}
    errors = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == to_text(fingerprint(text)) and r.edited_fingerprint == to_text(fingerprint(changed))
        for other, near in ((changed, r.near_edited), (following, r.near_next)):
            a, b = phrases(text), phrases(other)
            errors.append(near - len(a & b) / max(1, len(a | b)))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06


def test_parser_can_be_continued():
    text = "abracadabra abracadabra abracadabra"
    whole = PhraseParser().feed(text)
    assert whole.phrases == phrases(text)
    for cut in range(len(text) + 1):
        first = PhraseParser().feed(text[:cut])
        other = first.copy()
        assert first.feed(text[cut:], cut).ends == whole.ends
        assert other.feed("zzz", cut).phrases == phrases(text[:cut] + "zzz")


def test_small_sets_are_exact():
    a, b = "the cat sat on the mat", "the cat sat on the hat"
    pa, pb = phrases(a), phrases(b)
    assert abs(likeness(fingerprint(a), fingerprint(b)) - len(pa & pb) / len(pa | pb)) < 1e-12
    assert likeness(fingerprint(""), fingerprint("")) == 1.0 and likeness(fingerprint(""), fingerprint("a")) == 0.0
    assert (from_text(to_text(fingerprint(a))) == fingerprint(a)).all()


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = check(fingerprints(awkward), rows)
    assert {r.doc_id for r in got if r.n_chars == 0} == {None, 4, 5}
    # Rows with a null id come last; the first row follows them.
    last = [r for r in got if r.doc_id is None]
    assert len(last) == 2
    same = [r for r in got if r.doc_id == 2]
    assert len(same) == 2 and 1.0 in {r.near_next for r in same}


def test_one_row_follows_itself(spark, no_docs):
    df = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    row = fingerprints(df).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert fingerprints(no_docs).count() == 0
