import collections

import numpy as np
import pytest

from adloom.llm.components import star_components
from adloom.llm.near_dup import (
    band_keys,
    min_max_signature,
    near_duplicates,
    one_of_each_group,
)
from adloom.llm.words import BLOCK, hashed_words, shingle_sets


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, found in enumerate(sets):
        common = collections.Counter(j for s in found for j in holders[s])
        for j, n in common.items():
            if 100 * n >= 75 * (len(found) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for s in found:
            holders[s].append(i)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None and sets[i]:
            names[find(i)] = min(doc_id, names.get(find(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        name = names.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), name, doc_id == name))
    return out


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def test_whole_table_against_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(near_duplicates(documents)) == sorted(brute_force(rows), key=repr)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(near_duplicates(awkward)) == sorted(brute_force(rows), key=repr)


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert one_of_each_group(no_docs).columns == no_docs.columns


def test_chain_through_the_threshold(spark):
    """Neighbours are linked, the ends are not alike: one component."""
    words = [f"w{i}" for i in range(400)]
    rows = [(10 + k, " ".join(words[k * 25 : k * 25 + 200])) for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(df)) == sorted(brute_force(rows), key=repr)
    assert {r.component_id for r in near_duplicates(df).collect()} == {10}


def test_star_of_copies_that_only_the_original_links(spark):
    """Copies differ from each other by more than the threshold, not from the original."""
    words = [f"w{i}" for i in range(300)]
    rows = [(50, " ".join(words))]
    for k in range(24):
        changed = list(words)
        for j in range(10):
            changed[(k * 11 + j * 29) % 300] = f"x{k}-{j}"
        rows.append((100 - k, " ".join(changed)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(df)) == sorted(brute_force(rows), key=repr)


def test_one_of_each_group(awkward):
    left = one_of_each_group(awkward)
    assert left.columns == awkward.columns
    ids = sorted((r.doc_id, r.text is None) for r in left.collect() if r.doc_id is not None)
    # Id 2 repeats id 1; 8 is a near copy of 7; empty texts stay.
    assert [i for i, _ in ids] == [1, 4, 5, 6, 7, 9, 9, 10, 11]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 7), (60, 50), (50, 55), (55, 60), (9, 9)]
    got = {r.node: r.root for r in star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 1, 50: 50, 55: 50, 60: 50}
    assert star_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_min_max_estimates_are_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 1 << 63, 700).astype(np.uint64)
        a, b = pool[:500], pool[100:600]
        errors.append((min_max_signature(a) == min_max_signature(b)).mean() - 400 / 600)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert len(set(band_keys(min_max_signature(pool)).tolist())) == 40


@pytest.mark.parametrize("cut", [BLOCK - 3, BLOCK, 2 * BLOCK + 11])
def test_blocks_do_not_change_words(cut):
    text = (b"ab cde\t" * (3 * BLOCK // 7 + 9))[:cut] + b"ends here"
    words, bounds = hashed_words([b"x", text, b""])
    lookup = {}
    expected = [b"x", *text.split()]
    assert len(words) == len(expected) and bounds.tolist() == [0, 1, len(expected), len(expected)]
    for value, word in zip(words.tolist(), expected, strict=True):
        assert lookup.setdefault(word, value) == value
    assert len(set(lookup.values())) == len(lookup)


def test_shingle_sets():
    sets = shingle_sets([b"", b"a b", b"a B", b"a b c d e f", b"\n a  b c d\te f "])
    assert [len(s) for s in sets] == [0, 1, 1, 2, 2]
    assert (sets[1] == sets[2]).all() and (sets[3] == sets[4]).all()


def test_rows_without_an_id_read_their_own_text_only(spark, monkeypatch):
    """Each text that shares a bucket is read again once, not once for every row without an id."""
    from adloom.llm import near_dup

    rows = [(None, " ".join(f"w{i // 2}x{j}" for j in range(40)) + (" end" if i % 2 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    read = []
    plain = near_dup.set_blocks

    def counting(docs, wanted, id_col, text_col):
        blocks = plain(docs, wanted, id_col, text_col)
        read.append((blocks.selectExpr("sum(size(nodes)) n").first().n, wanted.count()))
        places = wanted.select("place.doc_id", "place.text_hash").distinct().count()
        assert places == wanted.count()
        return blocks

    monkeypatch.setattr(near_dup, "set_blocks", counting)
    found = near_dup.near_duplicates(docs).collect()
    assert len(found) == 400 and read == [(400, 400)]
    assert len({r.text_hash for r in found}) == 400 and {r.component_id for r in found} == {None}
