import math
import re
from collections import Counter

import numpy as np
import pytest

from adloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, len(w), Counter(w)) for i, w in counted if w]
    n_docs, total = len(counted), sum(n for _, n, _ in counted)
    df = Counter(t for _, _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, n, c in counted:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, k, None if missing else doc, -s) for k, (s, missing, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def test_whole_tables_against_brute_force(spark, sf_dir, documents, rows):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    expected = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(lexical.search(documents.repartition(7), items)) == expected
    # In many passes, the same.
    assert rows(lexical.search(documents, items, terms_per_pass=300)) == expected


def test_shared_sums():
    rng = np.random.default_rng(5)
    items = [sorted(rng.zipf(1.3, size).clip(max=80).tolist()) for size in rng.integers(0, 150, 40)]
    items = [[t - 1 for t in item] for item in items]
    sums = lexical.share(items, 80)
    value = rng.integers(1, 1000, 80)
    node = np.zeros(sums.nodes, np.int64)
    node[:80] = value
    for layer in sums.steps:
        node[layer[:, 0]] = node[layer[:, 1]] + node[layer[:, 2]]
    for item, rest in zip(items, sums.rest, strict=True):
        assert node[rest].sum() == sum(value[t] for t in item)
    # Fewer additions than item by item.
    assert sums.additions < 0.7 * sum(max(len(item) - 1, 0) for item in items)


def test_same_items_share_everything():
    sums = lexical.share([[0, 1, 2, 3]] * 3, 4)
    assert [len(r) for r in sums.rest] == [1, 1, 1] and sums.additions == 3


@pytest.mark.parametrize("piece", [1, 3, 7, 1 << 20])
def test_terms_are_whole_at_piece_ends(monkeypatch, piece):
    monkeypatch.setattr(lexical, "_PIECE", piece)
    text = "One two-three 42x ÀB漢字!🎉ok \x7f del\x00nul İ ſ K {a}[b]"
    assert lexical.term_counts(text.encode()) == Counter(t.encode() for t in terms(text))


def test_awkward_rows(spark, awkward, no_docs, rows):
    asked = [(1, "seven SIX five"), (1, "seven SIX five"), (None, "few words few"), (3, None), (4, ""), (5, "absent"), (6, "word1 word1 漢字")]
    items = spark.createDataFrame([(*r, 1, 2, 3) for r in asked], "item_id long, text string, rank int, score int, doc_id int")
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows(lexical.search(awkward, items)) == brute(docs, asked)
    assert lexical.search(no_docs, items).count() == 0
    assert lexical.search(awkward, items.limit(0)).count() == 0


def test_ties_go_by_id_over_many_tasks(spark, rows):
    same = spark.range(1000).selectExpr("1000 - id as doc_id", "'alpha beta' as text").repartition(20)
    other = spark.createDataFrame([(i, f"gamma{i}") for i in range(2000, 4000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    got = lexical.search(same.unionAll(other), items).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(1, 11))


def test_long_lengths_stay_exact(spark, rows):
    # 75 n N passes 64 bits only with whole numbers of any size; m itself is small.
    weights = np.array([1000])
    plan = lexical.plan([(1, "a")])
    table = spark.createDataFrame([(1, 10**15, [0], [10**6])], "doc_id long, n long, terms array<int>, tfs array<long>")
    n_docs, total = 10**9, 10**20
    m = 25 + 75 * 10**15 * n_docs // total
    got = lexical._ranked(table, plan, weights, n_docs, total, 10).first()
    assert got.score == 1000 * ((10**9 * 10**6) // (1000 * 10**6 + 8 * m))
