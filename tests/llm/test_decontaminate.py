import collections
import re

import numpy as np

from adloom.llm import decontaminate
from adloom.llm.decontaminate import Searcher, build_index, find_leaks, parts_to_find, question_and_answer, without_leaks
from adloom.llm.words import PARTS, hashed_words

ITEMS = "item_id long, text string"
FILLER = [f"fill{i}" for i in range(500)]


def benchmark_of(n=40, words=30):
    rng = np.random.default_rng(9)
    return [(i, " ".join([*(f"q{i}x{j}" for j in range(words - 8)), *rng.choice(FILLER[:20], 4)]) + "? the answer is " + f"a{i}") for i in range(n)]


def around(text, before=150, after=150):
    return " ".join([*FILLER[:before], text, *FILLER[100 : 100 + after]])


def leaks(df):
    return {(r.doc_id, r.item_id) for r in df.collect() if r.leaked}


def test_planted_items_are_found(spark):
    items = benchmark_of()
    rows = [(i, around(text.upper(), 10 * i)) for i, text in items[:20]] + [(100 + i, around("")) for i in range(20)]
    cut = items[30][1].split()
    rows.append((200, around(" ".join(cut[:5]))))
    cut[3] = "changed"
    rows.append((201, around(" ".join(cut))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, ITEMS)
    found = find_leaks(docs, benchmark)
    assert leaks(found) == {(i, i) for i in range(20)} | {(201, 30)}
    # Several small indexes give what one gives.
    assert leaks(find_leaks(docs, benchmark, shard_words=300)) == leaks(found)
    kept = {r.doc_id for r in without_leaks(docs, benchmark).collect()}
    assert kept == {100 + i for i in range(20)} | {200}


def test_scores_against_every_passage_and_item():
    """Block-max WAND against scoring all items for all passages."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words, rng.integers(4, 25)))) for i in range(70)]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 3, 40, 200, 700)]
    texts += [" ".join([texts[2], items[k][1], texts[1]]) for k in range(20)]
    lists = [t.split() for _, t in items]
    df = collections.Counter(w for ws in lists for w in set(ws))
    hashed, bounds = hashed_words([" ".join(df).encode()], PARTS)
    of = dict(zip(hashed.view(np.int64).tolist(), df, strict=True))
    passage = 64
    index = build_index(items, {h: df[w] for h, w in of.items()}, len(items), passage)
    got = {(d, i): s for d, i, s, _, _ in Searcher(index)(*hashed_words([t.encode() for t in texts], PARTS))}
    want = {}
    for d, text in enumerate(texts):
        ws = text.split()
        halves = max(1, -(-len(ws) // passage))
        for start in range(0, halves, 1):
            inside = set(ws[start * passage : (start + 2) * passage])
            for i, item in enumerate(lists):
                tf = collections.Counter(item)
                weight = {
                    w: np.log(1 + (len(items) - max(df[w], 0.7) + 0.5) / (max(df[w], 0.7) + 0.5))
                    * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(item) / passage))
                    for w, n in tf.items()
                }
                share = sum(v for w, v in weight.items() if w in inside) / sum(weight.values())
                if share >= decontaminate.THRESHOLD - 1e-9:
                    want[d, i] = max(share, want.get((d, i), 0))
    assert got.keys() == want.keys() and len(want) > 50
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_whole_table_against_brute_force(spark, sf_dir, documents):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")

    def runs(text):
        words = re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.lower())
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    items = {r.item_id: runs(r.text) for r in benchmark.collect()}
    want = {(r.doc_id, i) for r in documents.collect() for i, x in items.items() if len(x & runs(r.text)) >= 0.6 * len(x)}
    assert want and want <= leaks(find_leaks(documents, benchmark))
    assert len(leaks(find_leaks(documents, benchmark))) <= len(want) + 1


def test_awkward_rows(spark, awkward, no_docs):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "..."), (4, "few words"), (4, "few words"), (None, "one two three four five six seven"), (6, "absent thing")], ITEMS
    )
    found = find_leaks(awkward, items)
    got = sorted(((r.doc_id, r.item_id) for r in found.collect() if r.leaked), key=repr)
    assert got == sorted([(1, None), (2, None), (2, None), (3, None), (None, None), (9, 4)], key=repr)
    assert find_leaks(no_docs, items).count() == 0
    empty = spark.createDataFrame([], ITEMS)
    assert find_leaks(awkward, empty).count() == 0
    assert without_leaks(awkward, empty).count() == awkward.count()
    assert without_leaks(awkward, items).columns == awkward.columns


def test_question_and_answer():
    assert question_and_answer("What is it? A cat.") == ("What is it?", " A cat.")
    assert question_and_answer("One. Two. Three.") == ("One. Two.", " Three.")
    assert question_and_answer("line one\nline two") == ("line one\n", "line two")
    assert question_and_answer("only this.") == ("only this.", "")
    assert question_and_answer("") == ("", "")


def test_every_passage_is_verified(spark):
    """Shuffled copies, with as many of the words or more, stand before the copy that counts."""
    rng = np.random.default_rng(5)
    items = [*benchmark_of(), (90, " ".join(f"long{i}" for i in range(300)))]
    rows = []
    for i, text in items[:10]:
        shuffled, edited = rng.permutation(text.split()), text.split()
        edited[3] = "changed"
        rows.append((i, " ".join([*shuffled, *(FILLER * 3), text, *FILLER])))
        rows.append((100 + i, " ".join([*shuffled, *(FILLER * 3), " ".join(edited), *FILLER])))
        rows.append((200 + i, " ".join([*shuffled, *(FILLER * 3), *shuffled])))
    found = find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert leaks(found) == {(d, i) for i in range(10) for d in (i, 100 + i)}
    assert {r.question_overlap for r in found.collect() if r.doc_id < 10} == {1.0}


def test_only_marked_answers_are_split_off():
    assert parts_to_find("What is it? A cat.") == ("What is it?", " A cat.")
    assert parts_to_find("Pick one.\nA: the cat. It purrs.") == ("Pick one.\n", "A: the cat. It purrs.")
    assert parts_to_find("Explain. Answer: a cat") == ("Explain. ", "Answer: a cat")
    for text in ("One. Two. Er.", "line one\nline two", "Why? So it is. It ends.", "Answer: yes.", "only this?", ""):
        assert parts_to_find(text) == (text, "")


def test_prose_without_its_last_sentence_is_a_leak(spark):
    prose = [(i, ". ".join(" ".join(f"w{i}x{s}x{j}" for j in range(9)) for s in range(4)) + ". Er.") for i in range(5)]
    asked = [(50, " ".join(f"q{j}" for j in range(20)) + "? It is the answer")]
    rows = [(i, around(text.removesuffix(" Er."))) for i, text in prose] + [(50, around(asked[0][1].split("?")[0]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert leaks(find_leaks(docs, spark.createDataFrame(prose + asked, ITEMS))) == {(i, i) for i in range(5)}


def test_table_items_without_their_last_sentence(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    rows = [(r.item_id, around(question_and_answer(r.text)[0])) for r in benchmark]
    # At least half of the item has to stand before its last sentence.
    long = {i for i, text in rows for r in benchmark if r.item_id == i and len(question_and_answer(r.text)[0]) >= 0.7 * len(r.text)}
    found = leaks(find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(benchmark)))
    assert len(long) > 10 and {(i, i) for i in long} <= found


def test_items_do_not_depend_on_each_other(spark):
    """Items of 600 and of 3,000 words beside short ones, in one index or in several."""
    rng = np.random.default_rng(8)
    short = [*benchmark_of(), (70, " ".join(f"s{i}" for i in range(20)))]
    long = [(80, " ".join(rng.choice(FILLER, 600))), (81, " ".join(f"v{i}" for i in range(3000)))]
    scattered = " ".join(f"s{i} " + " ".join(FILLER[10 * i : 10 * i + 10]) for i in range(11))
    rows = [(i, around(text)) for i, text in short[:10]] + [(70, scattered), (71, around(long[1][1])), (72, long[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    alone = sorted(map(tuple, find_leaks(docs, spark.createDataFrame(short, ITEMS)).collect()))
    assert (70, 70) not in {r[:2] for r in alone if r[5]}
    for words in (10**6, 500):
        found = find_leaks(docs, spark.createDataFrame(short + long, ITEMS), shard_words=words).collect()
        assert sorted(tuple(r) for r in found if r.item_id < 80) == alone
        assert {(r.doc_id, r.item_id) for r in found if r.leaked} >= {(71, 81), (72, 80)}


def test_clean_texts_stay_under_any_column_names(spark):
    items = benchmark_of(3)
    rows = [(1, around(items[0][1]), "a", 1, 2), (1, None, "b", 1, 2), (None, "", "c", 1, 2), (2, "plain", "d", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _digest string, _hash int, item_id int")
    kept = without_leaks(docs, spark.createDataFrame(items, ITEMS))
    assert kept.columns == docs.columns and sorted(r[2] for r in kept.collect()) == ["b", "c", "d"]
