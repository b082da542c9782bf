"""Training passages that hold benchmark items, found with a BM25 index of the items.

The index holds the items; every passage of every training text is a query. An
item's score is the share of its BM25 mass that the passage's words carry, so one
threshold serves items of any length. Retrieval is block-max WAND: items stand in
blocks, each term keeps its largest weight per block, and a block is scored only
when the largest weights of the passage's terms can reach the threshold: all passages
of a batch are pruned by their bounds at once, which takes the place of a moving pivot.
Terms of the least weight, which cannot lift an item over half the threshold, open no
block. Term statistics are those of the training texts, and a passage is as long as
items of one length class ask for, so what is found for an item does not depend on the
other items.
All passages retrieved are verified: enough of the question's word runs and of the
answer's words must stand in one of them. Only an item that has an answer is split;
other texts, such as prose, are all question.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.batches import unused
from adloom.llm.words import PARTS, binary_texts, hashed_words, in_order, ranges
from adloom.operators.joins import fits_broadcast
from adloom.storage import materialize

K1, B = 1.2, 0.75
THRESHOLD = 0.5
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.5, 0.5
RUN = 5
# Terms in a smaller share of the texts all weigh the same: else the words of an item that
# leaked often would weigh less than its other words.
RARE = 0.01
BLOCK_ITEMS = 4
# Words of items in one broadcast index; larger benchmarks are split into several.
SHARD_WORDS = 2_000_000
LEAST_PASSAGE = 64

RESULT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, leaked boolean"


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is what follows the last question mark, line break or sentence end
    inside the text; a text of one sentence is all question."""
    ends = [m.end() for m in re.finditer(r"[?!.](?=\s+\S)|\n+(?=\s*\S)", text)]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


# A word that opens an answer; a single letter does so at the start of a line only.
_ANSWER = re.compile(r"(?:\b(?:answer|solution|antwort|lösung|réponse|respuesta)|^[ \t]*a)[ \t]*:(?=\s*\S)", re.IGNORECASE | re.MULTILINE)


def parts_to_find(text: str) -> tuple[str, str]:
    """Question and answer where the text marks an answer or ends in what follows a
    question mark; any other text is all question."""
    marked = [m.start() for m in _ANSWER.finditer(text) if text[: m.start()].strip()]
    if marked:
        return text[: marked[-1]], text[marked[-1] :]
    question, answer = question_and_answer(text)
    return (question, answer) if question.rstrip().endswith("?") else (text, "")


def _runs(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return words
    length = min(RUN, len(words))
    return np.unique(in_order(words, len(words) - length + 1, length))


@dataclass
class Index:
    """Items, sorted terms and two sets of postings: (term -> block, largest weight) of
    the essential terms and (term -> item, weight) of all."""

    item_ids: list[int]
    question_runs: list[np.ndarray]
    question_lengths: list[int]
    answers: list[np.ndarray]
    passage: int
    terms: np.ndarray
    essential: np.ndarray
    block_starts: np.ndarray
    blocks: np.ndarray
    block_weights: np.ndarray
    rest: np.ndarray
    item_starts: np.ndarray
    items: np.ndarray
    weights: np.ndarray


def _csr(keys: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.bincount(keys, minlength=n))))


def build_index(items: list[tuple[int, str]], df: dict[int, int], n_texts: int, passage: int) -> Index:
    """``df``: number of training texts with each term, of ``n_texts``."""
    parts = [parts_to_find(text) for _, text in items]
    questions = _word_lists([q for q, _ in parts])
    answers = _word_lists([a for _, a in parts])
    term_of, item_of, weight_of, light = [], [], [], []
    for i, (question, answer) in enumerate(zip(questions, answers, strict=True)):
        words = np.concatenate((question, answer))
        terms, tf = np.unique(words, return_counts=True)
        n = np.array([max(df.get(int(t), 0), RARE * n_texts) for t in terms.view(np.int64)], np.float64)
        idf = np.log(1 + (n_texts - n + 0.5) / (n + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / passage))
        weight /= max(weight.sum(), 1e-12)
        order = np.argsort(weight, kind="stable")
        small = np.zeros(len(terms), bool)
        small[order[np.cumsum(weight[order]) < THRESHOLD / 2]] = True
        term_of.append(terms)
        item_of.append(np.full(len(terms), i))
        weight_of.append(weight)
        light.append(small)
    terms = np.concatenate([np.empty(0, np.uint64), *term_of])
    item = np.concatenate([np.empty(0, np.int64), *item_of])
    weight = np.concatenate([np.empty(0), *weight_of])
    small = np.concatenate([np.empty(0, bool), *light])
    vocabulary, at = np.unique(terms, return_inverse=True)
    order = np.lexsort((item, at))
    block = item // BLOCK_ITEMS
    n_blocks = -(-len(items) // BLOCK_ITEMS)
    rest_of_item = np.bincount(item[small], weight[small], max(len(items), 1))
    rest = np.zeros(max(n_blocks, 1))
    np.maximum.at(rest, np.arange(len(items)) // BLOCK_ITEMS, rest_of_item[: len(items)])
    pair, where = np.unique(at[~small] * max(n_blocks, 1) + block[~small], return_inverse=True)
    largest = np.zeros(len(pair))
    np.maximum.at(largest, where, weight[~small])
    essential = np.zeros(len(vocabulary), bool)
    essential[at[~small]] = True
    return Index(
        item_ids=[i for i, _ in items],
        question_runs=[_runs(q) for q in questions],
        question_lengths=[len(q) for q in questions],
        answers=[np.unique(a) for a in answers],
        passage=passage,
        terms=vocabulary,
        essential=essential,
        block_starts=_csr(pair // max(n_blocks, 1), len(vocabulary)),
        blocks=pair % max(n_blocks, 1),
        block_weights=largest,
        rest=rest,
        item_starts=_csr(at, len(vocabulary)),
        items=item[order],
        weights=weight[order],
    )


def _word_lists(texts: list[str]) -> list[np.ndarray]:
    words, bounds = hashed_words([t.encode("utf-8", "replace") for t in texts], PARTS)
    return [words[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _postings(starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ranges(starts[keys], starts[keys + 1])


class Searcher:
    def __init__(self, index: Index) -> None:
        self.index = index
        # A first test that most words outside the vocabulary fail.
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(index.terms & np.uint64(0xFFFF)).astype(np.int64)] = True

    def _terms(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are terms, and which terms."""
        terms = self.index.terms
        at = np.flatnonzero(self.maybe[(words & np.uint64(0xFFFF)).astype(np.int64)])
        found = np.minimum(np.searchsorted(terms, words[at]), max(len(terms) - 1, 0))
        hit = terms[found] == words[at]
        return at[hit], found[hit]

    def __call__(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """(text number, item id, score, question and answer overlap) of each pair: the best
        score of its passages, and the overlaps of the passage that shows most. The texts
        are given as ``hashed_words`` gives them."""
        index = self.index
        if not len(index.terms):
            return
        # Half passages of ``passage`` words; a passage is two in a row, so any run of
        # ``passage`` words lies inside one.
        halves = -(-np.diff(bounds) // index.passage)
        first_half = np.concatenate(([0], np.cumsum(halves)))
        at, term = self._terms(words)
        text = np.searchsorted(bounds, at, "right") - 1
        half = first_half[text] + (at - bounds[text]) // index.passage
        pivot = index.essential[term]
        key = np.unique(half[pivot] * len(index.terms) + term[pivot])
        posting, owner = _postings(index.block_starts, key % len(index.terms))
        where = (key // len(index.terms))[owner] * len(index.rest) + index.blocks[posting]
        cells, back = np.unique(where, return_inverse=True)
        bound = np.bincount(back, index.block_weights[posting], len(cells))
        # A half takes part in the passage it opens and in the one it closes.
        cell_half, cell_block = cells // len(index.rest), cells % len(index.rest)
        closes = np.isin(cell_half, first_half[:-1], invert=True)
        passage = np.concatenate((cell_half, cell_half[closes] - 1)) * len(index.rest) + np.concatenate((cell_block, cell_block[closes]))
        opened, back = np.unique(passage, return_inverse=True)
        upper = np.bincount(back, np.concatenate((bound, bound[closes])), len(opened))
        reachable = upper + index.rest[opened % len(index.rest)] >= THRESHOLD - 1e-9
        opened = opened[reachable]
        # All terms of the passages opened, against the items of the blocks opened there.
        starts = np.unique(opened // len(index.rest))
        docs = np.searchsorted(first_half, starts, "right") - 1
        lows = bounds[docs] + (starts - first_half[docs]) * index.passage
        highs = np.minimum(bounds[docs + 1], lows + 2 * index.passage)
        hits, owner = ranges(np.searchsorted(at, lows), np.searchsorted(at, highs))
        key = np.unique(owner * len(index.terms) + term[hits])
        posting, back = _postings(index.item_starts, key % len(index.terms))
        where = (key // len(index.terms))[back]
        items = index.items[posting]
        block = starts[where] * len(index.rest) + items // BLOCK_ITEMS
        at_most = np.minimum(np.searchsorted(opened, block), max(len(opened) - 1, 0))
        kept = opened[at_most] == block if len(opened) else np.zeros(0, bool)
        pairs, back = np.unique(where[kept] * len(index.item_ids) + items[kept], return_inverse=True)
        scores = np.bincount(back, index.weights[posting[kept]], len(pairs))
        found = np.flatnonzero(scores >= THRESHOLD - 1e-9)
        best: dict[tuple[int, int], tuple[bool, float, float]] = {}
        top: dict[tuple[int, int], float] = {}
        # Pairs come passage by passage; runs of a passage are hashed once for each length.
        now, runs = -1, {}
        for pair, score in zip(pairs[found].tolist(), scores[found].tolist(), strict=True):
            start, item = divmod(pair, len(index.item_ids))
            if start != now:
                now, runs = start, {}
            doc = int(docs[start])
            question, answer = self._overlap(words[lows[start] : highs[start]], item, runs)
            shown = (question >= QUESTION_OVERLAP and answer >= ANSWER_OVERLAP, question, answer)
            best[doc, item] = max(best.get((doc, item), shown), shown)
            top[doc, item] = max(top.get((doc, item), score), score)
        for (doc, item), (_, question, answer) in sorted(best.items()):
            yield doc, index.item_ids[item], top[doc, item], question, answer

    def _overlap(self, passage: np.ndarray, item: int, known: dict[int, np.ndarray]) -> tuple[float, float]:
        runs, answer = self.index.question_runs[item], self.index.answers[item]
        length = min(RUN, self.index.question_lengths[item])
        if length not in known:
            known[length] = in_order(passage, max(len(passage) - length + 1, 0), length) if length else passage
        question = float(np.isin(runs, known[length]).mean()) if len(runs) else 1.0
        return question, float(np.isin(answer, passage).mean()) if len(answer) else 1.0


def length_class(words: int) -> int:
    """Words of a half passage that any run of ``words`` words fits into: a power of two."""
    return max(LEAST_PASSAGE, 1 << max(words - 1, 0).bit_length())


def _text_frequencies(texts: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """Training texts that hold each of the terms; counted per task, then summed."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            words, bounds = hashed_words(binary_texts(batch.column(0)), PARTS)
            at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
            known = np.flatnonzero(vocabulary[at] == words)
            text = np.searchsorted(bounds, known, "right") - 1
            total += np.bincount(np.unique(text * len(vocabulary) + at[known]) % len(vocabulary), minlength=len(vocabulary))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary[used].view(np.int64)), pa.array(total[used])], names=["term", "n"])

    found = texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in found.collect()}


def _search(texts: DataFrame, benchmark: DataFrame, shard_words: int) -> DataFrame:
    """The rows of ``find_leaks`` for texts (doc_id of any type, text)."""
    spark = texts.sparkSession
    kind = texts.schema["doc_id"].dataType
    schema = RESULT.replace("doc_id long", f"doc_id {kind.simpleString()}")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, bounds = hashed_words(binary_texts(batch.column(1)), PARTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(bounds), pa.int64())], names=["item_id", "text", "n"]
            )

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    items = materialize(items.mapInArrow(measure, "item_id long, text string, n long").where("n > 0"), "items")
    words = items.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first().words
    if not words:
        return texts.limit(0).mapInArrow(lambda batches: iter(()), schema)
    n_texts = texts.count()
    shards = -(-words // shard_words)
    found: DataFrame | None = None
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard).orderBy("item_id", "text")
        classes: dict[int, list[tuple[int, str]]] = {}
        for r in part.collect():
            classes.setdefault(length_class(r.n), []).append((r.item_id, r.text))
        if not classes:
            continue
        vocabulary = np.unique(np.concatenate([w for rows in classes.values() for w in _word_lists([text for _, text in rows])]))
        df = _text_frequencies(texts, vocabulary)
        indexes = spark.sparkContext.broadcast([build_index(rows, df, n_texts, passage) for passage, rows in sorted(classes.items())])

        def search(batches: Iterable[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            searchers = [Searcher(index) for index in indexes.value]
            for batch in batches:
                ids = batch.column(0)
                hashed = hashed_words(binary_texts(batch.column(1)), PARTS)
                rows = [row for searcher in searchers for row in searcher(*hashed)]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                leaked = [q >= QUESTION_OVERLAP and a >= ANSWER_OVERLAP for _, _, _, q, a in rows]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(columns[0], pa.int64())), *map(pa.array, columns[1:], kinds), pa.array(leaked, pa.bool_())],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "leaked"],
                )

        here = texts.mapInArrow(search, schema)
        found = here if found is None else found.union(here)
    return found


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """A row for each text and benchmark item whose BM25 share in some passage reaches
    THRESHOLD; ``score`` is the largest share. Every such passage is verified: ``leaked``
    when both overlaps reach theirs in one of them. The overlaps are those of a passage
    where they do, if any, and of those the one with the largest question overlap.

    Null and empty texts give no rows, nor do items without words. Rows of ``docs``
    that are repeated give their rows again; of benchmark rows with one ``item_id`` and
    text one counts. A null id is carried through. No benchmark or no texts: no rows.
    An item's rows do not depend on the other items. Items are split by hash into indexes
    of about ``shard_words`` words, the only thing that is broadcast; all length classes
    of an index are searched in one pass over the texts.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return _search(texts, benchmark, shard_words)


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with their own columns,
    whatever their names. Null and empty texts stay; no rows and no items: all stay. A text
    is known by its 128-bit digest, so repeated, null and missing ids do not matter."""
    digest = F.md5(F.col(f"`{text_col}`"))
    texts = docs.select(digest.alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    (name,) = unused(docs, "_digest")
    bad = _search(texts, benchmark, SHARD_WORDS).where("leaked").select(F.col("doc_id").alias(name)).distinct()
    bad = materialize(bad, "leaks")
    bad = F.broadcast(bad) if fits_broadcast(bad) else bad
    return docs.withColumn(name, digest).join(bad, name, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
