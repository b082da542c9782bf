"""Ranked lexical search of many queries at once, with shared partial sums.

Benchmark items are the queries, documents are what is ranked, by a whole-number BM25.
One pass over the texts keeps, per document, its length and the counts of the terms that
any item uses. Items share terms, so their sums are planned once: pairs of terms (or of
earlier pairs) that two items or more hold become nodes of a directed acyclic graph. For
a batch of documents every node's accumulator is formed once, from its two parts, and
every item adds up the few nodes it is left with. A task keeps ten documents per item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.words import PARTS, binary_texts
from adloom.storage import materialize

# Items searched in one pass over the kept counts hold about this many terms in all.
TERMS_PER_PASS = 200_000
# Pairs are looked for among so many neighbouring shared terms of an item.
PAIR_WINDOW = 64
# Accumulators of one batch: nodes x documents.
CELLS = 4_000_000
_PIECE = 1 << 20

# Letters A-Z lower-cased, ASCII other than letters and digits a space; signs beyond
# ASCII are several bytes over 127 and stay as they are.
_FOLD = bytes(32 if PARTS[c] else c + 32 if 65 <= c <= 90 else c for c in range(256))


def term_counts(text: bytes) -> Counter:
    """Terms of a whole text (UTF-8) and their occurrences, a piece at a time."""
    counts: Counter = Counter()
    start, size = 0, len(text)
    while start < size:
        end = start + _PIECE
        if end < size:
            # Never inside a term.
            while end < size and not PARTS[text[end]]:
                end += 1
        counts.update(text[start:end].translate(_FOLD).split())
        start = end
    return counts


@dataclass
class SharedSums:
    """How the items' sums are formed. Nodes 0 to ``terms`` - 1 are the terms; ``steps``
    are layers of (node, part, part), each layer after all it needs; ``rest`` lists the
    nodes that every item adds up."""

    terms: int
    nodes: int
    steps: list[np.ndarray]
    rest: list[np.ndarray]

    @property
    def additions(self) -> int:
        return self.nodes - self.terms + sum(max(len(r) - 1, 0) for r in self.rest)


def share(items: list[list[int]], terms: int) -> SharedSums:
    """Mine the term sets that items share: again and again the pair of nodes that most
    items hold becomes a node of its own, until no two items share a pair.

    A term that an item repeats is that many units of it. Units of one item alone take
    no part. The window only bounds the mining; every item's sum is the same without.
    """
    units: dict[tuple[int, int], int] = {}
    leaf: list[int] = []
    holders: Counter = Counter()
    sets: list[list[int]] = []
    for item in items:
        seen: Counter = Counter()
        own = []
        for term in item:
            key = (term, seen[term])
            seen[term] += 1
            if key not in units:
                units[key] = len(leaf)
                leaf.append(term)
            own.append(units[key])
        holders.update(own)
        sets.append(own)
    windows: list[tuple[int, set[int]]] = []
    alone: list[list[int]] = []
    for i, own in enumerate(sets):
        shared = sorted((u for u in own if holders[u] > 1), key=lambda u: (-holders[u], u))
        alone.append([leaf[u] for u in own if holders[u] == 1])
        windows += [(i, set(shared[at : at + PAIR_WINDOW])) for at in range(0, len(shared), PAIR_WINDOW)]
    # A unit's node is its term; nodes of pairs follow.
    parts: list[tuple[int, int]] = []
    count: Counter = Counter()
    where: dict[tuple[int, int], set[int]] = defaultdict(set)
    for w, (_, held) in enumerate(windows):
        for pair in combinations(sorted(held), 2):
            count[pair] += 1
            where[pair].add(w)
    heap = [(-n, pair) for pair, n in count.items() if n > 1]
    heapq.heapify(heap)
    base = len(leaf)
    while heap:
        n, pair = heapq.heappop(heap)
        if -n != count[pair]:
            if count[pair] > 1:
                heapq.heappush(heap, (-count[pair], pair))
            continue
        if count[pair] < 2:
            continue
        node = base + len(parts)
        parts.append(pair)
        grown = set()
        for w in list(where[pair]):
            held = windows[w][1]
            held -= set(pair)
            for gone in (*combinations(pair, 2), *(tuple(sorted((p, h))) for p in pair for h in held)):
                count[gone] -= 1
                where[gone].discard(w)
            for h in held:
                count[h, node] += 1
                where[h, node].add(w)
                grown.add((h, node))
            held.add(node)
        for pair in grown:
            if count[pair] > 1:
                heapq.heappush(heap, (-count[pair], pair))
    # Numbers: terms first, then the pairs.
    number = [*leaf, *range(terms, terms + len(parts))]
    depth = [0] * (terms + len(parts))
    layers: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for k, (a, b) in enumerate(parts):
        a, b = number[a], number[b]
        depth[terms + k] = max(depth[a], depth[b]) + 1
        layers[depth[terms + k]].append((terms + k, a, b))
    rest = alone
    for i, held in windows:
        rest[i].extend(number[h] for h in held)
    return SharedSums(
        terms,
        terms + len(parts),
        [np.array(layers[level], np.int64) for level in sorted(layers)],
        [np.array(sorted(r), np.int64) for r in rest],
    )


@dataclass
class Pass:
    """The items of one pass: their ids, the terms they use and their shared sums."""

    ids: list
    terms: list[bytes]
    sums: SharedSums


def plan(rows: list[tuple]) -> Pass:
    """Items (id, text) as shared sums."""
    number: dict[bytes, int] = {}
    items = []
    for _, text in rows:
        items.append([number.setdefault(term, len(number)) for term in sorted(term_counts((text or "").encode("utf-8", "surrogatepass")).elements())])
    return Pass([i for i, _ in rows], list(number), share(items, len(number)))


def counted(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs) per document: its number of terms, and which of ``terms``
    it holds how often."""
    number = {term: i for i, term in enumerate(terms)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, found, tfs, bounds = [], [], [], [0]
            for text in binary_texts(batch.column(1)):
                counts = term_counts(text)
                lengths.append(counts.total())
                for term in counts.keys() & number.keys():
                    found.append(number[term])
                    tfs.append(counts[term])
                bounds.append(len(found))
            offsets = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class _Best:
    """The best documents of every item so far: falling score, rising id, null ids last."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.kept: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]
        # A score has to be above 0, and at least the last one kept.
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, ids: list) -> None:
        hit_items, hit_docs = np.nonzero(scores >= self.least[:, None])
        bounds = np.searchsorted(hit_items, np.arange(len(self.kept) + 1))
        for item in np.unique(hit_items):
            docs = hit_docs[bounds[item] : bounds[item + 1]]
            values = scores[item, docs]
            if len(docs) > self.top:
                # Ties with the last place stay until ids decide.
                last = np.partition(values, -self.top)[-self.top]
                docs, values = docs[values >= last], values[values >= last]
            new = [(-int(s), ids[d] is None, ids[d] or 0) for s, d in zip(values, docs, strict=True)]
            best = heapq.nsmallest(self.top, self.kept[item] + new)
            self.kept[item] = best
            if len(best) == self.top:
                self.least[item] = -best[-1][0]


def _ranked(table: DataFrame, search: Pass, weights: np.ndarray, documents: int, total: int, top: int) -> DataFrame:
    """(at, item_id, doc_id, score): the best ``top`` documents of each task for each item."""
    sums, ids = search.sums, search.ids
    flat = np.concatenate([*sums.rest, np.empty(0, np.int64)]).astype(np.int64)
    starts = np.cumsum([0, *(len(r) for r in sums.rest)])
    # reduceat takes no empty runs: items without terms have no documents.
    some = np.flatnonzero(np.diff(starts))
    rows = max(16, CELLS // max(sums.nodes, 1))

    def scores(n: list[int], held: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        # Long numbers: 75 n N may pass 64 bits.
        m = np.array([25 + (75 * size * documents) // total for size in n], np.int64)
        node = np.zeros((sums.nodes, len(n)), np.int64)
        node[terms, held] = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[held]))
        for layer in sums.steps:
            node[layer[:, 0]] = node[layer[:, 1]] + node[layer[:, 2]]
        out = np.zeros((len(ids), len(n)), np.int64)
        # A few items at a time: their nodes are copied together.
        for low in range(0, len(some), 64):
            group = some[low : low + 64]
            first, last = starts[group[0]], starts[group[-1] + 1]
            out[group] = np.add.reduceat(node[flat[first:last]], starts[group] - first, axis=0)
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(ids), top)
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                part = batch.slice(low, rows)
                term_lists, n = part.column("terms"), part.column("n").to_pylist()
                sizes = np.diff(term_lists.offsets.to_numpy())
                held = np.repeat(np.arange(part.num_rows), sizes)
                terms = term_lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tfs = part.column("tfs").flatten().to_numpy(zero_copy_only=False)
                best.add(scores(n, held, terms, tfs), part.column("doc_id").to_pylist())
        found = [(at, ids[at], None if missing else doc, -score) for at, kept in enumerate(best.kept) for score, missing, doc in kept]
        if found:
            columns = list(zip(*found, strict=True))
            kinds = [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["at", "item_id", "doc_id", "score"])

    return table.mapInArrow(run, "at long, item_id long, doc_id long, score long")


def _searched(docs: DataFrame, search: Pass, top: int) -> DataFrame:
    table = materialize(counted(docs, search.terms), "term-counts")
    whole = table.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    holding = table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    weights = np.zeros(len(search.terms), np.int64)
    for r in holding:
        weights[r["term"]] = term_weight(whole["documents"], r["df"])
    found = _ranked(table.where("n > 0"), search, weights, whole["documents"], whole["total"], top)
    order = Window.partitionBy("at").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    terms_per_pass: int = TERMS_PER_PASS,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above
    0, highest first, equal scores by rising id, null ids last.

    Terms are runs of ASCII letters and digits (A-Z lower-cased) and of all signs beyond
    ASCII. Null and empty texts, as item or as document, have none: they rank nothing and
    are ranked nowhere. Repeated document rows are ranked one by one; every row of
    ``items`` is ranked on its own, also under a repeated or null id. Empty tables give no
    rows. Other columns are ignored.

    Items go through in passes of bounded size, each of them over all documents.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    held = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    # A term takes some six bytes.
    passes = max(1, math.ceil(held / (6 * terms_per_pass)))
    dealt = asked.withColumn("_pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    found = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for k in range(passes):
        rows = [(r["item_id"], r["text"]) for r in dealt.where(F.col("_pass") == k).collect()]
        if rows:
            found = found.unionAll(_searched(docs, plan(rows), top))
    return found


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE = rf"""
WITH words AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS terms
  FROM documents
), sized AS (SELECT *, len(terms) AS n FROM words WHERE len(terms) > 0),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sized),
asked AS (
  SELECT row_number() OVER () AS entry, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS terms
  FROM benchmark
), wanted AS (SELECT entry, item_id, term, count(*) AS times FROM (SELECT entry, item_id, unnest(terms) AS term FROM asked) GROUP BY ALL),
held AS (
  SELECT place, doc_id, term, count(*)::BIGINT AS tf
  FROM (SELECT place, doc_id, unnest(terms) AS term FROM sized) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, whole GROUP BY term, docs
), scored AS (
  SELECT place, held.doc_id, held.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))) AS part
  FROM held JOIN weighed USING (term) JOIN sized USING (place), whole
), sums AS (
  SELECT entry, item_id, place, doc_id, sum(part * times)::BIGINT AS score
  FROM scored JOIN wanted USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY entry ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM sums WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
