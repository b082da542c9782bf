"""Numbers of unigram pieces per text, without making the pieces.

The vocabulary is that of a public piece model; its pieces get the Zipf scores
-round(8 * log2(2 + rank)), whole numbers, so that sums are exact. An Aho-Corasick
automaton names every vocabulary match; going from left to right, each position
keeps the best score and the number of pieces that reach it.

Rules of the tokenizer, kept exactly: spaces become a mark, one mark opens every
text that is not empty; among equal scores the longest last piece wins; a code point
without a piece of its own may stand as unknown, 10 below the lowest score, and
counts its UTF-8 bytes. No piece holds a mark behind another sign, so the best
reading of a text is that of its words one after the other: words are counted once
and looked up again.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0


def zipf_score(rank: int) -> float:
    return -float(round(8 * math.log2(2 + rank)))


def load_vocabulary(path: str) -> dict[str, float]:
    """Ordinary pieces in the order of their ids, scored by rank."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return {model.id_to_piece(i): zipf_score(rank) for rank, i in enumerate(plain)}


class PieceCounter:
    def __init__(self, vocabulary: dict[str, float], most_words: int = 400_000) -> None:
        import ahocorasick

        if any(MARK in piece.lstrip(MARK) for piece in vocabulary):
            raise ValueError("a piece goes over the beginning of a word")
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece in vocabulary if len(piece) == 1}
        self.unknown = min(vocabulary.values()) - UNKNOWN_PENALTY
        self.words = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self.most_words = most_words
        self.known: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        n = len(word)
        best, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        if self.single.issuperset(word):
            # At each end the automaton names the longest match first.
            for last, (length, score) in self.automaton.iter(word):
                total = best[last + 1 - length] + score
                if total > best[last + 1]:
                    best[last + 1], count[last + 1] = total, count[last + 1 - length] + 1
            return count[n]
        found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for last, match in self.automaton.iter(word):
            found[last].append(match)
        for end, (matches, sign) in enumerate(zip(found, word, strict=True), 1):
            for length, score in matches:
                total = best[end - length] + score
                if total > best[end]:
                    best[end], count[end] = total, count[end - length] + 1
            if sign not in self.single and best[end - 1] + self.unknown > best[end]:
                best[end] = best[end - 1] + self.unknown
                count[end] = count[end - 1] + len(sign.encode("utf-8", "surrogatepass"))
        return count[n]

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for word in self.words.findall(MARK + text.replace(" ", MARK)):
            n = known.get(word)
            if n is None:
                if len(known) >= self.most_words:
                    known.clear()
                n = known[word] = self.count_word(word)
            total += n
        return total


_counters: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    if path not in _counters:
        _counters[path] = PieceCounter(load_vocabulary(path))
    return _counters[path]


def piece_counts(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, n_pieces) of every row, whole texts.

    Null and empty texts have no pieces. Ids are carried through, null and repeated ones
    too; other columns are ignored. The counting needs no shuffle; a word of any length
    takes time and memory in proportion.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(public_tokenizers.path(model))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([count(t) for t in texts], pa.int64())],
                names=["doc_id", "n_chars", "n_pieces"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, n_pieces long")
