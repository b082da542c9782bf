"""Lempel-Ziv phrase fingerprints.

A text is parsed greedily into phrases, each the longest one already in the
dictionary and one more code point, which is then added. The set of phrases stands
for the text the way a compressor's dictionary does; its SIZE smallest hashes are
the fingerprint, and two fingerprints give the likeness of the phrase sets.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.words import SubstringHashes

SIZE = 128
# Runs of neighbouring rows for each shuffle partition.
RUNS_PER_PARTITION = 4
_NONE = np.iinfo(np.int64).min


class PhraseParser:
    """The dictionary of one text, which can be copied and continued."""

    def __init__(self) -> None:
        self.phrases: set[str] = set()
        self.ends: list[int] = []
        self.open = ""

    def feed(self, text: str, offset: int = 0) -> PhraseParser:
        phrases, add, end, phrase = self.phrases, self.phrases.add, self.ends.append, self.open
        for at, sign in enumerate(text, offset + 1):
            phrase += sign
            if phrase not in phrases:
                add(phrase)
                end(at)
                phrase = ""
        self.open = phrase
        return self

    def copy(self) -> PhraseParser:
        other = PhraseParser()
        other.phrases, other.ends, other.open = set(self.phrases), list(self.ends), self.open
        return other


_hashes = SubstringHashes()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def smallest_hashes(codes: np.ndarray, parser: PhraseParser) -> np.ndarray:
    """Sorted, distinct; a text whose last phrase is already known adds nothing for it."""
    ends = np.array(parser.ends, np.int64)
    hashes = _hashes(codes, np.concatenate(([0], ends[:-1])).astype(np.int64)[: len(ends)], ends)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 4 * SIZE:
        short = np.partition(short, 2 * SIZE)[: 2 * SIZE]
    return np.unique(short)[:SIZE]


def to_text(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.astype("<u4").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets: of the SIZE smallest hashes of
    both together, the share that both have. Two empty sets are alike."""
    together = np.union1d(a, b)[:SIZE]
    return float(np.isin(together, np.intersect1d(a, b)).mean()) if len(together) else 1.0


def fingerprint(text: str) -> np.ndarray:
    return smallest_hashes(_codes(text), PhraseParser().feed(text))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Reading:
    """One text on its way: its own fingerprint, and the parse of the half that stays
    when it is edited."""

    def __init__(self, doc_id: int | None, text: str) -> None:
        self.doc_id, self.text, self.stays = doc_id, text, len(text) - len(text) // 2
        parser = PhraseParser().feed(text[: self.stays])
        self.kept = parser.copy()
        self.own = smallest_hashes(_codes(text), parser.feed(text[self.stays :], self.stays))

    def row(self, following: Reading) -> tuple:
        changed = edited(self.text, following.text)
        other = smallest_hashes(_codes(changed), self.kept.feed(changed[self.stays :], self.stays))
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        near = likeness(self.own, other), likeness(self.own, following.own)
        return (self.doc_id, len(self.text), digest, to_text(self.own), to_text(other), *near)


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def in_runs(rows: DataFrame, runs: int) -> DataFrame:
    """Deal (id, text, h) into runs of neighbours by descending id, nulls last.

    Adds ``run`` and ``edge``: each run ends with a copy of the first row of the run
    below (of the very first row after the last one), marked as edge, so that every row
    finds its successor in its own run. Runs are bounded by quantiles of the ids; rows
    that share an id stay in one run, ordered by the hash of their text.
    """
    cuts = sorted(set(rows.approxQuantile("id", [i / runs for i in range(1, runs)], 0.1 / runs))) if runs > 1 else []
    # A null sorts below every id.
    number = F.coalesce(F.col("id"), F.lit(_NONE))
    below = F.filter(F.array(*(F.lit(int(c)) for c in cuts)).cast("array<bigint>"), lambda cut: cut < number)
    placed = rows.withColumn("run", F.size(below))
    first = placed.groupBy("run").agg(F.max(F.struct(number.alias("number"), F.col("h"))).alias("top"))
    # One narrow row per run.
    tops = [tuple(r) for r in first.select("run", "top.number", "top.h").orderBy("run").collect()]
    plain = placed.select("id", "text", "h", "run", F.lit(False).alias("edge"))
    if not tops:
        return plain
    # The first row of a run follows the last row of the run above it.
    edges = [(run, top, h, tops[(i + 1) % len(tops)][0]) for i, (run, top, h) in enumerate(tops)]
    edges = rows.sparkSession.createDataFrame(edges, "_run int, _top long, _h long, _to int")
    copies = (
        placed.join(F.broadcast(edges), (F.col("run") == F.col("_run")) & (number == F.col("_top")) & (F.col("h") == F.col("_h")))
        .select("id", "text", "h", F.col("_to").alias("run"), F.lit(True).alias("edge"))
        .dropDuplicates(["run"])
    )
    return plain.union(copies)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text (the second half replaced by the
    beginning of the next text, by descending id, the first one after the last), and how
    alike the own one is to the edited text's and to the next text's.

    A null text is empty; empty texts have an empty fingerprint. Rows with a null id
    come last; rows that repeat an id follow each other by the hash of their text. A
    single row is its own successor. No rows give no rows; other columns are ignored.
    Texts are shuffled once and read one by one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    dealt = in_runs(rows, RUNS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    run_order = [F.col("run"), F.col("edge"), F.desc_nulls_last("id"), F.desc("h")]
    dealt = dealt.repartition("run").sortWithinPartitions(*run_order).select("run", "edge", "id", "text")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, before_run = None, None
        for batch in batches:
            out = []
            for run, edge, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                now = Reading(doc_id, text)
                if before is not None and before_run == run:
                    out.append(before.row(now))
                before, before_run = None if edge else now, run
            yield _table(out)

    return dealt.mapInArrow(read, RESULT)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [field.split()[0] for field in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
