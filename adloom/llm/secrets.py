"""Secret scans through a trigram index.

Every rule's regular expression is turned into a Boolean query over the trigrams
that any match must hold. An index keeps, per segment of texts, the posting list of
each trigram; lists are intersected and united to candidates, which are verified
with the expression itself. A rule without a mandatory trigram reads every text.
Trigrams are bytes of the text with A-Z lower-cased.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.words import binary_texts
from adloom.operators.joins import fits_broadcast
from adloom.storage import materialize

# A part of an expression with more readings than this is not spelled out.
MOST_STRINGS = 64
SEGMENT_TEXTS = 4096


@dataclass(frozen=True)
class Rule:
    """``group`` of a match has to have ``least`` characters; matches that fail are
    dropped after matching, so they still cover their text."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.finditer(self.pattern, text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# Fixed by the contract of the query, in this order.
BASE = [
    Rule("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
]
# Published shapes of further credentials.
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("basic_auth", r"[a-z]{2,8}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@[A-Za-z0-9.-]+"),
]
RULES = BASE + MORE

# A query: None asks for nothing, an int is a trigram, else ("and" | "or", parts).
Query = None | int | tuple


def both(a: Query, b: Query) -> Query:
    return a if b is None or a == b else b if a is None else ("and", (a, b))


def either(a: Query, b: Query) -> Query:
    return None if a is None or b is None else a if a == b else ("or", (a, b))


def trigram(data: bytes) -> int:
    return data[0] << 16 | data[1] << 8 | data[2]


def of_string(text: str) -> Query:
    data = text.encode("utf-8")
    return reduce(both, (trigram(data[i : i + 3]) for i in range(len(data) - 2)), None)


def of_strings(texts: set[str]) -> Query:
    queries = [of_string(t) for t in sorted(texts)]
    return reduce(either, queries[1:], queries[0])


def _lower(sign: int) -> str:
    return chr(sign).lower() if sign < 128 else chr(sign)


class _Reader:
    """Walks a parsed expression. ``strings`` are all readings of what was read since
    ``query`` was last extended; a part that cannot be spelled out ends them."""

    def __init__(self) -> None:
        self.query: Query = None
        self.strings = {""}

    def end(self) -> None:
        self.query, self.strings = both(self.query, of_strings(self.strings)), {""}

    def follow(self, strings: set[str] | None) -> None:
        if strings is None or len(strings) > MOST_STRINGS:
            self.end()
        else:
            if len(self.strings) * len(strings) > MOST_STRINGS:
                self.end()
            self.strings = {a + b for a, b in product(self.strings, strings)}

    def read(self, parsed) -> _Reader:
        for kind, value in parsed:
            if kind is op.LITERAL:
                self.follow({_lower(value)})
            elif kind is op.IN:
                self.follow(_members(value))
            elif kind is op.SUBPATTERN:
                self._inner(value[-1])
            elif kind is op.BRANCH:
                parts = [_Reader().read(p) for p in value[1]]
                if all(p.query is None for p in parts):
                    self.follow(set().union(*(p.strings for p in parts)))
                else:
                    for p in parts:
                        p.end()
                    self.end()
                    self.query = both(self.query, reduce(either, [p.query for p in parts]))
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                least, most, inner = value
                if (least, most) == (0, 1):
                    part = _Reader().read(inner)
                    self.follow(part.strings | {""} if part.query is None else None)
                else:
                    for _ in range(min(least, 3)):
                        self._inner(inner)
                    if (least, most) != (min(least, 3), least):
                        self.end()
            elif kind is op.AT or kind is op.ASSERT_NOT:
                continue
            else:
                self.end()
        return self

    def _inner(self, parsed) -> None:
        part = _Reader().read(parsed)
        if part.query is None:
            self.follow(part.strings)
        else:
            part.end()
            self.end()
            self.query = both(self.query, part.query)


def _members(items) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(_lower(value))
        elif kind is op.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {_lower(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    # Broad classes say little and would multiply every string.
    return found if len(found) <= 6 else None


def trigram_query(pattern: str) -> Query:
    """What every match must hold; None when there is no mandatory trigram."""
    reader = _Reader().read(parser.parse(pattern))
    reader.end()
    return reader.query


def trigrams_of(query: Query) -> set[int]:
    if query is None:
        return set()
    return {query} if isinstance(query, int) else set().union(*map(trigrams_of, query[1]))


def evaluate(query: Query, postings: dict[int, np.ndarray]) -> np.ndarray:
    if isinstance(query, int):
        return postings.get(query, np.empty(0, np.int64))
    join = np.intersect1d if query[0] == "and" else np.union1d
    return reduce(join, (evaluate(part, postings) for part in query[1]))


def text_trigrams(data: bytes, wanted: np.ndarray | None) -> np.ndarray:
    """Distinct trigrams of a text; ``wanted`` marks those to keep."""
    found = [np.empty(0, np.int32)]
    for start in range(0, max(len(data) - 2, 0), 1 << 20):
        b = np.frombuffer(data[start : start + (1 << 20) + 2].lower(), np.uint8).astype(np.int32)
        grams = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
        found.append(np.unique(grams if wanted is None else grams[wanted[grams]]))
    return np.unique(np.concatenate(found))


def build_index(docs: DataFrame, trigrams: set[int] | None = None, text_col: str = "text") -> DataFrame:
    """Segments of the index: (texts array<long>, postings map<int, array<int>>).

    Texts are named by their xxhash64, so copies share an entry of their segment.
    ``trigrams`` restricts the index to those a set of rules can ask for; None indexes
    all. Null and empty texts stand in no list.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None
        if trigrams is not None:
            wanted = np.zeros(1 << 24, bool)
            wanted[sorted(trigrams)] = True
        names: dict[int, int] = {}
        grams, owners = [], []

        def segment() -> pa.RecordBatch:
            gram, owner = np.concatenate([np.empty(0, np.int32), *grams]), np.concatenate([np.empty(0, np.int32), *owners])
            order = np.lexsort((owner, gram))
            gram, owner = gram[order], owner[order]
            keys, starts = np.unique(gram, return_index=True)
            lists = np.split(owner, starts[1:]) if len(keys) else []
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([list(names)], pa.list_(pa.binary())),
                    pa.array([list(zip(keys.tolist(), lists, strict=True))], pa.map_(pa.int32(), pa.list_(pa.int32()))),
                ],
                names=["texts", "postings"],
            )

        for batch in batches:
            for data, name in zip(binary_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                if name in names:
                    continue
                found = text_trigrams(data, wanted)
                names[name] = len(names)
                grams.append(found)
                owners.append(np.full(len(found), names[name], np.int32))
                if len(names) == SEGMENT_TEXTS:
                    yield segment()
                    names, grams, owners = {}, [], []
        if names:
            yield segment()

    texts = docs.select(F.col(f"`{text_col}`").alias("text"), text_name(text_col))
    return texts.mapInArrow(run, "texts array<binary>, postings map<int, array<int>>")


def text_name(text_col: str) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def candidates(index: DataFrame, queries: list[Query]) -> DataFrame:
    """(text, rules): texts that some query lets through, with the numbers of the queries."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, lists in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                postings = {gram: np.array(owners, np.int64) for gram, owners in lists}
                rules: dict[int, list[int]] = {}
                for number, query in enumerate(queries):
                    if query is not None:
                        for owner in evaluate(query, postings).tolist():
                            rules.setdefault(owner, []).append(number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[o] for o in rules], pa.binary()), pa.array(list(rules.values()), pa.list_(pa.int32()))],
                    names=["text", "rules"],
                )

    # A text of several segments has equal lists in all of them.
    return index.mapInArrow(run, "text binary, rules array<int>").dropDuplicates(["text"])


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _joined(found: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row (doc_id, n_assign, n_access, n_hex, base_sha256, spans); spans are
    ``kind:start:end`` in code points, by start and then by the rules' order.

    ``rules`` are added to the base rules. Null and empty texts have no spans. Ids are
    carried through, null and repeated ones too; other columns are ignored. No rows give
    no rows. Equal texts share their candidate entry, and a text shared by very many
    rows is split by the skew join.
    """
    rules = BASE + (MORE if rules is None else rules)
    queries = [trigram_query(rule.pattern) for rule in rules]
    index = materialize(build_index(docs, set().union(*map(trigrams_of, queries)), text_col), "trigram-index")
    hits = materialize(candidates(index, queries), "candidates").select(F.col("text").alias("_hash"), "rules")
    if fits_broadcast(hits):
        hits = F.broadcast(hits)
    always = [number for number, query in enumerate(queries) if query is None]

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, asked in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = [
                    (start, number, end, rules[number].kind)
                    for number in [*always, *(asked or [])]
                    for start, end in rules[number].spans(text or "")
                ]
                base = [f for f in found if f[1] < len(BASE)]
                counts = [sum(f[1] == k for f in base) for k in range(len(BASE))]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), text_name(text_col).alias("h"))
    joined = rows.join(hits, F.col("h") == F.col("_hash"), "left").select("doc_id", "text", "rules")
    return joined.mapInArrow(verify, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {RESULT}")
