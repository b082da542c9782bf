"""Toxicity of whole texts after a noisy-channel restoration of disguised words.

1. A character 4-gram language model is counted over all texts given.
2. Spots that look disguised (digits or symbols inside a word, letters repeated
   three times or more, letters spelled out one by one) become a lattice: every
   written sign may stand for some letters, for nothing or for a word end. Viterbi
   decoding under the language model picks the reading.
3. The words of the restored text and their beginnings are weighed by a lexicon
   learned from labelled texts, and a logistic regression over three sums of
   weights gives the score. No entry is cut off: weights shrink with the evidence
   for them, and the regression sees each text without its own share in them.

Text that has one reading only is not sent through the decoder.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.words import SubstringHashes, binary_texts, mix

# What a sign may stand for.
READINGS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "*": "aeiou",
}
# Log-probabilities of the channel.
READ_AS_LETTER, READ_AS_NOTHING, READ_AS_GAP, SHORTENED, JOINED, PARTED = -2.0, -5.0, -5.0, -0.5, -0.5, -4.0

# Letters are 1-26 after folding case and accents, 27 any other letter, 0 the rest.
LETTERS, ORDER = 28, 4
_TABLE_SIZE = 0x3000
_FOLD = np.zeros(_TABLE_SIZE + 1, np.uint8)
for _code in range(_TABLE_SIZE):
    _base = unicodedata.normalize("NFD", chr(_code).lower())[:1]
    _FOLD[_code] = ord(_base) - 96 if "a" <= _base <= "z" else 27 * chr(_code).isalpha()
_FOLD[_TABLE_SIZE] = 27


def _signs(signs: str) -> np.ndarray:
    table = np.zeros(_TABLE_SIZE + 1, bool)
    table[[ord(c) for c in signs]] = True
    return table


_DIGIT, _MONEY = _signs("0123456789"), _signs("@$")

PREFIXES = (4, 5, 6, 7)
# Labelled texts that the lexicon and the regression are fitted on, at most.
SAMPLE_ROWS = 20_000
# A lexicon entry with evidence (signed root of the likelihood ratio) of HALF_AT has half
# its log-odds as weight; STEEPNESS is how fast less evidence takes the rest.
HALF_AT, STEEPNESS = 3.0, 8
# Characters handled at once, and words whose features are counted together.
_BLOCK = 1 << 17
_WORDS_TOGETHER = 50_000


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.minimum(codes, _TABLE_SIZE)


def _is_letter(sign: str) -> bool:
    return bool(_FOLD[min(ord(sign), _TABLE_SIZE)])


def _blocks(texts: list[str]) -> Iterator[str]:
    """Texts in pieces that end between words; a word is as long as it is."""
    held, size = [], 0
    for text in texts:
        start = 0
        while True:
            end = start + _BLOCK
            while end < len(text) and _is_letter(text[end]) and _is_letter(text[end - 1]):
                end += 1
            held.append(text[start:end])
            size += len(held[-1])
            if size >= _BLOCK:
                yield "\n".join(held)
                held, size = [], 0
            start = end
            if start >= len(text):
                break
    if held:
        yield "\n".join(held)


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of all runs of ORDER letters; word ends count as letter 0."""
    counts = np.zeros(LETTERS**ORDER, np.int64)
    for block in _blocks(texts):
        letters = np.concatenate((np.zeros(ORDER, np.int64), _FOLD[_codes(block)], np.zeros(1, np.int64))).astype(np.int64)
        grams = letters[: len(letters) - ORDER + 1].copy()
        for k in range(1, ORDER):
            grams = grams * LETTERS + letters[k : len(letters) - ORDER + 1 + k]
        counts += np.bincount(grams, minlength=len(counts))
    counts[0] = 0
    return counts


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log-probability of the last letter of each run given those before it, each
    order smoothed with the one below."""
    cube = counts.astype(np.float64).reshape((LETTERS,) * ORDER)
    chance = np.full(LETTERS, 1 / LETTERS)
    for order in range(1, ORDER + 1):
        seen = cube.sum(axis=tuple(range(ORDER - order)))
        total = seen.sum(-1, keepdims=True)
        chance = (seen + 5 * chance) / (total + 5)
    return np.log(chance).reshape(-1)


class Decoder:
    def __init__(self, logp: np.ndarray) -> None:
        self.logp = array("d", logp)
        self.known: dict[str, str] = {}

    def _lattice(self, text: str) -> list[list[tuple[int, ...]]]:
        """Per written run its readings: (log-probability, letters...)."""
        lattice, i = [], 0
        spelled, stretched = bool(_SPELLED.fullmatch(text)), bool(_REPEATED.search(text))
        while i < len(text):
            j = i + 1
            while j < len(text) and text[j].lower() == text[i].lower():
                j += 1
            sign, n = text[i], j - i
            letter = int(_FOLD[min(ord(sign), _TABLE_SIZE)])
            if letter and sign not in READINGS:
                if n >= 2 and stretched:
                    lattice.append([(SHORTENED, letter), (SHORTENED, letter, letter)])
                else:
                    lattice += [[(0.0, letter)]] * n
            elif sign in READINGS:
                options = [(READ_AS_LETTER, ord(c) - 96) for c in READINGS[sign]]
                lattice += [[*options, (READ_AS_NOTHING,), (READ_AS_GAP, 0)]] * n
            else:
                lattice.append([(JOINED if spelled else READ_AS_NOTHING,), (PARTED if spelled else JOINED, 0)])
            i = j
        return lattice

    def __call__(self, text: str) -> str:
        """The likeliest reading, letters folded, word ends as spaces. Equal scores:
        the reading listed first."""
        if (found := self.known.get(text)) is not None:
            return found
        mask, logp = LETTERS ** (ORDER - 1), self.logp
        # State: the last ORDER - 1 letters. Value: (score, way back).
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        for options in [*self._lattice(text), [(0.0, 0)]]:
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, way) in states.items():
                for cost, *letters in options:
                    to, total, back = state, score + cost, way
                    for letter in letters:
                        gram = to * LETTERS + letter
                        # A second word end in a row says nothing.
                        if letter or to % LETTERS:
                            total += logp[gram]
                        to, back = gram % mask, (back, letter)
                    if to not in after or total > after[to][0]:
                        after[to] = (total, back)
            states = after
        _, way = max(states.values(), key=lambda v: v[0])
        letters = []
        while way is not None:
            way, letter = way
            letters.append(chr(96 + letter) if 0 < letter < 27 else "ɐ" if letter else " ")
        found = " ".join("".join(reversed(letters)).split())
        if len(self.known) > 200_000:
            self.known.clear()
        self.known[text] = found
        return found


_SPELLED = re.compile(r"[^\W_](?:[ ._*-]{1,2}[^\W_]){2,}")
_DISGUISED = re.compile(
    r"(?<![^\W_])[^\W_](?:[ ._*-]{1,2}[^\W_]){2,}(?![^\W_])"
    r"|[@$!|+(<€£*\w](?:[\w@$!|+(<€£*._-]*[^\W_])?(?:[@$]{1,2}(?!\S))?"
)
_REPEATED = re.compile(r"([^\W\d_])\1\1", re.IGNORECASE)
_MIXED = re.compile(r"[^\W\d_][0-9@$!|+(<€£*._-]+[^\W\d_]|[0-9@$!|+(<€£][^\W\d_]|[^\W\d_][0-9]|[^\W\d_][@$]{1,2}(?!\S)")


def _matching(pattern: str, beyond: bool) -> np.ndarray:
    """Which signs a class of the spot patterns takes; ``beyond`` for those past the table."""
    return np.array([*(bool(re.match(pattern, chr(c))) for c in range(_TABLE_SIZE)), beyond])


_SEPARATOR, _INSIDE, _READABLE = _signs(" ._*-"), _signs("0123456789@$!|+(<€£*._-"), _signs("0123456789@$!|+(<€£")
_ALPHA, _WORD, _SURE = _matching(r"[^\W\d_]", True), _matching(r"[^\W_]", True), _matching(r"[^\W_]", False)
# What a repeated sign is compared by; signs that differ may be alike here.
_ALIKE = np.where(_FOLD > 0, _FOLD, 28 * _ALPHA).astype(np.uint8)


def _suspicious(codes: np.ndarray) -> bool:
    """Whether a text can hold a spot that ``restore`` reads anew: true for all that have
    one of _MIXED, _REPEATED or _SPELLED."""
    alpha = _ALPHA[codes]
    if (_READABLE[codes[:-1]] & alpha[1:]).any() or (alpha[:-1] & (_DIGIT | _MONEY)[codes[1:]]).any():
        return True
    # Runs of signs between two letters.
    inside = _INSIDE[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if (alpha[edges[:-1]] & alpha[edges[1:] + 1] & inside[edges[1:]]).any():
        return True
    alike = _ALIKE[codes]
    if (alpha[2:] & (alike[2:] == alike[1:-1]) & (alike[1:-1] == alike[:-2])).any():
        return True
    # Three signs of words in a row, each on its own, one or two separators apart.
    word, sure = _WORD[codes], _SURE[codes]
    word[1:] &= ~sure[:-1]
    word[:-1] &= ~sure[1:]
    alone = np.flatnonzero(word)
    apart, after = np.diff(alone), alone[:-1]
    near = (apart >= 2) & (apart <= 3) & _SEPARATOR[codes[after + 1]] & _SEPARATOR[codes[after + apart - 1]]
    return bool((near[1:] & near[:-1]).any())


def restore(text: str, decoder: Decoder) -> str:
    """The text with every disguised spot replaced by its reading."""
    if len(text) < 2 or not _suspicious(_codes(text)):
        return text

    def read(match: re.Match) -> str:
        spot = match.group()
        if _SPELLED.fullmatch(spot) or _REPEATED.search(spot) or _MIXED.search(spot):
            return f" {decoder(spot)} "
        return spot

    return _DISGUISED.sub(read, text)


_hashes = SubstringHashes()
_SEEDS = mix(np.arange(11, 11 + len(PREFIXES) + 1, dtype=np.uint64))


def word_features(text: str) -> np.ndarray:
    """One row per word: hashes of the word and of its beginnings (0: it has none of
    that length)."""
    rows = [np.empty((0, len(PREFIXES) + 1), np.uint64)]
    for block in _blocks([text]):
        letters = _FOLD[_codes(block)]
        inside = letters > 0
        starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        ends = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
        row = np.zeros((len(starts), len(PREFIXES) + 1), np.uint64)
        row[:, 0] = _hashes(letters, starts, ends) ^ _SEEDS[0]
        for k, size in enumerate(PREFIXES, 1):
            long = ends - starts > size
            row[long, k] = _hashes(letters, starts[long], starts[long] + size) ^ _SEEDS[k]
        rows.append(row)
    return np.concatenate(rows)


def _measures(total: float, words: int) -> np.ndarray:
    n = words + 1
    return np.array([1.0, np.log1p(total), np.log1p(100 * total / n), total / np.sqrt(n)])


def _strongest(weights: np.ndarray) -> float:
    """A word counts once, by its strongest entry."""
    return float(weights.max(1).sum()) if weights.size else 0.0


@dataclass
class Model:
    logp: np.ndarray
    entries: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    beta: np.ndarray

    def sums(self, text: str, decoder: Decoder) -> np.ndarray:
        rows = word_features(restore(text, decoder))
        total = 0.0
        if len(rows) and len(self.entries):
            at = np.minimum(np.searchsorted(self.entries, rows), len(self.entries) - 1)
            total = _strongest(np.where(self.entries[at] == rows, self.weights[at], 0.0))
        return _measures(total, len(rows))

    def score(self, text: str, decoder: Decoder) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.sums(text, decoder) @ self.beta, -30, 30))))


def lexicon(words: np.ndarray, texts: np.ndarray, total_words: np.ndarray, total_texts: np.ndarray) -> np.ndarray:
    """The weight of each feature; arrays of (toxic, clean) counts.

    It is the smoothed log-odds over words, shrunk by how surely more of the toxic texts
    hold the feature than of the clean ones; 0 for features that speak for clean texts.
    """
    rates = (words + 0.5) / (total_words + 1)
    weight = np.maximum(np.log(rates[:, 0]) - np.log(rates[:, 1]), 0)
    toxic, n, share = texts[:, 0], np.maximum(texts.sum(1), 1), total_texts[0] / max(total_texts.sum(), 1)
    if not 0 < share < 1:
        return np.zeros(len(words))
    ratio = 0.0
    for k, expected in ((toxic, n * share), (n - toxic, n * (1 - share))):
        ratio = ratio + 2 * k * np.log(np.maximum(k, 1) / expected)
    evidence = np.sqrt(np.where(toxic > n * share, np.maximum(ratio, 0), 0)) ** STEEPNESS
    return weight * evidence / (evidence + HALF_AT**STEEPNESS)


@dataclass
class Counts:
    """What the lexicon is made of: (toxic, clean) words and texts of each feature."""

    features: np.ndarray  # sorted hashes
    words: np.ndarray
    texts: np.ndarray
    total_words: np.ndarray
    total_texts: np.ndarray

    def sums_without(self, rows: np.ndarray, toxic: int) -> np.ndarray:
        """The sums of a text that is counted here, weighed by the other texts."""
        unique, back, own = np.unique(rows.reshape(-1), return_inverse=True, return_counts=True)
        if not len(rows) or not len(self.features):
            return _measures(0.0, len(rows))
        at = np.minimum(np.searchsorted(self.features, unique), len(self.features) - 1)
        found = np.flatnonzero(self.features[at] == unique)
        kind = np.array([toxic, 1 - toxic])
        weights = np.zeros(len(unique))
        weights[found] = lexicon(
            self.words[at[found]] - np.outer(own[found], kind),
            self.texts[at[found]] - kind,
            self.total_words - len(rows) * kind,
            self.total_texts - kind,
        )
        return _measures(_strongest(weights[back].reshape(rows.shape)), len(rows))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - ridge * beta * (np.arange(len(beta)) > 0)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curve, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


_COUNTS = ["toxic", "clean", "toxic_texts", "clean_texts"]


def _feature_counts(texts: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
    """Words and texts of each kind that have a feature; all words count under feature 0."""
    rows = [np.concatenate((f.reshape(-1)[f.reshape(-1) != 0], np.zeros(len(f), np.uint64))) for f, _ in texts]
    unique, at = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    toxic = np.array([t for _, t in texts], np.int64)
    found = np.unique(at * len(rows) + owner)
    columns = [pa.array(unique.view(np.int64))]
    for index, which in ((at, toxic[owner]), (found // len(rows), toxic[found % len(rows)])):
        columns += [pa.array(np.bincount(index, which == kind, len(unique)).astype(np.int64)) for kind in (1, 0)]
    return pa.RecordBatch.from_arrays(columns, names=["feature", *_COUNTS])


def _texts(column) -> list[str]:
    pa.default_memory_pool().release_unused()
    return [value or "" for value in column.to_pylist()]


def count_language(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The language model's counts over every text; the table has LETTERS**ORDER cells,
    whatever the corpus."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LETTERS**ORDER, np.int64)
        for batch in batches:
            counts += gram_counts(_texts(batch.column(0)))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["gram", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "gram int, n long")
    total = counted.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(LETTERS**ORDER, np.int64)
    counts[total["gram"].to_numpy(np.int64)] = total["n"].to_numpy(np.int64)
    return counts


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label is learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Language model over all texts; lexicon and regression over the labelled texts
    that are not held out, at most ``sample_rows`` of them by the hash of their id.

    Equal texts count once, toxic when at least half of their labels say so. Rows
    without a label or an id are not learned from. Without any toxic or any clean
    text every score is the share of toxic labels (0.5 / 1 smoothed).
    """
    logp = language_model(count_language(docs, text_col))
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
        .select(F.col("doc_id").alias("_label_id"), "_toxic")
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    sample = (
        texts.join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
        .groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n"))
        .agg(F.first("text").alias("text"), (F.avg("_toxic") >= 0.5).cast("int").alias("toxic"))
        .select("text", "toxic")
    )
    from adloom.storage import materialize

    sample = materialize(sample, "labelled")
    shared = docs.sparkSession.sparkContext.broadcast(logp)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            held: list[tuple[np.ndarray, int]] = []
            size = 0
            for text, toxic in zip(_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                held.append((word_features(restore(text, decoder)), toxic))
                size += len(held[-1][0])
                if size >= _WORDS_TOGETHER:
                    yield _feature_counts(held)
                    held, size = [], 0
            if held:
                yield _feature_counts(held)

    counted = (
        sample.mapInArrow(count, "feature long, " + ", ".join(f"{c} long" for c in _COUNTS))
        .groupBy("feature")
        .agg(*(F.sum(c).alias(c) for c in _COUNTS))
        .where((F.col("feature") == 0) | (F.col("toxic_texts") > 0))
        .toPandas()
    )
    found = counted[_COUNTS].to_numpy(np.int32).reshape(-1, 2, 2)
    hashes = counted.feature.to_numpy(np.int64).view(np.uint64)
    whole = hashes == 0
    # Texts without any word are in no row; the share of toxic texts needs the others only.
    totals = found[whole].sum(0) if whole.any() else np.zeros((2, 2))
    order = np.flatnonzero(~whole)[np.argsort(hashes[~whole])]
    counts = Counts(hashes[order], found[order, 0], found[order, 1], totals[0], totals[1])
    weights = lexicon(counts.words, counts.texts, totals[0], totals[1])
    model = Model(logp, counts.features[weights > 0], weights[weights > 0], np.zeros(4))
    measured = docs.sparkSession.sparkContext.broadcast(counts)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            labelled = zip(_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True)
            x = np.array([measured.value.sums_without(word_features(restore(t, decoder)), y) for t, y in labelled]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), batch.column(1)], names=["a", "b", "c", "d", "toxic"])

    fitted = sample.mapInArrow(measure, "a double, b double, c double, d double, toxic int").toPandas()
    y = fitted.toxic.to_numpy(np.float64)
    if len(y) and 0 < y.sum() < len(y):
        model.beta = logistic(fitted[["a", "b", "c", "d"]].to_numpy(np.float64), y)
    else:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        model.beta = np.array([np.log(rate / (1 - rate)) - 1e-9, 0, 0, 0])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; null text is empty, a row with
    a null id is scored too, repeated rows each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value.logp)
        for batch in batches:
            scores = [shared.value.score(t, decoder) for t in _texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = scored.mapInArrow(run, f"doc_id {scored.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value.logp)
        for batch in batches:
            keep = [shared.value.score(t, decoder) < 0.5 for t in _texts(batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
