"""Words of whole texts as 64-bit hashes, a batch of documents at a time.

Words are what is left between the six ASCII spaces, with A-Z lower-cased. A
batch is one buffer; the hash of every word in it comes from one running sum, so
there is no Python work per word. Texts are read in blocks cut at spaces, which
bounds the arrays for a text of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACES = b" \t\n\x0b\x0c\r"
# Odd, so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BLOCK = 1 << 19

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
# For words without punctuation: all ASCII but letters and digits parts them.
PARTS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class SubstringHashes:
    """Hashes of substrings of an integer sequence, equal for equal substrings
    wherever they stand: sum(code * base**-position), shifted back to position 0."""

    def __init__(self) -> None:
        self.up = _powers(_BASE, 1)
        self.down = self.up

    def __call__(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(codes) + 1
        if n > len(self.up):
            size = 1 << n.bit_length()
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        running = np.zeros(n, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.down[: n - 1], out=running[1:])
        return mix((running[ends] - running[starts]) * self.up[starts])


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_hashes = SubstringHashes()


def _pieces(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > BLOCK:
        end = start + BLOCK
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def _block_words(pieces: list[bytes], parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the pieces, and how many each piece has."""
    buffer = np.frombuffer(b" ".join(pieces) + b" ", np.uint8)
    space = parts[buffer]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(space & np.concatenate(([False], inside[:-1])))
    bounds = np.cumsum([len(p) + 1 for p in pieces])
    upto = np.searchsorted(starts, bounds)
    return _hashes(_LOWER[buffer], starts, ends), np.diff(upto, prepend=0)


def hashed_words(texts: list[bytes], parts: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after the other, and ``bounds``: text ``i`` has
    the words ``bounds[i]`` to ``bounds[i + 1]``. ``parts`` marks the bytes between words."""
    counts = np.zeros(len(texts), np.int64)
    found: list[np.ndarray] = [np.empty(0, np.uint64)]
    pieces: list[bytes] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        hashes, sizes = _block_words(pieces, parts)
        found.append(hashes)
        np.add.at(counts, owners, sizes)
        pieces.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for piece in _pieces(text):
            pieces.append(piece)
            owners.append(i)
            held += len(piece)
            if held >= BLOCK:
                flush()
                held = 0
    if pieces:
        flush()
    return np.concatenate(found), np.concatenate(([0], np.cumsum(counts)))


_PLACES = _powers(_BASE, 64)


def in_order(words: np.ndarray, n: int, length: int) -> np.ndarray:
    """Hashes of ``n`` runs of ``length`` words, each starting one word later."""
    total = np.zeros(n, np.uint64)
    for j in range(length):
        total += words[j : j + n] * _PLACES[j + 1]
    return mix(total + np.uint64(length))


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles; a text
    with fewer words has one, of all its words; a text without words has none."""
    words, bounds = hashed_words(texts)
    every = in_order(words, max(len(words) - size + 1, 0), size)
    sets = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        if high - low >= size:
            sets.append(np.unique(every[low : high - size + 1]))
        elif high > low:
            sets.append(in_order(words[low:high], 1, int(high - low)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def ranges(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges, one range after the other, and whose each is."""
    sizes = highs - lows
    owner = np.repeat(np.arange(len(lows)), sizes)
    shift = np.repeat(lows - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) if len(lows) else lows
    return shift + np.arange(len(owner)), owner


def binary_texts(column) -> list[bytes]:
    """An Arrow string column as bytes; null is empty."""
    import pyarrow as pa

    # What earlier batches needed goes back to the system, not to the pool.
    pa.default_memory_pool().release_unused()
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]
