"""Token ids in a bit-packed binary format.

File layout, little-endian throughout:

    magic "IDPK" | u32 bits per id | u32 ids per block
    blocks: ids of ``bits`` bits each, least significant bit first; every block but
            the last holds the same number of ids
    document table: i64 doc_id | u8 1 where doc_id is known | u64 first id, then the end
    block table: u64 byte offset of each block, then the end of the last
    footer: u64 ids | u64 documents | u64 blocks | u64 offset of the document table | magic

A reader seeks to the blocks that hold the ids it wants and unpacks them with a
fixed number of numpy operations whatever the width.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adloom.llm.files import attempt_name, create, open_for_reading
from adloom.llm.words import binary_texts
from adloom.storage import fresh_path, materialize

MAGIC = b"IDPK"
BLOCK_IDS = 1 << 16
# Words a worker remembers: some 250 bytes each. Half of them are forgotten at a time.
MOST_WORDS = 600_000
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
_FOOTER = struct.Struct("<QQQQ4s")
_HEADER = struct.Struct("<4sII")
# A word no text is likely to hold; words that do hold it are encoded one by one.
_MARK = "\x02"
_ENDS = (b".", b",")
_BEYOND_LATIN = "\u0250"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids fill exactly ``bits`` bytes: work on all groups of eight at once."""
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    groups.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(groups), bits), np.uint8)
    for lane in range(8):
        first, shift = divmod(lane * bits, 8)
        spread = groups[:, lane] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, first + k] |= (spread >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    groups = np.zeros((-(-n // 8), bits), np.uint8)
    groups.reshape(-1)[: len(data)] = np.frombuffer(data, np.uint8)
    ids = np.zeros((len(groups), 8), np.uint32)
    for lane in range(8):
        first, shift = divmod(lane * bits, 8)
        value = np.zeros(len(groups), np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            value |= groups[:, first + k].astype(np.uint64) << np.uint64(8 * k)
        ids[:, lane] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return ids.reshape(-1)[:n]


class IdFileWriter:
    """Writes one file; holds one block of ids and the document table."""

    def __init__(self, sink, bits: int, block_ids: int = BLOCK_IDS) -> None:
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        self.pending: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.doc_ids: list[int | None] = []
        self.starts: list[int] = []
        self.offset = sink.write(_HEADER.pack(MAGIC, bits, block_ids)) or _HEADER.size
        self.blocks = [self.offset]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            self._flush(self.held - self.held % self.block_ids)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate([np.empty(0, np.uint32), *self.pending])
        for low in range(0, upto, self.block_ids):
            data = pack(ids[low : min(low + self.block_ids, upto)], self.bits)
            self.sink.write(data)
            self.offset += len(data)
            self.blocks.append(self.offset)
        self.pending, self.held = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self._flush(self.held)
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        table = self.offset
        self.sink.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.sink.write(known.tobytes())
        self.sink.write(np.array([*self.starts, self.n_ids], "<u8").tobytes())
        self.sink.write(np.array(self.blocks, "<u8").tobytes())
        self.sink.write(_FOOTER.pack(self.n_ids, len(self.doc_ids), len(self.blocks) - 1, table, MAGIC))
        self.sink.close()


class IdFile:
    """Random access to one file: tables in memory, ids read by block."""

    def __init__(self, path: str) -> None:
        self.source = open_for_reading(path)
        size = self.source.size()
        magic, self.bits, self.block_ids = _HEADER.unpack(self._at(0, _HEADER.size))
        self.n_ids, n_docs, n_blocks, table, end = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{path} is no token id file, or is cut off")
        data = self._at(table, size - _FOOTER.size - table)
        ids, known = np.frombuffer(data, "<i8", n_docs), np.frombuffer(data, np.uint8, n_docs, 8 * n_docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, 9 * n_docs).astype(np.int64)
        self.blocks = np.frombuffer(data, "<u8", n_blocks + 1, 17 * n_docs + 8).astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def ids(self, low: int, high: int) -> np.ndarray:
        """The ids ``low`` to ``high`` of the file, from one range read."""
        if high <= low:
            return np.empty(0, np.uint32)
        first, last = low // self.block_ids, (high - 1) // self.block_ids
        data = self._at(int(self.blocks[first]), int(self.blocks[last + 1] - self.blocks[first]))
        parts = []
        for block in range(first, last + 1):
            at = int(self.blocks[block] - self.blocks[first])
            n = min(self.block_ids, self.n_ids - block * self.block_ids)
            parts.append(unpack(data[at : at + -(-n * self.bits // 8)], n, self.bits))
        return np.concatenate(parts)[low - first * self.block_ids : high - first * self.block_ids]

    def documents(self, span: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id, ids) of every document, about ``span`` ids read at a time."""
        low = 0
        while low < len(self.doc_ids):
            high = max(low + 1, int(np.searchsorted(self.starts, self.starts[low] + span, "right")) - 1)
            base = int(self.starts[low])
            ids = self.ids(base, int(self.starts[high]))
            for i in range(low, high):
                start = int(self.starts[i])
                yield self.doc_ids[i], start, ids[start - base : int(self.starts[i + 1]) - base]
            low = high

    def close(self) -> None:
        self.source.close()


class WordEncoder:
    """Whole texts through the tokenizer, each distinct word once per batch of work.

    The tokenizer splits at white space and drops it, so the ids of a text are
    those of its words in order. It lower-cases, and takes a stop or comma at the end
    of a word by itself, so ``Word`` and ``word,`` share the work of ``word``. New
    words go to the library joined by a mark word whose id tells where each ends. Words
    of lower-case Latin letters alone are what normalising and splitting leave of them,
    so they skip both, and the bytes that their ids stand for tell where each ends. Half of the words known are forgotten when they become too many;
    those in use are carried over.
    """

    def __init__(self, path: str, most_words: int = MOST_WORDS) -> None:
        # One thread: Spark runs as many tasks as there are cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.vocabulary = self.tokenizer.get_vocab_size()
        # A piece has one sign for each byte it stands for, and what marks the end of a word.
        self.sizes = np.zeros(self.vocabulary, np.int64)
        end = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        for piece, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(piece.removesuffix(end))
        self.most_words = most_words
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        ids = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = ids[0] if len(ids) == 1 else None

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_words(self, tokenizer, words: list[bytes]) -> None:
        between = f" {_MARK} ".encode()
        for start in range(0, len(words), 16_384):
            new = words[start : start + 16_384]
            joined = [between.join(new[i : i + 256]).decode("utf-8", "replace") for i in range(0, len(new), 256)]
            ids: list[int] = []
            for encoding in tokenizer.encode_batch_fast(joined, add_special_tokens=False):
                ids += encoding.ids
                ids.append(self.mark)
            flat = np.array(ids, np.uint32)
            ends = 4 * np.flatnonzero(flat == self.mark)
            data, starts = flat.tobytes(), np.concatenate(([0], ends[:-1] + 4))
            found = [data[low:high] for low, high in zip(starts.tolist(), ends.tolist(), strict=True)]
            self.cache.update(zip(new, found, strict=True))

    def _encode_letters(self, words: list[bytes]) -> None:
        for start in range(0, len(words), 16_384):
            new = words[start : start + 16_384]
            joined = [b" ".join(new[i : i + 256]).decode() for i in range(0, len(new), 256)]
            ids: list[int] = []
            for encoding in self.plain.encode_batch_fast(joined, add_special_tokens=False):
                ids += encoding.ids
            flat = np.array(ids, np.uint32)
            upto, wanted = np.cumsum(self.sizes[flat]), np.cumsum([len(w) for w in new])
            last = np.searchsorted(upto, wanted)
            if last[-1] != len(flat) - 1 or (upto[last] != wanted).any():
                # Some byte has no piece of its own.
                self._encode_words(self.plain, new)
                continue
            data, ends = flat.tobytes(), (4 * (last + 1)).tolist()
            self.cache.update(zip(new, (data[low:high] for low, high in zip([0, *ends[:-1]], ends, strict=True)), strict=True))

    def _learn(self, words: set[bytes]) -> None:
        ended = {w for w in words if w[-1:] in _ENDS and w[-2:-1].isalnum()}
        stems = {w[:-1] for w in ended} | {w[-1:] for w in ended}
        letters: list[bytes] = []
        others: list[bytes] = []
        for word in (words - ended) | stems.difference(self.cache):
            if word.isalpha() and word.islower():
                letters.append(word)
            elif self.mark is None or _MARK.encode() in word:
                self.cache[word] = self._encode(word.decode("utf-8", "replace")).tobytes()
            else:
                text = word.decode("utf-8", "replace")
                (letters if text.isalpha() and text.islower() and max(text) < _BEYOND_LATIN else others).append(word)
        self._encode_letters(letters)
        self._encode_words(self.tokenizer, others)
        for word in ended:
            self.cache[word] = self.cache[word[:-1]] + self.cache[word[-1:]]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        # Special tokens are recognised as written.
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        if len(self.cache) > self.most_words // 2:
            self.older, self.cache = self.cache, {}
        new = set().union(*split).difference(self.cache)
        known = new.intersection(self.older)
        self.cache.update((word, self.older[word]) for word in known)
        if len(new) > len(known):
            self._learn(new - known)
        of = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(of, words)), np.uint32) for words in split]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


MANIFEST = "part int, path string, n_docs long, n_ids long"


def write_token_ids(
    docs: DataFrame,
    folder: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the ids in ascending
    ``id_col`` order, one file per range of ids. Returns the manifest
    (part, path, n_docs, n_ids); ``part`` orders the files.

    A null or empty text is its end id alone. Rows with a null id come first; rows
    that share an id are ordered by the hash of their text. Other columns are
    ignored. No rows give an empty manifest. The range boundaries hold about equal
    numbers of rows, and a file is written block by block, so the largest thing in
    memory is one Arrow batch of texts.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode, writer, path = encoder(public_tokenizers.path(tokenizer)), None, ""
        end = np.array([end_id], np.uint32)
        for batch in batches:
            if writer is None:
                path = attempt_name(folder, part, ".idpk")
                writer = IdFileWriter(create(path), bits_for(max(encode.vocabulary, end_id + 1)))
            ids = batch.column(0).to_pylist()
            for doc_id, coded in zip(ids, encode(binary_texts(batch.column(1))), strict=True):
                writer.add(doc_id, np.concatenate((coded, end)))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "path": [path], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]},
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    # The hash deals rows of one id, or without one, to several files in their order.
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "text")
    return materialize(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_ids(manifest: DataFrame, digest=None, digest_type: str = "ids array<int>") -> DataFrame:
    """Per document (doc_id, start, n_tokens) and what ``digest(ids)`` returns (the ids
    themselves by default), read back from the files. ``start`` counts the ids of all
    documents before it over all files."""
    first = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One narrow row per file.
    files = manifest.withColumn("first", first).select("path", "first").repartition(max(1, manifest.count()), "path")
    digest = digest or (lambda ids: ids.tolist())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
    names = digest_type.split()[0]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = IdFile(path)
                rows: list[tuple] = []
                held = 0
                for doc_id, start, ids in file.documents():
                    rows.append((doc_id, first_id + start, len(ids), digest(ids)))
                    held += len(ids)
                    if held > 1 << 20:
                        yield _rows(rows, schema, names)
                        rows, held = [], 0
                file.close()
                yield _rows(rows, schema, names)

    return files.mapInArrow(read, f"doc_id long, start long, n_tokens long, {digest_type}")


def _rows(rows: list[tuple], schema: pa.Schema, name: str) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], field.type) for i, field in enumerate(schema)]
    values = [r[3] for r in rows]
    kind = pa.list_(pa.int32()) if values and isinstance(values[0], list) else pa.int64()
    return pa.RecordBatch.from_arrays([*columns, pa.array(values, kind)], names=[*schema.names, name])


def ids_crc32(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def token_file_table(spark: SparkSession, docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write the files of ``docs`` to the shared folder and read their digests back."""
    manifest = write_token_ids(docs, fresh_path(spark, "token-ids"), tokenizer)
    return read_token_ids(manifest, ids_crc32, "ids_crc32 long")
