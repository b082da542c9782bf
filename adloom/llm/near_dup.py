"""Near-duplicate groups by min-max hashing.

Every permutation gives two signature values, its minimum and its maximum over
the shingle set, so a signature of 160 values costs 80 hash evaluations. Four
values make a band; documents that share one of 40 bands are candidates. At a
similarity of exactly 0.75 a pair is missed with probability
(1 - 0.75**4)**40 < 3e-7. Candidates are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.batches import unused
from adloom.llm.components import star_components
from adloom.llm.words import binary_texts, mix, ranges, shingle_sets
from adloom.operators.joins import fits_broadcast, lookup_join
from adloom.storage import materialize

WORDS = 5
PERCENT = 75
BANDS, ROWS = 40, 4
# Shingles of the sets that are compared together; a set counts SET_WEIGHT besides, so
# that a block has no more than 250 sets.
BLOCK_SHINGLES, SET_WEIGHT = 16_000, 64
_MEETINGS = 1 << 19
# Shingles whose hashes are evaluated at once: bounds the work array to 80 x 4096.
_CHUNK = 4096
_RANDOM = np.random.RandomState(75)
_FACTORS = (_RANDOM.randint(0, 1 << 31, BANDS * ROWS // 2).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_MASKS = _RANDOM.randint(0, 1 << 32, BANDS * ROWS // 2, dtype=np.uint64).astype(np.uint32)
_BAND_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def min_max_signature(shingles: np.ndarray) -> np.ndarray:
    """Per permutation the smallest and the largest value, from one evaluation."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    high = np.zeros(len(_FACTORS), np.uint32)
    for start in range(0, len(x), _CHUNK):
        values = (x[None, start : start + _CHUNK] ^ _MASKS[:, None]) * _FACTORS[:, None]
        np.minimum(low, values.min(1), out=low)
        np.maximum(high, values.max(1), out=high)
    # Neighbouring values of a band come from different permutations.
    return np.concatenate((low, high))


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = _BAND_SEEDS.copy()
    for row in signature.reshape(ROWS, BANDS):
        keys = mix(keys ^ row.astype(np.uint64))
    return keys.view(np.int64)


def set_digest(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def shingled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, n, node, keys): set size, digest of the set (null for an empty
    one) and band keys of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(binary_texts(batch.column(1)), WORDS)
            keys = [band_keys(min_max_signature(s)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n", "node", "keys"],
            )

    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text)).mapInArrow(
        run, "doc_id long, text_hash long, n long, node binary, keys array<long>"
    )


def set_blocks(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, nodes, sizes, shingles): the full sets of ``wanted`` (node, place, block),
    recomputed from whole texts, those of a block one after the other. A place is the id
    and the hash of one text that has the set, so rows without an id, or with one id,
    do not meet each other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, blocks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            sets = shingle_sets(binary_texts(batch.column(1)), WORDS)
            rows = [(n, b, s.view(np.int64)) for n, b, s in zip(nodes, blocks, sets, strict=True) if set_digest(s) == n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.binary()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                ],
                names=["node", "block", "shingles"],
            )

    wanted = wanted.select("node", "block", F.col("place.doc_id").alias("_doc"), F.col("place.text_hash").alias("_hash"))
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    text = F.col(f"`{text_col}`")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_h"))
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_h") == F.col("_hash"))
    found = texts.join(wanted, same).select("node", "_text", "block")
    sets = found.mapInArrow(run, "node binary, block long, shingles array<long>")
    # Rows that repeat an id give a node again. A block holds about BLOCK_SHINGLES
    # shingles, or one larger set.
    one = sets.groupBy("block", "node").agg(F.first("shingles").alias("shingles"))
    blocks = one.groupBy("block").agg(F.collect_list(F.struct("node", "shingles")).alias("m"))
    return blocks.select(
        "block",
        F.col("m.node").alias("nodes"),
        F.transform("m.shingles", F.size).alias("sizes"),
        F.flatten("m.shingles").alias("shingles"),
    )


def _alike_pairs(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the sets of ``a`` and of ``b`` with 100 * intersection >= 75 * union.

    Sets are written one after the other. Shingles that both sides have meet through
    their positions in sorted order; nothing is estimated.
    """
    a_owner, b_owner = np.repeat(np.arange(len(a_sizes)), a_sizes), np.repeat(np.arange(len(b_sizes)), b_sizes)
    order = np.argsort(b, kind="stable")
    b, b_owner = b[order], b_owner[order]
    low, high = np.searchsorted(b, a, "left"), np.searchsorted(b, a, "right")
    upto = np.cumsum(high - low)
    common = np.zeros(len(a_sizes) * len(b_sizes), np.int64)
    # So many meetings at once, however often a shingle repeats.
    cuts = np.searchsorted(upto, np.arange(_MEETINGS, int(upto[-1]) if len(upto) else 0, _MEETINGS)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)], strict=True):
        hits, owner = ranges(low[start:end], high[start:end])
        common += np.bincount(a_owner[start:end][owner] * len(b_sizes) + b_owner[hits], minlength=len(common))
    common = common.reshape(len(a_sizes), len(b_sizes))
    union = a_sizes[:, None] + b_sizes[None, :] - common
    return np.nonzero(100 * common >= PERCENT * union)


def _stars(names: list[bytes], first: list[int], second: list[int]) -> Iterator[tuple[bytes, bytes]]:
    """Of what the links given connect, each name with the smallest one of its part."""
    parent = {name: name for name in names}

    def find(x: bytes) -> bytes:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, j in zip(first, second, strict=True):
        x, y = find(names[i]), find(names[j])
        parent[max(x, y)] = min(x, y)
    return ((name, root) for name in parent if (root := find(name)) != name)


def confirmed(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """What links between the two blocks of each pair (a, b) connect, on full sets: each
    node with the smallest one of its part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[bytes, bytes]] = []
            for row in range(batch.num_rows):
                a_names, a_sizes, a, b_names, b_sizes, b = (column[row].values for column in batch.columns)
                first, second = _alike_pairs(*(np.asarray(x) for x in (a, a_sizes, b, b_sizes)))
                links += _stars(a_names.to_pylist() + b_names.to_pylist(), first.tolist(), (second + len(a_names)).tolist())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], names=["a", "b"])

    columns = ["nodes", "sizes", "shingles"]
    left = blocks.select(F.col("block").alias("a"), *(F.col(c).alias(f"a_{c}") for c in columns))
    right = blocks.select(F.col("block").alias("b"), *(F.col(c).alias(f"b_{c}") for c in columns))
    both = pairs.join(left, "a").join(right, "b").drop("a", "b")
    return both.mapInArrow(run, "a binary, b binary")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) for every row.

    Words, sets and links as in the module text. ``component_id`` is the smallest id
    that can be reached over links, its own included; ``kept`` marks that document.
    Texts that are null, empty or hold only spaces are linked with nothing, not even
    with each other. Rows that repeat an id with equal words are one node; with other
    words each text is a node of its own. A row with a null id takes part: its group
    is named by the smallest known id, or by null when there is none, and it is kept
    only in that case. No rows give no rows; other columns are ignored.

    Equal sets are one node from the start. Nodes that share their fullest band bucket
    stand in blocks of bounded size. Members of a bucket are not paired with each
    other: each member's block meets the block of the bucket's hub, the member with the
    most bucket mates over all bands (the text others were copied from), and every link
    between the two blocks is found. Only buckets that still hold several components
    go on; there the blocks of different components meet, so that every candidate pair
    is confirmed, refused, or inside one component.
    """
    rows = materialize(shingled(docs, id_col, text_col), "shingled")
    nodes = (
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min(F.struct("doc_id", "text_hash")).alias("place"),
            F.first("n").alias("n"),
            F.first("keys").alias("keys"),
        )
    )
    placed = materialize(nodes.select("node", "place", "n", F.explode("keys").alias("key")), "bands")
    shared = materialize(placed.groupBy("key").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1"), "buckets")
    if fits_broadcast(shared):
        shared = F.broadcast(shared)
    placed = materialize(placed.join(shared, "key"), "bucketed")

    fullest = placed.groupBy("node").agg(
        F.sum("mates").alias("degree"),
        F.max(F.struct("mates", "key"))["key"].alias("anchor"),
        F.first("place").alias("place"),
        F.first("n").alias("n"),
    )
    fullest = materialize(fullest, "anchors")
    cells = fullest.groupBy("anchor").agg(F.ceil(F.sum(F.col("n") + SET_WEIGHT) / BLOCK_SHINGLES).alias("cells"))
    cell = F.pmod(F.xxhash64("node"), F.col("cells"))
    blocked = materialize(
        fullest.join(cells, "anchor").select("node", "place", "degree", F.xxhash64("anchor", cell).alias("block")), "blocked"
    )
    blocks = materialize(set_blocks(docs, blocked, id_col, text_col), "set-blocks")

    members = materialize(placed.select("key", "node").join(blocked.select("node", "degree", "block"), "node"), "members")
    hubs = members.groupBy("key").agg(F.max(F.struct("degree", "node", "block"))["block"].alias("hub"))
    tried = members.select("key", "block").distinct().join(hubs, "key").select(*_ordered("block", "hub")).distinct()
    tried = materialize(tried, "block-pairs")
    links = materialize(confirmed(tried, blocks), "links")
    roots = materialize(star_components(links), "roots")

    members = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = materialize(members.groupBy("key", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi")), "parts")
    several = parts.groupBy("key").agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least <> most").select("key")
    parts = materialize(parts.join(several, "key", "left_semi"), "open-parts")
    others = parts.select("key", F.col("block").alias("other"), F.col("lo").alias("other_lo"), F.col("hi").alias("other_hi"))
    # Blocks of one and the same component have nothing left to find in this bucket.
    differ = "block <= other and not (lo = hi and other_lo = other_hi and lo = other_lo)"
    open_pairs = parts.join(others, "key").where(differ).select(*_ordered("block", "other"))
    more = confirmed(open_pairs.distinct().join(tried, ["a", "b"], "left_anti"), blocks)
    # What is known is as many edges as nodes.
    known = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = materialize(star_components(materialize(more.union(known), "links")), "roots")

    # Only linked nodes have a name to look up. A root may have very many.
    linked = materialize(nodes.select("node", "doc_id").join(roots, "node"), "linked")
    names = materialize(linked.groupBy("root").agg(F.min("doc_id").alias("component_id")), "names")
    named = lookup_join(linked.select("node", "root"), names, ["root"], "inner", spread_by=["node"]).select("node", "component_id")
    alone = nodes.select("node", "doc_id").join(roots.select("node"), "node", "left_anti")
    named = named.union(alone.select("node", F.col("doc_id").alias("component_id")))
    joined = rows.select("doc_id", "text_hash", "n", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_hash",
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns, whatever their names; of
    rows with the same id and text, one. Null and empty texts stay; no rows give no rows."""
    found = materialize(near_duplicates(docs, id_col, text_col), "near-dup")
    doc, digest = unused(docs, "_id", "_hash")
    of_row = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(digest))
    ids = [F.col("doc_id").alias(doc), F.col("text_hash").alias(digest)]

    def marked(rows: DataFrame) -> DataFrame:
        rows = rows.select(*ids).distinct()
        return F.broadcast(rows) if fits_broadcast(rows) else rows

    left = docs.join(marked(found.where("not kept")), of_row, "left_anti")
    repeated = found.where("kept").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    if repeated.isEmpty():
        return left
    repeated = marked(repeated)
    single = left.join(repeated, of_row, "left_anti")
    return single.unionByName(left.join(repeated, of_row, "left_semi").dropDuplicates([id_col, text_col]))
