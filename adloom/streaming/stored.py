"""Appending what a table does not hold yet, without reading the table for it.

Beside a table lies a Bloom filter of its keys: per period (the partition folder of a
row) words of 64 bits, four of which a key sets. It is one flat folder, sorted by period,
so a batch adds few files to it however many periods it meets. Rows of it are written
before the rows
of the table, so a key that the filter does not know is new, whatever was cut off in
between. Only keys that it seems to know are looked up, in the periods they belong to.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.joins import fits_broadcast
from adloom.sinks.writers import append_partitioned
from adloom.sources.readers import read_or_empty, unless_missing
from adloom.storage import materialize

FILTER_DDL = "word bigint, bits bigint, period string"
# Words of one period's filter; only words in use are stored. Sixteen bits a key are
# left at 2^28 keys a period, where one new key in fifty is looked up for nothing.
FILTER_WORDS = 1 << 26


def filter_path(path: str) -> str:
    return f"{path.rstrip('/')}_keys/words"


def _by_period(words: DataFrame) -> DataFrame:
    """Few files, the words of a period next to each other in them."""
    return words.hint("rebalance", "period").sortWithinPartitions("period", "word")


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None as long as nothing was written to it."""
    try:
        return unless_missing(lambda: spark.read.parquet(path))
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def _period(by: tuple[str, ...]) -> Column:
    known = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in by]
    return F.concat_ws("-", *known) if by else F.lit("all")


def _same(rows: DataFrame, other: DataFrame, keys: list[str]) -> list[Column]:
    """Equal keys of ``rows`` and of ``other``, whose names begin with ``_``. Their hash comes
    first: a sort compares one number in place of long texts that begin alike."""
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    kinds, others = dict(rows.dtypes), dict(other.dtypes)
    if any(kinds[k] != others[f"_{k}"] for k in keys):
        return same
    return [F.xxhash64(*keys) == F.xxhash64(*(f"_{k}" for k in keys)), *same]


def _marked(rows: DataFrame, by: tuple[str, ...], keys: list[str]) -> DataFrame:
    """Per row its period, the word of its key and the bits the key sets."""
    hashed = rows.withColumns({"period": _period(by), "_h": F.xxhash64(*keys), "_g": F.xxhash64(F.lit(1), *keys)})
    bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(_g, {6 * i}) & 63 as int))" for i in range(4))
    return hashed.withColumns({"word": F.pmod("_h", F.lit(FILTER_WORDS)), "bits": F.expr(bits)}).drop("_h", "_g")


def write_filter(rows: DataFrame, path: str, by: tuple[str, ...], keys: list[str]) -> None:
    """Add the keys of ``rows`` to the filter of the table at ``path``."""
    words = _marked(rows.select(*dict.fromkeys([*by, *keys])), by, keys).groupBy("period", "word").agg(F.bit_or("bits").alias("bits"))
    _by_period(words).write.mode("append").option("compression", "zstd").parquet(filter_path(path))


def merge_filter(spark: SparkSession, path: str) -> None:
    """One row per word again, after many batches; run it while nothing is appended."""
    merged = read_or_empty(spark, filter_path(path), FILTER_DDL).groupBy("period", "word").agg(F.bit_or("bits").alias("bits"))
    held = materialize(merged, "merged-filter")
    _by_period(held).write.mode("overwrite").option("compression", "zstd").parquet(filter_path(path))


def perhaps_stored(rows: DataFrame, path: str, by: tuple[str, ...], keys: list[str]) -> DataFrame:
    """The keys (with ``by``) that the filter does not clear. The table is not read, the
    filter only in the periods of ``rows``."""
    spark = rows.sparkSession
    narrow = rows.select(*dict.fromkeys([*by, *keys]))
    # Periods are calendar months: few, however many rows there are.
    periods = [r.period for r in narrow.select(_period(by).alias("period")).distinct().collect()] if by else ["all"]
    known = read_or_empty(spark, filter_path(path), FILTER_DDL).where(F.col("period").isin(periods))
    marked = _marked(narrow, by, keys)
    words = marked.select("word")
    if fits_broadcast(words):
        # The filter holds the words of all rows stored so far; few of them are those of ``rows``.
        known = known.join(F.broadcast(words), "word", "left_semi")
    known = known.select("period", "word", F.col("bits").alias("_bits"))
    hit = [marked["period"] == known["period"], marked["word"] == known["word"], F.col("bits").bitwiseAND(F.col("_bits")) == F.col("bits")]
    return marked.join(known, hit, "left_semi").select(*narrow.columns).distinct()


def unstored(rows: DataFrame, path: str, by: tuple[str, ...], keys: list[str]) -> DataFrame:
    """Rows whose keys the table at ``path`` does not hold. ``rows`` is read several
    times, so pass a table or something as cheap as one."""
    spark = rows.sparkSession
    if unless_missing(lambda: spark.read.schema(FILTER_DDL).parquet(filter_path(path))) is None:
        # A table without a filter, or nothing yet: the filter is made from the table.
        table = stored_table(spark, path)
        if table is None:
            return rows
        write_filter(table, path, by, keys)
    # What follows asks for keys only, again and again.
    narrow = materialize(rows.select(*dict.fromkeys([*by, *keys])), "keys")
    hits = materialize(perhaps_stored(narrow, path, by, keys), "perhaps-stored")
    if hits.isEmpty():
        return rows
    table = stored_table(spark, path)
    if table is None:
        return rows
    if by:
        # One list, however long, and only partition columns: folders are left out unread.
        months = [r.period for r in hits.select(_period(by).alias("period")).distinct().collect()]
        table = table.where(_period(by).isin(months))
    wanted = _sized(hits.select(*keys))
    held = table.select(*keys) if wanted.small else _perhaps_among(table.select(*keys), wanted.rows, keys)
    found = _sized(materialize(_among(held, wanted, keys, "left_semi").distinct(), "stored"))
    if _among(narrow, found, keys, "left_anti").isEmpty():
        # Said in the plan: nothing has to be read to append no rows.
        return rows.where(F.lit(False))
    return materialize(_among(rows, found, keys, "left_anti"), "unstored")


class _Keys(NamedTuple):
    """Keys to look for, measured once for all joins with them."""

    rows: DataFrame
    small: bool


def _sized(keys: DataFrame) -> _Keys:
    return _Keys(keys, fits_broadcast(keys))


def _perhaps_among(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without most of those whose keys are not ``wanted``: the hashes of the keys
    are small enough for all tasks where the keys are not, and ``rows`` stays where it is."""
    kinds, others = dict(rows.dtypes), dict(wanted.dtypes)
    hashes = wanted.select(F.xxhash64(*keys).alias("_h"))
    if any(kinds[k] != others[k] for k in keys) or not fits_broadcast(hashes):
        return rows
    return rows.join(F.broadcast(hashes), F.xxhash64(*keys) == F.col("_h"), "left_semi")


def _among(rows: DataFrame, found: _Keys, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join; NULL keys are keys too."""
    other = found.rows.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = _same(rows, other, keys)
    return rows.join(F.broadcast(other) if found.small else other, same, how)


def without(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys ``found`` does not have; NULL keys are keys too."""
    return _among(rows, _sized(found.select(*keys).distinct()), keys, "left_anti")


def append(rows: DataFrame, path: str, by: tuple[str, ...], keys: list[str]) -> None:
    """Append rows known to be new; the filter learns them first."""
    write_filter(rows, path, by, keys)
    if by:
        append_partitioned(rows, path, by)
    else:
        rows.write.mode("append").option("compression", "zstd").parquet(path)


def append_new(rows: DataFrame, path: str, by: tuple[str, ...], keys: list[str]) -> None:
    """Append what the table does not hold. A batch that is run again, a batch that was cut
    off while it committed, or a run whose checkpoint was lost adds what is missing."""
    append(unstored(rows, path, by, keys), path, by, keys)
