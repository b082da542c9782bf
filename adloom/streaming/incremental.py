"""Incremental runs. A run processes what has arrived since the last one and
stops; the checkpoint, not a tag on the object, records what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adloom.functions.values import epoch_ms, month_of, year_of
from adloom.operators.dedupe import dedupe_urls, page_versions
from adloom.operators.joins import fits_broadcast
from adloom.operators.normalize import bronze_metadata
from adloom.operators.pages import accepted, extract_content, quarantined, with_job_type
from adloom.schemas import AD_HTML_DDL, CONTENT_REJECTS_DDL, PAYLOAD_REJECTS_DDL
from adloom.sources.readers import parse_landed, read_or_empty
from adloom.storage import materialize
from adloom.streaming.fields import register_fields
from adloom.streaming.stored import append, append_new, stored_table, unstored, without

# The file source forgets files older than this against the newest one; files may be
# landed late, so it is set beyond any real age. The checkpoint names every file done.
_MAX_FILE_AGE = "36500d"


def default_checkpoint(target: str) -> str:
    """Beside the table it belongs to."""
    return f"{target.rstrip('/')}_progress"


def _drain(stream: DataFrame, checkpoint: str, write) -> StreamingQuery:
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _files(spark: SparkSession, files_per_batch: int | None):
    reader = spark.readStream.option("maxFileAge", _MAX_FILE_AGE).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def run_metadata(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str | None,
    category: str,
    keep_nested: bool = False,
    files_per_batch: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """New payload files of one category into its bronze table, records that cannot be
    parsed into ``rejects`` (``<target>_rejected`` by default).

    A document is known by its place: file, line and position in the line's list
    (``source_file``, ``source_line``, ``source_doc``). Fields that the category does not
    declare stay in ``other``; their names go to the registry (``fields.known_fields``). Each place is written once, and every
    place is written, whatever happens to the checkpoint or to a batch while it commits.
    """
    rejects = rejects or f"{target.rstrip('/')}_rejected"
    files = _files(spark, files_per_batch).schema("value string").format("text").load(landing)
    files = files.select("value", "_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start")

    def write(batch: DataFrame, _: int) -> None:
        lines = batch.toDF("value", "source_file", "_size", "_block").withColumn("_seq", F.monotonically_increasing_id())
        parsed = parse_landed(lines, category, lean=not keep_nested, keep_other=True)
        rows = bronze_metadata(parsed.where("error is null").drop("error", "record"), category, keep_nested)
        by, place = ("_y", "_m") if keep_nested else ("y", "m"), ["source_file", "source_line", "source_doc"]
        rows = unstored(rows, target, by, place)
        register_fields(rows, "other", target)
        append(rows, target, by, place)
        bad = parsed.where("error is not null").select("source_file", "source_line", "record", "error")
        if not bad.isEmpty():
            append_new(bad, rejects, (), ["source_file", "source_line"])

    return _drain(files, checkpoint or default_checkpoint(target), write)


def content_rows(html: DataFrame, urls: DataFrame) -> DataFrame:
    """Pages joined to their URLs and parsed: one row per URL and page version, with
    ``html_hash`` naming the version. A page whose URL is not known yet gives no row.

    Deduplication comes before the parse, which is the expensive step, and shares its
    exchange by ``id`` with the join.
    """
    wanted = dedupe_urls(urls) if "ingeston_ts_url" not in urls.columns else urls
    versions = html if "html_hash" in html.columns else page_versions(html)
    return _parsed(versions.join(wanted, "id"))


def _parsed(rows: DataFrame) -> DataFrame:
    parsed = extract_content(with_job_type(rows))
    seen = epoch_ms(F.col("timestamp"))
    return parsed.withColumns({"timestamp": seen, "y": year_of(seen), "m": month_of(seen)})


# What names a row of the content table, and what names a landed page.
_CONTENT_KEYS = ["id", "canonical_url", "html_hash"]
_PLACE = ["_file", "_row"]


def _landed(reader) -> DataFrame:
    """Pages of a parquet scan with the place each stands at."""
    return reader.select("html_main", "id", "ingestion_ts", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _versions(pages: DataFrame) -> DataFrame:
    """Page versions without their HTML: earliest time and one place of each."""
    known = pages.where("html_main is not null and id is not null")
    hashed = known.select("id", F.sha2("html_main", 256).alias("html_hash"), "ingestion_ts", *_PLACE)
    found = hashed.groupBy("id", "html_hash").agg(F.min("ingestion_ts").alias("ingestion_ts"), F.min(F.struct(*_PLACE)).alias("_p"))
    return found.select("id", "html_hash", "ingestion_ts", *(F.col(f"_p.{c}").alias(c) for c in _PLACE))


def content_paths(target: str, waiting: str | None = None) -> dict[str, str]:
    """The tables a content run keeps beside its target: every page version that landed and
    where, every URL joined so far, and the versions that came without a URL."""
    target = target.rstrip("/")
    return {"pages": f"{target}_pages", "urls": f"{target}_urls", "waiting": waiting or f"{target}_waiting"}


def run_content(
    spark: SparkSession,
    html_landing: str,
    urls: DataFrame,
    target: str,
    quarantine: str,
    checkpoint: str | None,
    files_per_batch: int | None = None,
    waiting: str | None = None,
) -> StreamingQuery:
    """New page files into the content table; rejected pages into ``quarantine``.

    A page version is stored once per URL however files are dealt to batches and runs, and
    whichever of page and URL lands first: new pages meet all URLs, new URLs meet all pages
    landed before. Both sides are remembered by narrow tables (``content_paths``); a batch
    asks the filter of the stored keys and reads the target only where that says so. HTML
    is read twice, hashed and then, only that of rows to be stored, parsed; it is exchanged
    at most once. Landed files have to stay, since late URLs are joined to them; URLs whose
    page is gone are asked for again by each run. Versions without a URL are listed in
    ``waiting`` (``<target>_waiting`` by default).
    """
    paths = content_paths(target, waiting)
    # Once per run, not once per batch.
    known = materialize(dedupe_urls(urls), "urls")

    def pairs(versions: DataFrame, wanted: DataFrame) -> DataFrame:
        """(version, URL) pairs that are not stored, without HTML."""
        seen = epoch_ms(F.col("timestamp"))
        joined = _by_id(wanted, versions).withColumns({"y": year_of(seen), "m": month_of(seen)})
        joined = materialize(joined, "pairs")
        fresh = unstored(unstored(joined, target, ("y", "m"), _CONTENT_KEYS), quarantine, (), _CONTENT_KEYS)
        return materialize(fresh.drop("y", "m"), "new-pairs")

    def store(fresh: DataFrame, pages: DataFrame) -> DataFrame:
        """Parse and append new pairs; returns those whose page was found."""
        wanted = F.broadcast(fresh) if fits_broadcast(fresh) else fresh
        rows = materialize(_parsed(pages.select("html_main", *_PLACE).join(wanted, _PLACE)), "content")
        append(accepted(rows.drop(*_PLACE)), target, ("y", "m"), _CONTENT_KEYS)
        append(quarantined(rows.drop(*_PLACE)), quarantine, (), _CONTENT_KEYS)
        return rows

    def write(batch: DataFrame, _: int) -> None:
        versions = materialize(_versions(batch), "versions")
        fresh = pairs(versions, known)
        if not fresh.isEmpty():
            store(fresh, batch)
        append_new(versions, paths["pages"], (), ["id", "html_hash"])
        orphans = without(versions, _by_id(known.select("id"), versions.select("id")), ["id"])
        if not orphans.isEmpty():
            append_new(orphans, paths["waiting"], (), ["id", "html_hash"])

    def store_late() -> None:
        late = materialize(unstored(known, paths["urls"], (), ["id", "canonical_url"]), "late-urls")
        if late.isEmpty():
            return
        # Not there before the first batch is logged.
        landed = stored_table(spark, paths["pages"])
        done = late
        fresh = None if landed is None else pairs(landed, late)
        if fresh is not None and not fresh.isEmpty():
            # Only the named files are opened, and those that are gone have no rows.
            files = [r["_file"] for r in fresh.select("_file").distinct().collect()]
            pages = spark.read.schema(AD_HTML_DDL).option("recursiveFileLookup", True).parquet(html_landing)
            found = store(fresh, _landed(pages.where(F.col("_metadata.file_path").isin(files))))
            gone = without(fresh, found, _CONTENT_KEYS)
            done = without(late, gone, ["id", "canonical_url"])
        append(done.select("id", "canonical_url"), paths["urls"], (), ["id", "canonical_url"])

    store_late()
    files = _files(spark, files_per_batch).schema(AD_HTML_DDL).parquet(html_landing)
    return _drain(_landed(files), checkpoint or default_checkpoint(target), write)


def _by_id(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """``rows`` (all URLs) joined to the versions of a batch: the smaller side goes to the
    larger one where it is measured to be small."""
    return rows.join(F.broadcast(versions) if fits_broadcast(versions) else versions, "id")


def read_rejected_payloads(spark: SparkSession, target: str) -> DataFrame:
    """Readable also when nothing was rejected."""
    return read_or_empty(spark, f"{target.rstrip('/')}_rejected", PAYLOAD_REJECTS_DDL)


def read_rejected_content(spark: SparkSession, quarantine: str) -> DataFrame:
    return read_or_empty(spark, quarantine, CONTENT_REJECTS_DDL)


def crawl_frontier(urls: DataFrame, html: DataFrame) -> DataFrame:
    """Ads whose page is not stored yet, once each (the smallest URL)."""
    wanted = urls.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("canonical_url").alias("canonical_url"))
    return wanted.join(html.select("id").distinct(), "id", "left_anti")


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Batch form of incremental discovery: listed files (path) not in the ledger."""
    return listing.join(ledger.select("path").distinct(), "path", "left_anti")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Names, sizes and times only; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), "length", "modificationTime")


def mark_done(files: DataFrame, ledger_path: str) -> None:
    """Batch form of the commit marker: append the processed files to the ledger."""
    files.select("path", F.current_timestamp().alias("done_at")).write.mode("append").parquet(ledger_path)


def high_water_mark(target: DataFrame, column: str):
    return target.agg(F.max(column).alias("mark")).first().mark


def rows_after(source: DataFrame, column: str, mark, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows not loaded yet. Rows at the mark itself or without a time may be new: they are
    read again and those that ``target`` holds, by ``keys``, are left out."""
    if mark is None:
        return source
    open_ = source.where((F.col(column) >= F.lit(mark)) | F.col(column).isNull())
    stored = target.where((F.col(column) >= F.lit(mark)) | F.col(column).isNull())
    return without(open_, stored, keys)
