"""Landing to bronze, per category, and the job-ad content flow."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from adloom.functions.text import replace_nul
from adloom.functions.values import category_name
from adloom.operators.pages import main_subtree, parse_errors
from adloom.sinks.writers import append_parquet
from adloom.sources.readers import read_ad_html, read_ad_urls, source_path, union_pages, unless_missing
from adloom.storage import materialize
from adloom.streaming.incremental import crawl_frontier, run_content, run_metadata
from adloom.streaming.stored import append_new

# Configured search keys and occupations.
SEARCH_KEYS = [
    "SEARCH_ID_REALESTATE_HOMES",
    "SEARCH_ID_REALESTATE_LETTINGS",
    "SEARCH_ID_CAR_USED",
    "SEARCH_ID_JOB_FULLTIME",
    "SEARCH_ID_REALESTATE_NEWBUILDINGS",
]
OCCUPATIONS = ["0.1", "0.12", "0.22", "0.23", "0.25"]


def ingest_metadata(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    search_keys: list[str] | None = None,
    keep_nested: bool = False,
    checkpoint_root: str | None = None,
) -> dict[str, str]:
    """Every selected category, new files only; returns the bronze paths of those
    that have landed anything yet. New buildings are one of the categories. Progress is
    kept beside each table unless ``checkpoint_root`` says otherwise."""
    targets = {}
    for key in search_keys if search_keys is not None else SEARCH_KEYS:
        if key not in SEARCH_KEYS:
            raise ValueError(f"unknown search key: {key}")
        category = category_name(key)
        target = source_path(bronze_root, "ad_metadata", category)
        started = partial(
            run_metadata,
            spark,
            source_path(landing_root, "ad_metadata", category),
            target,
            f"{checkpoint_root}/{category}-metadata{'-full' if keep_nested else ''}" if checkpoint_root else None,
            category,
            keep_nested,
        )
        if unless_missing(started) is not None:
            targets[category] = target
    return targets


def land_search_pages(pages: DataFrame, landing_root: str, category: str = "job_fulltime") -> None:
    """Landed search pages (docs, page, last, occupation) to the URL table: every ad of
    the configured occupations with its time, URL and occupation."""
    docs = union_pages(pages.where(F.col("occupation").isin(OCCUPATIONS)))
    rows = docs.select(
        F.col("doc.id").cast("string").alias("id"),
        F.col("doc.timestamp").cast("bigint").alias("timestamp"),
        "doc.canonical_url",
        "occupation",
        F.current_timestamp().alias("ingeston_ts"),
    )
    append_parquet(rows, source_path(landing_root, "ad_urls", category))


def land_fetched_pages(fetched: DataFrame, landing_root: str, category: str = "job_fulltime", rejects: str | None = None) -> None:
    """Fetched pages (id, html) to the page table: the main part, without NULs. A page
    that cannot be read or has no main part is stored as NULL, and fetched once; its whole
    html and the reason go to ``rejects`` (``<page table>_rejected`` by default), which
    ``read_rejected_content`` reads."""
    target = source_path(landing_root, "ad_html", category)
    pages = materialize(main_subtree(fetched.select(F.col("id").cast("string").alias("id"), "html")), "fetched")
    refused = parse_errors(pages.where("html_main is null"))
    reason = F.when(F.col("html").isNull(), "no page").otherwise(F.coalesce("parse_error", F.lit("no main part")))
    refused = refused.select(
        "id",
        F.lit(None).cast("string").alias("canonical_url"),
        F.lit(None).cast("string").alias("job_type"),
        reason.alias("error"),
        F.col("html").alias("html_main"),
        F.sha2("html", 256).alias("html_hash"),
    )
    # Before the page table, which says that the page needs no other fetch.
    append_new(refused.distinct(), rejects or f"{target}_rejected", (), ["id", "html_hash"])
    rows = pages.select(replace_nul(F.col("html_main")).alias("html_main"), "id", F.current_timestamp().alias("ingestion_ts"))
    append_parquet(rows, target)


def pages_to_fetch(spark: SparkSession, landing_root: str, category: str = "job_fulltime") -> DataFrame:
    """What a fetcher has to download next; before the first run everything."""
    return crawl_frontier(
        read_ad_urls(spark, landing_root, category), read_ad_html(spark, landing_root, category)
    )


def ingest_content(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    category: str = "job_fulltime",
    checkpoint_root: str | None = None,
    files_per_batch: int | None = None,
) -> tuple[str, str]:
    """New pages, if any, into the content table; returns its path and the
    quarantine's."""
    target = f"{bronze_root.rstrip('/')}/{category}/ad_content"
    rejected = f"{bronze_root.rstrip('/')}/{category}/ad_content_rejected"
    unless_missing(
        lambda: run_content(
            spark,
            source_path(landing_root, "ad_html", category),
            read_ad_urls(spark, landing_root, category),
            target,
            rejected,
            f"{checkpoint_root}/{category}-content" if checkpoint_root else None,
            files_per_batch,
        )
    )
    return target, rejected
