"""Unified ads, dimensions, bridges and the wide ad table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.text import clean_text, keyword_list, slash_list
from adloom.functions.values import joined_key
from adloom.operators.dedupe import merge_rows
from adloom.operators.flatten import ensure_columns
from adloom.operators.ids import dense_ids
from adloom.operators.joins import lookup_join, shuffled

# The columns gold reads from the two bronze tables.
CONTENT_COLUMNS = {
    "article_header": "string",
    "article_content": "string",
    "keywords": "string",
    "timestamp": "timestamp",
    "job_type": "string",
    "sektor": "string",
    "bransje": "string",
    "stillingsfunksjon": "string",
}
METADATA_COLUMNS = {
    "canonical_url": "string",
    "heading": "string",
    "location": "string",
    "job_title": "string",
    "company_name": "string",
    "no_of_positions": "bigint",
    "timestamp": "timestamp",
    "published": "timestamp",
}


def select_content(bronze: DataFrame, id_col: str = "id") -> DataFrame:
    """Gold's view of the content table; open attributes are promoted to columns."""
    if "attributes" in bronze.columns:
        promoted = {
            c: F.try_element_at("attributes", F.lit(c))
            for c in CONTENT_COLUMNS
            if c not in bronze.columns
        }
        bronze = bronze.withColumns(promoted)
    return _typed(bronze, id_col, CONTENT_COLUMNS)


def select_metadata(bronze: DataFrame, id_col: str = "id") -> DataFrame:
    return _typed(bronze, id_col, METADATA_COLUMNS)


def _typed(bronze: DataFrame, id_col: str, columns: dict[str, str]) -> DataFrame:
    known = ensure_columns(bronze, columns)
    return known.select(
        F.col(id_col).cast("string").alias("ad_id"), *[F.col(c).cast(t).alias(c) for c, t in columns.items()]
    )


def clean_content(content: DataFrame) -> DataFrame:
    """One row per ad with cleaned text."""
    merged = merge_rows(content, ["ad_id"], ["timestamp"])
    return merged.withColumn("article_content", clean_text(F.col("article_content")))


def clean_metadata(metadata: DataFrame) -> DataFrame:
    """One row per ad; ``published`` falls back from the timestamp."""
    seen = metadata.withColumn("published", F.coalesce("timestamp", "published")).drop("timestamp")
    merged = merge_rows(seen.withColumn("_seen", F.col("published")), ["ad_id"], ["_seen"])
    return merged.drop("_seen")


def unify_ads(metadata: DataFrame, content: DataFrame) -> DataFrame:
    """Metadata left-joined to content, with parsed keyword and function lists.

    Both inputs hold one row per ad, so both shuffles are already on ``ad_id``. The
    lists are parsed after the join, which then carries the shorter raw text. Neither side
    was measured, so none is broadcast.
    """
    return metadata.join(shuffled(content), "ad_id", "left").withColumns(
        {
            "keywords": keyword_list(F.col("keywords")),
            "stillingsfunksjon": slash_list(F.col("stillingsfunksjon")),
        }
    )


def keyword_dim(ads: DataFrame) -> DataFrame:
    return _value_dim(ads, "keywords", "keyword")


def function_dim(ads: DataFrame) -> DataFrame:
    return _value_dim(ads, "stillingsfunksjon", "stillingsfunksjon")


def _value_dim(ads: DataFrame, list_col: str, name: str) -> DataFrame:
    values = ads.select(F.explode(F.array_distinct(list_col)).alias(name)).distinct()
    return dense_ids(values, [name])


def employer_dim(ads: DataFrame) -> DataFrame:
    """One row per company name (a missing name is a row too, numbered last) with
    one of its known industries and sectors: the smallest, to be reproducible."""
    firms = ads.groupBy("company_name").agg(F.min("bransje").alias("bransje"), F.min("sektor").alias("sektor"))
    return dense_ids(firms, ["company_name"]).select("id", "company_name", "bransje", "sektor")


def keyword_bridge(ads: DataFrame, dim: DataFrame) -> DataFrame:
    return _bridge(ads, dim, "keywords", "keyword", "keyword_id")


def function_bridge(ads: DataFrame, dim: DataFrame) -> DataFrame:
    return _bridge(ads, dim, "stillingsfunksjon", "stillingsfunksjon", "stillingsfunksjon_id")


def _bridge(ads: DataFrame, dim: DataFrame, list_col: str, name: str, id_col: str) -> DataFrame:
    """Ad x list element pairs as ids.

    "The list contains the value" is an equality after exploding the list.
    Elements are made distinct inside the row; ``ads`` has one row per ad, so no
    further distinct is needed. A value that most ads share is the skew here.
    """
    pairs = ads.select("ad_id", F.explode(F.array_distinct(list_col)).alias(name))
    ids = dim.select(name, F.col("id").alias(id_col))
    joined = lookup_join(pairs, ids, [name], "inner", spread_by=["ad_id"])
    return joined.select(joined_key(F.col("ad_id"), F.col(id_col)).alias("id"), "ad_id", id_col)


# The ad columns that the wide table repeats.
AD_COLUMNS = [
    "canonical_url",
    "heading",
    "location",
    "job_title",
    "no_of_positions",
    "published",
    "article_header",
    "article_content",
    "timestamp",
    "job_type",
]


def with_employer(ads: DataFrame, employers: DataFrame) -> DataFrame:
    """Ads with ``employer_id``; an ad without company name gets none."""
    ids = employers.where("company_name is not null").select("company_name", F.col("id").alias("employer_id"))
    return lookup_join(ads, ids, ["company_name"], "left", spread_by=["ad_id"])


def ads_with_ids(
    ads: DataFrame,
    employers: DataFrame | None,
    keyword_ads: DataFrame,
    function_ads: DataFrame,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per ad x keyword x function. ``columns`` narrows the ad columns that
    are repeated; leave out ``article_content`` where only ids are needed. ``ads`` has one
    row per ad, with an id; without ``employers`` it has their ids already."""
    kept = AD_COLUMNS if columns is None else columns
    # Only ids go through the joins; the text keys are made of them afterwards, and the
    # ad's own columns, texts among them, are joined once at the end. All joins are on
    # ad_id, so each reuses the partitioning of the one before.
    named = ads if employers is None else with_employer(ads.select("ad_id", "company_name"), employers)
    base = named.select("ad_id", "employer_id")
    joined = base.join(shuffled(keyword_ads.select("ad_id", "keyword_id")), "ad_id", "left").join(
        shuffled(function_ads.select("ad_id", "stillingsfunksjon_id")), "ad_id", "left"
    )

    def key(number: str):
        return F.when(F.col(number).isNotNull(), joined_key(F.col("ad_id"), F.col(number)))

    ids = joined.select(
        "ad_id", "employer_id", key("keyword_id").alias("keyword_bridge_id"), key("stillingsfunksjon_id").alias("stillingsfunksjon_bridge_id")
    )
    wide = ids.join(shuffled(ads.select("ad_id", *kept)), "ad_id") if kept else ids
    return wide.select("ad_id", "employer_id", *kept, "keyword_bridge_id", "stillingsfunksjon_bridge_id")


def ad_employers(ads: DataFrame, employers: DataFrame, function_ads: DataFrame | None = None) -> DataFrame:
    """(ad_id, employer_id, rows) of ads with an employer: what counting an employer's
    keywords needs of the wide table. ``rows`` is how often the wide table repeats a
    keyword of the ad, once per function."""
    known = with_employer(ads.select("ad_id", "company_name"), employers).where("employer_id is not null")
    if function_ads is None:
        return known.select("ad_id", "employer_id", F.lit(1).cast("bigint").alias("rows"))
    repeats = function_ads.groupBy("ad_id").agg(F.count(F.lit(1)).alias("rows"))
    joined = known.select("ad_id", "employer_id").join(repeats, "ad_id", "left")
    return joined.withColumn("rows", F.coalesce("rows", F.lit(1)))
