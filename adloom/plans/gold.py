"""Bronze tables to the gold star: unified ads, dimensions, bridges, n-grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.dims import (
    ads_with_ids,
    clean_content,
    clean_metadata,
    employer_dim,
    function_bridge,
    function_dim,
    keyword_bridge,
    keyword_dim,
    select_content,
    select_metadata,
    unify_ads,
    with_employer,
)
from adloom.operators.tokens import ngrams, ngrams_with_bridges
from adloom.sinks.writers import export_jdbc, open_bucketed, snapshot, write_bucketed
from adloom.sources.readers import read_months, read_table_jdbc
from adloom.storage import materialize


@dataclass
class GoldTables:
    ads: DataFrame
    keywords: DataFrame
    employers: DataFrame
    stillingsfunksjon: DataFrame
    keyword_ads_bridge: DataFrame
    stillingsfunksjon_ads_bridge: DataFrame
    ads_with_id: DataFrame
    ngrams: DataFrame

    def exports(self) -> dict[str, DataFrame]:
        names = (
            "keywords",
            "employers",
            "stillingsfunksjon",
            "ads_with_id",
            "ngrams",
            "keyword_ads_bridge",
            "stillingsfunksjon_ads_bridge",
        )
        return {name: getattr(self, name) for name in names}


def build_gold(
    metadata: DataFrame,
    content: DataFrame,
    stopwords: DataFrame,
    fanout: bool = False,
    id_col: str = "id",
) -> GoldTables:
    """``metadata`` and ``content`` are bronze rows, already limited to the wanted
    months. The unified ads are written once, since every later table reads some
    of their columns. With ``fanout`` n-grams repeat per keyword x function row.
    """
    ads = unify_ads(
        clean_metadata(select_metadata(metadata, id_col)),
        clean_content(select_content(content, id_col)),
    )
    ads = materialize(ads, "gold-ads")
    keywords, employers, functions = keyword_dim(ads), employer_dim(ads), function_dim(ads)
    by_keyword = materialize(keyword_bridge(ads, keywords), "keyword-bridge")
    by_function = materialize(function_bridge(ads, functions), "function-bridge")
    wide = ads_with_ids(ads, employers, by_keyword, by_function)
    if fanout:
        ids = ads_with_ids(ads, employers, by_keyword, by_function, columns=[])
        grams = ngrams_with_bridges(ads, ids, stopwords)
    else:
        texts = with_employer(ads.select("ad_id", "company_name", "article_content"), employers)
        grams = ngrams(texts, stopwords, carry=["ad_id", "employer_id"])
    return GoldTables(ads, keywords, employers, functions, by_keyword, by_function, wide, grams)


# Columns of the two bronze tables that gold reads.
BRONZE_METADATA_DDL = """id bigint, canonical_url string, heading string, location string, job_title string,
    company_name string, no_of_positions bigint, timestamp timestamp, published timestamp, y int, m int"""
BRONZE_CONTENT_DDL = """id string, article_header string, article_content string, keywords string,
    timestamp timestamp, job_type string, attributes map<string,string>, batch int, y int, m int"""


def gold_from_bronze(
    spark: SparkSession,
    bronze_root: str,
    stopwords: DataFrame,
    first: tuple[int, int] | None = None,
    last: tuple[int, int] | None = None,
    category: str = "job_fulltime",
    fanout: bool = False,
) -> GoldTables:
    """The gold tables of a range of months."""
    root = f"{bronze_root.rstrip('/')}/{category}"
    metadata = read_months(spark, f"{root}/ad_metadata", first, last, schema=BRONZE_METADATA_DDL)
    content = read_months(spark, f"{root}/ad_content", first, last, schema=BRONZE_CONTENT_DDL)
    return build_gold(metadata, content, stopwords, fanout)


def write_gold(gold: GoldTables, root: str) -> dict[str, str]:
    """Replace the gold tables as parquet; returns their paths."""
    paths = {}
    for table, frame in gold.exports().items():
        paths[table] = f"{root.rstrip('/')}/{table}"
        frame.write.mode("overwrite").parquet(paths[table])
    return paths


# The tables that are joined by ad.
BY_AD = ("ads", "keyword_ads_bridge", "stillingsfunksjon_ads_bridge", "ngrams")


def write_by_ad(gold: GoldTables, root: str, prefix: str = "gold", buckets: int = 200) -> dict[str, DataFrame]:
    """Replace the tables of BY_AD, all bucketed on ``ad_id``; the ads have ``employer_id``.

    Choose ``buckets`` so that a bucket of the largest table fits a task; the tables of one
    ``prefix`` have to agree in it. An ad has one row in the ads and as many in the others
    as it has values, so no bucket is hot.
    """
    frames = {name: getattr(gold, name) for name in BY_AD}
    frames["ads"] = with_employer(gold.ads, gold.employers)
    return {
        name: write_bucketed(frame, f"{root.rstrip('/')}/{name}", f"{prefix}_{name}", "ad_id", buckets)
        for name, frame in frames.items()
    }


def open_by_ad(spark: SparkSession, root: str, prefix: str = "gold", buckets: int = 200) -> dict[str, DataFrame]:
    """The tables of ``write_by_ad`` in another session."""
    return {name: open_bucketed(spark, f"{root.rstrip('/')}/{name}", f"{prefix}_{name}", "ad_id", buckets) for name in BY_AD}


def wide_by_ad(stored: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """The wide table from the tables bucketed by ad: no row is exchanged."""
    return ads_with_ids(stored["ads"], None, stored["keyword_ads_bridge"], stored["stillingsfunksjon_ads_bridge"], columns)


def phrases_by_ad(stored: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """N-grams with the named columns of their ads, joined bucket by bucket."""
    return stored["ngrams"].join(stored["ads"].select("ad_id", *columns), "ad_id")


def export_gold(gold: GoldTables, url: str, properties: dict[str, str] | None = None) -> None:
    for table, frame in gold.exports().items():
        export_jdbc(frame, url, table, properties)


def snapshot_tables(spark: SparkSession, config: list[dict], url: str, root: str, read=read_table_jdbc) -> list[str]:
    """Snapshot the configured relational tables (``table_fqn``, ``path``, and what
    the reader needs, such as ``partition_column``) as parquet."""
    paths = []
    for item in config:
        options = {k: v for k, v in item.items() if k not in ("table_fqn", "path")}
        table = read(spark, url, item["table_fqn"], **options)
        paths.append(snapshot(table, f"{root}/{item['path'].strip('/')}", item["table_fqn"]))
    return paths


def gold_counts(gold: GoldTables) -> DataFrame:
    """Rows per table, for a run report."""
    frames = [df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, df in gold.exports().items()]
    out = frames[0].select("*")
    for frame in frames[1:]:
        out = out.union(frame)
    return out
