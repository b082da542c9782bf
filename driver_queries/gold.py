"""Unified ads, dimensions, bridges, search and employer queries.

Two stand-ins for ads: `documents` (whole texts; every word of a text counts as a
keyword of its ad, so common words are shared by most ads) and `part` (short
texts, several rows per ad in the wide table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.dims import (
    ad_employers,
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
)
from adloom.operators.serving import (
    employer_by_id,
    employer_keywords,
    employer_keywords_all,
    hits_by_type,
    read_index,
    search,
    search_batch,
    searchable,
    write_index,
)
from adloom.operators.tokens import ngrams, ngrams_with_bridges, union_all
from adloom.plans.gold import build_gold, gold_counts, gold_from_bronze, phrases_by_ad, wide_by_ad, write_by_ad
from adloom.schemas import EXPORT_TABLES
from adloom.sinks.writers import append_partitioned, export_frame
from adloom.storage import fresh_path, materialize
from driver_queries.registry import load, load_spread, query
from driver_queries.text import NGRAMS_SQL, STOPWORDS_SQL, stopwords

# --- ads from documents -------------------------------------------------------


def document_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, and every benchmark item as an ad that has no content yet."""
    docs = load(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("location"),
        F.nullif("source", F.lit("src0")).alias("company_name"),
        F.col("n_chars").alias("no_of_positions"),
    )
    items = load(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b"), "item_id").alias("id"), F.lit("benchmark").alias("company_name")
    )
    return union_all([docs, items]).withColumns(
        {
            "canonical_url": F.concat(F.lit("https://ads.example/job/fulltime/"), "id"),
            "heading": F.concat_ws(" ", F.lit("ad"), "id"),
        }
    )


def document_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_spread(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("article_content"),
        F.col("text").alias("keywords"),
        F.lit("fulltime").alias("job_type"),
        F.col("lang").alias("sektor"),
        F.col("source").alias("bransje"),
        F.concat_ws("/", "lang", "source").alias("stillingsfunksjon"),
    )


def document_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify_ads(
        clean_metadata(select_metadata(document_metadata(spark, sf_dir))),
        clean_content(select_content(document_content(spark, sf_dir))),
    )


DOCUMENT_ADS_SQL = r"""
    ads AS (
        SELECT m.ad_id, 'https://ads.example/job/fulltime/' || m.ad_id AS canonical_url,
               'ad ' || m.ad_id AS heading, m.location, m.company_name, m.no_of_positions,
               regexp_replace(regexp_replace(lower(c.text), '[|!?:;./\-%&]', ' ', 'g'), '[\t\n\f\r ]+', ' ', 'g')
                   AS article_content,
               regexp_extract_all(lower(c.text), '\w+') AS keywords,
               CASE WHEN c.doc_id IS NOT NULL THEN 'fulltime' END AS job_type, c.lang AS sektor, c.source AS bransje,
               string_split(lower(c.lang || '/' || c.source), '/') AS functions
        FROM (SELECT CAST(doc_id AS VARCHAR) AS ad_id, lang AS location, nullif(source, 'src0') AS company_name,
                     n_chars AS no_of_positions FROM documents
              UNION ALL SELECT 'b' || item_id, NULL, 'benchmark', NULL FROM benchmark) m
        LEFT JOIN documents c ON CAST(c.doc_id AS VARCHAR) = m.ad_id)"""

# --- ads from parts -----------------------------------------------------------


def part_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("heading"),
        F.col("p_type").alias("job_title"),
        F.col("p_brand").alias("company_name"),
        F.col("p_size").alias("no_of_positions"),
    )


def part_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(": ", "p_name", "p_type", F.concat_ws(", ", "p_brand", "p_name", "p_size"))
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("article_header"),
        text.alias("article_content"),
        F.concat_ws(", ", "p_name", "p_type").alias("keywords"),
        F.col("p_type").alias("sektor"),
        F.col("p_brand").alias("bransje"),
        F.concat(F.col("p_type"), F.lit("/size "), F.col("p_size")).alias("stillingsfunksjon"),
    )


def part_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify_ads(
        clean_metadata(select_metadata(part_metadata(spark, sf_dir))),
        clean_content(select_content(part_content(spark, sf_dir))),
    )


PART_ADS_SQL = r"""
    ads AS (
        SELECT CAST(p_partkey AS VARCHAR) AS ad_id, p_name AS heading, p_type AS job_title, p_brand AS company_name,
               CAST(p_size AS BIGINT) AS no_of_positions, p_name AS article_header,
               regexp_replace(regexp_replace(lower(p_name || ': ' || p_type || ': ' || p_brand || ', ' || p_name
                   || ', ' || p_size), '[|!?:;./\-%&]', ' ', 'g'), '[\t\n\f\r ]+', ' ', 'g') AS article_content,
               regexp_extract_all(lower(p_name || ', ' || p_type), '\w+') AS keywords,
               p_type AS sektor, p_brand AS bransje,
               string_split(lower(p_type || '/size ' || p_size), '/') AS functions
        FROM part)"""

DIMS_SQL = """
    keywords AS (SELECT row_number() OVER (ORDER BY keyword) AS id, keyword
                 FROM (SELECT DISTINCT unnest(keywords) AS keyword FROM ads)),
    employers AS (SELECT row_number() OVER (ORDER BY company_name NULLS LAST) AS id, company_name,
                         min(bransje) AS bransje, min(sektor) AS sektor
                  FROM ads GROUP BY company_name),
    functions AS (SELECT row_number() OVER (ORDER BY stillingsfunksjon) AS id, stillingsfunksjon
                  FROM (SELECT DISTINCT unnest(functions) AS stillingsfunksjon FROM ads)),
    keyword_bridge AS (
        SELECT concat(ad_id, '_', k.id) AS id, ad_id, k.id AS keyword_id
        FROM (SELECT DISTINCT ad_id, unnest(keywords) AS keyword FROM ads) a JOIN keywords k USING (keyword)),
    function_bridge AS (
        SELECT concat(ad_id, '_', f.id) AS id, ad_id, f.id AS stillingsfunksjon_id
        FROM (SELECT DISTINCT ad_id, unnest(functions) AS stillingsfunksjon FROM ads) a
        JOIN functions f USING (stillingsfunksjon)),
    wide AS (
        SELECT a.*, e.id AS employer_id, k.id AS keyword_bridge_id, s.id AS stillingsfunksjon_bridge_id
        FROM ads a LEFT JOIN employers e ON a.company_name = e.company_name
        LEFT JOIN keyword_bridge k ON a.ad_id = k.ad_id LEFT JOIN function_bridge s ON a.ad_id = s.ad_id)"""
DOCUMENT_GOLD_SQL = f"WITH {DOCUMENT_ADS_SQL}, {DIMS_SQL}"
PART_GOLD_SQL = f"WITH {PART_ADS_SQL}, {DIMS_SQL}"


@query(
    "join_meta_content",
    f"""WITH {DOCUMENT_ADS_SQL}
        SELECT ad_id, canonical_url, heading, location, company_name, no_of_positions, article_content, job_type,
               sektor, bransje, array_to_string(keywords, ' ') AS keywords,
               array_to_string(functions, ' ') AS stillingsfunksjon
        FROM ads""",
)
def join_meta_content(spark, sf_dir):
    ads = document_ads(spark, sf_dir)
    return ads.select(
        "ad_id", "canonical_url", "heading", "location", "company_name", "no_of_positions", "article_content",
        "job_type", "sektor", "bransje", F.array_join("keywords", " ").alias("keywords"),
        F.array_join("stillingsfunksjon", " ").alias("stillingsfunksjon"),
    )


@query("dim_keywords", f"{DOCUMENT_GOLD_SQL} SELECT * FROM keywords")
def dim_keywords(spark, sf_dir):
    return keyword_dim(document_ads(spark, sf_dir))


@query("dim_employers", f"{DOCUMENT_GOLD_SQL} SELECT * FROM employers")
def dim_employers(spark, sf_dir):
    return employer_dim(document_ads(spark, sf_dir))


@query("dim_functions", f"{DOCUMENT_GOLD_SQL} SELECT * FROM functions")
def dim_functions(spark, sf_dir):
    return function_dim(document_ads(spark, sf_dir))


@query("bridge_keywords", f"{DOCUMENT_GOLD_SQL} SELECT * FROM keyword_bridge")
def bridge_keywords(spark, sf_dir):
    ads = materialize(document_ads(spark, sf_dir).select("ad_id", "keywords"), "ads")
    return keyword_bridge(ads, keyword_dim(ads))


@query("bridge_functions", f"{DOCUMENT_GOLD_SQL} SELECT * FROM function_bridge")
def bridge_functions(spark, sf_dir):
    ads = materialize(document_ads(spark, sf_dir).select("ad_id", "stillingsfunksjon"), "ads")
    return function_bridge(ads, function_dim(ads))


def _star(ads: DataFrame, columns: list[str] | None = None):
    """The ids of an ad table: dimensions, bridges and the wide table. Only the wide table
    reads the bridges, and that once: they go into its joins without being written."""
    ads = materialize(ads, "ads")
    keywords, employers, functions = keyword_dim(ads), employer_dim(ads), function_dim(ads)
    by_keyword, by_function = keyword_bridge(ads, keywords), function_bridge(ads, functions)
    wide = ads_with_ids(ads, employers, by_keyword, by_function, columns)
    return ads, keywords, employers, functions, by_keyword, wide


@query(
    "ads_with_ids",
    f"""{PART_GOLD_SQL} SELECT ad_id, heading, job_title, employer_id, no_of_positions, article_header,
        article_content, keyword_bridge_id, stillingsfunksjon_bridge_id FROM wide""",
)
def ads_with_ids_query(spark, sf_dir):
    wide = _star(part_ads(spark, sf_dir))[-1]
    return wide.select(
        "ad_id", "heading", "job_title", "employer_id", "no_of_positions", "article_header", "article_content",
        "keyword_bridge_id", "stillingsfunksjon_bridge_id",
    )


@query(
    "ads_with_ids_documents",
    f"""{DOCUMENT_GOLD_SQL} SELECT ad_id, employer_id, keyword_bridge_id, stillingsfunksjon_bridge_id, location
        FROM wide""",
)
def ads_with_ids_documents(spark, sf_dir):
    # The texts are not asked for: they are neither exchanged nor written.
    return _star(document_ads(spark, sf_dir).drop("article_content"), ["location"])[-1]


def _stored_by_ad(spark, sf_dir):
    gold = build_gold(part_metadata(spark, sf_dir), part_content(spark, sf_dir), stopwords(spark))
    root = fresh_path(spark, "by-ad")
    return write_by_ad(gold, root, f"adloom_{root[-32:]}", int(spark.conf.get("spark.sql.shuffle.partitions")))


@query(
    "ads_with_ids_stored",
    f"""{PART_GOLD_SQL} SELECT ad_id, heading, job_title, employer_id, no_of_positions, article_header,
        article_content, keyword_bridge_id, stillingsfunksjon_bridge_id FROM wide""",
)
def ads_with_ids_stored(spark, sf_dir):
    """The wide table joined from stored tables that are bucketed by ad."""
    columns = ["heading", "job_title", "no_of_positions", "article_header", "article_content"]
    return wide_by_ad(_stored_by_ad(spark, sf_dir), columns)


_PART_KEPT_SQL = rf"""{PART_GOLD_SQL}, {STOPWORDS_SQL},
    tokens AS (
        SELECT ad_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
        FROM (SELECT ad_id, regexp_extract_all(article_content, '\w+') AS w FROM ads)),
    kept AS (SELECT * FROM tokens ANTI JOIN stopwords ON word = stopword),
    combined AS (SELECT ad_id, string_agg(word, ' ' ORDER BY pos) AS words FROM kept GROUP BY ad_id),
    grams AS (SELECT ad_id, word AS words, 1 AS ngram_size FROM kept
              UNION ALL
              SELECT ad_id, unnest(list_distinct(regexp_extract_all(words, '(\w+)\s+(\w+)'))), 2 FROM combined)"""


@query(
    "ngrams_stored",
    f"""{_PART_KEPT_SQL}
        SELECT words, ngram_size, ad_id, employer_id, heading, job_title
        FROM grams JOIN (SELECT DISTINCT ad_id, employer_id, heading, job_title FROM wide) USING (ad_id)""",
)
def ngrams_stored(spark, sf_dir):
    """Phrases with the heading and title of their ads, joined bucket by bucket."""
    phrases = phrases_by_ad(_stored_by_ad(spark, sf_dir), ["heading", "job_title"])
    return phrases.select("words", "ngram_size", "ad_id", "employer_id", "heading", "job_title")


@query(
    "ngrams_fanout",
    f"""{_PART_KEPT_SQL}
        SELECT row_number() OVER (ORDER BY words, ngram_size, g.ad_id, keyword_bridge_id, stillingsfunksjon_bridge_id)
               AS id, words, ngram_size, g.ad_id, keyword_bridge_id, stillingsfunksjon_bridge_id, employer_id
        FROM grams g JOIN wide w ON g.ad_id = w.ad_id""",
)
def ngrams_fanout(spark, sf_dir):
    star = _star(part_ads(spark, sf_dir), [])
    return ngrams_with_bridges(star[0], star[-1], stopwords(spark))


# --- serving ------------------------------------------------------------------

_SEARCH_SQL = f"""WITH {DOCUMENT_ADS_SQL.replace('ads AS', 'doc_ads AS', 1)},
    {DIMS_SQL.replace('FROM ads', 'FROM doc_ads')},
    {NGRAMS_SQL},
    searchable AS (
        SELECT id, keyword AS value, 'keyword' AS type FROM keywords
        UNION ALL SELECT id, stillingsfunksjon, 'function' FROM functions
        UNION ALL SELECT id, company_name, 'employer' FROM employers
        UNION ALL SELECT id, words, 'phrase' FROM ngrams)"""


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ads = materialize(document_ads(spark, sf_dir).drop("article_content"), "ads")
    texts = load_spread(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").cast("string").alias("ad_id"), F.lower("text").alias("article_content")
    )
    return searchable(keyword_dim(ads), function_dim(ads), employer_dim(ads), ngrams(texts, stopwords(spark)))


def _hits_sql(pattern: str) -> str:
    return f"""
        SELECT id, value, type FROM (
            SELECT *, row_number() OVER (PARTITION BY type ORDER BY id) AS r FROM searchable
            WHERE value ILIKE '{pattern}' AND id IS NOT NULL)
        WHERE r <= 10 ORDER BY id, type, value LIMIT 10"""


@query("search_hits", f"{_SEARCH_SQL} {_hits_sql('%en%')}")
def search_hits(spark, sf_dir):
    return search(_tables(spark, sf_dir), "EN")


@query("search_hits_wildcard", f"{_SEARCH_SQL} {_hits_sql('%s_c%1%')}")
def search_hits_wildcard(spark, sf_dir):
    return search(_tables(spark, sf_dir), "s_c%1")


@query(
    "search_hits_by_type",
    f"""{_SEARCH_SQL}, hits AS ({_hits_sql('%src1%')})
        SELECT type, string_agg(id || ':' || value, '|' ORDER BY id, value) AS hits FROM hits GROUP BY type""",
)
def search_hits_by_type(spark, sf_dir):
    grouped = hits_by_type(search(_tables(spark, sf_dir), "src1"))
    return grouped.select(
        "type", F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["id"], h["value"])), "|").alias("hits")
    )


@query(
    "search_hits_batch",
    rf"""{_SEARCH_SQL},
        queries AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\w+')) AS query FROM benchmark),
        found AS (SELECT query, s.* FROM searchable s JOIN queries ON contains(lower(s.value), query)
                  WHERE length(query) >= 2),
        per_type AS (SELECT *, row_number() OVER (PARTITION BY query, type ORDER BY id) AS r FROM found),
        ranked AS (SELECT query, id, value, type,
                          CAST(row_number() OVER (PARTITION BY query ORDER BY id, type, value) AS INTEGER) AS rank
                   FROM per_type WHERE r <= 10)
        SELECT query AS query_id, id, value, type, rank FROM ranked WHERE rank <= 10""",
)
def search_hits_batch(spark, sf_dir):
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\w+"), F.lit(0)))
    queries = load(spark, sf_dir, "benchmark").select(word.alias("query")).distinct()
    return search_batch(_tables(spark, sf_dir), queries.select(F.col("query").alias("query_id"), "query"), literal=True)


_STORED_QUERIES = ["en", "src1", "e", "s_c%1", "der", "zzzz", "the an", "%a_b%", "__"]


@query(
    "search_hits_stored",
    rf"""{_SEARCH_SQL},
        queries AS (SELECT unnest({_STORED_QUERIES}) AS query),
        found AS (SELECT query, s.* FROM searchable s JOIN queries ON s.value ILIKE '%' || query || '%'
                  WHERE length(query) >= 2),
        per_type AS (SELECT *, row_number() OVER (PARTITION BY query, type ORDER BY id) AS r FROM found),
        ranked AS (SELECT query, id, value, type,
                          CAST(row_number() OVER (PARTITION BY query ORDER BY id, type, value) AS INTEGER) AS rank
                   FROM per_type WHERE r <= 10)
        SELECT query AS query_id, id, value, type, rank FROM ranked WHERE rank <= 10""",
)
def search_hits_stored(spark, sf_dir):
    """The index written, read back and searched: no table is read, no value taken apart."""
    root = fresh_path(spark, "search-index")
    write_index(_tables(spark, sf_dir), root)
    queries = spark.createDataFrame([(q, q) for q in _STORED_QUERIES], "query_id string, query string")
    return search_batch(read_index(spark, root), queries)


@query("employer_lookup", f"{DOCUMENT_GOLD_SQL} SELECT * FROM employers WHERE id = 3")
def employer_lookup(spark, sf_dir):
    return employer_by_id(employer_dim(document_ads(spark, sf_dir)), 3)


_COUNTS_SQL = """counts AS (
        SELECT w.employer_id, k.id, k.keyword, {n} AS "count"
        FROM wide w JOIN keyword_bridge b ON w.keyword_bridge_id = b.id JOIN keywords k ON b.keyword_id = k.id
        WHERE w.employer_id IS NOT NULL GROUP BY w.employer_id, k.id, k.keyword),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY employer_id ORDER BY "count" DESC, id) AS INTEGER) AS rank
               FROM counts)"""
_ADS_SQL = _COUNTS_SQL.format(n="count(DISTINCT w.ad_id)")
_ROWS_SQL = _COUNTS_SQL.format(n="count(*)")


def _employer_keywords(spark: SparkSession, sf_dir: str, functions: bool = False):
    """Keywords, their bridge, and each ad's employer."""
    ads = document_ads(spark, sf_dir).drop("article_content")
    ads = materialize(ads, "ads")
    keywords, employers = keyword_dim(ads), employer_dim(ads)
    by_function = function_bridge(ads, function_dim(ads)) if functions else None
    return keywords, keyword_bridge(ads, keywords), ad_employers(ads, employers, by_function)


@query(
    "employer_top_keywords",
    f'{DOCUMENT_GOLD_SQL}, {_ROWS_SQL} SELECT "count", id, keyword FROM ranked WHERE rank <= 10 AND employer_id = 2',
)
def employer_top_keywords(spark, sf_dir):
    keywords, bridge, ads = _employer_keywords(spark, sf_dir, functions=True)
    return employer_keywords(ads, bridge, keywords, 2, count_rows=True)


@query(
    "employer_top_keywords_all",
    f'{DOCUMENT_GOLD_SQL}, {_ADS_SQL} SELECT employer_id, rank, "count", id, keyword FROM ranked WHERE rank <= 10',
)
def employer_top_keywords_all(spark, sf_dir):
    keywords, bridge, ads = _employer_keywords(spark, sf_dir)
    return employer_keywords_all(ads, bridge, keywords)


# --- the whole flow and the export shape --------------------------------------

_PART_COUNTS_SQL = f"""{_PART_KEPT_SQL}
    SELECT 'keywords' AS "table", count(*) AS rows FROM keywords
    UNION ALL SELECT 'employers', count(*) FROM employers
    UNION ALL SELECT 'stillingsfunksjon', count(*) FROM functions
    UNION ALL SELECT 'ads_with_id', count(*) FROM wide
    UNION ALL SELECT 'ngrams', count(*) FROM grams
    UNION ALL SELECT 'keyword_ads_bridge', count(*) FROM keyword_bridge
    UNION ALL SELECT 'stillingsfunksjon_ads_bridge', count(*) FROM function_bridge"""


@query("gold_tables", _PART_COUNTS_SQL)
def gold_tables(spark, sf_dir):
    return gold_counts(build_gold(part_metadata(spark, sf_dir), part_content(spark, sf_dir), stopwords(spark)))


@query(
    "export_relational",
    f"""{PART_GOLD_SQL}
        SELECT ad_id, heading, job_title, CAST(employer_id AS INTEGER) AS employer_id,
               CAST(no_of_positions AS INTEGER) AS no_of_positions, article_header, article_content,
               keyword_bridge_id, stillingsfunksjon_bridge_id, CAST(NULL AS VARCHAR) AS canonical_url,
               CAST(NULL AS VARCHAR) AS location, CAST(NULL AS TIMESTAMP) AS published,
               CAST(NULL AS TIMESTAMP) AS "timestamp", CAST(NULL AS VARCHAR) AS job_type
        FROM wide""",
)
def export_relational(spark, sf_dir):
    """Every export table is checked and shaped; the wide one is returned."""
    gold = build_gold(part_metadata(spark, sf_dir), part_content(spark, sf_dir), stopwords(spark))
    frames = {table: export_frame(gold.exports()[table], table) for table in EXPORT_TABLES}
    return frames["ads_with_id"].withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("published", "timestamp")}
    )


# --- every export, from stored bronze tables ---------------------------------------

_EXPORT_GOLD_SQL = _PART_KEPT_SQL.replace(
    "FROM part)",
    """FROM part),
    dated AS (SELECT *, TIMESTAMP '2024-01-01' + to_days(CAST(CAST(ad_id AS BIGINT) % 300 AS INTEGER)) AS seen FROM ads)""",
    1,
)

_EXPORT_SQL = {
    "keywords": "SELECT CAST(id AS INTEGER) AS id, keyword FROM keywords",
    "employers": "SELECT CAST(id AS INTEGER) AS id, company_name, bransje, sektor FROM employers",
    "stillingsfunksjon": "SELECT CAST(id AS INTEGER) AS id, stillingsfunksjon FROM functions",
    "ads_with_id": """SELECT w.ad_id, 'https://ads.example/' || w.ad_id AS canonical_url, heading, CAST(NULL AS VARCHAR) AS location, job_title,
        CAST(employer_id AS INTEGER) AS employer_id, CAST(no_of_positions AS INTEGER) AS no_of_positions, seen AS published,
        article_header, article_content, keyword_bridge_id, seen + INTERVAL 1 HOUR AS "timestamp", 'fulltime' AS job_type,
        stillingsfunksjon_bridge_id
        FROM wide w JOIN (SELECT ad_id, seen FROM dated) d ON w.ad_id = d.ad_id""",
    "ngrams": """SELECT row_number() OVER (ORDER BY words, ngram_size, g.ad_id) AS id, words, ngram_size, g.ad_id,
        CAST(NULL AS VARCHAR) AS keyword_bridge_id, CAST(NULL AS VARCHAR) AS stillingsfunksjon_bridge_id,
        CAST(e.id AS INTEGER) AS employer_id
        FROM grams g JOIN ads a ON g.ad_id = a.ad_id LEFT JOIN employers e ON a.company_name = e.company_name""",
    "keyword_ads_bridge": "SELECT id, ad_id, CAST(keyword_id AS INTEGER) AS keyword_id FROM keyword_bridge",
    "stillingsfunksjon_ads_bridge": "SELECT id, ad_id, CAST(stillingsfunksjon_id AS INTEGER) AS stillingsfunksjon_id FROM function_bridge",
}


def _bronze_of_parts(spark: SparkSession, sf_dir: str) -> str:
    """Both bronze tables of the job category, by month, as ingestion leaves them."""
    root = fresh_path(spark, "bronze")
    seen = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("id") % 300)
    months = {"y": F.year("timestamp"), "m": F.month("timestamp")}
    metadata = part_metadata(spark, sf_dir).withColumns(
        {"timestamp": seen, "canonical_url": F.concat(F.lit("https://ads.example/"), "id")}
    )
    append_partitioned(metadata.withColumns(months), f"{root}/job_fulltime/ad_metadata")
    named = ("sektor", "bransje", "stillingsfunksjon")
    content = part_content(spark, sf_dir).withColumns(
        {
            "timestamp": seen + F.make_dt_interval(hours=F.lit(1)),
            "job_type": F.lit("fulltime"),
            "attributes": F.create_map(*(x for n in named for x in (F.lit(n), F.col(n)))),
        }
    )
    content = content.drop(*named).withColumn("id", F.col("id").cast("string"))
    append_partitioned(content.withColumns(months), f"{root}/job_fulltime/ad_content")
    return root


def _register_export(table: str) -> None:
    @query(f"exports_{table}", f"{_EXPORT_GOLD_SQL} {_EXPORT_SQL[table]}")
    def export(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = gold_from_bronze(spark, _bronze_of_parts(spark, sf_dir), stopwords(spark), (2024, 1), (2024, 12))
        frame = export_frame(gold.exports()[table], table)
        times = {c: F.col(c).cast("timestamp_ntz") for c, kind in frame.dtypes if kind == "timestamp"}
        return frame.withColumns(times) if times else frame


for _table in EXPORT_TABLES:
    _register_export(_table)
