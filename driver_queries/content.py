"""Crawl frontier, deduplication and page extraction."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.text import drop_nbsp, label_key, replace_nul
from adloom.operators.dedupe import dedupe_html, dedupe_urls
from adloom.operators.pages import (
    accepted,
    extract_content,
    list_items,
    main_subtree,
    parse_errors,
    quarantined,
    subtree_text,
    with_ad_type,
    with_job_type,
)
from adloom.operators.tokens import union_all
from adloom.plans.bronze import OCCUPATIONS, ingest_content, land_fetched_pages, land_search_pages, pages_to_fetch
from adloom.schemas import AD_HTML_DDL
from adloom.sinks.writers import append_parquet
from adloom.sources.readers import read_or_empty, source_path
from adloom.storage import fresh_path
from adloom.streaming.incremental import crawl_frontier, read_rejected_content
from driver_queries.registry import load, load_spread, query

# --- URLs and stored pages: every page is listed twice and stored twice --------


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("id"), F.col("url").alias("canonical_url"), "page_id"
    )
    listed = pages.withColumns({"timestamp": F.col("page_id") + 500, "occupation": F.lit(None).cast("string")})
    again = pages.withColumns({"timestamp": F.col("page_id") + 100, "occupation": F.concat(F.lit("0."), "page_id")})
    both = union_all([listed.withColumn("round", F.lit(1)), again.withColumn("round", F.lit(2))])
    return both.select(
        "id", "timestamp", "canonical_url", "occupation", F.timestamp_seconds("round").alias("ingeston_ts")
    )


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_spread(spark, sf_dir, "pages", "page_id")
    rounds = [
        pages.select(
            F.col("html").alias("html_main"),
            F.col("page_id").cast("string").alias("id"),
            F.timestamp_seconds(F.lit(n)).alias("ingestion_ts"),
        )
        for n in (2, 1)
    ]
    missing = rounds[0].withColumn("html_main", F.lit(None).cast("string"))
    return union_all([*rounds, missing])


@query(
    "dedupe_urls",
    """SELECT CAST(page_id AS VARCHAR) AS id, url AS canonical_url, page_id + 100 AS "timestamp",
              '0.' || page_id AS occupation, 1 AS seen FROM pages""",
)
def dedupe_urls_query(spark, sf_dir):
    urls = dedupe_urls(_urls(spark, sf_dir))
    return urls.withColumn("seen", F.unix_seconds("ingeston_ts_url").cast("int")).drop("ingeston_ts_url")


@query(
    "dedupe_html",
    """SELECT CAST(page_id AS VARCHAR) AS id, replace(html, 'a', chr(65533)) AS html_main, 1 AS seen FROM pages""",
)
def dedupe_html_query(spark, sf_dir):
    """With NUL bytes in the stored pages, replaced on the way."""
    stored = _html(spark, sf_dir).withColumn("html_main", F.replace("html_main", F.lit("a"), F.lit("\u0000")))
    cleaned = stored.withColumn("html_main", replace_nul(F.col("html_main")))
    return dedupe_html(cleaned).select("id", "html_main", F.unix_seconds("ingestion_ts").cast("int").alias("seen"))


_SEGMENT_SQL = r"""string_split(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/')[3]"""


@query(
    "urls_join_html",
    f"""SELECT CAST(page_id AS VARCHAR) AS id, url AS canonical_url, length(html) AS n, {_SEGMENT_SQL} AS job_type,
               CASE WHEN contains(url, 'position') THEN 'position' ELSE 'other' END AS ad_type
        FROM pages""",
)
def urls_join_html(spark, sf_dir):
    joined = dedupe_urls(_urls(spark, sf_dir)).join(dedupe_html(_html(spark, sf_dir)), "id")
    typed = with_ad_type(with_job_type(joined))
    return typed.select("id", "canonical_url", F.length("html_main").cast("bigint").alias("n"), "job_type", "ad_type")


@query(
    "crawl_frontier",
    "SELECT CAST(page_id AS VARCHAR) AS id, url AS canonical_url FROM pages WHERE url NOT LIKE '%/en/%'",
)
def crawl_frontier_query(spark, sf_dir):
    stored = _html(spark, sf_dir).join(
        _urls(spark, sf_dir).where("canonical_url like '%/en/%'").select("id").distinct(), "id", "left_semi"
    )
    return crawl_frontier(_urls(spark, sf_dir), stored)


@query("missing_source_empty", "SELECT CAST(page_id AS VARCHAR) AS id, url AS canonical_url FROM pages")
def missing_source_empty(spark, sf_dir):
    """First run: nothing is stored, so every page is on the frontier."""
    stored = read_or_empty(spark, fresh_path(spark, "nothing-here"), AD_HTML_DDL)
    return crawl_frontier(_urls(spark, sf_dir), stored)


# --- markup of the raw pages ---------------------------------------------------

_UNESCAPE = "replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


@query(
    "html_text",
    f"""SELECT page_id, {_UNESCAPE.format("trim(regexp_extract(html, '<h1>(.*?)</h1>', 1))")} AS heading,
               {_UNESCAPE.format("trim(regexp_extract(html, '<title>(.*?)</title>', 1))")} AS title
        FROM pages""",
)
def html_text(spark, sf_dir):
    pages = load_spread(spark, sf_dir, "pages", "page_id")
    titled = subtree_text(subtree_text(pages, tag="h1", out="heading"), tag="title", out="title")
    return titled.select("page_id", "heading", "title")


_LINK_SQL = r"""regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1), '(?s)<li><a[^>]*>(.*?)</a>', 1)"""


@query(
    "html_list_attributes",
    rf"""WITH items AS (SELECT page_id, unnest({_LINK_SQL}) AS item FROM pages)
         SELECT DISTINCT page_id, lower(trim(replace({_UNESCAPE.format('item')}, ':', ''))) AS label FROM items""",
)
def html_list_attributes(spark, sf_dir):
    listed = list_items(load_spread(spark, sf_dir, "pages", "page_id"))
    return listed.select("page_id", F.explode(F.map_keys("attributes")).alias("label")).distinct()


@query(
    "label_cleanup",
    "SELECT page_id, lower(trim(replace(replace(url, ':', ''), chr(160), ''))) AS label FROM pages",
)
def label_cleanup(spark, sf_dir):
    noisy = F.concat(F.lit("\u00a0 "), "url", F.lit(": \u00a0"))
    return load(spark, sf_dir, "pages").select("page_id", label_key(drop_nbsp(noisy)).alias("label"))


# --- ad pages built from whole documents ----------------------------------------
# English and French texts become article pages, German ones position pages,
# Spanish ones carry a job type the extractor does not know.


# A page is a template whose fields are columns; the SQL renders the same text.
_ARTICLE = (
    '<main><h1>Site</h1><section aria-label="Jobbdetaljer"><section><p>share</p></section><section><h2>{title}</h2>'
    "<p>{source}</p><ul><li>Frist <span>{n_chars}</span></li></ul></section><section><p>{paragraphs}</p><!-- end -->"
    "</section><section><ul><li><b>Sektor:</b> <a>{lang}</a></li></ul></section><section><p>{source}, {lang}</p>"
    "</section></section></main>"
)
_POSITION = (
    "<main><div>menu</div><div><div><h1>{title}</h1><dl><dt>Frist</dt><dd>{n_chars}</dd></dl></div><section>"
    "<p>{paragraphs}</p></section><div><dl><dt>Sektor</dt><dd>{lang}</dd><dt>surplus</dt></dl></div></div></main>"
)


def _render(template: str, fields: dict[str, Column]) -> Column:
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[fields[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def _render_sql(template: str) -> str:
    pieces = re.split(r"\{(\w+)\}", template)
    return " || ".join(f"CAST({p} AS VARCHAR)" if i % 2 else f"'{p}'" for i, p in enumerate(pieces))


def _ad_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_spread(spark, sf_dir, "documents", "doc_id")
    escaped = F.col("text")
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "</p>\n<p>")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(entity))
    fields = {c: F.col(c) for c in ("source", "lang", "n_chars")}
    fields |= {"title": F.concat(F.lit("Ad&nbsp;"), "doc_id"), "paragraphs": escaped}
    job_type = (
        F.when(F.col("lang") == "en", "fulltime").when(F.col("lang") == "fr", "parttime")
        .when(F.col("lang") == "de", "positions").otherwise("hobby")
    )
    page = F.when(F.col("lang") == "de", _render(_POSITION, fields)).otherwise(_render(_ARTICLE, fields))
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("https://ads.example/job/"), job_type, F.lit("/ad?id="), "doc_id").alias("canonical_url"),
        page.alias("html_main"),
        F.col("source").alias("occupation"),
        (F.col("n_chars") * 86_400_000).alias("timestamp"),
    )


@query(
    "html_main_subtree",
    f"""WITH d AS (
            SELECT doc_id, lang, source, n_chars, 'Ad' || chr(160) || doc_id AS title,
                   replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10),
                           '</p>' || chr(10) || '<p>') AS paragraphs
            FROM documents)
        SELECT CAST(doc_id AS VARCHAR) AS id,
               CASE WHEN lang = 'de' THEN {_render_sql(_POSITION)} ELSE {_render_sql(_ARTICLE)} END AS html_main,
               CAST(NULL AS VARCHAR) AS absent
        FROM d""",
)
def html_main_subtree(spark, sf_dir):
    """The main part of a whole page; a tag that the page lacks gives NULL."""
    whole = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>t</title></head><body><nav>n</nav>"),
        "html_main",
        F.lit("<footer>f</footer></body></html>"),
    )
    pages = _ad_pages(spark, sf_dir).select("id", whole.alias("html"))
    return main_subtree(main_subtree(pages), tag="aside", out="absent").drop("html")


_LAYOUT_SQL = r"""
    SELECT CAST(doc_id AS VARCHAR) AS id,
           CASE lang WHEN 'en' THEN 'fulltime' WHEN 'fr' THEN 'parttime' WHEN 'de' THEN 'positions' ELSE 'hobby' END
               AS job_type,
           lang <> 'es' AS fits, lang, source, n_chars,
           array_to_string(list_filter(list_transform(string_split(text, chr(10)),
               lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), '|') AS body
    FROM documents"""


@query(
    "html_layouts",
    rf"""WITH d AS ({_LAYOUT_SQL})
         SELECT id, job_type,
                CASE WHEN lang = 'de' THEN 'Ad' || id WHEN fits THEN 'Ad' || chr(160) || id END AS article_header,
                CASE WHEN fits THEN body END AS article_content,
                CASE WHEN lang IN ('en', 'fr') THEN 'Sektor:|' || lang END AS about_section_content,
                CASE WHEN lang IN ('en', 'fr') THEN source || ', ' || lang END AS keywords,
                CASE WHEN fits THEN CAST(n_chars AS VARCHAR) END AS frist,
                CASE WHEN fits THEN lang END AS sektor,
                CASE WHEN lang IN ('en', 'fr') THEN source END AS arbeidsgiver,
                CASE WHEN lang IN ('en', 'fr') THEN 5 END AS sections,
                CASE WHEN NOT fits THEN 'unsupported job type: hobby' END AS error
         FROM d""",
)
def html_layouts(spark, sf_dir):
    parsed = extract_content(with_job_type(_ad_pages(spark, sf_dir)))
    attribute = {k: F.try_element_at("attributes", F.lit(k)) for k in ("frist", "sektor", "arbeidsgiver")}
    return parsed.withColumns(attribute).select(
        "id", "job_type", "article_header", "article_content", "about_section_content", "keywords", *attribute,
        F.col("`_debug_article_section-counts`").alias("sections"), "error",
    )


@query(
    "quarantine",
    f"""WITH d AS ({_LAYOUT_SQL}) SELECT 'accepted' AS outcome, count(*) AS n FROM d WHERE fits
        UNION ALL SELECT 'rejected', count(*) FROM d WHERE NOT fits""",
)
def quarantine(spark, sf_dir):
    parsed = extract_content(with_job_type(_ad_pages(spark, sf_dir)))
    counts = [
        rows.agg(F.lit(name).alias("outcome"), F.count(F.lit(1)).alias("n"))
        for name, rows in (("accepted", accepted(parsed)), ("rejected", quarantined(parsed)))
    ]
    return union_all(counts)


_MS_DAY = "TIMESTAMP '1970-01-01' + to_days(CAST(n_chars AS INTEGER))"


_CONTENT_SQL = f"""WITH d AS ({_LAYOUT_SQL})
        SELECT id, job_type, length(body) AS n, CAST(year({_MS_DAY}) AS INTEGER) AS y,
               CAST(month({_MS_DAY}) AS INTEGER) AS m, {{occupation}} AS occupation, '' AS error FROM d WHERE fits
        UNION ALL
        SELECT id, job_type, NULL, NULL, NULL, NULL, 'unsupported job type: hobby' FROM d WHERE NOT fits"""


def _content(spark: SparkSession, target: str, rejected: str) -> DataFrame:
    good = spark.read.parquet(target).select(
        "id", "job_type", F.length("article_content").cast("bigint").alias("n"), "y", "m", "occupation", F.lit("").alias("error")
    )
    return union_all([good, read_rejected_content(spark, rejected).select("id", "job_type", "error")])


def _listed(pages: DataFrame) -> DataFrame:
    return pages.select("id", "timestamp", "canonical_url", "occupation", F.current_timestamp().alias("ingeston_ts"))


def _stored(pages: DataFrame) -> DataFrame:
    return pages.select("html_main", "id", F.current_timestamp().alias("ingestion_ts"))


@query("incremental_content", _CONTENT_SQL.format(occupation="source"))
def incremental_content(spark, sf_dir):
    """Three arrivals, the last of them twice, then a run with nothing new; every URL is
    listed twice. The number of files per batch changes nothing."""
    root = fresh_path(spark, "content")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    pages = _ad_pages(spark, sf_dir)
    append_parquet(_listed(pages).union(_listed(pages)), source_path(landing, "ad_urls", "job_fulltime"))
    arrivals = ("length(html_main) < 1000", "length(html_main) between 1000 and 3000", "length(html_main) > 3000")
    for files_per_batch, arrival in zip((5, None, None, None), (*arrivals, arrivals[-1]), strict=True):
        append_parquet(_stored(pages.where(arrival)), source_path(landing, "ad_html", "job_fulltime"))
        ingest_content(spark, landing, bronze, files_per_batch=files_per_batch)
    target, rejected = ingest_content(spark, landing, bronze)
    assert pages_to_fetch(spark, landing).isEmpty()
    return _content(spark, target, rejected)


@query("content_lost_checkpoint", _CONTENT_SQL.format(occupation="source"))
def content_lost_checkpoint(spark, sf_dir):
    """The second run starts without the progress of the first: nothing is lost or doubled."""
    root = fresh_path(spark, "content")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    pages = _ad_pages(spark, sf_dir)
    append_parquet(_listed(pages), source_path(landing, "ad_urls", "job_fulltime"))
    for run, arrival in enumerate(("length(html_main) < 2000", "length(html_main) >= 2000")):
        append_parquet(_stored(pages.where(arrival)), source_path(landing, "ad_html", "job_fulltime"))
        target, rejected = ingest_content(spark, landing, bronze, checkpoint_root=f"{root}/progress-{run}")
    return _content(spark, target, rejected)


@query("content_waiting", _CONTENT_SQL.format(occupation="source"))
def content_waiting(spark, sf_dir):
    """All pages land with half of the URLs; the others arrive one run later."""
    root = fresh_path(spark, "content")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    pages = _ad_pages(spark, sf_dir)
    append_parquet(_stored(pages), source_path(landing, "ad_html", "job_fulltime"))
    for arrival in ("length(html_main) < 2000", "length(html_main) >= 2000"):
        append_parquet(_listed(pages.where(arrival)), source_path(landing, "ad_urls", "job_fulltime"))
        target, rejected = ingest_content(spark, landing, bronze)
    return _content(spark, target, rejected)


@query("content_second_url", f"SELECT q.* FROM ({_CONTENT_SQL.format(occupation='source')}) q, range(2)")
def content_second_url(spark, sf_dir):
    """Every ad gets a second URL one run after its page was stored."""
    root = fresh_path(spark, "content")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    pages = _ad_pages(spark, sf_dir)
    append_parquet(_stored(pages), source_path(landing, "ad_html", "job_fulltime"))
    for end in ("", "?second"):
        listed = _listed(pages).withColumn("canonical_url", F.concat("canonical_url", F.lit(end)))
        append_parquet(listed, source_path(landing, "ad_urls", "job_fulltime"))
        target, rejected = ingest_content(spark, landing, bronze)
    return _content(spark, target, rejected)


_OCCUPATION_CASE = "CASE CAST(id AS BIGINT) % 5 " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(OCCUPATIONS)) + " END"


@query("ads_flow", _CONTENT_SQL.format(occupation=_OCCUPATION_CASE))
def ads_flow(spark, sf_dir):
    """Landed search pages to the URL table, fetched pages to the page table, both to
    content. Every page is searched and landed; a fetch is due for each ad."""
    root = fresh_path(spark, "flow")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    ads = _ad_pages(spark, sf_dir).withColumn("occupation", F.expr(_OCCUPATION_CASE))
    search = ads.select(
        F.array(F.struct("id", "timestamp", "canonical_url")).alias("docs"),
        (F.col("id").cast("bigint") % 120 + 1).cast("int").alias("page"),
        F.lit(120).alias("last"),
        "occupation",
    )
    land_search_pages(search, landing)
    due = pages_to_fetch(spark, landing)
    whole = F.concat(F.lit("<html><body><nav>n</nav>"), "html_main", F.lit("<footer>f</footer></body></html>"))
    land_fetched_pages(ads.join(due.select("id"), "id", "left_semi").select("id", whole.alias("html")), landing)
    return _content(spark, *ingest_content(spark, landing, bronze))


@query(
    "page_parse_errors",
    """SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'unreadable page: AssertionError' END AS parse_error,
              page_id % 7 = 0 AS no_main FROM pages""",
)
def page_parse_errors(spark, sf_dir):
    """Pages that the parser refuses cost their own values only."""
    broken = F.when(F.col("page_id") % 7 == 0, F.lit("<main><![x[y]]></main>")).otherwise(F.lit("<main>m</main>"))
    pages = load_spread(spark, sf_dir, "pages", "page_id").select("page_id", F.concat(broken, "html").alias("html"))
    parsed = main_subtree(parse_errors(pages))
    return parsed.select("page_id", "parse_error", F.col("html_main").isNull().alias("no_main"))
