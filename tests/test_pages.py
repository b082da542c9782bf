"""Page markup, the two layouts, deduplication, the content stream."""

import pytest
from pyspark.sql import functions as F

from adloom.functions.markup import Page
from adloom.operators.dedupe import dedupe_html, dedupe_urls, latest_row, merge_rows
from adloom.operators.pages import (
    accepted,
    article_record,
    extract_content,
    list_items,
    main_subtree,
    quarantined,
    subtree_text,
    with_job_type,
)
from adloom.plans.bronze import ingest_content, pages_to_fetch
from adloom.sources.readers import source_path

LAYOUT_A = """<html><body><main><section aria-label="Jobbdetaljer"><section><p>share</p></section>
<section><h2>Title</h2><p>Employer</p><ul><li>Frist <span>1.1.</span></li><li>Ansettelsesform <span>Fast</span> stilling</li><li>Sted: <b>Oslo</b></li></ul></section>
<section>body&nbsp;text <p> x </p><script>no()</script><p>y&amp;z</p></section>
<section><p>About us</p><ul><li><span>Sektor:</span> <a>Privat</a></li><li></li></ul></section>{keywords}</section></main></body></html>"""
LAYOUT_B = """<main><div>nav</div><div><div><h1>Ti&nbsp;tle</h1><dl><dt>Frist</dt><dd>1.1.</dd><dt>Alone</dt></dl></div>
<section>body<p>more</p></section><div><dl><dt> Sektor </dt><dd>Offentlig</dd></dl></div></div></main>"""


def test_layout_a():
    record = article_record(LAYOUT_A.format(keywords="<section><p>kw1, kw2</p></section>"), "fulltime")
    assert record["article_header"] == "Title"
    assert record["attributes"] == {"arbeidsgiver": "Employer", "frist": "1.1.", "ansettelsesform": "Fast", "sted:": "Oslo", "sektor": "Privat"}
    assert record["article_content"] == "bodytext|x|y&z"
    assert record["about_section_content"] == "About us|Sektor:|Privat"
    assert record["keywords"] == "kw1, kw2" and record["section_count"] == 5


@pytest.mark.parametrize("keywords, count", [("", 4), ("<section>none</section>", 5)])
def test_layout_a_without_keywords(keywords, count):
    record = article_record(LAYOUT_A.format(keywords=keywords), "management")
    assert record["keywords"] is None and record["section_count"] == count


def test_layout_b():
    record = article_record(LAYOUT_B, "positions")
    assert record["article_header"] == "Title" and record["article_content"] == "body|more"
    assert record["attributes"] == {"frist": "1.1.", "sektor": "Offentlig"}
    assert record.get("about_section_content") is None and record.get("keywords") is None


@pytest.mark.parametrize(
    "html, job_type, reason",
    [
        (LAYOUT_B, "fulltime", "no article section"),
        (LAYOUT_B, "hobby", "unsupported job type: hobby"),
        ("<p>x", "positions", "no main"),
        ("<main><div></div></main>", "positions", "1 blocks"),
        (None, "fulltime", "no html"),
        ("<section aria-label='Jobbdetaljer'><section>", "parttime", "1 sections"),
        ("", None, "unsupported job type: None"),
    ],
)
def test_pages_that_do_not_fit(html, job_type, reason):
    assert article_record(html, job_type) == {"error": reason}


def test_broken_markup_and_main():
    page = Page("<main class=a><p>one<br>two</i><div>three<!-- c -->four</main><p>after</p>")
    main = page.first(page.root, "main")
    assert page.joined(main) == "one|two|three|four"
    assert page.markup(main) == '<main class="a"><p>one<br/>two<div>three<!-- c -->four</div></p></main>'
    page = Page("<main><script>if (a < b) {}</script>1 &lt; 2</main>")
    assert page.markup(page.root.kids[0]) == "<main><script>if (a < b) {}</script>1 &lt; 2</main>"


def test_page_columns(spark):
    df = spark.createDataFrame(
        [(1, "<main><ul><li><b>Key:</b> <i>v</i></li></ul></main>"), (2, "<p>no</p>"), (3, None)], "id int, html string"
    )
    out = list_items(subtree_text(main_subtree(df)))
    found = {r.id: (r.html_main, r.text, r.attributes) for r in out.collect()}
    assert found == {
        1: ("<main><ul><li><b>Key:</b> <i>v</i></li></ul></main>", "Key:|v", {"key": "v"}),
        2: (None, None, None),
        3: (None, None, None),
    }


def test_extract_routes_bad_rows_aside(spark):
    df = spark.createDataFrame(
        [
            ("1", "https://h/job/fulltime/a", LAYOUT_A.format(keywords="")),
            ("2", "https://h/job/positions/a", LAYOUT_B),
            ("3", "https://h/job/hobby/a", LAYOUT_B),
            ("4", "https://h/job", LAYOUT_B),
            ("5", "https://h/job/fulltime/a", None),
        ],
        "id string, canonical_url string, html_main string",
    )
    out = extract_content(with_job_type(df)).cache()
    assert sorted(r.id for r in accepted(out).collect()) == ["1", "2"]
    assert {r.id: r.error for r in quarantined(out).collect()} == {
        "3": "unsupported job type: hobby", "4": "unsupported job type: None", "5": "no html",
    }
    assert "_debug_article_section-counts" in out.columns


def test_pages_are_parsed_once(spark):
    """A filter on the outcome must not add a second parse."""
    df = spark.createDataFrame([("1", "u", "x", "hobby")], "id string, canonical_url string, html_main string, job_type string")
    plan = accepted(extract_content(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_dedupe_rules(spark, rows):
    html = spark.createDataFrame(
        [("h", "1", 5), ("h", "1", 3), ("g", "1", 4), (None, "1", 1), ("h", None, 1)], "html_main string, id string, t int"
    ).withColumn("ingestion_ts", F.timestamp_seconds("t")).drop("t")
    out = dedupe_html(html).withColumn("ingestion_ts", F.unix_seconds("ingestion_ts"))
    assert rows(out) == [("g", "1", 4), ("h", "1", 3)]
    urls = spark.createDataFrame(
        [("1", 9, "u", None, 1), ("1", 7, "u", "b", 3), ("1", 8, "u", "a", 2), ("1", 1, "v", None, 5), (None, 1, "u", "a", 1)],
        "id string, timestamp bigint, canonical_url string, occupation string, t int",
    ).withColumn("ingeston_ts", F.timestamp_seconds("t")).drop("t")
    out = dedupe_urls(urls).withColumn("ingeston_ts_url", F.unix_seconds("ingeston_ts_url"))
    assert rows(out) == [("1", "u", 7, "a", 1), ("1", "v", 1, None, 5)]


def test_latest_and_merged_rows(spark, rows):
    df = spark.createDataFrame(
        [("1", 1, "a", None), ("1", 2, None, "x"), ("1", 2, None, "w"), ("2", None, "c", "z"), (None, 1, "n", "n")],
        "k string, t int, p string, q string",
    )
    assert rows(latest_row(df, ["k"], ["t"])) == [("1", 2, None, "x"), ("2", None, "c", "z"), (None, 1, "n", "n")]
    assert rows(merge_rows(df, ["k"], ["t"])) == [("1", 2, "a", "x"), ("2", None, "c", "z"), (None, 1, "n", "n")]
    with_map = df.withColumn("m", F.create_map(F.lit("a"), F.col("p")))
    assert {r.k: r.q for r in latest_row(with_map, ["k"], ["t"]).collect()} == {"1": "x", "2": "z", None: "n"}


def test_content_run_end_to_end(spark, tmp_path):
    landing, bronze, checkpoints = (str(tmp_path / d) for d in ("landing", "bronze", "cp"))
    urls = [
        ("1", 1735689600000, "https://h/job/fulltime/1", "0.1"),
        ("1", 1735689600000, "https://h/job/fulltime/1", None),
        ("2", 1738368000000, "https://h/job/positions/2", "0.1"),
        ("3", 1, "https://h/job/hobby/3", "0.1"),
        ("9", 1, "https://h/job/fulltime/9", "0.1"),
    ]
    spark.createDataFrame(urls, "id string, timestamp bigint, canonical_url string, occupation string").withColumn(
        "ingeston_ts", F.current_timestamp()
    ).write.parquet(source_path(landing, "ad_urls", "job_fulltime"))
    assert sorted(r.id for r in pages_to_fetch(spark, landing).collect()) == ["1", "2", "3", "9"]

    def store(pages):
        spark.createDataFrame(pages, "html_main string, id string").withColumn(
            "ingestion_ts", F.current_timestamp()
        ).write.mode("append").parquet(source_path(landing, "ad_html", "job_fulltime"))

    page = LAYOUT_A.format(keywords="")
    store([(page, "1"), (page, "1"), (page.replace("Title", "New"), "1"), (LAYOUT_B, "3")])
    target, rejected = ingest_content(spark, landing, bronze, checkpoint_root=checkpoints)
    store([(LAYOUT_B, "2")])
    for _ in range(2):
        ingest_content(spark, landing, bronze, checkpoint_root=checkpoints)
    out = spark.read.parquet(target)
    assert sorted((r.id, r.article_header, r.y, r.m) for r in out.collect()) == [
        ("1", "New", 2025, 1), ("1", "Title", 2025, 1), ("2", "Title", 2025, 2),
    ]
    assert [r.id for r in spark.read.parquet(rejected).collect()] == ["3"]
    assert [r.id for r in pages_to_fetch(spark, landing).collect()] == ["9"]
