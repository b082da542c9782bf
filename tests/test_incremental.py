"""Runs that must lose and repeat nothing, and records that must be seen."""

import gzip
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from adloom.operators import tokens
from adloom.operators.flatten import distinct_keys
from adloom.operators.joins import heavy_keys, salted_join
from adloom.operators.pages import article_record, list_items, main_subtree, parse_errors, subtree_text
from adloom.operators.quality import QualityError
from adloom.plans.bronze import land_fetched_pages
from adloom.sinks.writers import export_frame, key_statements, write_csv
from adloom.sources import readers as R
from adloom.storage import shared_folder
from adloom.streaming import stored
from adloom.streaming.incremental import (
    read_rejected_content,
    read_rejected_payloads,
    rows_after,
    run_content,
    run_metadata,
)

PAGE = (
    '<main><section aria-label="Jobbdetaljer"><section></section><section><h2>Title</h2><p>E</p><ul><li>F <span>1</span></li></ul>'
    "</section><section>body</section><section><ul><li><b>S:</b><a>P</a></li></ul></section></section></main>"
)


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, text, days_old=0):
        (folder / name).write_text(text if isinstance(text, str) else json.dumps(text))
        if days_old:
            when = os.stat(folder / name).st_mtime - days_old * 86_400
            os.utime(folder / name, (when, when))

    land.path = str(folder)
    return land


def docs(*numbers):
    return {"docs": [{"id": str(n), "timestamp": 1_700_000_000_000} for n in numbers]}


def test_late_files_and_lost_progress(spark, landing, tmp_path):
    target = str(tmp_path / "bronze")
    landing("a.json", docs(1))
    run_metadata(spark, landing.path, target, None, "car_used")
    landing("b.json", docs(2), days_old=400)
    run_metadata(spark, landing.path, target, None, "car_used")
    assert ids(spark, target) == [1, 2]
    landing("c.json", docs(3))
    run_metadata(spark, landing.path, target, str(tmp_path / "new-progress"), "car_used", files_per_batch=1)
    assert ids(spark, target) == [1, 2, 3]
    second = str(tmp_path / "second")
    run_metadata(spark, landing.path, second, None, "car_used")
    assert ids(spark, second) == [1, 2, 3]


def test_bad_payloads_are_seen(spark, landing, tmp_path):
    target = str(tmp_path / "bronze")
    assert read_rejected_payloads(spark, target).count() == 0
    landing("pretty.json", json.dumps(docs(1, 2), indent=2))
    landing("lines.json", json.dumps(docs(3)) + "\n" + json.dumps(docs(4)) + "\n\n{\"docs\": [{\"id\": 5\n")
    landing("cut.json", json.dumps(docs(6))[:25])
    landing("empty.json", " \n")
    landing("none.json", {"docs": []})
    run_metadata(spark, landing.path, target, None, "car_used")
    run_metadata(spark, landing.path, target, None, "car_used")
    assert ids(spark, target) == [1, 2, 3, 4]
    bad = {(r.source_file.rsplit("/", 1)[1], r.error) for r in read_rejected_payloads(spark, target).collect()}
    assert bad == {("lines.json", "malformed JSON"), ("cut.json", "malformed JSON"), ("empty.json", "empty file")}
    assert R.rejected_payloads(spark, landing.path, "car_used").count() == 3


def test_undeclared_fields_stay(spark, landing, tmp_path):
    doc = {"id": "1", "timestamp": 1, "surprise": {"x": [1, 2]}, "price": {"amount": 5, "net": 4}, "mileage": 7}
    landing("a.json", {"docs": [doc, {"id": "2"}]})
    target = str(tmp_path / "bronze")
    run_metadata(spark, landing.path, target, None, "car_used")
    found = {r.id: r.other for r in spark.read.parquet(target).collect()}
    assert found[1]["price.net"] == "4" and json.loads(found[1]["surprise"]) == {"x": [1, 2]} and len(found[1]) == 2
    assert found[2] == {}


def test_half_a_commit_is_made_whole(spark, landing, tmp_path):
    """A driver lost while a batch commits: some month folders stand, others do not, and
    the progress does not know of the batch."""
    target = tmp_path / "bronze"
    months = [1_700_000_000_000 + 40 * 86_400_000 * k for k in range(3)]
    landing("a.json", {"docs": [{"id": str(k), "timestamp": t} for k, t in enumerate(months)]})
    landing("b.json", "\n".join(json.dumps({"docs": [{"id": str(10 + k), "timestamp": t}] * 2}) for k, t in enumerate(months)))
    everything = [0, 1, 2, 10, 10, 11, 11, 12, 12]
    run_metadata(spark, landing.path, str(target), None, "car_used")
    assert ids(spark, str(target)) == everything
    for lost in ([0, 1], [2], [0, 2]):
        folders = sorted(p for p in target.glob("y=*/m=*"))
        for k in lost:
            shutil.rmtree(folders[k])
        shutil.rmtree(f"{target}_progress")
        run_metadata(spark, landing.path, str(target), None, "car_used")
        assert ids(spark, str(target)) == everything
    # Without its filter a table is asked itself.
    shutil.rmtree(f"{target}_keys")
    shutil.rmtree(f"{target}_progress")
    run_metadata(spark, landing.path, str(target), None, "car_used")
    assert ids(spark, str(target)) == everything


def test_one_cut_line_costs_itself(spark, landing, tmp_path):
    cut = json.dumps(docs(1))[:-4]
    landing("lines.json", "\n".join([cut, json.dumps(docs(2)), "", json.dumps(docs(3, 4)), "[]", json.dumps(docs(5))]))
    landing("whole.json", json.dumps(docs(6), indent=1))
    target = str(tmp_path / "bronze")
    run_metadata(spark, landing.path, target, None, "car_used")
    rows = {(r.id, os.path.basename(r.source_file), r.source_line, r.source_doc) for r in spark.read.parquet(target).collect()}
    assert rows == {(2, "lines.json", 2, 0), (3, "lines.json", 4, 0), (4, "lines.json", 4, 1), (5, "lines.json", 6, 0), (6, "whole.json", 0, 0)}
    bad = {(r.source_line, r.record) for r in read_rejected_payloads(spark, target).collect()}
    assert bad == {(1, cut), (5, "[]")}
    assert sorted(d.id for r in R.read_payloads(spark, landing.path, "car_used").collect() for d in r.docs) == list("23456")


def test_lines_keep_their_number_however_files_are_cut(spark, landing, tmp_path):
    landing("big.json", "\n".join(json.dumps(docs(n)) if n % 7 else "" for n in range(4000)))
    landing("odd [1] %20 {a}.json", json.dumps(docs(9999), indent=1))
    found = []
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for cut in ("5000", size):
            spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
            scan = spark.read.text(landing.path)
            parsed = R.parse_landed(R.text_lines(scan), "car_used")
            found.append(sorted((r.source_line, r.docs[0].id) for r in parsed.where("error is null").collect()))
            tasks = R.text_lines(scan).rdd.getNumPartitions()
            assert (tasks > 20) == (cut == "5000")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found[0] == found[1] == [(0, "9999")] + [(n + 1, str(n)) for n in range(4000) if n % 7]


def test_the_lines_of_one_gzipped_file_are_parsed_by_many_tasks(spark, landing, monkeypatch):
    lines = "\n".join(json.dumps(docs(n)) if n % 7 else "[]" for n in range(2000))
    with gzip.open(f"{landing.path}/one.json.gz", "wt") as file:
        file.write(lines)
    tasks = []
    plain = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df, label: tasks.append((label, df.rdd.getNumPartitions())) or plain(df, label))
    parsed = R.parse_landed(R.text_lines(spark.read.text(landing.path)), "car_used")
    assert dict(tasks)["payloads"] == spark.sparkContext.defaultParallelism > 1
    found = {(r.source_line, r.docs[0].id if r.docs else r.record) for r in parsed.collect()}
    assert found == {(n + 1, str(n) if n % 7 else "[]") for n in range(2000)}


@pytest.mark.parametrize("small", ["all", "hashes", "none"])
def test_stored_keys_are_found_however_many_they_are(spark, tmp_path, monkeypatch, small):
    """Long keys that begin alike and NULL keys, with sides that fit all tasks or do not."""
    path = str(tmp_path / "t")
    text = F.when(F.col("id") % 10 > 0, F.concat(F.lit("file:///a/long/folder/"), F.col("id") % 10))
    rows = spark.range(400).select("id", text.alias("file"), (F.col("id") % 3).cast("int").alias("y"))
    keys = ["file", "id"]
    fits = stored.fits_broadcast
    chosen = {"all": fits, "hashes": lambda df: df.columns in (["_h"], ["word"]) and fits(df), "none": lambda df: False}
    monkeypatch.setattr(stored, "fits_broadcast", chosen[small])
    stored.append_new(rows.where("id < 250"), path, ("y",), keys)
    fresh = stored.unstored(rows, path, ("y",), keys)
    assert sorted(r.id for r in fresh.collect()) == list(range(250, 400))
    stored.append_new(rows, path, ("y",), keys)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(400))
    # Nothing is read again where nothing is new.
    again = stored.unstored(rows, path, ("y",), keys)
    assert again.isEmpty() and "Range" not in again._jdf.queryExecution().optimizedPlan().toString()
    assert stored.without(rows, rows.where("id >= 9").withColumn("id", F.col("id").cast("int")), keys).count() == 9


def test_new_keys_are_stored_without_reading_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(2000).select("id", (F.col("id") % 3).cast("int").alias("y"), F.lit(None).cast("int").alias("m"))
    read = []
    plain = stored.stored_table
    monkeypatch.setattr(stored, "stored_table", lambda spark, where: read.append(where) or plain(spark, where))
    stored.append_new(rows.where("id < 1000"), path, ("y", "m"), ["id"])
    read.clear()
    stored.append_new(rows.where("id >= 1000 and id < 1500"), path, ("y", "m"), ["id"])
    assert path not in read
    # Seen keys of one month: only that month is looked at, and nothing is stored twice.
    stored.append_new(rows.where("id >= 1500 or (id < 300 and y = 1)"), path, ("y", "m"), ["id"])
    assert path in read
    stored.merge_filter(spark, path)
    assert stored.unstored(rows, path, ("y", "m"), ["id"]).isEmpty()
    table = spark.read.parquet(path)
    assert table.count() == 2000 == table.select("id").distinct().count()


def test_a_batch_of_pages_does_not_read_the_target(spark, tmp_path, monkeypatch):
    landing, target, bad = (str(tmp_path / d) for d in ("html", "content", "bad"))
    store(spark, landing, [(PAGE.replace("Title", f"T{n}"), str(n)) for n in range(20)])
    run_content(spark, landing, url_table(spark, *range(20)), target, bad, None)
    read = []
    plain = stored.stored_table
    monkeypatch.setattr(stored, "stored_table", lambda spark, where: read.append(where) or plain(spark, where))
    store(spark, landing, [(PAGE.replace("Title", f"T{n}"), str(n)) for n in range(20, 40)])
    run_content(spark, landing, url_table(spark, *range(40)), target, bad, None)
    assert len(ids(spark, target)) == 40 and not {target, bad} & set(read)


def test_a_missing_landed_file_is_asked_for_again(spark, tmp_path):
    landing, target, bad = (str(tmp_path / d) for d in ("html", "content", "bad"))
    store(spark, landing, [(PAGE, "1"), (PAGE, "2")])
    run_content(spark, landing, url_table(spark, 1), target, bad, None)
    hidden = str(tmp_path / "elsewhere")
    os.rename(landing, hidden)
    os.mkdir(landing)
    run_content(spark, landing, url_table(spark, 1, 2), target, bad, None)
    assert ids(spark, target) == ["1"]
    os.rmdir(landing)
    os.rename(hidden, landing)
    run_content(spark, landing, url_table(spark, 1, 2), target, bad, None)
    assert ids(spark, target) == ["1", "2"]


def store(spark, path, pages):
    rows = spark.createDataFrame(pages, "html_main string, id string").withColumn("ingestion_ts", F.current_timestamp())
    rows.coalesce(1).write.mode("append").parquet(path)


def url_table(spark, *numbers):
    rows = [(str(n), 1_735_689_600_000, f"https://h/job/fulltime/{n}", "0.1") for n in numbers]
    df = spark.createDataFrame(rows, "id string, timestamp bigint, canonical_url string, occupation string")
    return df.withColumn("ingeston_ts", F.current_timestamp())


@pytest.mark.parametrize("files_per_batch", [1, 20])
def test_content_does_not_depend_on_batches(spark, tmp_path, files_per_batch):
    landing, target, bad = (str(tmp_path / d) for d in ("html", "content", "bad"))
    for _ in range(3):
        store(spark, landing, [(PAGE, "1"), (PAGE.replace("Title", "New"), "2")])
    run_content(spark, landing, url_table(spark, 1, 2), target, bad, None, files_per_batch)
    assert ids(spark, target) == ["1", "2"]
    assert read_rejected_content(spark, bad).count() == 0
    store(spark, landing, [(PAGE, "1"), ("<main>no layout</main>", "1")])
    for _ in range(2):
        run_content(spark, landing, url_table(spark, 1, 2), target, bad, str(tmp_path / "other-progress"), files_per_batch)
    assert ids(spark, target) == ["1", "2"]
    assert [r.error for r in read_rejected_content(spark, bad).collect()] == ["no article section"]


def test_pages_wait_for_their_url(spark, tmp_path):
    landing, target, bad = (str(tmp_path / d) for d in ("html", "content", "bad"))
    store(spark, landing, [(PAGE, "1"), (PAGE, "2")])
    run_content(spark, landing, url_table(spark, 1), target, bad, None)
    assert ids(spark, target) == ["1"] and ids(spark, f"{target}_waiting") == ["2"]
    for _ in range(2):
        run_content(spark, landing, url_table(spark, 1, 2), target, bad, None)
    assert ids(spark, target) == ["1", "2"]


def test_second_url_after_the_page(spark, tmp_path):
    landing, target, bad = (str(tmp_path / d) for d in ("html", "content", "bad"))
    store(spark, landing, [(PAGE, "1"), ("<main>no layout</main>", "2")])
    first = url_table(spark, 1, 2)
    second = first.union(first.withColumn("canonical_url", F.concat("canonical_url", F.lit("?second"))))
    for urls, times in ((first, 1), (second, 2), (second, 2)):
        run_content(spark, landing, urls, target, bad, None)
        assert ids(spark, target) == ["1"] * times and ids(spark, bad) == ["2"] * times
    assert spark.read.parquet(target).select("canonical_url").distinct().count() == 2


def test_refused_fetched_pages_are_kept(spark, tmp_path):
    landing = str(tmp_path)
    pages = [(1, f"<html>{PAGE}</html>"), (2, "<main><![x[y]]></main>"), (3, "<p>no main</p>"), (4, None)]
    fetched = spark.createDataFrame(pages, "id int, html string")
    for _ in range(2):
        land_fetched_pages(fetched, landing)
    table = R.source_path(landing, "ad_html", "job_fulltime")
    assert ids(spark, table) == sorted("1234" * 2)
    kept = sorted((r.id, r.error, r.html_main) for r in read_rejected_content(spark, f"{table}_rejected").collect())
    assert kept == [("2", "unreadable page: AssertionError", pages[1][1]), ("3", "no main part", pages[2][1]), ("4", "no page", None)]


def test_unreadable_pages_cost_themselves_only(spark):
    broken = "<main><![x[y]]></main>"
    assert article_record(broken, "fulltime") == {"error": "unreadable page: AssertionError"}
    df = spark.createDataFrame([(1, broken), (2, "<main>ok</main>"), (3, None)], "id int, html string")
    out = list_items(subtree_text(main_subtree(parse_errors(df))))
    assert {r.id: (r.html_main, r.text, r.parse_error) for r in out.collect()} == {
        1: (None, None, "unreadable page: AssertionError"), 2: ("<main>ok</main>", "ok", None), 3: (None, None, None),
    }


def test_csv_values_come_back(spark, tmp_path):
    rows = [(1, "x\ny"), (2, ""), (3, None), (4, 'say "hi", now'), (5, " spaced "), (6, "back\\slash\"")]
    df = spark.createDataFrame(rows, "id int, v string")
    write_csv(df, str(tmp_path / "csv"))
    back = R.read_csv(spark, str(tmp_path / "csv"), "v string, id int, absent double")
    assert sorted((r.id, r.v) for r in back.collect()) == rows and back.first().absent is None


def test_csv_payload_with_quoted_breaks(spark):
    body = 'b, "A"\r\n"one\ntwo ""x""",1\r\n,2\n"",3\nlast\n'
    out = R.parse_csv_payload(spark.createDataFrame([(body,)], "body string"), "body", "a int, b string")
    assert [(r.line_no, r.a, r.b) for r in out.orderBy("line_no").collect()] == [
        (1, 1, 'one\ntwo "x"'), (2, 2, None), (3, 3, ""), (4, None, "last"),
    ]


def test_rows_at_the_mark(spark):
    source = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, None), (5, 9)], "k int, t int")
    loaded = source.where("k in (1, 2)")
    assert sorted(r.k for r in rows_after(source, "t", 7, loaded, ["k"]).collect()) == [3, 4, 5]
    assert rows_after(source, "t", None, loaded, ["k"]).count() == 5


def test_more_than_a_thousand_heavy_keys(spark):
    facts = spark.range(30_000).select((F.col("id") % 1500).alias("k"), "id")
    lookup = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    heavy = heavy_keys(facts, ["k"], rows_per_cell=10)
    assert heavy.count() == 1500 and {r._cells for r in heavy.collect()} == {2}
    joined = salted_join(facts, lookup, ["k"], "inner", spread_by=["id"], rows_per_cell=10)
    assert joined.count() == 30_000 and joined.where("v <> 2 * k").isEmpty()


def test_more_than_two_thousand_map_keys(spark):
    df = spark.range(2500).select(F.create_map(F.concat(F.lit("k"), "id"), F.lit("v")).alias("m"))
    assert len(distinct_keys(df, "m")) == 2500


def test_rows_of_one_ad_do_not_mix(spark, monkeypatch):
    """The same outcome for a short and a long list, also where an ad has several rows."""
    ads = spark.createDataFrame([("1", "the red blue"), ("1", "the green"), ("2", "the"), ("3", None)], "ad_id string, article_content string")
    stop = spark.createDataFrame([("the",), ("og",)], "stopword string")

    def outcome():
        grams = sorted((r.ad_id, r.words) for r in tokens.ngram_rows(ads, stop, (1, 2)).collect())
        kept = sorted(((r.ad_id, r.words) for r in tokens.kept_words(ads, stop).collect()), key=repr)
        return grams, kept

    short = outcome()
    assert ("1", "red blue") in short[0] and ("1", "blue green") not in short[0]
    assert short[1] == sorted([("1", ["red", "blue"]), ("1", ["green"]), ("2", []), ("3", None)], key=repr)
    monkeypatch.setattr(tokens, "STOPWORD_LIMIT", 1)
    assert outcome() == short


def test_keys_of_the_export(spark):
    assert key_statements("keywords") == [
        "ALTER TABLE keywords ADD CONSTRAINT pk_keywords PRIMARY KEY (id)",
        "ALTER TABLE keywords ADD CONSTRAINT uq_keywords_keyword UNIQUE (keyword)",
    ]
    assert key_statements("ngrams") == []
    with pytest.raises(QualityError, match="NULL"):
        export_frame(spark.createDataFrame([(None, "a"), (1, "b")], "id int, keyword string"), "keywords")


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_keys_of_very_many_months_are_looked_up(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(4000).select("id", F.col("id").cast("int").alias("y"), F.lit(None).cast("int").alias("m"))
    stored.append_new(rows.where("id = 7"), path, ("y", "m"), ["id"])
    monkeypatch.setattr(stored, "perhaps_stored", lambda rows, *_: rows)
    assert stored.unstored(rows, path, ("y", "m"), ["id"]).count() == 3999


def test_a_batch_adds_few_files_to_the_filter(spark, tmp_path):
    path = tmp_path / "t"
    rows = spark.range(300).select("id", F.col("id").cast("int").alias("y"))
    stored.write_filter(rows, str(path), ("y",), ["id"])
    assert len(list((tmp_path / "t_keys").rglob("*.parquet"))) <= 8
    assert stored.perhaps_stored(rows, str(path), ("y",), ["id"]).count() == 300
