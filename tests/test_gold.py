"""Dimensions, bridges, search, employer queries, checks, the gold flow."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adloom.operators import dims, serving, tokens
from adloom.operators.quality import (
    QualityError,
    assert_columns,
    assert_not_null,
    assert_primary_key,
    assert_unique,
    conform,
)
from adloom.plans.gold import build_gold, open_by_ad, phrases_by_ad, snapshot_tables, wide_by_ad, write_by_ad
from adloom.schemas import EXPORT_TABLES, JOB_CONTENT_DDL, JOB_METADATA_DDL
from adloom.sinks.writers import export_frame, index_statements, jdbc_column_types

METADATA = [
    (1, "Acme", "Cook", "2025-06-01"),
    (1, "Acme", None, "2025-06-02"),
    (2, "Acme", "Chef", None),
    (3, None, "Dev", None),
    (4, "Zeta", "Dev", None),
]
CONTENT = [
    (1, "The red pan. The blue pan", "Food, Wine food", "Privat", "Mat", "Kitchen/Bar"),
    (2, "the a", None, "Offentlig", None, "kitchen/"),
    (4, "blue sky blue sky", "", "Privat", "IT", None),
]


@pytest.fixture(scope="module")
def bronze(spark):
    metadata = spark.createDataFrame(METADATA, "id bigint, company_name string, heading string, d string").withColumn(
        "published", F.to_timestamp("d")
    )
    content = spark.createDataFrame(
        CONTENT, "id bigint, article_content string, keywords string, sektor string, bransje string, stillingsfunksjon string"
    ).withColumn("attributes", F.create_map(F.lit("job_type"), F.lit("fulltime")))
    return metadata, content


@pytest.fixture(scope="module")
def stop(spark):
    return spark.createDataFrame([("the",), ("a",)], "stopword string")


@pytest.fixture(scope="module")
def gold(bronze, stop):
    return build_gold(*bronze, stop)


def test_unified_ads(gold):
    ads = {r.ad_id: r for r in gold.ads.collect()}
    assert set(ads) == {"1", "2", "3", "4"}
    assert ads["1"].heading == "Cook" and str(ads["1"].published) == "2025-06-02 00:00:00"
    assert ads["1"].article_content == "the red pan the blue pan" and ads["1"].keywords == ["food", "wine", "food"]
    assert ads["1"].stillingsfunksjon == ["kitchen", "bar"] and ads["1"].job_type == "fulltime"
    assert ads["2"].keywords is None and ads["3"].article_content is None


def test_dimensions_and_bridges(gold, rows):
    assert rows(gold.keywords) == [(1, "food"), (2, "wine")]
    assert rows(gold.employers) == [(1, "Acme", "Mat", "Offentlig"), (2, "Zeta", "IT", "Privat"), (3, None, None, None)]
    assert rows(gold.stillingsfunksjon) == [(1, ""), (2, "bar"), (3, "kitchen")]
    assert rows(gold.keyword_ads_bridge) == [("1_1", "1", 1), ("1_2", "1", 2)]
    assert rows(gold.stillingsfunksjon_ads_bridge) == [("1_2", "1", 2), ("1_3", "1", 3), ("2_1", "2", 1), ("2_3", "2", 3)]


def test_bridge_equals_contains_join(gold, rows):
    literal = gold.keywords.join(gold.ads, F.array_contains("keywords", F.col("keyword"))).select("ad_id", "id").distinct()
    assert rows(gold.keyword_ads_bridge.select("ad_id", "keyword_id")) == rows(literal)


def test_tables_by_ad_are_joined_without_an_exchange(spark, gold, rows, tmp_path):
    stored = write_by_ad(gold, str(tmp_path), "t_by_ad", 3)
    again = open_by_ad(spark, str(tmp_path), "t_by_ad_again", 3)
    assert all(rows(stored[n].select(sorted(stored[n].columns))) == rows(t.select(sorted(t.columns))) for n, t in again.items())
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for tables in (stored, again):
            wide, phrases = wide_by_ad(tables), phrases_by_ad(tables, ["heading"])
            for df in (wide, phrases):
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert "Exchange" not in plan and "SortMergeJoin" in plan
            assert rows(wide.select(gold.ads_with_id.columns)) == rows(gold.ads_with_id)
            assert phrases.count() == gold.ngrams.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for prefix in ("t_by_ad", "t_by_ad_again"):
            for name in stored:
                spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")


def test_wide_table(gold):
    wide = gold.ads_with_id.select("ad_id", "employer_id", "keyword_bridge_id", "stillingsfunksjon_bridge_id").collect()
    assert len(wide) == 4 + 2 + 1 + 1
    assert {r.employer_id for r in wide if r.ad_id == "3"} == {None}


def test_ngrams_default_and_fanout(gold, bronze, stop):
    once = [(r.words, r.ngram_size) for r in gold.ngrams.where("ad_id = '1'").collect()]
    assert sorted(once) == [("blue", 1), ("blue pan", 2), ("pan", 1), ("pan", 1), ("red", 1), ("red pan", 2)]
    fanned = build_gold(*bronze, stop, fanout=True).ngrams
    assert fanned.where("ad_id = '1'").count() == 6 * 4
    assert fanned.select("id").distinct().count() == fanned.count()


def test_large_dimensions_take_the_shuffled_path(monkeypatch, gold, bronze, stop, rows):
    from adloom.operators import joins

    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(joins.salted_join, "__defaults__", (None, 1, None))
    again = build_gold(*bronze, stop)
    for name, frame in gold.exports().items():
        assert rows(again.exports()[name]) == rows(frame), name


def brute_search(tables, query, k=10):
    hits = []
    for kind, rows_ in tables.items():
        found = sorted((i, v, kind) for i, v in rows_ if v is not None and query.lower() in v.lower())
        hits += found[:k]
    return sorted(hits, key=lambda h: (h[0], h[2], h[1]))[:k] if len(query) >= 2 else []


@pytest.fixture(scope="module")
def tables(spark):
    data = {
        "keyword": [(i, f"word{i} alpha") for i in range(1, 40)],
        "function": [(1, "Alphabet"), (2, None), (3, "be_ta"), (4, "100%")],
        "employer": [(1, "ALPHA as"), (2, "x"), (3, "")],
        "phrase": [(i, "alpha beta" if i % 3 else "gamma") for i in range(1, 60)],
    }
    return data, {k: spark.createDataFrame(v, "id bigint, value string") for k, v in data.items()}


@pytest.mark.parametrize("query", ["alpha", "AL", "a", "", "beta", "zzz", "mm", "word1"])
def test_search(tables, query):
    data, frames = tables
    assert [tuple(r) for r in serving.search(frames, query).collect()] == brute_search(data, query)


def test_search_wildcards(tables):
    _, frames = tables
    assert {r.value for r in serving.search(frames, "e_t").collect()} >= {"be_ta"}
    assert {r.type for r in serving.search(frames, "l_h").collect()} >= {"keyword", "employer"}
    assert {r.value for r in serving.search(frames, "l_h", literal=True).collect()} == set()
    assert {r.value for r in serving.search(frames, "e_ta", literal=True).collect()} == {"be_ta"}
    assert {r.value for r in serving.search(frames, "0%", literal=True).collect()} == {"100%"}


@pytest.mark.parametrize("literal", [True, False])
@pytest.mark.parametrize("broadcast", [True, False])
def test_batch_search_equals_single_searches(monkeypatch, spark, tables, literal, broadcast):
    if not broadcast:
        monkeypatch.setattr(serving, "fits_broadcast", lambda df: False)
    _, frames = tables
    asked = ["alpha", "AL", "a", "be", "e_ta", "0%", "zzz", "a%b", "%%", "word1", "l_h", "_____"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, query string")
    got = {}
    for r in serving.search_batch(frames, queries, literal).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.value, r.type))
    for number, query in enumerate(asked):
        want = [tuple(r) for r in serving.search(frames, query, literal).collect()]
        assert got.get(number, []) == want, query


def test_hits_by_type(tables):
    _, frames = tables
    grouped = {r.type: len(r.hits) for r in serving.hits_by_type(serving.search(frames, "alpha")).collect()}
    assert sum(grouped.values()) == 10


def test_employer_queries(gold):
    assert serving.employer_by_id(gold.employers, 2).first().company_name == "Zeta"
    args = (gold.ads_with_id, gold.keyword_ads_bridge, gold.keywords)
    assert [tuple(r) for r in serving.employer_keywords(*args, 1).collect()] == [(1, 1, "food"), (1, 2, "wine")]
    rows_ = serving.employer_keywords(*args, 1, count_rows=True).collect()
    assert [tuple(r) for r in rows_] == [(2, 1, "food"), (2, 2, "wine")]
    top = serving.employer_keywords_all(*args, k=1).collect()
    assert [tuple(r) for r in top] == [(1, 1, 1, 1, "food")]


def test_plans(gold):
    bridge = dims.keyword_bridge(gold.ads, gold.keywords)
    plan = bridge._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "SinglePartition" not in plan and "Cartesian" not in plan


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, None), (None, None)], "id int, v string")
    assert_unique(df, ["id"])
    with pytest.raises(QualityError, match="duplicate"):
        assert_unique(df, ["v"])
    with pytest.raises(QualityError, match="NULL"):
        assert_primary_key(df, ["id"])
    with pytest.raises(QualityError, match="missing"):
        assert_columns(df, ["html_main"])
    assert_not_null(df.where("id is not null"), ["id", "v"])


def test_declared_tables(spark):
    row = dict(
        id=1, type="t", main_search_key="k", heading="h", timestamp=0, ad_type=1, canonical_url="u", job_title="j",
        published=0, created_at=0, ad_id=1, occupation="o",
    )
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in row.items()))
    stamps = {c: F.timestamp_millis(c) for c in ("timestamp", "published", "created_at")}
    out = conform(df.withColumns(stamps), JOB_METADATA_DDL)
    assert len(out.columns) == 18 and out.first().company_name is None
    assert not out.schema["heading"].nullable and out.schema["company_name"].nullable
    with pytest.raises(QualityError):
        conform(df.drop("heading"), JOB_METADATA_DDL)
    with pytest.raises(QualityError):
        conform(spark.sql("select 1 id, cast(null as string) content, current_timestamp() created_at"), JOB_CONTENT_DDL)


def test_export_shape(gold):
    for table in EXPORT_TABLES:
        assert export_frame(gold.exports()[table], table).count() == gold.exports()[table].count()
    assert jdbc_column_types("employers") == "id INTEGER, company_name TEXT, bransje TEXT, sektor TEXT"
    assert index_statements("ngrams")[0] == "CREATE INDEX IF NOT EXISTS idx_ngrams_words ON ngrams (words)"
    with pytest.raises(QualityError):
        export_frame(gold.keywords.withColumn("keyword", F.lit("same")), "keywords")


def test_landing_to_gold(spark, tmp_path, stop):
    """Payloads and pages through bronze to gold, for one month."""
    import json

    from adloom.plans.bronze import ingest_content, ingest_metadata
    from adloom.plans.gold import gold_from_bronze, write_gold
    from adloom.sources.readers import source_path
    from test_pages import LAYOUT_A

    landing, bronze_root, checkpoints = (str(tmp_path / d) for d in ("landing", "bronze", "cp"))
    june, may = 1749000000000, 1746500000000
    docs = [
        {"id": "1", "timestamp": june, "company_name": "Acme", "canonical_url": "https://h/job/fulltime/1"},
        {"id": "2", "timestamp": june, "company_name": "Zeta"},
        {"id": "3", "timestamp": may, "company_name": "Old"},
    ]
    folder = tmp_path / "landing" / "job_fulltime" / "ad_metadata"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps({"docs": docs}))
    ingest_metadata(spark, landing, bronze_root, ["SEARCH_ID_JOB_FULLTIME"], checkpoint_root=checkpoints)
    urls = spark.createDataFrame([("1", june, "https://h/job/fulltime/1", "0.1")], "id string, timestamp bigint, canonical_url string, occupation string")
    urls.withColumn("ingeston_ts", F.current_timestamp()).write.parquet(source_path(landing, "ad_urls", "job_fulltime"))
    pages = spark.createDataFrame([(LAYOUT_A.format(keywords="<section><p>Go, Rust</p></section>"), "1")], "html_main string, id string")
    pages.withColumn("ingestion_ts", F.current_timestamp()).write.parquet(source_path(landing, "ad_html", "job_fulltime"))
    ingest_content(spark, landing, bronze_root, checkpoint_root=checkpoints)

    gold = gold_from_bronze(spark, bronze_root, stop, (2025, 6), (2025, 6))
    ads = {r.ad_id: r for r in gold.ads.collect()}
    assert set(ads) == {"1", "2"} and ads["1"].sektor == "Privat" and ads["1"].keywords == ["go", "rust"]
    paths = write_gold(gold, str(tmp_path / "gold"))
    assert sorted(r.keyword for r in spark.read.parquet(paths["keywords"]).collect()) == ["go", "rust"]
    assert {r.employer_id for r in spark.read.parquet(paths["ngrams"]).collect()} == {1}


def test_snapshots_from_config(spark, tmp_path):
    config = [{"table_fqn": "db.s.one", "path": "/a/"}, {"table_fqn": "db.s.two", "path": "b"}]
    paths = snapshot_tables(spark, config, "jdbc:unused", str(tmp_path), read=lambda s, url, fqn: s.range(len(fqn)))
    assert [spark.read.parquet(p).count() for p in paths] == [8, 8]
    assert paths[0].endswith("/a/one.zst.parquet")


def test_the_stored_index_holds_a_value_once(spark, tmp_path):
    from adloom.operators.serving import read_index, search_batch, write_index

    words = [(n, f"{a}{b} {c}") for n, (a, b, c) in enumerate((a, b, c) for a in "abX" for b in "c_d" for c in ("en", "xyz"))]
    tables = {kind: spark.createDataFrame(words, "id bigint, value string") for kind in ("keyword", "phrase")}
    write_index(tables, str(tmp_path / "index"))
    index = read_index(spark, str(tmp_path / "index"))
    assert set(spark.read.parquet(str(tmp_path / "index" / "postings")).columns) == {"gram", "vid", "bucket"}
    asked = ["en", "XYZ", "c xyz", "a%en", "__", "zz", "%d_x%"]
    queries = spark.createDataFrame([(q, q) for q in asked], "query_id string, query string")
    found, direct = (sorted(map(tuple, search_batch(t, queries).collect())) for t in (index, tables))
    assert found == direct and {r[0] for r in found} == {"en", "XYZ", "c xyz", "a%en", "__", "%d_x%"}


def test_neighbours_share_the_rows_of_the_index(spark, tmp_path, monkeypatch):
    from adloom.operators import serving

    texts = ["", "a", "Ab", "abab", "æ\U0001f600æ\U0001f600", "İx", "a%b_c d", "\u0000n", "x" * 300, "zz"] + [f"w{n} v{n % 7}" for n in range(500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, value string")
    # Bytes that are no text.
    rows = rows.union(rows.limit(1).select(F.lit(-1), F.unhex(F.lit("61FF62")).cast("string"))).coalesce(1)
    serving.write_index({"keyword": rows}, str(tmp_path / "index"))
    index = serving.read_index(spark, str(tmp_path / "index"))
    pairs = index.postings.select("gram", F.explode("vid").alias("vid"))
    single = serving._postings(index.values, [1, 2, 3], ["vid"])
    assert pairs.count() == pairs.distinct().count() == single.count()
    assert pairs.exceptAll(single).isEmpty() and single.exceptAll(pairs).isEmpty()
    # Before, every substring of every value was a row.
    assert index.postings.count() < pairs.count() / 2
    together = sorted((g, v) for batch in serving._gram_lists(texts, [*range(len(texts))]) for g, vs in zip(*map(pa.Array.to_pylist, batch)) for v in vs)
    assert together == sorted({(t[i : i + n], v) for v, t in enumerate(texts) for n in (1, 2, 3) for i in range(len(t) - n + 1)})
    monkeypatch.setattr(serving, "GRAM", 5)
    many = [chr(0x4E00 + k) + chr(0x8000 + 7 * k) for k in range(3000)]
    parts = list(serving._gram_lists(many, [*range(3000)]))
    assert len(parts) > 1 and sum(len(p) for p in parts) == len({g for t in many for g in (*t, t)})


def test_a_side_that_was_not_measured_is_not_broadcast(monkeypatch, gold, stop):
    """Spark guesses the size of a side from its files, before lists are exploded."""
    for module, name in ((tokens, "materialize"), (tokens, "dense_ids")):
        monkeypatch.setattr(module, name, lambda df, _: df)
    ads = gold.ads.withColumn("employer_id", F.lit(1))
    wide = dims.ads_with_ids(ads, None, gold.keyword_ads_bridge, gold.stillingsfunksjon_ads_bridge, ["heading"])
    fanned = tokens.ngrams_with_bridges(ads, wide, stop)
    unified = dims.unify_ads(gold.ads.select("ad_id", "heading"), gold.ads.select("ad_id", "article_content").withColumns({c: F.lit("x") for c in ("keywords", "stillingsfunksjon")}))
    for df in (wide, fanned, unified):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_frequent_queries_meet_the_first_values_only(monkeypatch, spark):
    """No table between the steps lists every value under every substring asked for."""
    words = [(n, f"{'äbc'[n % 3]}l{n} ab{'' if n % 50 else 'z'} ab") for n in range(1, 601)] + [(601, "x" * 300 + "ab x")]
    tables = {kind: spark.createDataFrame(words, "id bigint, value string") for kind in ("keyword", "phrase")}
    queries = ["AB", "l", "äl", "b ab", "l6_0 a", "x x", "zz", "%_"]
    asked = spark.createDataFrame([(q, q) for q in queries], "query_id string, query string")
    monkeypatch.setattr(serving, "SEARCHED_AT_ONCE", 0, raising=False)
    seen = {}

    def counted(df, label, kept=serving.materialize):
        stored = kept(df, label)
        seen[label] = max(seen.get(label, 0), stored.count())
        return stored

    monkeypatch.setattr(serving, "materialize", counted)
    found = serving.search_batch(tables, asked).orderBy("rank").collect()
    for query in queries:
        want = [tuple(r) for r in serving.search(tables, query).collect()]
        assert [(r.id, r.value, r.type) for r in found if r.query_id == query] == want, query
    assert max(seen.values()) == seen["values"], seen


def test_the_wide_table_writes_neither_texts_nor_bridges(monkeypatch, spark, tmp_path):
    """What the result does not hold, or one join reads once, is not written in between."""
    from driver_queries import gold as queries

    docs = [(1, "Red pan, red", "en", "src1", 12), (2, None, "de", "src0", 0)]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, "x")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stored = {}

    def kept(df, label, write=queries.materialize):
        stored[label] = write(df, label)
        return stored[label]

    monkeypatch.setattr(queries, "materialize", kept)
    found = queries.ads_with_ids_documents(spark, str(tmp_path)).collect()
    assert list(stored) == ["ads"] and "article_content" not in stored["ads"].columns
    # Keywords pan, red; functions de, en, src0, src1; employers benchmark, src1.
    assert {tuple(r) for r in found} == {
        *(("1", 2, "en", f"1_{k}", f"1_{f}") for k in (1, 2) for f in (2, 4)),
        *(("2", None, "de", None, f"2_{f}") for f in (1, 3)),
        ("b7", 1, None, None, None),
    }
    assert len(found) == 7
