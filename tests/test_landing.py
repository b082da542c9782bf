"""Payload scans, flattening, normalising, sinks."""

import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import values as V
from adloom.operators.flatten import (
    ensure_columns,
    expand_struct,
    explode_docs,
    extract_key,
    flatten_category,
    structure_to_schema,
    variant_exprs,
)
from adloom.operators.normalize import bronze_metadata, normalize_search_key
from adloom.plans.bronze import SEARCH_KEYS, ingest_content, ingest_metadata
from adloom.schemas import AD_HTML_DDL, CATEGORY_SCHEMAS, doc_schema
from adloom.sinks.writers import append_partitioned, rebuild, snapshot, write_json
from adloom.sources import readers as R

DOCS = [
    {
        "id": "11", "type": "bap", "heading": "A", "timestamp": 1700000000123, "coordinates": {"lat": 59.9, "lon": 10.7},
        "extras": [], "labels": None, "price": {"amount": 5, "currency_code": "NOK"}, "mileage": 7, "surprise": {"x": 1},
        "image": {"url": "http://i/1", "height": 4}, "flags": ["a", "b"],
    },
    {"id": 12, "type": "bap", "timestamp": None, "coordinates": None, "mileage": 7.5},
    {"id": "13", "timestamp": 1704067199999, "price": "not a struct", "labels": [{"id": "l", "text": "t", "type": "y"}]},
]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "car_used" / "ad_metadata"
    folder.mkdir(parents=True)
    with gzip.open(folder / "one.json.gz", "wt") as f:
        json.dump({"docs": DOCS[:2], "metadata": {"paging": {"last": 3}}}, f)
    (folder / "two.json").write_text(json.dumps({"docs": DOCS[2:]}))
    (folder / "empty.json").write_text(json.dumps({"docs": []}))
    return tmp_path


def test_payload_scan_plain_and_gz(spark, landing):
    payloads = R.read_payloads(spark, R.source_path(str(landing), "ad_metadata", "car_used"), "car_used")
    docs = explode_docs(payloads)
    assert docs.count() == 3
    files = {r.source_file.rsplit("/", 1)[1] for r in docs.collect()}
    assert files == {"one.json.gz", "two.json"}
    flat = {r.id: r for r in flatten_category(docs, "car_used").collect()}
    assert set(flat) == {11, 12, 13}
    assert flat[11].price_amount == 5 and flat[11].price_price_unit is None and flat[11].extras == []
    assert flat[11].image_url == "http://i/1" and flat[11].flags == ["a", "b"] and flat[11].mileage == 7.0
    assert flat[11].timestamp == datetime.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert flat[12].coordinates_lat is None and flat[12].timestamp is None
    # A wrong type costs that field only.
    assert flat[13].price_amount is None and flat[13].labels[0].text == "t"


def test_variant_reads_numbers_kept_as_text(spark, tmp_path):
    doc = {"id": "5", "mileage": "7", "price": {"amount": "12"}, "timestamp": "bad"}
    (tmp_path / "p.json").write_text(json.dumps({"docs": [doc]}))
    row = R.read_payload_variants(spark, str(tmp_path)).select(*variant_exprs(doc_schema("car_used"))).first()
    assert (row.id, row.mileage, row.price_amount, row.timestamp) == (5, 7.0, 12, None)


def test_lean_and_full_bronze(spark, landing):
    payloads = R.read_payloads(spark, R.source_path(str(landing), "ad_metadata", "car_used"), "car_used")
    lean = bronze_metadata(payloads, "car_used")
    assert not {"image", "flags", "labels", "price", "coordinates"} & set(lean.columns)
    assert {"coordinates_lat", "price_amount", "y", "m", "published", "source_file", "ingestion_ts"} <= set(lean.columns)
    by_id = {r.id: (r.y, r.m) for r in lean.collect()}
    assert by_id == {11: (2023, 11), 12: (None, None), 13: (2023, 12)}
    full = bronze_metadata(payloads, "car_used", keep_nested=True)
    assert {"image_url", "flags", "labels", "_y", "_m"} <= set(full.columns)


def test_every_category_has_a_flat_shape(spark):
    widths = {"car_used": 29, "job_fulltime": 23, "realestate_homes": 56, "realestate_lettings": 48}
    for category, width in widths.items():
        docs = spark.createDataFrame([], T.StructType().add("doc", CATEGORY_SCHEMAS[category]))
        assert len(flatten_category(docs, category).columns) == width


def test_unknown_search_key(spark):
    with pytest.raises(ValueError, match="unknown category"):
        normalize_search_key(spark.range(1), "SEARCH_ID_BOATS")


def test_bad_deadline_becomes_null(spark):
    df = spark.createDataFrame(
        [("1", 0, "86400000"), ("2", None, "soon")], "id string, timestamp bigint, deadline string"
    )
    out = {r.id: r.deadline for r in normalize_search_key(df, "SEARCH_ID_JOB_FULLTIME").collect()}
    assert out == {1: datetime.datetime(1970, 1, 2), 2: None}


def test_expand_map_struct_and_missing(spark):
    df = spark.createDataFrame(
        [({"a": "1", "b": "2"}, (7,)), (None, None)], "attrs map<string,string>, s struct<x:int>"
    )
    out = expand_struct(expand_struct(expand_struct(df, "attrs", drop=True), "s"), "nope")
    assert out.columns == ["s", "attrs_a", "attrs_b", "s_x"]
    found = {tuple(r) for r in out.select("attrs_a", "attrs_b", "s_x").collect()}
    assert found == {("1", "2", 7), (None, None, None)}
    assert extract_key(df, "z", "nope", "k").first().z is None
    assert extract_key(df, "z", "s", "x").first().z == 7
    assert ensure_columns(df, {"t": "timestamp"}).schema["t"].dataType == T.TimestampType()


def test_recorded_structure(spark):
    schema = structure_to_schema({"a": "VARCHAR", "b": {"c": "UBIGINT"}, "d": ["NULL"], "e": [{"f": "DOUBLE"}]})
    assert schema.simpleString() == "struct<a:string,b:struct<c:bigint>,d:array<string>,e:array<struct<f:double>>>"


def test_incremental_categories(spark, landing, tmp_path):
    out, checkpoints = str(tmp_path / "bronze"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds nothing new
        targets = ingest_metadata(spark, str(landing), out, ["SEARCH_ID_CAR_USED"], checkpoint_root=checkpoints)
        assert spark.read.parquet(targets["car_used"]).count() == 3
    late = landing / "car_used" / "ad_metadata" / "late.json"
    late.write_text(json.dumps({"docs": [{"id": "14", "timestamp": 1}]}))
    ingest_metadata(spark, str(landing), out, ["SEARCH_ID_CAR_USED"], checkpoint_root=checkpoints)
    assert spark.read.parquet(targets["car_used"]).count() == 4
    with pytest.raises(ValueError):
        ingest_metadata(spark, str(landing), out, ["SEARCH_ID_BOATS"], checkpoint_root=checkpoints)
    assert len(SEARCH_KEYS) == 5


def test_nothing_landed_yet(spark, tmp_path):
    assert ingest_metadata(spark, str(tmp_path), str(tmp_path / "b"), checkpoint_root=str(tmp_path / "cp")) == {}
    ingest_content(spark, str(tmp_path), str(tmp_path / "b"), checkpoint_root=str(tmp_path / "cp"))
    assert not (tmp_path / "b").exists()


def test_union_by_name_and_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    append_partitioned(spark.sql("select 1 a, 2024 y, 12 m"), path)
    append_partitioned(spark.sql("select 2 a, 'new' b, 2025 y, 1 m union all select 3, 'x', 2025, 6"), path)
    df = R.read_months(spark, path, (2024, 12), (2025, 5))
    assert sorted((r.a, r.b) for r in df.collect()) == [(1, None), (2, "new")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_rebuild_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rebuild(spark.sql("select 1 a, 2025 y, 1 m union all select 2, 2025, 2"), path)
    rebuild(spark.sql("select 9 a, 2025 y, 2 m"), path, full_refresh=False)
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 9]
    rebuild(spark.sql("select 5 a, 2025 y, 3 m"), path)
    assert [r.a for r in spark.read.parquet(path).collect()] == [5]


def test_word_list_files(spark, tmp_path):
    (tmp_path / "no.json").write_text(json.dumps(["og", "i"], indent=1))
    (tmp_path / "en.json").write_text('["the"]')
    out = R.read_word_lists(spark, str(tmp_path))
    assert sorted(r.stopword for r in out.collect()) == ["i", "og", "the"]


def test_category_landing(spark, tmp_path):
    folder = tmp_path / "food" / "fish"
    folder.mkdir(parents=True)
    with gzip.open(folder / "1300_ab-cd.json.gz", "wt") as f:
        json.dump({"hits": [1, 2]}, f)
    row = (
        R.read_category_landing(spark, str(tmp_path / "food"))
        .select("category", "chain_id", F.variant_get("payload", "$.hits[1]", "int").alias("h"), V.food_label(F.col("category")).alias("l"))
        .first()
    )
    assert tuple(row) == ("fish", "1300", 2, "Fisk & skalldyr")


def test_missing_source_is_empty_but_other_errors_are_not(spark, tmp_path):
    assert R.read_or_empty(spark, str(tmp_path / "none"), AD_HTML_DDL).count() == 0


def test_csv_payload_column(spark):
    df = spark.createDataFrame([(1, "a,b\r\n1,x\r\n2,y\r\n"), (2, "a,b\n")], "k int, body string")
    out = R.parse_csv_payload(df, "body", "a int, b string")
    assert [tuple(r) for r in out.orderBy("a").collect()] == [(1, 1, 1, "x"), (1, 2, 2, "y")]


def test_snapshot_path(spark, tmp_path):
    path = snapshot(spark.range(3), str(tmp_path), "db.schema.tbl")
    assert path.endswith("/tbl.zst.parquet")
    snapshot(spark.range(2), str(tmp_path), "db.schema.tbl")
    assert spark.read.parquet(path).count() == 2


def test_values(spark):
    row = (
        spark.sql("select 1 x")
        .select(
            V.url_segment(F.lit("https://h.example/job/fulltime/ad.html?x=1#f"), 2).alias("a"),
            V.url_segment(F.lit("https://h.example/job"), 2).alias("b"),
            V.joined_key(F.lit(None).cast("string"), F.lit(3)).alias("c"),
            V.published_flag(F.lit("False")).alias("d"),
            V.published_flag(F.lit("True")).alias("e"),
            V.category_of_search_key(F.lit("SEARCH_ID_CAR_USED")).alias("f"),
            V.base64_text(F.lit("w6Y=")).alias("g"),
            V.food_label(F.lit("nothing")).alias("h"),
            V.query_value(F.lit("a b&~*ø")).alias("i"),
            V.filter_options_url("https://s.example", F.lit("1300")).alias("j"),
            V.stores_url("https://s.example", F.lit("1300")).alias("k"),
            V.ad_type_of_url(F.lit("https://h/position/1")).alias("l"),
            V.job_search_page_url("https://h", F.lit("0.1"), F.lit("1"), F.lit(2)).alias("m"),
            V.product_page_url(
                "https://s.example", F.lit("1"), F.lit(None).cast("string"), F.lit("1"), F.lit("50"), F.lit("9")
            ).alias("n"),
        )
        .first()
    )
    from urllib.parse import quote_plus

    assert (row.a, row.b, row.c, row.d, row.e, row.f, row.g, row.h) == (
        "fulltime", None, "_3", "", "1", "car_used", "æ", None,
    )
    assert row.i == quote_plus("a b&~*ø")
    assert row.j == "https://s.example/products/1300?page_size=0&full_response=true"
    assert row.k == "https://s.example/handoveroptions/1300" and row.l == "position"
    assert row.m == "https://h?searchkey=SEARCH_ID_JOB_FULLTIME&occupation=0.1&q=&published=1&vertical=job&page=2"
    assert row.n.startswith("https://s.example/products/1/9?page=1&page_size=50&") and "&facet=&" in row.n
    assert V.split_table_name("db.finance.ads") == ("finance", "ads")


def test_a_record_is_parsed_once(spark, landing):
    for df, parse in ((R.read_payloads(spark, str(landing), "car_used"), "from_json"), (R.read_payload_variants(spark, str(landing)), "parseJson")):
        plan = df.where("docs is not null" if "docs" in df.columns else "doc is not null")._jdf.queryExecution().optimizedPlan()
        assert plan.toString().count(parse) == 1


def test_the_cut_line_of_a_part_is_made_of_few_documents(spark):
    import driver_queries.landing as queries

    orders = spark.range(5000).selectExpr(
        "id as o_orderkey", "id % 2 as part", "id as o_custkey", "date'2024-01-01' as o_orderdate", "1.5D as o_totalprice", "'F' as o_orderstatus"
    )
    cut = queries._cut_lines(orders)
    assert "WindowGroupLimit" in cut._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.part, len(r.value), r.o_custkey) for r in cut.collect()) == [(0, 70, -1), (1, 70, -1)]


def test_documents_are_made_of_the_collected_orders(spark):
    import driver_queries.landing as queries

    orders = spark.range(40).selectExpr(
        "id as o_orderkey", "id % 3 as o_custkey", "date'2024-01-01' as o_orderdate", "1.5D as o_totalprice", "if(id % 2 = 0, 'F', 'P') as o_orderstatus"
    )
    made = orders.groupBy("o_custkey").agg(queries._docs("car_used").alias("docs")).select(F.explode("docs").alias("d"))
    plain = orders.select(queries._doc("car_used").alias("d"))
    assert sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))


def test_payloads_are_compressed_at_the_fastest_level(spark, tmp_path):
    rows = spark.range(20_000).select("id", F.concat(F.lit("name-"), F.sha2(F.col("id").cast("string"), 256)).alias("name"))
    write_json(rows.coalesce(1), str(tmp_path / "out"), gzip=True)
    (file,) = (tmp_path / "out").glob("*.json.gz")
    text = gzip.decompress(file.read_bytes())
    assert len(text.splitlines()) == 20_000
    assert file.stat().st_size > 1.03 * len(gzip.compress(text, 6))


def test_text_with_other_line_ends_leaves_a_payload_one_line(spark, tmp_path):
    """JSON text may hold signs that a pattern takes for the end of a line."""
    lines = [json.dumps({"docs": [{"id": str(n), "heading": f"a{end}b"}]}, ensure_ascii=False) for n, end in enumerate("\u2028\u0085")]
    (tmp_path / "a.json").write_text(f"{lines[0]}\n \n  {lines[1]}\t\n", encoding="utf-8")
    found = R.read_payloads(spark, str(tmp_path), "car_used").collect()
    assert sorted((d.id, d.heading) for r in found for d in r.docs) == [("0", "a\u2028b"), ("1", "a\u0085b")]
