"""Scans, sinks, flattening, normalising and incremental runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.values import (
    base64_text,
    category_of_search_key,
    epoch_ms_or_null,
    food_label,
    product_page_url,
    published_flag,
    schema_of,
    search_page_url,
    table_of,
)
from adloom.operators.flatten import (
    discover_structure,
    expand_struct,
    extract_key,
    flatten_exprs,
    structure_to_schema,
    variant_exprs,
)
from adloom.operators.normalize import bronze_metadata, normalize_search_key, published_on, select_categories
from adloom.operators.quality import conform, null_counts
from adloom.operators.sketches import merged_counts, period_sketches
from adloom.operators.tokens import union_all
from adloom.schemas import JOB_METADATA_DDL, doc_schema
from adloom.plans.bronze import ingest_metadata
from adloom.sinks.writers import (
    append_parquet,
    append_partitioned,
    rebuild,
    replace_partitions,
    replace_table,
    snapshot,
    write_csv,
    write_json,
)
from adloom.sources.readers import (
    more_pages,
    parse_csv_payload,
    read_category_landing,
    read_csv,
    read_months,
    read_or_empty,
    read_parquet_files,
    read_payload_variants,
    read_payloads,
    read_recursive,
    read_word_lists,
    source_path,
    union_pages,
    with_landing_columns,
    with_source_file,
)
from adloom.functions.text import words
from adloom.storage import fresh_path
from adloom.streaming.incremental import (
    high_water_mark,
    list_files,
    mark_done,
    new_files,
    read_rejected_payloads,
    rows_after,
    run_metadata,
)
from adloom.streaming.fields import known_fields, with_fields
from driver_queries.expected import DROPPED, EXPECTED
from driver_queries.registry import load, load_spread, query

# --- Payloads built from `orders`: every field gets a value that depends on the
# --- order and on the field's name, so a mixed-up path shows.


def _value(kind: str, path: str, order=F.col) -> Column:
    if kind == "labels":
        return F.array(*(F.struct(*(_value("text", f"{p}.{n}", order).alias(n) for n in ("id", "text", "type"))) for p in (path, path + "2")))
    if kind == "list":
        return F.array(_value("text", path, order), _value("text", path + "2", order))
    if kind == "time":
        return F.unix_millis(order("o_orderdate").cast("timestamp"))
    if kind == "long":
        return order("o_orderkey") + F.lit(len(path))
    return order("o_totalprice") if kind == "double" else F.concat(F.lit(path + "-"), order("o_orderkey").cast("string"))


def _doc(category: str, order=F.col) -> Column:
    """A document of ``orders`` with every expected field; some lack their coordinates.
    ``order`` gives a column of the order."""
    fields: dict[str, list[Column] | Column] = {}
    for path, kind in EXPECTED[category]:
        name, _, inner = path.partition(".")
        value = order("o_orderkey").cast("string") if path == "id" else _value(kind, path, order)
        if inner:
            fields.setdefault(name, []).append(value.alias(inner))
        else:
            fields[name] = value
    whole = {n: F.struct(*v) if isinstance(v, list) else v for n, v in fields.items()}
    whole["coordinates"] = F.when(order("o_orderstatus") != "P", whole["coordinates"])
    return F.struct(*(v.alias(n) for n, v in whole.items()))


# What a document is made of.
_ORDER = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"]


def _docs(category: str) -> Column:
    """The documents of a group of ``orders``: only the columns they are made of are
    exchanged, and the documents, thirty times as long, are made of them afterwards."""
    return F.transform(F.array_agg(F.struct(*_ORDER)), lambda o: _doc(category, lambda name: o[name]))


def _sql_value(kind: str, path: str) -> str:
    if kind == "labels":
        return " || '|' || ".join(" || ':' || ".join(_sql_value("text", f"{p}.{n}") for n in ("id", "text", "type")) for p in (path, path + "2"))
    if kind == "list":
        return f"{_sql_value('text', path)} || '|' || {_sql_value('text', path + '2')}"
    if kind == "time":
        return "o_orderdate"
    if kind == "long":
        return f"o_orderkey + {len(path)}"
    return "o_totalprice" if kind == "double" else f"'{path}-' || o_orderkey"


def _flat_sql(category: str, lean: bool) -> str:
    columns = {}
    for path, kind in EXPECTED[category]:
        name = path.partition(".")[0]
        if lean and name in DROPPED:
            continue
        value = "o_orderkey" if path == "id" else _sql_value(kind, path)
        columns[path.replace(".", "_")] = f"CASE WHEN o_orderstatus <> 'P' THEN {value} END" if name == "coordinates" else value
    if lean:
        columns.setdefault("published", "CAST(NULL AS TIMESTAMP)")
    y, m = ("y", "m") if lean else ("_y", "_m")
    columns[y] = "CAST(year(o_orderdate) AS INTEGER)"
    columns[m] = "CAST(month(o_orderdate) AS INTEGER)"
    return "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in columns.items()) + " FROM orders"


def _land_payloads(orders: DataFrame, category: str, path: str) -> None:
    """Payloads of several documents each: the orders of one customer."""
    payloads = orders.groupBy("o_custkey").agg(_docs(category).alias("docs")).select("docs")
    write_json(payloads, path, gzip=True)


def _plain(df: DataFrame) -> DataFrame:
    """Comparable form: lists as text, times without zone, no audit columns."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            if isinstance(f.dataType.elementType, T.StructType):
                names = f.dataType.elementType.fieldNames()
                col = F.transform(col, lambda s: F.concat_ws(":", *[s[n] for n in names]))
            col = F.array_join(col, "|")
        elif isinstance(f.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(f.name))
    return df.select(*out).drop("source_file", "ingestion_ts")


def _register_category(category: str) -> None:
    @query(f"flatten_{category}", _flat_sql(category, lean=False))
    def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_path(spark, category)
        _land_payloads(load_spread(spark, sf_dir, "orders", "o_orderkey"), category, path)
        return _plain(bronze_metadata(read_payloads(spark, path, category), category, keep_nested=True))

    @query(f"normalize_{category}", _flat_sql(category, lean=True))
    def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_path(spark, category)
        _land_payloads(load_spread(spark, sf_dir, "orders", "o_orderkey"), category, path)
        return _plain(bronze_metadata(read_payloads(spark, path, category, lean=True), category))


for _category in EXPECTED:
    _register_category(_category)


@query("flatten_unknown_shape", " ".join(["SELECT * EXCLUDE (_y, _m) FROM (", _flat_sql("car_used", lean=False), ")"]))
def flatten_unknown_shape(spark, sf_dir):
    """All columns of the variant form."""
    path = fresh_path(spark, "variant")
    _land_payloads(load_spread(spark, sf_dir, "orders", "o_orderkey"), "car_used", path)
    return _plain(read_payload_variants(spark, path).select(*variant_exprs(doc_schema("car_used"))))


@query(
    "schema_driven_select",
    """SELECT 'type-' || o_orderkey AS "type", o_orderkey AS id, o_orderdate AS published,
              'logo.url-' || o_orderkey AS logo_url, 'logo.path-' || o_orderkey AS logo_path,
              'flags-' || o_orderkey || '|' || 'flags2-' || o_orderkey AS flags,
              o_orderkey + 15 AS no_of_positions
       FROM orders""",
)
def schema_driven_select(spark, sf_dir):
    path = fresh_path(spark, "structure")
    _land_payloads(load_spread(spark, sf_dir, "orders", "o_orderkey"), "job_fulltime", path)
    recorded = {
        "type": "VARCHAR",
        "id": "VARCHAR",
        "published": "UBIGINT",
        "logo": {"url": "VARCHAR", "path": "VARCHAR"},
        "flags": ["VARCHAR"],
        "no_of_positions": "UBIGINT",
    }
    schema = structure_to_schema(recorded)
    docs = spark.read.schema(T.StructType().add("docs", T.ArrayType(schema))).json(path)
    return _plain(docs.select(F.explode("docs").alias("doc")).select(*flatten_exprs(schema)))


@query(
    "structure_discovery",
    """SELECT 'OBJECT<' || string_agg(DISTINCT key || ': BIGINT', ', ') || '>' AS structure
       FROM (SELECT unnest(json_keys(props)) AS key FROM events)""",
)
def structure_discovery(spark, sf_dir):
    return discover_structure(load(spark, sf_dir, "events"), "props")


@query(
    "expand_struct_columns",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k, user_id AS who_user,
              "value" AS who_value, CAST(json_extract(props, '$.k') AS BIGINT) AS k
       FROM events""",
)
def expand_struct_columns(spark, sf_dir):
    events = load(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "map<string,bigint>").alias("props"),
        F.struct(F.col("user_id").alias("user"), "value").alias("who"),
    )
    wide = expand_struct(extract_key(events, "k", "props", "k"), "props", drop=True)
    return expand_struct(expand_struct(wide, "who", drop=True), "absent_column")


@query(
    "props_json_extract",
    """SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum
       FROM events GROUP BY event_type""",
)
def props_json_extract(spark, sf_dir):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return load(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(k).alias("k_sum")
    )


@query(
    "source_file_lineage",
    "SELECT '.json.gz' AS suffix, count(*) AS n, true AS named FROM orders",
)
def source_file_lineage(spark, sf_dir):
    path = fresh_path(spark, "lineage")
    _land_payloads(load_spread(spark, sf_dir, "orders", "o_orderkey"), "car_used", path)
    rows = bronze_metadata(read_payloads(spark, path, "car_used"), "car_used")
    suffix = F.regexp_extract("source_file", r"(\.json\.gz)$", 1).alias("suffix")
    return rows.groupBy(suffix).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.contains("source_file", F.lit("/part-"))).alias("named")
    )


@query(
    "partitioned_write_prune",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
              count(*) AS n, count(DISTINCT o_custkey) AS customers, max(o_totalprice) AS top
       FROM orders
       WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1998-02-01'
       GROUP BY ALL""",
)
def partitioned_write_prune(spark, sf_dir):
    path = fresh_path(spark, "months")
    orders = load(spark, sf_dir, "orders").withColumns(
        {"y": F.year("o_orderdate"), "m": F.month("o_orderdate")}
    )
    append_partitioned(orders, path)
    return (
        read_months(spark, path, (1996, 3), (1998, 1))
        .groupBy("y", "m")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("o_custkey").alias("customers"),
            F.max("o_totalprice").alias("top"),
        )
    )


@query(
    "append_then_read",
    """SELECT o_orderkey, o_orderpriority FROM orders
       UNION ALL SELECT o_orderkey, o_orderpriority FROM orders""",
)
def append_then_read(spark, sf_dir):
    path = fresh_path(spark, "append")
    orders = load(spark, sf_dir, "orders")
    for _ in range(2):
        append_parquet(orders, path)
    return read_parquet_files(spark, path, ["o_orderkey", "o_orderpriority"])


@query("snapshot_overwrite", "SELECT * FROM customer")
def snapshot_overwrite(spark, sf_dir):
    customers = load(spark, sf_dir, "customer")
    root = fresh_path(spark, "snapshots")
    snapshot(customers.select("c_custkey"), root, "db.sales.customer")
    return spark.read.parquet(snapshot(customers, root, "db.sales.customer"))


@query("replace_table", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def replace_table_query(spark, sf_dir):
    by_priority = load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    path = fresh_path(spark, "table")
    by_priority.write.parquet(path)
    replace_table(by_priority, "adloom_priorities", path)
    return spark.read.parquet(path)


@query("json_gz_roundtrip", "SELECT * FROM customer")
def json_gz_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "json")
    customers = load(spark, sf_dir, "customer")
    write_json(customers, path, gzip=True)
    return spark.read.schema(customers.schema).json(path)


@query(
    "csv_roundtrip",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN NULL
              ELSE '"' || text || '", ' || chr(10) || ' end' END AS text, lang, n_chars FROM documents""",
)
def csv_roundtrip(spark, sf_dir):
    """Line breaks, quotes, empty values and NULL; the reader asks for another order."""
    path = fresh_path(spark, "csv")
    text = F.when(F.col("doc_id") % 5 == 0, "").when(
        F.col("doc_id") % 5 != 1, F.concat(F.lit('"'), "text", F.lit('", \n end'))
    )
    docs = load(spark, sf_dir, "documents").select("n_chars", "lang", text.alias("text"), "doc_id")
    write_csv(docs, path)
    return read_csv(spark, path, "doc_id bigint, text string, lang string, n_chars bigint")


@query(
    "csv_payload_rows",
    """SELECT s_nationkey, s_name AS symbol, s_acctbal AS price FROM supplier
       UNION ALL SELECT s_nationkey, 'total "' || s_suppkey || '",' || chr(10) || 'all', s_acctbal * 2 FROM supplier""",
)
def csv_payload_rows(spark, sf_dir):
    """Columns in another order than asked for, and a quoted line break."""
    quoted = F.concat(F.lit('"total ""'), F.col("s_suppkey"), F.lit('"",\nall"'))
    line = F.concat_ws(
        "\n",
        F.lit("price,symbol"),
        F.concat_ws(",", F.col("s_acctbal").cast("string"), "s_name"),
        F.concat_ws(",", (F.col("s_acctbal") * 2).cast("string"), quoted),
        F.lit(""),
    )
    payloads = load(spark, sf_dir, "supplier").select("s_nationkey", line.alias("body"))
    return parse_csv_payload(payloads, "body", "symbol string, price double").drop("line_no")


@query(
    "word_array_source",
    r"""SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(lower(text), '\w+')) AS word FROM documents)
        GROUP BY word""",
)
def word_array_source(spark, sf_dir):
    path = fresh_path(spark, "words")
    arrays = F.to_json(words(F.lower("text")))
    load(spark, sf_dir, "documents").select(arrays.alias("value")).write.text(path)
    found = read_word_lists(spark, path, one_per_line=True)
    return found.groupBy(F.col("stopword").alias("word")).agg(F.count(F.lit(1)).alias("n"))


@query("recursive_scan", "SELECT s_suppkey, s_name FROM supplier")
def recursive_scan(spark, sf_dir):
    path = fresh_path(spark, "tree")
    suppliers = load(spark, sf_dir, "supplier")
    suppliers.write.partitionBy("s_nationkey").parquet(f"{path}/deep")
    return read_recursive(spark, path).select("s_suppkey", "s_name")


_FOOD_CASE = """CASE lower(p_type) WHEN 'economy' THEN 'Frukt & grønt' WHEN 'standard' THEN 'Ost'
    WHEN 'promo' THEN 'Fisk & skalldyr' ELSE 'Kjøtt' END"""


def _food_code() -> Column:
    kind = F.lower("p_type")
    return (
        F.when(kind == "economy", "fruits_veggies")
        .when(kind == "standard", "cheese")
        .when(kind == "promo", "fish")
        .otherwise("meat")
    )


@query(
    "landing_path_columns",
    f"SELECT p_partkey, {_FOOD_CASE} AS label, CAST(p_size AS VARCHAR) AS chain_id FROM part",
)
def landing_path_columns(spark, sf_dir):
    path = F.concat(
        F.lit("s3a://landing/food_prices/"), _food_code(), F.lit("/"), F.col("p_size"), F.lit("_"), F.md5("p_name"),
        F.lit(".json.gz"),
    )
    files = with_landing_columns(load(spark, sf_dir, "part").select("p_partkey", path.alias("source_file")))
    return files.select("p_partkey", food_label(F.col("category")).alias("label"), "chain_id")


@query(
    "landing_files",
    f"""SELECT p_partkey, p_name, {_FOOD_CASE} AS label, CAST(p_size % 3 AS VARCHAR) AS chain_id, true AS named FROM part""",
)
def landing_files(spark, sf_dir):
    """JSON files named by category and chain, read back with what their names say."""
    root = fresh_path(spark, "food")
    parts = load(spark, sf_dir, "part").select(_food_code().alias("code"), (F.col("p_size") % 3).alias("chain"), "p_partkey", "p_name")
    parts.repartition("code", "chain").write.partitionBy("code", "chain").json(f"{root}/raw")
    jvm = spark.sparkContext._jvm
    raw = jvm.org.apache.hadoop.fs.Path(f"{root}/raw")
    store = raw.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Spark names its files itself; the landing zone has names of its own.
    for n, status in enumerate(store.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/raw/*/*/*.json"))):
        code, chain = (status.getPath().toString().split("/")[k].split("=")[1] for k in (-3, -2))
        target = jvm.org.apache.hadoop.fs.Path(f"{root}/landing/{code}/{chain}_{n}.json")
        store.mkdirs(target.getParent())
        store.rename(status.getPath(), target)
    rows = read_category_landing(spark, f"{root}/landing")
    return rows.select(
        F.try_variant_get("payload", "$.p_partkey", "bigint").alias("p_partkey"),
        F.try_variant_get("payload", "$.p_name", "string").alias("p_name"),
        food_label(F.col("category")).alias("label"),
        "chain_id",
        F.contains("source_file", F.lit("/landing/")).alias("named"),
    )


@query(
    "crawl_urls",
    f"""SELECT p_partkey,
           'https://shop.example/api/products/' || p_size || '?page=1&page_size=9999&full_response=true'
           || '&fieldset=maximal&facets=Category&facet='
           || replace(url_encode('Categories:' || {_FOOD_CASE}), '%20', '+') || '&showNotForSale=true' AS product_url,
           'https://ads.example/api/search?searchkey=SEARCH_ID_CAR_USED&published=&page=' || p_size
           || '&vertical=1' AS search_url
        FROM part""",
)
def crawl_urls(spark, sf_dir):
    label = food_label(_food_code())
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        product_page_url("https://shop.example/api", F.col("p_size"), label, F.lit("1"), F.lit("9999")).alias(
            "product_url"
        ),
        search_page_url(
            "https://ads.example/api/search",
            F.lit("SEARCH_ID_CAR_USED"),
            published_flag(F.lit("False")),
            F.col("p_size"),
        ).alias("search_url"),
    )


@query(
    "page_union_cap",
    """SELECT p_partkey, p_name, p_size + 5 AS page, CAST(NULL AS VARCHAR) AS title FROM part
       UNION ALL SELECT s_suppkey, s_name, 1, 'suppliers' FROM supplier""",
)
def page_union_cap(spark, sf_dir):
    """Every page up to the last one offered, however many there are."""
    parts = load(spark, sf_dir, "part").select(
        F.array(F.struct("p_partkey", "p_name")).alias("docs"),
        (F.col("p_size") + 5).alias("page"),
        F.lit(60).alias("last"),
    )
    suppliers = load(spark, sf_dir, "supplier").select(
        F.array(F.struct(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name"))).alias("docs"),
        F.lit(1).alias("page"),
        F.lit(1).alias("last"),
        F.lit("suppliers").alias("title"),
    )
    docs = union_pages(union_all([parts, suppliers]))
    return docs.select("doc.p_partkey", "doc.p_name", "page", "title")


@query(
    "page_union",
    """SELECT p_partkey, page FROM part, (VALUES (1), (2), (9)) pages(page) WHERE page <> 2 OR p_size < 40""",
)
def page_union(spark, sf_dir):
    """Pages without paging data, and pages behind the last one offered by now, stay."""
    part = load(spark, sf_dir, "part")
    docs = F.array(F.struct("p_partkey")).alias("docs")
    first = part.select(docs, F.lit(1).alias("page"), F.lit(None).cast("int").alias("last"))
    second = part.where("p_size < 40").select(docs, F.lit(2).alias("page"), F.lit(2).alias("last"))
    behind = part.select(docs, F.lit(9).alias("page"), F.lit(3).alias("last"))
    return union_pages(union_all([first, second, behind])).select("doc.p_partkey", "page")


@query(
    "pages_left",
    """SELECT search, page FROM (SELECT p_brand AS search, unnest(range(1, max(p_size) + 1)) AS page FROM part GROUP BY p_brand)
       ANTI JOIN (SELECT p_brand AS search, p_size AS page FROM part) USING (search, page)""",
)
def pages_left(spark, sf_dir):
    """What a search offers and was not landed: every brand is a search, every size a page."""
    part = load(spark, sf_dir, "part")
    landed = part.select(F.col("p_brand").alias("search"), F.col("p_size").alias("page"), "p_size")
    offered = F.when(F.col("page") % 2 == 0, F.max("p_size").over(Window.partitionBy("search")))
    return more_pages(landed.withColumn("last", offered), ["search"]).select("search", F.col("page").cast("bigint").alias("page"))


_BY_MONTH = """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
    count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM orders GROUP BY ALL"""


def _by_month(df: DataFrame) -> DataFrame:
    return df.groupBy("y", "m").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))


@query("incremental_rerun", _BY_MONTH)
def incremental_rerun(spark, sf_dir):
    """Two arrivals and one run with nothing new."""
    root = fresh_path(spark, "incremental")
    landing, target, checkpoint = f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint"
    orders = load(spark, sf_dir, "orders")
    _land_payloads(orders.where("o_orderstatus = 'F'"), "car_used", landing)
    run_metadata(spark, landing, target, checkpoint, "car_used")
    _land_payloads(orders.where("o_orderstatus <> 'F'"), "car_used", landing)
    run_metadata(spark, landing, target, checkpoint, "car_used")
    run_metadata(spark, landing, target, checkpoint, "car_used")
    return _by_month(spark.read.parquet(target))


def _late_files(spark: SparkSession, path: str, days: int) -> None:
    """Date the files of a folder back, as files landed late are."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in store.listStatus(folder):
        store.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query("incremental_old_file", _BY_MONTH)
def incremental_old_file(spark, sf_dir):
    """The second arrival carries a date 30 days before the first."""
    root = fresh_path(spark, "incremental")
    orders = load(spark, sf_dir, "orders")
    for n, arrival in enumerate(("o_orderstatus = 'F'", "o_orderstatus <> 'F'")):
        _land_payloads(orders.where(arrival), "car_used", f"{root}/landing/{n}")
        if n:
            _late_files(spark, f"{root}/landing/{n}", 30)
        run_metadata(spark, f"{root}/landing", f"{root}/bronze", None, "car_used")
    return _by_month(spark.read.parquet(f"{root}/bronze"))


@query("incremental_two_targets", f"SELECT *, 'first' AS target FROM ({_BY_MONTH}) UNION ALL SELECT *, 'second' FROM ({_BY_MONTH})")
def incremental_two_targets(spark, sf_dir):
    """One landing folder, two tables."""
    root = fresh_path(spark, "incremental")
    _land_payloads(load(spark, sf_dir, "orders"), "car_used", f"{root}/landing")
    found = []
    for target in ("first", "second"):
        run_metadata(spark, f"{root}/landing", f"{root}/{target}", None, "car_used")
        found.append(_by_month(spark.read.parquet(f"{root}/{target}")).withColumn("target", F.lit(target)))
    return union_all(found)


@query("incremental_lost_checkpoint", _BY_MONTH)
def incremental_lost_checkpoint(spark, sf_dir):
    """Every run starts without the progress of the one before; small batches."""
    root = fresh_path(spark, "incremental")
    orders = load(spark, sf_dir, "orders")
    for n, arrival in enumerate(("o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus = 'P'")):
        _land_payloads(orders.where(arrival), "car_used", f"{root}/landing")
        run_metadata(spark, f"{root}/landing", f"{root}/bronze", f"{root}/progress-{n}", "car_used", files_per_batch=1 + n)
    return _by_month(spark.read.parquet(f"{root}/bronze"))


@query(
    "payload_quarantine",
    """SELECT 'row' AS outcome, count(*) AS n FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT 'malformed JSON', count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'P'""",
)
def payload_quarantine(spark, sf_dir):
    """Records on one line, files spread over many lines, and records cut off."""
    root = fresh_path(spark, "quarantine")
    orders = load(spark, sf_dir, "orders")
    _land_payloads(orders.where("o_orderstatus = 'F'"), "car_used", f"{root}/landing/lines")
    docs = _docs("car_used").alias("docs")
    spread = orders.where("o_orderstatus = 'O'").groupBy("o_orderdate").agg(docs)
    spread = spread.select(F.to_json(F.struct("docs"), {"pretty": "true"}).alias("value"), F.month("o_orderdate").alias("m"), "o_orderdate")
    # One file per value: each folder gets one row per task that holds it.
    one = spread.groupBy("m").agg(F.min("o_orderdate").alias("o_orderdate"))
    first = spread.join(one, ["m", "o_orderdate"])
    first.select("value", "m").repartition("m").write.partitionBy("m").text(f"{root}/landing/spread")
    rest = orders.where("o_orderstatus = 'O'").join(one.select("o_orderdate"), "o_orderdate", "left_anti")
    _land_payloads(rest, "car_used", f"{root}/landing/rest")
    cut = orders.where("o_orderstatus = 'P'").groupBy("o_custkey").agg(docs)
    cut.select(F.substring(F.to_json(F.struct("docs")), 1, 60).alias("value")).write.text(f"{root}/landing/cut")
    run_metadata(spark, f"{root}/landing", f"{root}/bronze", None, "car_used")
    rows = spark.read.parquet(f"{root}/bronze").agg(F.lit("row").alias("outcome"), F.count(F.lit(1)).alias("n"))
    lines = read_rejected_payloads(spark, f"{root}/bronze").select(
        F.col("error").alias("outcome"), F.explode(F.split(F.regexp_replace("record", r"\s+$", ""), "\n")).alias("line")
    )
    return rows.union(lines.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")))


@query(
    "undeclared_fields",
    """SELECT o_orderkey AS id, 'x' || o_orderkey AS extra_field, CAST(o_custkey AS VARCHAR) AS extra_nested,
              o_orderkey + 12 AS price_amount FROM orders""",
)
def undeclared_fields(spark, sf_dir):
    """Fields that no schema declares, at the top and inside a declared object, stay."""
    root = fresh_path(spark, "undeclared")
    doc = _doc("car_used")
    orders = load_spread(spark, sf_dir, "orders", "o_orderkey").withColumn("d", doc)
    price = F.col("d.price").withField("net_amount", F.col("o_custkey"))
    wide = orders.withColumn("d", F.col("d").withField("price", price).withField("extra_field", F.concat(F.lit("x"), "o_orderkey")))
    write_json(wide.select(F.array("d").alias("docs")), f"{root}/landing", gzip=True)
    run_metadata(spark, f"{root}/landing", f"{root}/bronze", None, "car_used")
    return spark.read.parquet(f"{root}/bronze").select(
        "id",
        F.col("other")["extra_field"].alias("extra_field"),
        F.col("other")["price.net_amount"].alias("extra_nested"),
        "price_amount",
    )


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@query("incremental_half_commit", _BY_MONTH)
def incremental_half_commit(spark, sf_dir):
    """A driver lost while a batch commits: some month folders of its files are missing,
    and the progress does not know of it. Every payload has documents of many months."""
    root = fresh_path(spark, "incremental")
    _land_payloads(load(spark, sf_dir, "orders"), "car_used", f"{root}/landing")
    run_metadata(spark, f"{root}/landing", f"{root}/bronze", None, "car_used")
    for lost in ("y=1993", "y=1996/m=5", "y=1998"):
        _remove(spark, f"{root}/bronze/{lost}")
    _remove(spark, f"{root}/bronze_progress")
    run_metadata(spark, f"{root}/landing", f"{root}/bronze", None, "car_used")
    return _by_month(spark.read.parquet(f"{root}/bronze"))


@query(
    "payload_lines",
    """SELECT o_orderkey AS id, CAST(NULL AS VARCHAR) AS error, CAST(NULL AS BIGINT) AS line, true AS numbered
       FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT NULL, 'malformed JSON', 1, true FROM (SELECT DISTINCT o_custkey % 7 FROM orders)""",
)
def payload_lines(spark, sf_dir):
    """Files of one payload per line whose first line is cut off: that line is rejected."""
    root = fresh_path(spark, "lines")
    orders = load(spark, sf_dir, "orders").withColumn("part", F.col("o_custkey") % 7)
    text = F.to_json(F.struct(_docs("car_used").alias("docs")))
    good = orders.where("o_orderstatus <> 'P'").groupBy("part", "o_custkey").agg(text.alias("value"))
    lines = union_all([good, _cut_lines(orders)]).repartition("part").sortWithinPartitions("part", "o_custkey")
    lines.select("value", "part").write.partitionBy("part").text(f"{root}/landing")
    run_metadata(spark, f"{root}/landing", f"{root}/bronze", None, "car_used")
    rows = spark.read.parquet(f"{root}/bronze")
    bad = read_rejected_payloads(spark, f"{root}/bronze")
    return union_all(
        [
            rows.select("id", (F.col("source_line") > 1).alias("numbered")),
            bad.select("error", F.col("source_line").alias("line"), F.lit(True).alias("numbered")),
        ]
    )


def _cut_lines(orders: DataFrame) -> DataFrame:
    """Per part the first 70 signs of a payload. A document takes three signs at least, so
    no more than 24 reach into them, whatever the size of the part."""
    few = orders.withColumn("_n", F.row_number().over(Window.partitionBy("part").orderBy("o_orderkey"))).where("_n <= 24")
    text = F.to_json(F.struct(_docs("car_used").alias("docs")))
    return few.groupBy("part").agg(F.substring(text, 1, 70).alias("value")).withColumn("o_custkey", F.lit(-1).cast("long"))


_CATEGORY_OF = {0: "realestate_homes", 1: "realestate_lettings", 2: "car_used", 3: "job_fulltime", 4: "realestate_newbuildings"}


@query(
    "metadata_categories",
    "SELECT CASE o_custkey % 5 "
    + " ".join(f"WHEN {k} THEN '{c}'" for k, c in _CATEGORY_OF.items())
    + """ END AS category, o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS y,
        CAST(month(o_orderdate) AS INTEGER) AS m, o_orderdate AS "timestamp", true AS stamped FROM orders""",
)
def metadata_categories(spark, sf_dir):
    """All five categories through the plan; rows are stamped with the time of their run."""
    root = fresh_path(spark, "categories")
    orders = load(spark, sf_dir, "orders")
    for k, category in _CATEGORY_OF.items():
        _land_payloads(orders.where(F.col("o_custkey") % 5 == k), category, source_path(f"{root}/landing", "ad_metadata", category))
    before = spark.range(1).select(F.current_timestamp()).first()[0]
    targets = ingest_metadata(spark, f"{root}/landing", f"{root}/bronze")
    within = (F.col("ingestion_ts") >= F.lit(before)) & (F.col("ingestion_ts") <= F.current_timestamp())
    tables = [
        spark.read.parquet(path).select(F.lit(category).alias("category"), "id", "y", "m", "timestamp", within.alias("stamped"))
        for category, path in targets.items()
    ]
    return _plain(union_all(tables))


@query("nested_bronze", _flat_sql("car_used", lean=False))
def nested_bronze(spark, sf_dir):
    """The table that keeps every field, written by the plan below ``_y`` and ``_m``."""
    root = fresh_path(spark, "nested")
    _land_payloads(load_spread(spark, sf_dir, "orders", "o_orderkey"), "car_used", source_path(f"{root}/landing", "ad_metadata", "car_used"))
    targets = ingest_metadata(spark, f"{root}/landing", f"{root}/bronze", ["SEARCH_ID_CAR_USED"], keep_nested=True)
    table = spark.read.parquet(targets["car_used"])
    return _plain(table.drop("metadata", "other", "source_line", "source_doc"))


@query(
    "field_registry",
    """SELECT 'extra_field' AS field, 'string' AS kind, count(*) AS n, true AS once FROM orders
       UNION ALL SELECT 'price.net_amount', 'bigint', count(*), true FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'late_list', 'array', count(*), true FROM orders WHERE o_orderstatus <> 'F'""",
)
def field_registry(spark, sf_dir):
    """Names, kinds and counts of undeclared fields over two batches, one of which brings
    a new field."""
    root = _wide_payloads(spark, sf_dir)
    seen = known_fields(spark, f"{root}/bronze")
    return seen.select("field", "kind", "n", ((F.col("first_seen") < F.col("last_seen")) == (F.col("field") == "extra_field")).alias("once"))


@query(
    "registered_columns",
    """SELECT o_orderkey AS id, 'x' || o_orderkey AS other_extra_field,
              CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS "other_price.net_amount",
              CASE WHEN o_orderstatus <> 'F' THEN '[' || o_custkey || ']' END AS other_late_list FROM orders""",
)
def registered_columns(spark, sf_dir):
    """The registered fields as columns; no pass over the data for their names."""
    root = _wide_payloads(spark, sf_dir)
    table = spark.read.parquet(f"{root}/bronze").select("id", "other")
    return with_fields(table, "other", f"{root}/bronze", drop=True)


def _wide_payloads(spark: SparkSession, sf_dir: str) -> str:
    root = fresh_path(spark, "registry")
    orders = load_spread(spark, sf_dir, "orders", "o_orderkey").withColumn("d", _doc("car_used"))
    extra = F.col("d").withField("extra_field", F.concat(F.lit("x"), "o_orderkey"))
    first = extra.withField("price", F.col("d.price").withField("net_amount", F.col("o_custkey")))
    second = extra.withField("late_list", F.array("o_custkey"))
    for where, doc in (("o_orderstatus = 'F'", first), ("o_orderstatus <> 'F'", second)):
        write_json(orders.where(where).select(F.array(doc).alias("docs")), f"{root}/landing", gzip=True)
        run_metadata(spark, f"{root}/landing", f"{root}/bronze", None, "car_used")
    return root


@query("ledger_discovery", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def ledger_discovery(spark, sf_dir):
    """Batch discovery: a second pass sees only the files of the second arrival."""
    root = fresh_path(spark, "ledger")
    orders = load(spark, sf_dir, "orders")
    found = []
    for arrival in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        append_parquet(orders.where(arrival), f"{root}/files")
        ledger = read_or_empty(spark, f"{root}/ledger", "path string, done_at timestamp")
        files = new_files(list_files(spark, f"{root}/files").where("path like '%.parquet'"), ledger)
        rows = with_source_file(spark.read.parquet(f"{root}/files"), "path")
        out = f"{root}/out-{len(found)}"
        rows.join(files, "path", "left_semi").write.parquet(out)
        mark_done(files, f"{root}/ledger")
        found.append(spark.read.parquet(out))
    return union_all(found).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "full_vs_incremental",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS n, max(event_id) AS last_id
       FROM events GROUP BY ALL""",
)
def full_vs_incremental(spark, sf_dir):
    """Full build of the first part, then only the rows above the mark, then the
    touched days again: the same table as one full build."""
    path = fresh_path(spark, "rebuild")
    events = load(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    rebuild(events.where("ts < timestamp_ntz '2024-01-12 07:00:00'"), path, ("day",))
    stored = spark.read.parquet(path)
    rows = rows_after(events, "ts", high_water_mark(stored, "ts"), stored, ["event_id"])
    append_partitioned(rows, path, ("day",))
    replace_partitions(events.where("day >= date '2024-01-20'"), path, ("day",))
    return spark.read.parquet(path).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id")
    )


@query(
    "category_selection",
    """SELECT event_type, '1' AS flag, count(*) AS n FROM events
       WHERE event_type IN ('click', 'error') AND CAST(ts AS DATE) = DATE '2024-01-05'
       GROUP BY event_type
       UNION ALL
       SELECT event_type, '' AS flag, count(*) AS n FROM events
       WHERE event_type IN ('click', 'error') GROUP BY event_type""",
)
def category_selection(spark, sf_dir):
    chosen = select_categories(load(spark, sf_dir, "events"), "event_type", ["click", "error"])

    def counted(flag: str) -> DataFrame:
        rows = published_on(chosen, flag, "2024-01-05", "ts").withColumn("today_only", F.lit(flag == "1"))
        return rows.groupBy("event_type", published_flag(F.col("today_only")).alias("flag")).agg(
            F.count(F.lit(1)).alias("n")
        )

    return counted("1").unionByName(counted(""))


@query(
    "distinct_counts",
    """SELECT 'events' AS source, count(*) AS n, count(DISTINCT user_id) AS ids FROM events
       UNION ALL SELECT 'documents', count(*), count(DISTINCT text) FROM documents
       UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey) FROM orders""",
)
def distinct_counts(spark, sf_dir):
    def one(name: str, key: str) -> DataFrame:
        return load(spark, sf_dir, name).agg(
            F.lit(name).alias("source"), F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("ids")
        )

    return one("events", "user_id").union(one("documents", "text")).union(one("orders", "o_custkey"))


@query(
    "distinct_counts_merged",
    """SELECT 'events' AS source, 'all' AS range, count(*) AS n, true AS within FROM events
       UNION ALL SELECT 'events', 'part', count(*), true FROM events WHERE day(ts) BETWEEN 3 AND 12
       UNION ALL SELECT 'documents', 'all', count(*), true FROM documents
       UNION ALL SELECT 'orders', 'all', count(*), true FROM orders
       UNION ALL SELECT 'orders', 'part', count(*), true FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996""",
)
def distinct_counts_merged(spark, sf_dir):
    """Sketches stored per period, merged for a range: within 2 % of the exact count."""

    def one(name: str, value: str, period: Column, part: str | None) -> list[DataFrame]:
        path = fresh_path(spark, f"sketches-{name}")
        rows = load(spark, sf_dir, name).withColumn("period", period)
        append_parquet(period_sketches(rows, ["period"], {"ids": F.col(value)}), path)
        found = []
        for label, where in (("all", "true"), ("part", part)):
            if where is None:
                continue
            exact = rows.where(where).agg(F.count_distinct(value).alias("exact"))
            merged = merged_counts(spark.read.parquet(path).where(where), ["ids"]).join(F.broadcast(exact))
            within = F.abs(F.col("ids") - F.col("exact")) <= F.col("exact") * 0.02
            found.append(merged.select(F.lit(name).alias("source"), F.lit(label).alias("range"), F.col("rows").alias("n"), within.alias("within")))
        return found

    return union_all(
        [
            *one("events", "user_id", F.dayofmonth("ts"), "period between 3 and 12"),
            *one("documents", "text", F.col("lang"), None),
            *one("orders", "o_custkey", F.year("o_orderdate"), "period between 1994 and 1996"),
        ]
    )


@query(
    "decode_base64",
    """SELECT c_custkey, c_name AS decoded, c_mktsegment AS table_name, 'sales' AS schema_name,
              lower(c_mktsegment) AS category FROM customer""",
)
def decode_base64(spark, sf_dir):
    fqn = F.concat(F.lit("db.sales."), "c_mktsegment")
    return load(spark, sf_dir, "customer").select(
        "c_custkey",
        base64_text(F.base64(F.encode("c_name", "UTF-8"))).alias("decoded"),
        table_of(fqn).alias("table_name"),
        schema_of(fqn).alias("schema_name"),
        category_of_search_key(F.concat(F.lit("SEARCH_ID_"), "c_mktsegment")).alias("category"),
    )


@query("normalize_by_search_key", _flat_sql("job_fulltime", lean=True))
def normalize_by_search_key(spark, sf_dir):
    path = fresh_path(spark, "by-key")
    _land_payloads(load_spread(spark, sf_dir, "orders", "o_orderkey"), "job_fulltime", path)
    docs = read_payloads(spark, path, "job_fulltime", lean=True).select(F.explode("docs").alias("doc"), "source_file")
    return _plain(normalize_search_key(docs.select("doc.*", "source_file"), "SEARCH_ID_JOB_FULLTIME"))


@query(
    "lenient_epoch",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS deadline FROM orders""",
)
def lenient_epoch(spark, sf_dir):
    """Text that is no number of milliseconds becomes NULL."""
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    text = F.when(F.col("o_orderstatus") == "F", ms).when(F.col("o_orderstatus") == "O", F.lit("soon"))
    orders = load(spark, sf_dir, "orders")
    return _plain(orders.select("o_orderkey", epoch_ms_or_null(text).alias("deadline")))


@query(
    "null_counts",
    """SELECT count(*) FILTER (o_orderstatus = 'F') AS status, count(*) FILTER (o_totalprice > 100000) AS price,
              CAST(0 AS BIGINT) AS o_orderkey FROM orders""",
)
def null_counts_query(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.when(F.col("o_totalprice") <= 100000, F.col("o_totalprice")).alias("price"),
    )
    return null_counts(rows, ["o_orderkey", "status", "price"])


@query(
    "conform_job_metadata",
    """SELECT o_orderkey AS id, 'job' AS "type", 'key' AS main_search_key, o_orderstatus AS heading, NULL::VARCHAR AS location,
              o_orderdate AS "timestamp", o_custkey AS ad_type, 'u' || o_orderkey AS canonical_url, 'title' AS job_title,
              o_orderdate AS published, NULL::VARCHAR AS company_name, o_custkey % 7 AS no_of_positions,
              NULL::TIMESTAMP AS deadline, o_totalprice AS longitude, NULL::DOUBLE AS latitude, o_orderdate AS created_at,
              o_orderkey AS ad_id, '0.1' AS occupation FROM orders""",
)
def conform_job_metadata(spark, sf_dir):
    """A declared table: order, types, optional columns added, surplus ones dropped."""
    orders = load(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("timestamp")
    rows = orders.select(
        F.lit("0.1").alias("occupation"), F.col("o_orderkey").cast("string").alias("id"), F.lit("job").alias("type"),
        F.lit("key").alias("main_search_key"), F.col("o_orderstatus").alias("heading"), day.alias("timestamp"),
        F.col("o_custkey").alias("ad_type"), F.concat(F.lit("u"), "o_orderkey").alias("canonical_url"),
        F.lit("title").alias("job_title"), day.alias("published"), (F.col("o_custkey") % 7).cast("string").alias("no_of_positions"),
        F.col("o_totalprice").alias("longitude"), day.alias("created_at"), F.col("o_orderkey").alias("ad_id"), F.lit(1).alias("surplus"),
    )
    return _plain(conform(rows, JOB_METADATA_DDL))
