"""Landing and bronze readers."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from adloom.functions.values import split_table_name
from adloom.operators.joins import fits_broadcast, lookup_join
from adloom.schemas import AD_HTML_DDL, AD_URLS_DDL, payload_schema
from adloom.storage import materialize

# Where each landing table lives below the lake root.
SOURCES = {
    "ad_metadata": "{category}/ad_metadata",
    "ad_html": "{category}/ad_html",
    "ad_urls": "{category}/ad_urls",
    "stopwords": "stopwords",
    "food_prices": "food_prices",
}


def source_path(root: str, source: str, category: str = "") -> str:
    return f"{root.rstrip('/')}/{SOURCES[source].format(category=category)}"


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Lineage: the file each row was read from. Apply directly on a file scan."""
    return df.select("*", F.col("_metadata.file_path").alias(name))


def text_lines(df: DataFrame) -> DataFrame:
    """Lines (``value``) of a text scan with their file, its size, the block of the file a
    line was read from, and a number that rises with the lines of a block. Apply directly
    on the scan. A plain file is read by many tasks, a gzipped one by one."""
    return df.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    )


def dealt(lines: DataFrame) -> DataFrame:
    """Lines that stand in few splits, dealt over all cores: a gzipped file is one split
    however long it is, and parsing takes longer than unpacking. The place of a line says
    where it goes, so a task that runs again finds its lines again."""
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines if lines.rdd.getNumPartitions() >= cores else lines.repartition(cores, "source_file", "_seq")


def line_starts(lines: DataFrame, is_payload: Column) -> DataFrame:
    """Per block of a file what ``numbered`` and ``single_documents`` ask of its lines, found
    in one pass: the line before its first one, whether any line is a payload, the file's size."""
    blocks = lines.groupBy("source_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"), F.max("_size").alias("_size"), F.bool_or(is_payload).alias("_by_line")
    )
    before = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(blocks.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "line-starts")


def numbered(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """``source_line``, the position of a line in its file from 1 on, in place of ``_block``
    and ``_seq``. It does not depend on how the files were cut into blocks, so a repeated
    run gives a line the same number. ``starts`` are those of all ``lines``."""
    firsts = starts.select("source_file", "_block", "_first", "_start")
    placed = lookup_join(lines, firsts, ["source_file", "_block"], "inner", spread_by=["_seq"])
    line = F.col("_start") + F.col("_seq") - F.col("_first") + 1
    return placed.withColumn("source_line", line).drop("_block", "_seq", "_start", "_first")


# A single document is one string; a file beyond this many bytes is lines whatever it holds.
WHOLE_FILE_BYTES = 256 << 20


def whole_files(spark: SparkSession, names: list[str]) -> DataFrame:
    """Files (named as the scan names them) as one ``value`` each."""
    # Names are encoded, and the reader takes some signs for patterns.
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(name)) for name in names]
    return with_source_file(spark.read.text(paths, wholetext=True)) if paths else spark.createDataFrame([], "value string, source_file string")


def single_documents(lines: DataFrame, is_payload: Column) -> list[str]:
    """Names of the files in which no line is a payload by itself: each is one document, or
    nothing that can be read. A file of which only some lines are broken is not one of
    them. One name per such file reaches the driver, as the listing of the files does."""
    files = lines.groupBy("source_file").agg(F.bool_or(is_payload).alias("by_line"), F.max("_size").alias("size"))
    found = files.where(~F.coalesce("by_line", F.lit(False)) & (F.col("size") <= WHOLE_FILE_BYTES))
    return sorted(r.source_file for r in found.select("source_file").collect())


def _not_in_files(lines: DataFrame, names: list[str]) -> DataFrame:
    if not names:
        return lines
    files = lines.sparkSession.createDataFrame([(n,) for n in names], "source_file string")
    return lines.join(F.broadcast(files) if fits_broadcast(files) else files, "source_file", "left_anti")


_BLANK_LINE = r"^\s*$"


def _once(value: Column, name: str) -> Column:
    """``value`` as one column of every row, evaluated once. A later filter on it is not
    moved below it, which would repeat an expensive expression for each time it is named."""
    return F.explode(F.array(value)).alias(name)


def parse_payloads(records: DataFrame, category: str, lean: bool = False, keep_other: bool = False) -> DataFrame:
    """Typed payloads of ``records`` with ``error`` where a record is no payload.

    A value of a wrong type costs that value only. ``keep_other`` adds to every document
    the fields that the category does not declare, as ``other`` (path -> text).
    """
    schema = payload_schema(category, lean)
    broken = "_corrupt"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    carried = [c for c in records.columns if c not in ("record", "source_file")]
    parsed = records.select("*", _once(F.from_json("record", T.StructType([*schema.fields, T.StructField(broken, T.StringType())]), options), "_p"))
    fields = [F.col("_p")[f.name].alias(f.name) for f in schema.fields]
    # Partial results keep the fields; a record that is no JSON object keeps none.
    unread = F.col("_p").isNull() | (F.col("_p")[broken].isNotNull() & F.col("_p.docs").isNull())
    error = F.when(unread, F.when(~F.col("record").rlike(r"\S"), "empty file").otherwise("malformed JSON"))
    if keep_other:
        raw = F.from_json("record", "docs array<map<string,string>>")["docs"]
        fields.append(F.transform(raw, lambda doc: undeclared(doc, payload_schema(category, False)["docs"].dataType.elementType)).alias("_other"))
    # The text of a record is only carried on where it was not read.
    return parsed.select(*fields, "source_file", *carried, F.when(unread, F.col("record")).alias("record"), error.alias("error"))


def undeclared(doc: Column, schema: T.StructType) -> Column:
    """Fields of a document (name -> text) that ``schema`` lacks; those of a declared
    object as ``object.field``."""
    def without(fields: Column, names: list[str]) -> Column:
        return F.map_filter(fields, lambda key, _: ~key.isin(names))

    def inside(field: T.StructField) -> Column:
        fields = F.from_json(F.try_element_at(doc, F.lit(field.name)), "map<string,string>")
        named = F.transform_keys(
            without(fields, field.dataType.fieldNames()), lambda key, _: F.concat(F.lit(f"{field.name}."), key)
        )
        return F.coalesce(named, F.create_map().cast("map<string,string>"))

    objects = [f for f in schema.fields if isinstance(f.dataType, T.StructType)]
    return F.map_concat(without(doc, schema.fieldNames()), *map(inside, objects))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON records of plain or gzipped files: the lines of files that hold a payload per
    line, and whole files that hold one document.

    Which is which is found by one pass over the lines that parses nothing."""
    lines = text_lines(spark.read.text(path, recursiveFileLookup=True))
    # Patterns go through a long line character by character: most lines are known without.
    value = F.col("value")
    braced = (value.startswith("{") & value.endswith("}")) | value.rlike(r"(?s)^\s*\{.*\}\s*$")
    looks_whole = F.contains(value, F.lit('"docs"')) & braced
    whole = single_documents(lines, looks_whole)
    by_line = _not_in_files(lines, whole).where(value.startswith("{") | ~value.rlike(_BLANK_LINE))
    return by_line.unionByName(whole_files(spark, whole), allowMissingColumns=True).select(F.col("value").alias("record"), "source_file")


def parse_landed(lines: DataFrame, category: str, lean: bool = False, keep_other: bool = False) -> DataFrame:
    """``parse_payloads`` of landed lines (``text_lines``), written once, with
    ``source_line``: the line of the file, 0 where the file is one document. Lines that are
    no payload are errors of their own, also the first of a file."""
    spark = lines.sparkSession
    parsed = materialize(parse_payloads(dealt(lines).withColumnRenamed("value", "record"), category, lean, keep_other), "payloads")
    starts = line_starts(parsed, F.col("error").isNull())
    whole = single_documents(starts, F.col("_by_line"))
    documents = whole_files(spark, whole).select(F.col("value").alias("record"), "source_file", F.lit(0).cast("long").alias("source_line"))
    documents = materialize(parse_payloads(documents, category, lean, keep_other), "payloads") if whole else None
    read = _not_in_files(numbered(parsed.drop("_size"), starts), whole).where("record is null or record rlike '\\\\S'")
    return read if documents is None else read.unionByName(documents)


def read_payloads(spark: SparkSession, path: str, category: str, lean: bool = False, keep_other: bool = False) -> DataFrame:
    """Search payloads; records that cannot be parsed are left to ``rejected_payloads``."""
    parsed = parse_payloads(read_records(spark, path), category, lean, keep_other)
    return parsed.where("error is null").drop("record", "error")


def rejected_payloads(spark: SparkSession, path: str, category: str) -> DataFrame:
    parsed = parse_payloads(read_records(spark, path), category)
    return parsed.where("error is not null").select("source_file", "record", "error")


def read_payload_variants(spark: SparkSession, path: str) -> DataFrame:
    """The same for payloads of unknown shape: one VARIANT per document."""
    raw = read_records(spark, path).select(_once(F.try_parse_json("record"), "payload"), "source_file")
    docs = F.try_variant_get("payload", "$.docs", "array<variant>")
    return raw.select(F.explode(docs).alias("doc"), "source_file")


def read_parquet_files(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = with_source_file(spark.read.parquet(path))
    return df.select(*columns) if columns else df


def read_months(
    spark: SparkSession,
    root: str,
    first: tuple[int, int] | None = None,
    last: tuple[int, int] | None = None,
    names: tuple[str, str] = ("y", "m"),
    schema: str | StructType | None = None,
) -> DataFrame:
    """Partitioned parquet, columns united by name, limited to a month range.

    The range is written on the partition columns themselves so that it prunes
    directories before any file is opened. With a declared ``schema`` no file
    footers are merged: a column that a file lacks is NULL.
    """
    y, m = (F.col(n) for n in names)
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    df = reader.parquet(root)
    if first:
        df = df.where((y > first[0]) | ((y == first[0]) & (m >= first[1])))
    if last:
        df = df.where((y < last[0]) | ((y == last[0]) & (m <= last[1])))
    return df


def read_recursive(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(root)


def read_word_lists(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Files that each hold one JSON array of words (or one array per line): one
    row per word."""
    raw = with_source_file(spark.read.text(path, wholetext=not one_per_line))
    words = F.from_json("value", "array<string>")
    return raw.select(F.explode(words).alias("stopword"), "source_file")


def unless_missing(read):
    """The result of ``read()``, or None when its path does not exist yet. Any other
    error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A parquet source that may not exist yet counts as empty."""
    found = unless_missing(lambda: spark.read.schema(ddl).parquet(path))
    return spark.createDataFrame([], ddl) if found is None else found


def read_ad_urls(spark: SparkSession, root: str, category: str) -> DataFrame:
    return read_or_empty(spark, source_path(root, "ad_urls", category), AD_URLS_DDL)


def read_ad_html(spark: SparkSession, root: str, category: str) -> DataFrame:
    return read_or_empty(spark, source_path(root, "ad_html", category), AD_HTML_DDL)


# Quotes are doubled inside quoted values; an empty value is quoted, NULL is not.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

_EMPTY = "\u0000empty"


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with a header, columns by name in any order, values over several lines. A
    column the files lack is NULL."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # The reader would take an empty value for NULL once more, so it gets a name.
    raw = spark.read.options(**CSV_OPTIONS | {"emptyValue": _EMPTY}).option("multiLine", True).csv(path)

    def column(name: str) -> Column:
        value = F.col(f"`{name}`")
        return F.when(value == _EMPTY, "").otherwise(value) if name in raw.columns else F.lit(None)

    return raw.select(*(column(f.name).try_cast(f.dataType).alias(f.name) for f in wanted.fields))


# A record ends at a line break outside quotes.
_CSV_RECORD = r'((?:[^"\r\n]|"(?:[^"]|"")*")+)'


def parse_csv_payload(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """A CSV document held in a column (header first) to one row per record; columns by
    the header's names, in any order."""
    kept = [c for c in df.columns if c != column]
    records = F.regexp_extract_all(F.col(column), F.lit(_CSV_RECORD), F.lit(1))
    rows = df.select(*kept, F.get(records, F.lit(0)).alias("_head"), F.posexplode(F.slice(records, F.lit(2), F.size(records))).alias("_at", "_line"))
    names = F.transform(F.split("_head", ","), lambda n: F.lower(F.trim(F.btrim(F.trim(n), F.lit('"')))))
    cells = F.regexp_extract_all(F.concat(F.lit(","), F.col("_line")), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    plain = F.transform(
        cells,
        lambda c: F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).when(c != "", c),
    )
    rows = rows.select(*kept, (F.col("_at") + 1).alias("line_no"), F.map_from_arrays(names, F.slice(F.concat(plain, F.array_repeat(F.lit(None).cast("string"), F.size(names))), F.lit(1), F.size(names))).alias("_r"))
    fields = T.StructType.fromDDL(ddl).fields
    return rows.select(*kept, "line_no", *(F.try_element_at("_r", F.lit(f.name.lower())).try_cast(f.dataType).alias(f.name) for f in fields))


# Fixed value: ``.../{category}/{chain_id}_{uuid}.json[.gz]``.
_LANDING_NAME = r"([^/]+)/([^/_]+)_[^/]*\.json(?:\.gz)?$"


def with_landing_columns(df: DataFrame, path: str = "source_file") -> DataFrame:
    """Category and chain as encoded in a landing object's name."""
    return df.withColumns(
        {
            "category": F.regexp_extract(path, _LANDING_NAME, 1),
            "chain_id": F.regexp_extract(path, _LANDING_NAME, 2),
        }
    )


def read_category_landing(spark: SparkSession, path: str) -> DataFrame:
    """JSON objects of unknown shape with their landing columns; the payload stays
    a VARIANT."""
    raw = spark.read.option("singleVariantColumn", "payload").option("recursiveFileLookup", True).json(path)
    return with_landing_columns(with_source_file(raw))


def union_pages(pages: DataFrame, page: str = "page", last: str = "last") -> DataFrame:
    """Documents of all landed result pages. What was landed stays, also a page without
    paging data or beyond the last one that the search offers by now; ``more_pages`` says
    what is left to fetch. A page that was landed twice is left to the deduplication."""
    rest = [c for c in pages.columns if c != "docs"]
    return pages.select(F.explode("docs").alias("doc"), *rest)


def more_pages(pages: DataFrame, by: list[str], page: str = "page", last: str = "last") -> DataFrame:
    """(by, page): pages that a search offers and that were not landed. The latest known
    ``last`` counts; without paging data there is one page."""
    offered = pages.groupBy(*by).agg(F.greatest(F.max(last), F.lit(1)).alias("_last"))
    wanted = offered.select(*by, F.explode(F.sequence(F.lit(1), F.col("_last").cast("int"))).alias(page))
    same = [wanted[c].eqNullSafe(pages[c]) for c in by] + [wanted[page] == pages[page]]
    return wanted.join(pages, same, "left_anti")


def read_table_jdbc(
    spark: SparkSession,
    url: str,
    table_fqn: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """A relational table, read in parallel ranges of ``partition_column`` (a
    number, such as the primary key). Without one a single task reads the table,
    which only suits small tables. Unknown bounds are asked from the database."""
    schema, table = split_table_name(table_fqn)
    source = spark.read.format("jdbc").options(url=url, **(properties or {}))
    if partition_column is None:
        return source.option("dbtable", f"{schema}.{table}").load()
    if bounds is None:
        ends = f"SELECT min({partition_column}) AS low, max({partition_column}) AS high FROM {schema}.{table}"
        low, high = source.option("query", ends).load().first()
        bounds = (int(low or 0), int(high or 0))
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=f"{schema}.{table}", **(properties or {}))
        .options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1] + 1),
            numPartitions=str(partitions),
        )
        .load()
    )
