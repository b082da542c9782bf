"""Declared shapes: search payloads per category, landing and bronze tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def _list(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


# --- Fixed values: recorded payload shapes -----------------------------------
# `id` arrives as a JSON string in some payloads and a number in others; it is
# read as text and cast when flattened.
_IMAGE = _struct(url=S, path=S, height=L, width=L, aspect_ratio=D)
_LINK = _struct(url=S, path=S)
_POINT = _struct(lat=D, lon=D)
_LABELS = _list(_struct(id=S, text=S, type=S))
_PRICE = _struct(amount=L, currency_code=S, price_unit=S)
_PRICE_RANGE = _struct(amount_from=L, amount_to=L, currency_code=S)
_AREA = _struct(size=L, unit=S, description=S)
_AREA_RANGE = _struct(size_from=L, size_to=L, unit=S, description=S)
_BEDROOMS = _struct(start=L, end=L)

CATEGORY_SCHEMAS = {
    "car_used": _struct(
        type=S,
        id=S,
        main_search_key=S,
        heading=S,
        location=S,
        image=_IMAGE,
        flags=_list(S),
        timestamp=L,
        coordinates=_POINT,
        ad_type=L,
        labels=_LABELS,
        canonical_url=S,
        extras=_list(S),
        price=_PRICE,
        year=L,
        mileage=D,
        dealer_segment=S,
        warranty_duration=L,
        service_documents=_list(S),
        regno=S,
        ad_id=L,
        organisation_name=S,
    ),
    "job_fulltime": _struct(
        type=S,
        id=S,
        main_search_key=S,
        heading=S,
        location=S,
        flags=_list(S),
        timestamp=L,
        coordinates=_POINT,
        ad_type=L,
        labels=_LABELS,
        canonical_url=S,
        extras=_list(S),
        logo=_LINK,
        job_title=S,
        deadline=L,
        published=L,
        company_name=S,
        no_of_positions=L,
        ad_id=L,
        image=_LINK,
    ),
    "realestate_homes": _struct(
        type=S,
        id=S,
        main_search_key=S,
        heading=S,
        location=S,
        image=_IMAGE,
        flags=_list(S),
        styling=_list(S),
        timestamp=L,
        labels=_LABELS,
        canonical_url=S,
        extras=_list(S),
        logo=_LINK,
        price_suggestion=_PRICE,
        price_total=_PRICE,
        price_shared_cost=_PRICE,
        area_range=_AREA_RANGE,
        area_plot=_AREA,
        organisation_name=S,
        local_area_name=S,
        number_of_bedrooms=L,
        owner_type_description=S,
        property_type_description=S,
        viewing_times=_list(S),
        coordinates=_POINT,
        ad_type=L,
        image_urls=_list(S),
        ad_id=L,
        price_range_suggestion=_PRICE_RANGE,
        price_range_total=_PRICE_RANGE,
        bedrooms_range=_BEDROOMS,
        area=_AREA,
    ),
    "realestate_lettings": _struct(
        type=S,
        id=S,
        main_search_key=S,
        heading=S,
        location=S,
        image=_IMAGE,
        flags=_list(S),
        styling=_list(S),
        timestamp=L,
        labels=_LABELS,
        canonical_url=S,
        extras=_list(S),
        price_suggestion=_PRICE,
        price_total=_PRICE,
        price_shared_cost=_PRICE,
        area_range=_AREA_RANGE,
        area_plot=_AREA,
        local_area_name=S,
        number_of_bedrooms=L,
        property_type_description=S,
        viewing_times=_list(S),
        coordinates=_POINT,
        ad_type=L,
        image_urls=_list(S),
        furnished_state=S,
        ad_id=L,
        logo=_LINK,
        organisation_name=S,
        area=_AREA,
    ),
    # No recorded shape exists for new buildings: the shared fields plus the
    # nested columns its normaliser expands.
    "realestate_newbuildings": _struct(
        type=S,
        id=S,
        main_search_key=S,
        heading=S,
        location=S,
        image=_IMAGE,
        flags=_list(S),
        timestamp=L,
        labels=_LABELS,
        canonical_url=S,
        extras=_list(S),
        price_suggestion=_PRICE,
        price_total=_PRICE,
        price_shared_cost=_PRICE,
        area_range=_AREA_RANGE,
        area_plot=_AREA,
        coordinates=_POINT,
        ad_type=L,
        ad_id=L,
        bedrooms_range=_BEDROOMS,
    ),
}

# Columns that hold epoch milliseconds in the payload.
EPOCH_MS_COLUMNS = ("timestamp", "deadline", "published")

# Nested columns each category expands into `column_key` columns.
NESTED_COLUMNS = {
    "realestate_homes": [
        "price_suggestion",
        "price_total",
        "price_shared_cost",
        "area_range",
        "area_plot",
        "price_range_suggestion",
        "price_range_total",
        "bedrooms_range",
    ],
    "realestate_lettings": [
        "price_suggestion",
        "price_total",
        "price_shared_cost",
        "area_range",
        "area_plot",
    ],
    "car_used": ["price"],
    "job_fulltime": [],
    "realestate_newbuildings": [
        "price_suggestion",
        "price_total",
        "price_shared_cost",
        "area_range",
        "area_plot",
        "bedrooms_range",
    ],
}

# Columns the lean bronze table leaves out.
REDUNDANT_COLUMNS = [
    "image",
    "flags",
    "labels",
    "extras",
    "service_documents",
    "logo",
    "styling",
    "viewing_times",
    "image_urls",
    "area",
]

# Job types by page layout.
ARTICLE_JOB_TYPES = ("fulltime", "management", "parttime")
POSITION_JOB_TYPES = ("positions",)

AD_URLS_DDL = "id string, timestamp bigint, canonical_url string, occupation string, ingeston_ts timestamp"
AD_HTML_DDL = "html_main string, id string, ingestion_ts timestamp"
STOPWORDS_DDL = "stopword string"
PAYLOAD_REJECTS_DDL = "source_file string, source_line bigint, record string, error string"
CONTENT_REJECTS_DDL = "id string, canonical_url string, job_type string, error string, html_main string, html_hash string"

# Declared nullability of the two relational job tables.
JOB_METADATA_DDL = """
    id bigint not null, type string not null, main_search_key string not null,
    heading string not null, location string, timestamp timestamp not null,
    ad_type bigint not null, canonical_url string not null, job_title string not null,
    published timestamp not null, company_name string, no_of_positions bigint,
    deadline timestamp, longitude double, latitude double,
    created_at timestamp not null, ad_id bigint not null, occupation string not null"""

JOB_CONTENT_DDL = """
    id bigint not null, keywords string, nettverk string, sektor string, bransje string,
    stillingsfunksjon string, `arbeidsspråk` string, job_title string,
    content string not null, created_at timestamp not null, hjemmekontor string,
    flere_arbeidssteder string, arbeidsgiver string, frist string,
    ansettelsesform string, sted string, antall_stillinger bigint,
    lederkategori string, stillingstittel string"""

# Relational export: columns with their target types, in table order.
EXPORT_TABLES = {
    "keywords": "id INT, keyword STRING",
    "employers": "id INT, company_name STRING, bransje STRING, sektor STRING",
    "stillingsfunksjon": "id INT, stillingsfunksjon STRING",
    "ads_with_id": (
        "ad_id STRING, canonical_url STRING, heading STRING, location STRING, "
        "job_title STRING, employer_id INT, no_of_positions INT, published TIMESTAMP, "
        "article_header STRING, article_content STRING, keyword_bridge_id STRING, "
        "timestamp TIMESTAMP, job_type STRING, stillingsfunksjon_bridge_id STRING"
    ),
    "ngrams": (
        "id BIGINT, words STRING, ngram_size INT, ad_id STRING, keyword_bridge_id STRING, "
        "stillingsfunksjon_bridge_id STRING, employer_id INT"
    ),
    "keyword_ads_bridge": "id STRING, ad_id STRING, keyword_id INT",
    "stillingsfunksjon_ads_bridge": "id STRING, ad_id STRING, stillingsfunksjon_id INT",
}
EXPORT_UNIQUE = {
    "keywords": ["keyword"],
    "employers": ["company_name"],
    "stillingsfunksjon": ["stillingsfunksjon"],
}
EXPORT_INDEXES = {
    "keywords": ["keyword"],
    "employers": ["company_name"],
    "stillingsfunksjon": ["stillingsfunksjon"],
    "ads_with_id": ["ad_id"],
    "ngrams": ["words", "ad_id"],
}
# --- End of fixed values ------------------------------------------------------


def doc_schema(category: str) -> T.StructType:
    if category not in CATEGORY_SCHEMAS:
        raise ValueError(f"unknown category: {category}")
    return CATEGORY_SCHEMAS[category]


def payload_schema(category: str, lean: bool = False) -> T.StructType:
    """One landing file is one JSON object: the documents plus paging facts. ``lean``
    leaves out what the lean bronze table drops, so the scan does not parse it."""
    docs = doc_schema(category)
    if lean:
        docs = T.StructType([f for f in docs.fields if f.name not in REDUNDANT_COLUMNS])
    metadata = _struct(paging=_struct(current=L, last=L), title=S)
    return _struct(docs=_list(docs), metadata=metadata)
