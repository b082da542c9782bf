"""Column expressions for time, ids, codes, URLs and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Food category codes and their labels.
FOOD_CATEGORIES = {
    "bakery": "Bakeri",
    "bakerywares": "Bakevarer og kjeks",
    "kids_products": "Barneprodukter",
    "flowers_plants": "Blomster og planter",
    "desserts": "Dessert og iskrem",
    "drinks": "Drikke",
    "animals": "Dyr",
    "fish": "Fisk & skalldyr",
    "fruits_veggies": "Frukt & grønt",
    "home": "Hus & hjem",
    "kiosk_wares": "Kioskvarer",
    "meat": "Kjøtt",
    "chicken": "Kylling og fjærkre",
    "dairy_egg": "Meieri & egg",
    "dinner": "Middag",
    "dinner_addition": "Middagstilbehør",
    "cheese": "Ost",
    "personal": "Personlige artikler",
    "toppings": "Pålegg & frokost",
    "snacks_candy": "Snacks & godteri",
}
# Fixed value: the prefix of a search key.
SEARCH_KEY_PREFIX = "SEARCH_ID_"


def epoch_ms(value: Column) -> Column:
    return F.timestamp_millis(value)


def epoch_ms_or_null(value: Column) -> Column:
    """Values that are no whole number of milliseconds become NULL."""
    return F.timestamp_millis(value.try_cast("bigint"))


def year_of(ts: Column) -> Column:
    return F.year(ts).cast("int")


def month_of(ts: Column) -> Column:
    return F.month(ts).cast("int")


def joined_key(*parts: Column) -> Column:
    """``a_b`` keys; a missing part counts as empty text."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def category_of_search_key(key: Column) -> Column:
    return F.lower(F.replace(key, F.lit(SEARCH_KEY_PREFIX), F.lit("")))


def category_name(search_key: str) -> str:
    return search_key.replace(SEARCH_KEY_PREFIX, "").lower()


def food_label(code: Column) -> Column:
    pairs = [F.lit(x) for item in FOOD_CATEGORIES.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), code)


def url_segment(url: Column, index: int) -> Column:
    """Path segment of a URL (``/job/fulltime/x`` -> 2 is ``fulltime``), else NULL."""
    return F.get(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), index)


def job_type_of_url(url: Column) -> Column:
    return url_segment(url, 2)


def ad_type_of_url(url: Column) -> Column:
    return F.when(url.contains("position"), "position").otherwise("other")


def published_flag(param: Column) -> Column:
    """``false`` means no restriction (empty), anything else ``1``."""
    return F.when(F.lower(param.cast("string")) == "false", "").otherwise("1")


def query_value(value: Column) -> Column:
    """Form encoding; the two characters Java and the WHATWG form encoder of
    other languages treat differently are put right."""
    encoded = F.url_encode(value.cast("string"))
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def url_with_params(base: Column, params: dict[str, Column]) -> Column:
    pieces: list[Column] = [base]
    for position, (name, value) in enumerate(params.items()):
        pieces.append(F.lit(("?" if position == 0 else "&") + name + "="))
        pieces.append(query_value(value))
    return F.concat(*pieces)


def product_page_url(
    root: str,
    chain_id: Column,
    category_label: Column,
    page: Column,
    page_size: Column,
    store_id: Column | None = None,
) -> Column:
    base = F.concat(F.lit(f"{root}/products/"), chain_id.cast("string"))
    if store_id is not None:
        base = F.concat(base, F.when(store_id.isNotNull(), F.concat(F.lit("/"), store_id.cast("string"))).otherwise(""))
    facet = F.when(category_label.isNotNull(), F.concat(F.lit("Categories:"), category_label)).otherwise("")
    return url_with_params(
        base,
        {
            "page": page,
            "page_size": page_size,
            "full_response": F.lit("true"),
            "fieldset": F.lit("maximal"),
            "facets": F.lit("Category"),
            "facet": facet,
            "showNotForSale": F.lit("true"),
        },
    )


def filter_options_url(root: str, chain_id: Column) -> Column:
    base = F.concat(F.lit(f"{root}/products/"), chain_id.cast("string"))
    return url_with_params(base, {"page_size": F.lit("0"), "full_response": F.lit("true")})


def stores_url(root: str, chain_id: Column) -> Column:
    return F.concat(F.lit(f"{root}/handoveroptions/"), chain_id.cast("string"))


def search_page_url(root: str, search_key: Column, published: Column, page: Column) -> Column:
    return url_with_params(
        F.lit(root),
        {"searchkey": search_key, "published": published, "page": page, "vertical": F.lit("1")},
    )


def job_search_page_url(root: str, occupation: Column, published: Column, page: Column) -> Column:
    return url_with_params(
        F.lit(root),
        {
            "searchkey": F.lit(SEARCH_KEY_PREFIX + "JOB_FULLTIME"),
            "occupation": occupation,
            "q": F.lit(""),
            "published": published,
            "vertical": F.lit("job"),
            "page": page,
        },
    )


def base64_text(value: Column) -> Column:
    return F.decode(F.unbase64(value), "UTF-8")


def table_of(fqn: Column) -> Column:
    return F.split_part(fqn, F.lit("."), F.lit(-1))


def schema_of(fqn: Column) -> Column:
    return F.split_part(fqn, F.lit("."), F.lit(-2))


def split_table_name(fqn: str) -> tuple[str, str]:
    """``db.schema.table`` -> (schema, table)."""
    parts = fqn.split(".")
    if len(parts) < 2:
        raise ValueError(f"expected schema.table, got {fqn}")
    return parts[-2], parts[-1]
