"""What the flattened tables must hold, written out apart from the package's schemas.

Fixed values: ``path type`` of every field of a document, in order.
"""

_TEXT = {
    "car_used": """
        type text; id text; main_search_key text; heading text; location text; image.url text; image.path text;
        image.height long; image.width long; image.aspect_ratio double; flags list; timestamp time;
        coordinates.lat double; coordinates.lon double; ad_type long; labels labels; canonical_url text;
        extras list; price.amount long; price.currency_code text; price.price_unit text; year long;
        mileage double; dealer_segment text; warranty_duration long; service_documents list; regno text;
        ad_id long; organisation_name text; """,
    "job_fulltime": """
        type text; id text; main_search_key text; heading text; location text; flags list; timestamp time;
        coordinates.lat double; coordinates.lon double; ad_type long; labels labels; canonical_url text;
        extras list; logo.url text; logo.path text; job_title text; deadline time; published time;
        company_name text; no_of_positions long; ad_id long; image.url text; image.path text; """,
    "realestate_homes": """
        type text; id text; main_search_key text; heading text; location text; image.url text; image.path text;
        image.height long; image.width long; image.aspect_ratio double; flags list; styling list; timestamp time;
        labels labels; canonical_url text; extras list; logo.url text; logo.path text;
        price_suggestion.amount long; price_suggestion.currency_code text; price_suggestion.price_unit text;
        price_total.amount long; price_total.currency_code text; price_total.price_unit text;
        price_shared_cost.amount long; price_shared_cost.currency_code text; price_shared_cost.price_unit text;
        area_range.size_from long; area_range.size_to long; area_range.unit text; area_range.description text;
        area_plot.size long; area_plot.unit text; area_plot.description text; organisation_name text;
        local_area_name text; number_of_bedrooms long; owner_type_description text;
        property_type_description text; viewing_times list; coordinates.lat double; coordinates.lon double;
        ad_type long; image_urls list; ad_id long; price_range_suggestion.amount_from long;
        price_range_suggestion.amount_to long; price_range_suggestion.currency_code text;
        price_range_total.amount_from long; price_range_total.amount_to long;
        price_range_total.currency_code text; bedrooms_range.start long; bedrooms_range.end long; area.size long;
        area.unit text; area.description text; """,
    "realestate_lettings": """
        type text; id text; main_search_key text; heading text; location text; image.url text; image.path text;
        image.height long; image.width long; image.aspect_ratio double; flags list; styling list; timestamp time;
        labels labels; canonical_url text; extras list; price_suggestion.amount long;
        price_suggestion.currency_code text; price_suggestion.price_unit text; price_total.amount long;
        price_total.currency_code text; price_total.price_unit text; price_shared_cost.amount long;
        price_shared_cost.currency_code text; price_shared_cost.price_unit text; area_range.size_from long;
        area_range.size_to long; area_range.unit text; area_range.description text; area_plot.size long;
        area_plot.unit text; area_plot.description text; local_area_name text; number_of_bedrooms long;
        property_type_description text; viewing_times list; coordinates.lat double; coordinates.lon double;
        ad_type long; image_urls list; furnished_state text; ad_id long; logo.url text; logo.path text;
        organisation_name text; area.size long; area.unit text; area.description text; """,
    "realestate_newbuildings": """
        type text; id text; main_search_key text; heading text; location text; image.url text; image.path text;
        image.height long; image.width long; image.aspect_ratio double; flags list; timestamp time; labels labels;
        canonical_url text; extras list; price_suggestion.amount long; price_suggestion.currency_code text;
        price_suggestion.price_unit text; price_total.amount long; price_total.currency_code text;
        price_total.price_unit text; price_shared_cost.amount long; price_shared_cost.currency_code text;
        price_shared_cost.price_unit text; area_range.size_from long; area_range.size_to long;
        area_range.unit text; area_range.description text; area_plot.size long; area_plot.unit text;
        area_plot.description text; coordinates.lat double; coordinates.lon double; ad_type long; ad_id long;
        bedrooms_range.start long; bedrooms_range.end long; """,
}
EXPECTED = {
    category: [tuple(field.split()) for field in text.split(";") if field.strip()] for category, text in _TEXT.items()
}
# Fields that the lean form leaves out.
DROPPED = "image flags labels extras service_documents logo styling viewing_times image_urls area".split()
