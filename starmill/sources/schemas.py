"""Declared schemas of the raw (bronze) and aggregated (gold) tables."""

from __future__ import annotations

# Column names and spellings are those of the public data set.
BRONZE: dict[str, str] = {
    "orders": (
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp timestamp, order_approved_at timestamp,"
        " order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp,"
        " order_estimated_delivery_date timestamp"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string,"
        " shipping_limit_date timestamp, price double, freight_value double"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght int,"
        " product_description_lenght int, product_photos_qty int, product_weight_g int,"
        " product_length_cm int, product_height_cm int, product_width_cm int"
    ),
    "category_translation": (
        "product_category_name string, product_category_name_english string"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int,"
        " customer_city string, customer_state string"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
    ),
    "order_payments": (
        "order_id string, payment_sequential int, payment_type string,"
        " payment_installments int, payment_value double"
    ),
    "order_reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string,"
        " review_comment_message string, review_creation_date timestamp,"
        " review_answer_timestamp timestamp"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double,"
        " geolocation_city string, geolocation_state string"
    ),
}

# The published CSV file of every raw table.
CSV_FILES: dict[str, str] = {
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "products": "olist_products_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
    "customers": "olist_customers_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "order_payments": "olist_order_payments_dataset.csv",
    "order_reviews": "olist_order_reviews_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
}


def raw_table_name(entity: str) -> str:
    """``orders`` -> ``olist_orders_raw``; a raw name is returned as it is."""
    if entity.startswith("olist_") and entity.endswith("_raw"):
        return entity
    return f"olist_{entity}_raw"


def entity_name(table: str) -> str:
    """``olist_orders_raw`` -> ``orders``; an entity name is returned as it is."""
    if table.startswith("olist_") and table.endswith("_raw"):
        return table[len("olist_"):-len("_raw")]
    return table
