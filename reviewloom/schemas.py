"""Declared schemas."""

from pyspark.sql import types as T


RAW_REVIEW_DDL = (
    "rating double, title string, text string, asin string, parent_asin string, user_id string, "
    "timestamp bigint, verified_purchase boolean, helpful_vote bigint"
)
RAW_PRODUCT_DDL = (
    "parent_asin string, main_category string, title string, categories array<string>, price double, "
    "average_rating double, rating_number bigint"
)
# the sampled review, 18 columns
REVIEW_DDL = (
    "review_month int, rating double, parent_asin string, asin string, helpful_vote bigint, text string, "
    "timestamp bigint, title string, user_id string, verified_purchase boolean, review_date_timestamp string, "
    "main_category string, product_name string, categories string, price double, average_rating double, "
    "rating_number bigint, year int"
)


def from_ddl(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
