"""SQL twins of the review views, shared by the oracle queries."""

from reviewloom.functions.constants import WHITESPACE as WS

FIRST_PART = "first_part AS (SELECT l_orderkey, min(l_partkey) AS p FROM lineitem GROUP BY l_orderkey)"

RAW = f"""{FIRST_PART},
raw_reviews AS (
  SELECT o_orderkey AS row_id, CAST(o_custkey AS VARCHAR) AS user_id, CAST(p AS VARCHAR) AS asin,
         CAST(p AS VARCHAR) AS parent_asin, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS rating,
         epoch_ms(o_orderdate) AS timestamp, o_orderkey % 50 AS helpful_vote,
         o_orderstatus = 'F' AS verified_purchase,
         CASE WHEN o_orderkey % 17 <> 0 THEN array_to_string(list_slice(string_split(text, ' '), 1, 8), ' ') END AS title,
         text, o_orderdate AS review_time
  FROM orders LEFT JOIN first_part ON l_orderkey = o_orderkey
  LEFT JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents))"""

REVIEWS = f"""{RAW},
reviews AS (
  SELECT *, strftime(review_time, '%Y-%m-%d %H:%M:%S') AS review_date_timestamp,
         CAST(year(review_time) AS INTEGER) AS year, CAST(month(review_time) AS INTEGER) AS review_month
  FROM raw_reviews)"""

PRODUCTS = """product_stats AS (
  SELECT p, avg(CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)) AS average_rating, count(*) AS rating_number
  FROM orders LEFT JOIN first_part ON l_orderkey = o_orderkey GROUP BY p),
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS parent_asin, p_brand AS main_category, p_name AS product_name,
         p_brand || ',' || p_type || ',' || p_name AS categories, p_retailprice AS price,
         round(average_rating, 6) AS average_rating, coalesce(rating_number, 0) AS rating_number
  FROM part LEFT JOIN product_stats ON p = p_partkey)"""

JOINED = f"""{REVIEWS}, {PRODUCTS},
joined AS (SELECT reviews.*, products.* EXCLUDE (parent_asin) FROM reviews LEFT JOIN products USING (parent_asin))"""

PREDICTIONS = f"""{JOINED},
guesses AS (
  SELECT *, CASE WHEN row_id % 3 = 0 THEN 1 + CAST(user_id AS BIGINT) % 5 ELSE rating END AS guess FROM joined),
predictions AS (
  SELECT row_id, year, main_category,
         CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating <= 2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS label,
         CASE WHEN guess >= 4 THEN 'POSITIVE' WHEN guess <= 2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS prediction
  FROM guesses)"""


def clean(col: str) -> str:
    return f"regexp_replace(regexp_replace({col}, '{WS}+', ' ', 'g'), '<[^\\n]*?>', ' ', 'g')"


def words(col: str) -> str:
    return f"list_filter(string_split(regexp_replace({col}, '{WS}+', ' ', 'g'), ' '), lambda w: w <> '')"


def sentences(col: str) -> str:
    # RE2 has no look-behind: the break is marked first, then split on
    return f"list_filter(string_split(regexp_replace({col}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')"


TOKEN = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*|\$"


def tokens(col: str) -> str:
    return f"regexp_extract_all({col}, '{TOKEN}')"


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def escaped(text: str) -> str:
    return text.replace("'", "''")
