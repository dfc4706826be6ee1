"""Table layouts of the warehouse (serving types).

INTEGER keys are ``bigint``; TEXT is ``string``; DATE is ``date``; prices are
``decimal(12,4)``.  Facts carry a position column ``pos`` that orders rows the
way the source files listed them (packed into one decimal, see below), so
first-seen and last-row-wins rules can be evaluated on an unordered
DataFrame.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(12, 4)

RAW_COLUMNS = [
    "settlement_code", "store_name", "product_name", "product_code",
    "category_code", "retail_price", "promo_price",
]
EXPECTED_COLUMNS = len(RAW_COLUMNS)

# Position of a raw record, packed into one fixed-width decimal, so that
# aggregations over it use hash buffers:
#   days since 1970-01-01 of the archive date * 10**24
# + member index in the archive listing      * 10**12
# + record index in the member + 1 (member rows are 0, so they sort first)
POS_FILE_UNIT = 10 ** 12
POS_DATE_UNIT = 10 ** 24
POSITION = T.DecimalType(38, 0)

DIM_DATE = T.StructType([
    T.StructField("date_key", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("weekday", T.IntegerType()),
])
DIM_COMPANY = T.StructType([
    T.StructField("company_key", T.LongType()),
    T.StructField("uic", T.StringType()),
    T.StructField("company_name", T.StringType()),
])
DIM_SETTLEMENT = T.StructType([
    T.StructField("settlement_key", T.LongType()),
    T.StructField("ekatte", T.StringType()),
    T.StructField("settlement_name", T.StringType()),
])
DIM_CATEGORY = T.StructType([
    T.StructField("category_key", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("category_name", T.StringType()),
])
DIM_PRODUCT = T.StructType([
    T.StructField("product_key", T.LongType()),
    T.StructField("product_code", T.StringType()),
    T.StructField("product_name", T.StringType()),
])
DIM_STORE = T.StructType([
    T.StructField("store_key", T.LongType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("settlement_key", T.LongType()),
    T.StructField("company_key", T.LongType()),
])
DIM_FILE = T.StructType([
    T.StructField("file_key", T.LongType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("zip_date", T.DateType()),
])

DIMENSIONS = {
    "date": (DIM_DATE, "date_key", ["date"]),
    "company": (DIM_COMPANY, "company_key", ["uic"]),
    "settlement": (DIM_SETTLEMENT, "settlement_key", ["ekatte"]),
    "category": (DIM_CATEGORY, "category_key", ["category_code"]),
    "product": (DIM_PRODUCT, "product_key", ["product_code", "product_name"]),
    "store": (DIM_STORE, "store_key", ["store_name", "settlement_key", "company_key"]),
    "file": (DIM_FILE, "file_key", ["file_name", "zip_date"]),
}

FACT_KEYS = ["date_key", "store_key", "file_key", "category_key", "product_key"]
FACT_COLUMNS = FACT_KEYS + ["retail_price", "promo_price"]
PRICE_KEY = ["store_key", "category_key", "product_key"]

FACT = T.StructType(
    [T.StructField(k, T.LongType()) for k in FACT_KEYS]
    + [T.StructField("retail_price", PRICE), T.StructField("promo_price", PRICE),
       T.StructField("pos", POSITION)]
)

LOOKBACK_COLUMNS = FACT_COLUMNS + [
    "retail_price_day1", "promo_price_day1", "retail_price_day2", "promo_price_day2",
]

PROJECTION_COLUMNS = [
    "date_key", "settlement_key", "category_key", "company_key", "store_key",
    "file_key", "product_key", "file_name", "product_name", "category_name",
    "settlement_name", "store_name", "company_name", "retail_price",
    "promo_price", "price",
]

QUALITY = T.StructType([
    T.StructField("zip_date", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("null_prices", T.LongType()),
    T.StructField("unknown_settlements", T.LongType()),
    T.StructField("unknown_categories", T.LongType()),
    T.StructField("delimiter_anomalies", T.LongType()),
    T.StructField("untyped_prices", T.LongType()),
])
