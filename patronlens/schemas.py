"""Column names, warehouse schemas, segment rules and the segment -> metric map."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw column names expected in the source files.
INVOICE = "InvoiceNo"
PRODUCT = "StockCode"
DESCRIPTION = "Description"
QUANTITY = "Quantity"
DATE = "InvoiceDate"
PRICE = "UnitPrice"
CUSTOMER = "CustomerID"
COUNTRY = "Country"

REQUIRED_COLUMNS = (DATE, CUSTOMER, INVOICE, QUANTITY, PRICE)

UNKNOWN_COUNTRY = "Unknown"
MISSING_DESCRIPTION = "NAN"
MISSING_INVOICE = "nan"

# Texts that a CSV reader of the pandas family takes for "missing".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The nine segments in display order.
SEGMENTS = (
    "Champions",
    "Loyal Customers",
    "Potential Loyalist",
    "Recent Customers",
    "Promising",
    "Customers Needing Attention",
    "About to Sleep",
    "At Risk",
    "Hibernating",
)
DEFAULT_SEGMENT = "Hibernating"

# Fixed values: (segment, R from, R to, F from, F to, M from, M to); first match wins.
SEGMENT_RULES = (
    ("Champions", 5, 5, 1, 5, 5, 5),
    ("Champions", 4, 5, 2, 5, 4, 5),
    ("Loyal Customers", 3, 5, 2, 5, 3, 5),
    ("Loyal Customers", 4, 5, 1, 5, 4, 5),
    ("Potential Loyalist", 4, 5, 1, 2, 3, 4),
    ("Potential Loyalist", 3, 4, 1, 2, 3, 4),
    ("Recent Customers", 5, 5, 1, 1, 1, 2),
    ("Promising", 3, 4, 1, 1, 1, 2),
    ("Customers Needing Attention", 2, 3, 1, 5, 3, 4),
    ("About to Sleep", 2, 3, 1, 2, 1, 2),
    ("At Risk", 1, 2, 2, 5, 3, 5),
    ("At Risk", 1, 2, 1, 5, 5, 5),
    ("Hibernating", 1, 2, 1, 5, 1, 5),
)

# Which sum ranks the products of a segment.
SEGMENT_METRIC = {
    "Champions": "revenue",
    "Loyal Customers": "frequency",
    "Potential Loyalist": "frequency",
    "Recent Customers": "frequency",
    "Promising": "frequency",
    "Customers Needing Attention": "recency_weighted",
    "About to Sleep": "recency_weighted",
    "At Risk": "revenue",
    "Hibernating": "frequency",
}

# Scoring bins, recommendation list length, journey threshold, report lengths.
SCORE_BINS = 5
TOP_RECOMMENDATIONS = 10
JOURNEY_MIN_PERIODS = 6
JOURNEY_CANDIDATES = 100
TOP_PRODUCTS = 15
TOP_COUNTRIES = 10
TOP_MOVES = 10
DETAIL_ROWS = 50
COMPARE_ROWS = 5
HISTOGRAM_BINS = 30

MONEY = T.DecimalType(14, 2)
UNIT_PRICE = T.DecimalType(12, 4)
SCORE = T.DecimalType(8, 2)


def _table(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_STR, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_TS, _DATE, _BOOL = T.TimestampNTZType(), T.DateType(), T.BooleanType()

# Tables, columns and types of the warehouse.
TABLES = {
    "dim_customer": _table(
        ("customer_key", _LONG, False), ("customer_id", _STR, False), ("country", _STR, True),
        ("first_order", _TS, True), ("last_order", _TS, True), ("total_orders", _LONG, True),
        ("created_at", _TS, True), ("updated_at", _TS, True)),
    "dim_product": _table(
        ("product_key", _LONG, False), ("stock_code", _STR, False), ("description", _STR, True),
        ("created_at", _TS, True)),
    "dim_date": _table(
        ("date_key", _INT, False), ("full_date", _DATE, False), ("year", _INT, True),
        ("quarter", _INT, True), ("month", _INT, True), ("month_name", _STR, True),
        ("week", _INT, True), ("day_of_week", _INT, True), ("day_name", _STR, True),
        ("is_weekend", _BOOL, True)),
    "dim_geography": _table(("geo_key", _LONG, False), ("country", _STR, False)),
    "fact_sales": _table(
        ("invoice_no", _STR, True), ("customer_key", _LONG, True), ("product_key", _LONG, True),
        ("date_key", _INT, True), ("geo_key", _LONG, True), ("quantity", _INT, True),
        ("unit_price", UNIT_PRICE, True), ("total_amount", MONEY, True),
        ("invoice_date", _TS, True), ("period", _STR, False)),
    "customer_rfm": _table(
        ("customer_id", _STR, False), ("recency", _INT, True), ("frequency", _LONG, True),
        ("monetary", MONEY, True), ("r_score", _INT, True), ("f_score", _INT, True),
        ("m_score", _INT, True), ("rfm_score", _STR, True), ("rfm_total", _INT, True),
        ("segment", _STR, True), ("period", _STR, True), ("calculated_at", _TS, True)),
    "rfm_snapshot": _table(
        ("snapshot_date", _DATE, False), ("customer_id", _STR, False), ("recency", _INT, True),
        ("frequency", _LONG, True), ("monetary", MONEY, True), ("r_score", _INT, True),
        ("f_score", _INT, True), ("m_score", _INT, True), ("rfm_score", _STR, True),
        ("segment", _STR, True), ("period", _STR, False)),
    "product_recommendation": _table(
        ("segment", _STR, False), ("stock_code", _STR, True), ("description", _STR, True),
        ("score", SCORE, True), ("rank", _INT, True), ("period", _STR, False)),
    # what a month adds, and the running state that months are folded into
    "month_invoices": _table(
        ("customer_id", _STR, False), ("invoice_no", _STR, False), ("first_order", _TS, True),
        ("last_order", _TS, True), ("last_purchase", _TS, True), ("cents", _LONG, True),
        ("paid", _BOOL, True), ("period", _STR, False)),
    "month_countries": _table(
        ("customer_id", _STR, False), ("country", _STR, False), ("lines", _LONG, True),
        ("period", _STR, False)),
    "month_products": _table(
        ("stock_code", _STR, False), ("description", _STR, True), ("first_use", _TS, True),
        ("period", _STR, False)),
    "state_customer": _table(
        ("customer_id", _STR, False), ("first_order", _TS, True), ("last_order", _TS, True),
        ("total_orders", _LONG, True), ("last_purchase", _TS, True), ("frequency", _LONG, True),
        ("monetary_cents", _LONG, True), ("period", _STR, False)),
    "state_country": _table(
        ("customer_id", _STR, False), ("country", _STR, False), ("lines", _LONG, True),
        ("period", _STR, False)),
    "state_product": _table(
        ("stock_code", _STR, False), ("description", _STR, True), ("first_use", _TS, True),
        ("period", _STR, False)),
    "quarantine": _table(("run_period", _STR, False), ("reason", _STR, False), ("line", _STR, True)),
    "pipeline_log": _table(
        ("run_id", _STR, False), ("period", _STR, True), ("flow_name", _STR, True),
        ("status", _STR, True), ("rows_loaded", _LONG, True), ("started_at", _TS, True),
        ("finished_at", _TS, True), ("error_msg", _STR, True)),
}

# Natural keys.
KEYS = {
    "dim_customer": ("customer_id",),
    "dim_product": ("stock_code",),
    "dim_date": ("date_key",),
    "dim_geography": ("country",),
    "customer_rfm": ("customer_id",),
    "rfm_snapshot": ("period", "customer_id"),
    "product_recommendation": ("period", "segment", "rank"),
}

PERIOD_PARTITIONED = ("fact_sales", "rfm_snapshot", "product_recommendation", "month_invoices",
                      "month_countries", "month_products", "state_customer", "state_country",
                      "state_product")
APPENDED = ("pipeline_log", "quarantine")
