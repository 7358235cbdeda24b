"""Declared input schemas. Nothing in the library infers a schema from data."""

from pyspark.sql import types as T


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


BRONZE_EVENTS = _texts(
    "event_id", "session_id", "user_id", "anonymous_id", "event_type",
    "event_timestamp", "page_url", "referrer_url", "device_type", "os",
    "browser", "country_code", "ip_address", "properties", "revenue",
    "_ingested_at", "_source_file",
)

EVENT_MESSAGE = _texts(*[n for n in BRONZE_EVENTS.names if not n.startswith("_")], "_source")

ORDER_LINE_ITEMS = T.ArrayType(
    T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("unit_price_eur", T.DoubleType()),
        ]
    )
)

SILVER_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("revenue_eur", T.DoubleType()),
        T.StructField("is_first_order", T.BooleanType()),
        T.StructField("line_items", ORDER_LINE_ITEMS),
    ]
)

SYNC_STATE = T.StructType(
    [
        T.StructField("collection_name", T.StringType()),
        T.StructField("last_sync_at", T.TimestampType()),
    ]
)
