"""Declared schemas of the four pipelines."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, FLOAT, DOUBLE = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
STRING, DATE, TIMESTAMP = T.StringType(), T.DateType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names, order and types of the exchanged data.
APP_EVENT = struct(user_id=INT, state=STRING, event_id=INT, device_id=INT)
APP_EVENTS = T.ArrayType(APP_EVENT)
RAW_APP_EVENT_PAYLOAD = struct(data=T.ArrayType(
    struct(user_id=STRING, state=STRING, event_id=STRING, device_id=INT)))
ACTIVE_EVENT = struct(user_id=INT, state=STRING, event=STRING, device=STRING)

LANDED_ORDER = struct(**{
    "order-id": STRING, "product": STRING, "price": STRING, "payment method": STRING,
    "rating": STRING, "comment": STRING, "delivery address": STRING,
    "date": STRING, "time": STRING})
CURATED_ORDER = struct(**{
    "country": STRING, "order-id": STRING, "product": STRING, "price_dollar": FLOAT,
    "payment method": STRING, "rating": INT, "comment": STRING,
    "delivery address": STRING, "timestamp": TIMESTAMP})

STAGING_TABLES = {
    "users": struct(user_id=STRING, name=STRING, email=STRING, signup_date=DATE),
    "products": struct(product_id=STRING, product_name=STRING, category=STRING,
                       price=DOUBLE, stock=INT),
    "orders": struct(order_id=STRING, user_id=STRING, product_id=STRING,
                     quantity=INT, order_date=DATE),
    "clickstream": struct(click_id=STRING, user_id=STRING, product_id=STRING,
                          timestamp=TIMESTAMP),
}

TRANSACTION_IDS = ("nameOrig", "nameDest")
TRANSACTION_LABEL = "isFraud"
TRANSACTION_CATEGORY = "type"
