"""Columns of the three event logs and of the gold table.

Column names, their order and the partition column are fixed values: they are the
file and table contract.
"""

from pyspark.sql import types as T

PURCHASE = T.StructType(
    [
        T.StructField("transaction_datetime", T.TimestampNTZType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("purchase_id", T.StringType()),
        T.StructField("buyer_id", T.StringType()),
        T.StructField("prod_item_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("release_date", T.DateType()),
        T.StructField("producer_id", T.StringType()),
    ]
)

PRODUCT_ITEM = T.StructType(
    [
        T.StructField("transaction_datetime", T.TimestampNTZType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("purchase_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("item_quantity", T.IntegerType()),
        T.StructField("purchase_value", T.DoubleType()),
    ]
)

EXTRA_INFO = T.StructType(
    [
        T.StructField("transaction_datetime", T.TimestampNTZType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("purchase_id", T.StringType()),
        T.StructField("subsidiary", T.StringType()),
    ]
)

GOLD = T.StructType(
    [
        T.StructField("transaction_date", T.DateType()),
        T.StructField("subsidiary", T.StringType()),
        T.StructField("gmv", T.DoubleType()),
    ]
)

KEY = "purchase_id"
EVENT_TIME = "transaction_datetime"
DAY = "transaction_date"
# Beside the events of a typed log: the number of the batch that brought them.
ARRIVAL = "arrival"

# Folder of each log in bronze and in silver (fixed values).
BRONZE_FOLDERS = {
    "purchase": "purchase",
    "product_item": "product_item",
    "extra_info": "product_extra_info",
}
SILVER_FOLDERS = {
    "purchase": "purchase",
    "product_item": "product_item",
    "extra_info": "purchase_extra_info",
}

LOG_SCHEMAS = {
    "purchase": PURCHASE,
    "product_item": PRODUCT_ITEM,
    "extra_info": EXTRA_INFO,
}

# Which event counts as newest when a key has several: event time first, then every other
# column, so that equal times have one winner whatever the input order. The columns gold
# needs come first; gold can then drop the rest before the shuffle and still see the same
# winner as the full-width silver rows.
PRECEDENCE = {
    "purchase": [
        EVENT_TIME, DAY, "release_date", "order_date", "buyer_id", "prod_item_id", "producer_id",
    ],
    "product_item": [EVENT_TIME, "item_quantity", "purchase_value", "product_id", DAY],
    "extra_info": [EVENT_TIME, "subsidiary", DAY],
}

# What the gold table needs of each log, besides the key.
GOLD_INPUTS = {
    "purchase": [EVENT_TIME, DAY, "release_date"],
    "product_item": [EVENT_TIME, "item_quantity", "purchase_value"],
    "extra_info": [EVENT_TIME, "subsidiary"],
}
