"""Event logs out of an order schema (orders, lineitem, customer, nation, region).

Every order and every line item becomes events, after the life of a purchase:

* created at the order time, not yet released;
* paid some days later unless the order is open (status ``O``);
* a pending order (status ``P``) is re-sent 25 days after creation, with its release date, or
  with none where the priority is ``5-LOW`` (the payment is taken back).

Line items are item events at their shipping time. The subsidiary is the customer's region, one
hour after creation, and the customer's nation once a pending order is re-sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.logs import EventLogs
from daybook.schemas import EXTRA_INFO, PURCHASE

# Columns in use. With the schema given, no job reads file footers ahead of the query.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, "
    "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def purchase_events(spark: SparkSession, folder: str) -> DataFrame:
    # One scan of orders: each row carries its one to three events. The offsets in days (5, 10 or
    # 15 to payment, 25 to the second event, 23 to its release) are fixed values of the event model.
    paid_at = """o_orderdate + make_dt_interval(
        CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 10 ELSE 15 END)"""
    events = f"""inline(array_compact(array(
        named_struct('transaction_datetime', o_orderdate, 'release_date', CAST(NULL AS DATE)),
        IF(o_orderstatus <> 'O', named_struct(
            'transaction_datetime', {paid_at}, 'release_date', to_date({paid_at})), NULL),
        IF(o_orderstatus = 'P', named_struct(
            'transaction_datetime', o_orderdate + make_dt_interval(25),
            'release_date', IF(o_orderpriority <> '5-LOW',
                               to_date(o_orderdate + make_dt_interval(23)), NULL)), NULL))))"""
    return (
        read_table(spark, folder, "orders")
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS purchase_id",
            "CAST(o_custkey AS STRING) AS buyer_id",
            "o_orderpriority AS prod_item_id",
            "o_orderstatus AS producer_id",
            "to_date(o_orderdate) AS order_date",
            events,
        )
        .withColumn("transaction_date", F.to_date("transaction_datetime"))
        .select(PURCHASE.names)
    )


def item_events(spark: SparkSession, folder: str, value: str = "l_extendedprice") -> DataFrame:
    """``value`` is the SQL expression of the item's value."""
    return read_table(spark, folder, "lineitem").selectExpr(
        "l_shipdate AS transaction_datetime",
        "to_date(l_shipdate) AS transaction_date",
        "CAST(l_orderkey AS STRING) AS purchase_id",
        "CAST(l_partkey AS STRING) AS product_id",
        "CAST(l_quantity AS INT) AS item_quantity",
        f"{value} AS purchase_value",
    )


def extra_events(spark: SparkSession, folder: str) -> DataFrame:
    places = read_table(spark, folder, "nation").join(
        read_table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    customers = read_table(spark, folder, "customer").join(
        places, F.expr("c_nationkey = n_nationkey")
    )
    events = """inline(array_compact(array(
        named_struct('transaction_datetime', o_orderdate + make_dt_interval(0, 1),
                     'subsidiary', r_name),
        IF(o_orderstatus = 'P', named_struct(
            'transaction_datetime', o_orderdate + make_dt_interval(25, 1),
            'subsidiary', n_name), NULL))))"""
    return (
        read_table(spark, folder, "orders")
        .join(customers, F.expr("o_custkey = c_custkey"))
        .selectExpr("CAST(o_orderkey AS STRING) AS purchase_id", events)
        .withColumn("transaction_date", F.to_date("transaction_datetime"))
        .select(EXTRA_INFO.names)
    )


def order_logs(spark: SparkSession, folder: str) -> EventLogs:
    return EventLogs(
        purchase=purchase_events(spark, folder),
        product_item=item_events(spark, folder),
        extra_info=extra_events(spark, folder),
    )


def as_raw_text(logs: EventLogs) -> EventLogs:
    """The logs as the text cells a bronze file holds."""
    return logs.map(lambda _, df: df.select(*[F.col(c).cast("string") for c in df.columns]))
