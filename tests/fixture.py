"""Six purchases with their events, and helpers to build logs from rows of text."""

from datetime import date

from pyspark.sql import types as T

from daybook.logs import EventLogs
from daybook.schemas import LOG_SCHEMAS
from daybook.sources.bronze import conform_logs

# Input events.
# (event time, purchase, order date, release date)
PURCHASES = [
    ("2023-02-03 00:00:00", "56", "2023-01-14", None),
    ("2023-02-03 07:00:00", "70", "2023-01-24", None),
    ("2023-02-03 08:00:00", "55", "2023-02-03", None),
    ("2023-02-08 00:00:00", "56", "2023-01-14", "2023-02-08"),
    ("2023-02-08 02:00:00", "29", "2023-01-14", None),
    ("2023-02-08 08:00:00", "78", "2023-01-24", None),
    ("2023-02-13 00:00:00", "202", "2023-01-14", None),
    ("2023-02-18 00:00:00", "202", "2023-01-14", "2023-02-18"),
    ("2023-02-18 08:00:00", "78", "2023-01-24", "2023-02-18"),
    ("2023-02-23 02:00:00", "29", "2023-01-14", "2023-02-23"),
    ("2023-02-28 08:00:00", "55", "2023-02-03", None),
]
# (event time, purchase, product, quantity, value)
ITEMS = [
    ("2023-02-03 00:00:00", "56", "81426", "10", "55.45"),
    ("2023-02-03 07:00:00", "70", "23238", "10", "2000.45"),
    ("2023-02-03 08:00:00", "55", "23434", "5", "50.59"),
    ("2023-02-08 02:00:00", "29", "26361", "10", "50.55"),
    ("2023-02-08 08:00:00", "78", "38221", "10", "50.09"),
    ("2023-02-13 00:00:00", "202", "19358", "5", "55.53"),
    ("2023-02-28 08:00:00", "55", "23434", "5", "55.59"),
]
# (event time, purchase, subsidiary)
EXTRAS = [
    ("2023-02-03 01:00:00", "56", "internacional"),
    ("2023-02-03 08:00:00", "70", "internacional"),
    ("2023-02-03 09:00:00", "55", "nacional"),
    ("2023-02-08 03:00:00", "29", "internacional"),
    ("2023-02-08 09:00:00", "78", "nacional"),
    ("2023-02-13 01:00:00", "202", "nacional"),
    ("2023-02-28 09:00:00", "55", "nacional"),
]
# Expected gold of the whole log.
D8 = (date(2023, 2, 8), "internacional", 554.50)
D18 = (date(2023, 2, 18), "nacional", 778.55)
D23 = (date(2023, 2, 23), "internacional", 505.50)
FULL = [D8, D18, D23]


def _text(schema):
    return T.StructType([T.StructField(n, T.StringType()) for n in schema.names])


def _day(at):
    return None if at is None else at[:10]


def raw_logs(spark, purchases=PURCHASES, items=ITEMS, extras=EXTRAS):
    """Logs of text cells; the day is the date part of the event time."""
    rows = {
        "purchase": [(t, _day(t), k, "1", "2", order, rel, "3") for t, k, order, rel in purchases],
        "product_item": [(t, _day(t), k, p, q, v) for t, k, p, q, v in items],
        "extra_info": [(t, _day(t), k, s) for t, k, s in extras],
    }
    return EventLogs(
        **{n: spark.createDataFrame(r, _text(LOG_SCHEMAS[n])) for n, r in rows.items()}
    )


def logs(spark, purchases=PURCHASES, items=ITEMS, extras=EXTRAS):
    return conform_logs(raw_logs(spark, purchases, items, extras))


def rows(df):
    """Gold rows in order, NULLs first."""
    found = [tuple(r) for r in df.select("transaction_date", "subsidiary", "gmv").collect()]
    return sorted(found, key=lambda r: (r[0] or date.min, r[1] or ""))
