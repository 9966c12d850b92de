"""Reference exchange rates, units of currency per US dollar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from questmart.sources.literals import literal_table

# Currency, units per USD.
USD_RATES = [
    ("SAR", 3.752465),
    ("EUR", 0.88169),
    ("IDR", 16816.1),
    ("GBP", 0.755365),
    ("THB", 33.529881),
    ("VND", 25820.0),
    ("RUB", 82.176834),
    ("KRW", 1427.35016),
    ("AUD", 1.572624),
    ("BRL", 5.8566),
    ("MYR", 4.412496),
    ("PHP", 56.655017),
    ("INR", 85.758301),
    ("MXN", 20.05682),
    ("CAD", 1.38652),
    ("JPY", 142.863501),
    ("TRY", 38.096017),
]


def exchange_rate(spark: SparkSession) -> DataFrame:
    rows = [(currency, rate, None) for currency, rate in USD_RATES]
    columns = {"currency": "STRING", "usd_exchange_rate": "DOUBLE", "last_updated": "TIMESTAMP"}
    return literal_table(spark, rows, columns)
