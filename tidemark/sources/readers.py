"""Batch and stream readers. Schemas are always given, never inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Schemas of the supported feeds.
WEB_LOGS = (
    "ip STRING, timestamp TIMESTAMP_NTZ, method STRING, path STRING, status INT, bytes LONG, user_agent STRING"
)
API_USER = (
    "id LONG, username STRING, email STRING, age INT, is_active BOOLEAN, signup_date DATE, "
    "profile STRUCT<country: STRING, tier: STRING, score: DOUBLE>, tags ARRAY<STRING>"
)
SALES = {
    "order_id": "string", "order_date": "date", "region": "string", "category": "string",
    "quantity": "int", "unit_price": "double", "discount": "double",
}
EVENTS_LARGE = "event_id LONG, user_id LONG, event_type STRING, ts TIMESTAMP_NTZ, amount DOUBLE"
CHURN = (
    "customer_id STRING, gender STRING, senior INT, tenure_months INT, monthly_charges DOUBLE, "
    "total_charges DOUBLE, contract STRING, payment_method STRING, num_services INT, churn INT"
)
STORE_PRODUCTS = (
    "product_id STRING, product_name STRING, category STRING, price LONG, stock LONG, daily_sales DOUBLE, "
    "reorder_level LONG, expiry_days INT, last_price LONG, source STRING"
)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row (a byte-order mark is accepted); blank cells are null."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_raw_csv(spark: SparkSession, path: str, columns) -> DataFrame:
    """CSV with every column as text, for feeds whose types must be repaired first."""
    return read_csv(spark, path, ", ".join(f"`{c}` STRING" for c in columns))


def read_api(spark: SparkSession, path: str, record: str = API_USER, multi_line: bool = True) -> DataFrame:
    """Records of API responses shaped ``{status, count, results: [...]}``.

    A multi-line file is read by one task, so large intakes should arrive as many
    files or as one envelope per line (``multi_line=False``, which splits).
    """
    envelope = f"status STRING, count LONG, results ARRAY<STRUCT<{record}>>"
    return (
        spark.read.schema(envelope).option("multiLine", multi_line).json(path)
        .select(F.explode("results").alias("record"))
        .select("record.*")
    )


def union_sources(feeds: dict[str, DataFrame]) -> DataFrame:
    """All feeds as one table whose ``source`` column names each row's feed."""
    tagged = [
        df if "source" in df.columns else df.withColumn("source", F.lit(name))
        for name, df in feeds.items()
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged)


def read_log_stream(
    spark: SparkSession,
    path: str,
    schema,
    file_format: str = "parquet",
    max_files: int | None = None,
    **options,
) -> DataFrame:
    """A growing folder of log files as a stream; ``max_files`` bounds each step's intake."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
