"""Incremental ingestion: new source files are normalised as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.ids import encode_ids
from tessera.plans.normalize import normalize_records
from tessera.sources.tables import SOURCE_COLUMNS


def source_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The tab-separated files that arrive in a folder, as source records."""
    schema = StructType([StructField(c, StringType()) for c in SOURCE_COLUMNS])
    rows = spark.readStream.schema(schema).option("sep", "\t").option("header", True).csv(folder)
    rows = encode_ids(rows.fillna(""), "entity_id", "source", "id")
    return rows.select("source", "id", "country", F.col("business_name").alias("name"), F.col("business_address").alias("address"))


def normalize_stream(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """Starts a query that appends normalised records to a Parquet table, each file once; it ends when all files are read."""
    rows = normalize_records(source_stream(spark, folder))
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).partitionBy("country").trigger(availableNow=True).start()
