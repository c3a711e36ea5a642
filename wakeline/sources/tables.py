"""The error table: keyed append, full read, daily and full errors together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline import schema
from wakeline.operators.reshape import first_per_key

ERRORS = T.StructType(
    [
        T.StructField("node_name", T.StringType()),
        T.StructField("date", T.DateType()),
        *(T.StructField(f, T.DoubleType()) for f in schema.ERROR_FEATURES),
    ]
)
KEY = ("node_name", "date")


def make_error_table(spark: SparkSession, path: str) -> None:
    """Create the empty table unless it is there."""
    spark.createDataFrame([], ERRORS).write.mode("ignore").parquet(path)


def read_error_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ERRORS).parquet(path)


def new_errors(stored: DataFrame, incoming: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Incoming rows whose key is not stored, one per key. A row whose key is not complete is refused: it could not
    be recognised again."""
    payload = [c for c in incoming.columns if c not in key]
    unique = first_per_key(incoming.dropna(subset=list(key)), key, payload)
    return unique.join(stored.select(*key), list(key), "left_anti")


def refused_errors(incoming: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Incoming rows that ``new_errors`` refuses."""
    return incoming.where(" or ".join(f"`{k}` is null" for k in key))


def append_errors(spark: SparkSession, path: str, incoming: DataFrame, refused: str | None = None) -> int:
    """Append what is new; running it twice adds nothing. Rows without a complete key are counted, and appended to
    the table ``refused`` where one is named."""
    rows = incoming.select(*ERRORS.fieldNames())
    new_errors(read_error_table(spark, path), rows).write.mode("append").parquet(path)
    left = refused_errors(rows)
    if refused is not None:
        left.write.mode("append").parquet(refused)
    return left.count()


def read_errors_csv(spark: SparkSession, path: str, features: Sequence[str] = schema.ERROR_FEATURES) -> DataFrame:
    """Errors exported as CSV with a leading row number."""
    names = ["row", "node_name", "date", *features]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(text).option("header", True).option("enforceSchema", True).csv(path)
    return rows.select(
        "node_name",
        F.col("date").try_cast("date").alias("date"),
        *(F.col(f).try_cast("double").alias(f) for f in features),
    )


def read_all_errors(daily: DataFrame, full: DataFrame) -> DataFrame:
    """Both error tables in one, column ``grain`` telling them apart."""
    return daily.withColumn("grain", F.lit("daily")).unionByName(
        full.withColumn("grain", F.lit("full")), allowMissingColumns=True
    )
