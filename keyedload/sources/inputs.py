"""Input datasets: CSV text with a header, and RDDs of rows or tuples."""

from __future__ import annotations

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, **options) -> DataFrame:
    """CSV with a header, every column a string; the loader does the conversion.

    With ``columns`` the schema is fixed and Spark opens no file to find the names. A header that
    does not carry these names fails the read.
    """
    reader = spark.read.option("header", True).options(**options)
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def from_rdd(spark: SparkSession, rdd: RDD, schema: T.StructType | str | list[str]) -> DataFrame:
    """DataFrame over an RDD of ``Row`` (bound by name) or of tuples (bound by position).

    A full schema costs no look at the data, and an empty RDD is fine.
    """
    return spark.createDataFrame(rdd, schema)
