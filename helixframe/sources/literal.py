"""M8: literal one-off sources (a VCF directory, a layout table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def from_values(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal DataFrame; its size is the literal's, so it may be broadcast."""
    return spark.createDataFrame(list(rows), schema)
