"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.session import cut_lineage

# Words are runs of characters other than the ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Tables up to this many bytes (rows times a stated row size) may be broadcast.
BROADCAST_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the cluster's shared checkpoint folder, its lineage cut there."""
    return cut_lineage(df, eager=True)


def checked_broadcast(small: DataFrame, row_bytes: int) -> DataFrame:
    """Mark an already written table for broadcast, but only if its counted size is within the bound.

    Beyond the bound the join stays a shuffled one, which adaptive execution splits where a key is hot.
    """
    return F.broadcast(small) if small.count() * row_bytes <= BROADCAST_BYTES else small


def words(text: Column) -> Column:
    """The words of a text as an array (null text: null)."""
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.filter(F.split(spaced, " "), lambda w: w != F.lit(""))


def input_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes in a text column, summed over the whole table."""
    total = df.agg(F.sum(F.octet_length(F.col(column)).cast("long")).alias("n")).first()["n"]
    return int(total or 0)
