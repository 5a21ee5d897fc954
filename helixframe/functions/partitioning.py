"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin ``df`` over ``factor`` × the cluster's cores.

    For the one place where a few small rows fan out into very many: reference
    tiles (a 65 kb tile becomes 65 k index rows).  Moving the tiles costs a
    fraction of the index they produce, and keeps a reference held in a few
    files from being exploded by a few tasks.  (The partition count is not
    inspected: under adaptive execution that would run the upstream stages.)
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism * factor)
