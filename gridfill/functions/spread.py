"""Spreading rows that are about to multiply."""

from pyspark.sql import DataFrame


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Shuffle rows over all shuffle partitions by columns that tell them apart; without columns evenly, in turn.

    Adaptive execution merges shuffle partitions by their bytes, and a few small rows (outlines, tiles, spans)
    can explode into very many: with a given number of partitions they stay apart.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
