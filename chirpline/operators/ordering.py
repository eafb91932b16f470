"""Sorts and top-k. Equal counts are ordered by key, so results repeat."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_count(counted: DataFrame) -> DataFrame:
    """Largest count first: a full, range-partitioned sort."""
    keys = [name for name in counted.columns if name != "count"]
    return counted.orderBy(F.desc("count"), *[F.asc_nulls_last(key) for key in keys])


def by_airline(counted: DataFrame) -> DataFrame:
    """Airline ascending, and within it the largest count first."""
    return counted.orderBy(F.asc_nulls_last("airline"), F.desc("count"), F.asc_nulls_last("airline_sentiment"))


def top(counted: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest counts; each task keeps only its own ``k`` rows."""
    return by_count(counted).limit(k)
