"""Unions and gaps of half-open intervals, by running maxima."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merged(intervals: DataFrame, key: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Disjoint intervals that cover the same points."""
    w = Window.partitionBy(*key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1))
    grouped = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*key, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def gaps(intervals: DataFrame, key: list[str], length: str, start: str = "start", end: str = "end") -> DataFrame:
    """What the intervals leave open of [0, ``length``)."""
    bounded = intervals.select(*key, start, end, length)
    ends = intervals.select(*key, length).distinct().select(*key, F.col(length).alias(start), F.col(length).alias(end), length)
    w = Window.partitionBy(*key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    both = bounded.unionByName(ends).withColumn("_from", F.coalesce(F.max(end).over(w), F.lit(0)))
    return both.filter(F.col("_from") < F.col(start)).select(*key, F.col("_from").alias("gap_start"), F.col(start).alias("gap_end"))


def islands(rows: DataFrame, key: list[str], order: list[str], breaks: str) -> DataFrame:
    """``rows`` with ``island``, counted up wherever ``breaks`` is true."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("island", F.sum(F.when(F.col(breaks), 1).otherwise(0)).over(w))
