"""Best candidate with a threshold and a margin, nearest neighbours, lone partners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def winner(scored: DataFrame, key: list[str], candidate: str, score: str, threshold: float, margin: float, lone_needs_margin: bool = True) -> DataFrame:
    """One row for each key: the best candidate, its lead and a status.

    accepted: best >= threshold and lead >= margin; ambiguous: lead too small; else
    rejected.  A lone candidate's runner-up has score 0; ``lone_needs_margin`` false
    accepts it without a lead.
    """
    w = Window.partitionBy(*key).orderBy(F.col(score).desc(), F.col(candidate))
    ranked = scored.withColumn("_rank", F.row_number().over(w)).withColumn("_next", F.lead(score).over(w))
    best = ranked.filter("_rank = 1")
    lead = F.col(score) - F.coalesce(F.col("_next"), F.lit(0.0))
    close = lead < margin - 1e-12
    if not lone_needs_margin:
        close = close & F.col("_next").isNotNull()
    status = F.when(F.col(score) < threshold, "rejected").when(close, "ambiguous").otherwise("accepted")
    return best.select(*key, F.col(candidate).alias(candidate), F.col(score).alias(score), F.round(lead, 6).alias("lead"), status.alias("status"))


def top(scored: DataFrame, key: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def nearest(pairs: DataFrame, key: list[str], value: str, distance: str) -> DataFrame:
    """For each key the ``value`` at least ``distance``; ties go to the smaller value."""
    best = pairs.groupBy(*key).agg(F.min(F.struct(distance, value)).alias("_b"))
    return best.select(*key, F.col(f"_b.{value}").alias(value), F.col(f"_b.{distance}").alias(distance))


def alone(pairs: DataFrame, key: list[str]) -> DataFrame:
    """Pairs whose key has exactly one partner."""
    return pairs.withColumn("_n", F.count("*").over(Window.partitionBy(*key))).filter("_n = 1").drop("_n")
