"""Report rows and artefacts: CSV with joined lists, JSON exports, partition overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Italian month names in order.
MONTH_NAMES = ("gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre")
# How auditors write yes and no.
TRUE_WORDS, FALSE_WORDS = ("1", "yes", "y", "si", "sì", "true"), ("0", "no", "n", "false")


def discover(spark: SparkSession, root: str, suffix: str = "pdf") -> DataFrame:
    """path, year, month and month_number of the files under YYYY/month folders; hidden ones left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").load(root).select("path", "length", "modificationTime")
    parts = F.regexp_extract("path", r"/(\d{4})/([^/]+)/(?:[^/]+/)*[^/]+$", 1), F.regexp_extract("path", r"/(\d{4})/([^/]+)/(?:[^/]+/)*[^/]+$", 2)
    names = F.array(*map(F.lit, MONTH_NAMES))
    number = F.coalesce(F.nullif(F.array_position(names, F.lower(parts[1])).cast("int"), F.lit(0)), parts[1].try_cast("int"))
    return files.filter(~F.col("path").rlike(r"/\.")).select("path", "length", "modificationTime", parts[0].alias("year"), parts[1].alias("month"), number.alias("month_number")).filter("year <> ''").orderBy("year", "month_number", "path")


def write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Lists are joined with "; ", columns that aren't named are left out."""
    flat = [F.concat_ws("; ", F.col(c).cast(ArrayType(StringType()))).alias(c) if isinstance(rows.schema[c].dataType, ArrayType) else F.col(c) for c in columns]
    rows.select(flat).write.mode("overwrite").option("header", True).csv(path)


def export_articles(records: DataFrame, path: str, fields: list[str], partition: str) -> None:
    """Chosen fields as JSON, nulls as empty strings; only partitions with rows are replaced."""
    rows = records.select(partition, *(F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).json(path)


def audit_rates(audit: DataFrame, keys: list[str], verdicts: list[str]) -> DataFrame:
    """Per key and verdict: reviewed rows and the share of true ones; other words don't count."""
    long = audit.unpivot(keys, verdicts, "verdict", "said").withColumn("said", F.lower(F.trim("said")))
    value = F.when(F.col("said").isin(*TRUE_WORDS), 1).when(F.col("said").isin(*FALSE_WORDS), 0)
    return long.groupBy(*keys, "verdict").agg(F.count(value).alias("reviewed"), F.round(F.avg(value), 4).alias("rate"))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """An audit CSV; a byte-order mark before the first name is dropped."""
    rows = spark.read.option("header", True).csv(path)
    return rows.toDF(*(c.lstrip("﻿") for c in rows.columns))
