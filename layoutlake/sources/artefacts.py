"""Artefacts of a run: JSON with defaults, stage outputs, batch reports, swaps that keep the last success."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layoutlake.sources.reports import MONTH_NAMES, write_csv

#: Counters of a document's row that batch metrics add up over successful documents.
COUNTERS = ("articles", "with_title", "with_date", "with_body", "short_body", "review_required", "incomplete", "assigned_chars", "orphan_chars", "index_entries", "index_matched")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON files; none where the path doesn't exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_stage(df: DataFrame, root: str, stage: str, key: str = "document_id") -> None:
    """One stage's rows as JSON, a folder for each document; only documents with rows are replaced.

    Spark's committer makes a file visible when it is whole.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).json(f"{root}/{stage}")


def swap(df: DataFrame, target: str) -> None:
    """Write ``df`` beside ``target`` and put it in its place; a failed write leaves the last success there."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    fresh, old = path(f"{target}.new"), path(f"{target}.old")
    files.delete(fresh, True)
    df.write.parquet(fresh.toString())
    files.delete(old, True)
    had = files.exists(path(target))
    if had and not files.rename(path(target), old):
        raise OSError(f"can't move {target}")
    if not files.rename(fresh, path(target)):
        if had:
            files.rename(old, path(target))
        raise OSError(f"can't replace {target}")
    files.delete(old, True)


def safe_name(path: Column) -> Column:
    """The folder name of a document: its file name without ending, spaces as underscores."""
    return F.replace(F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", ""), F.lit(" "), F.lit("_"))


def export_body(body: Column, clean: Column, raw: Column) -> Column:
    """The first of three bodies that isn't blank, trimmed; an empty text without any."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in (body, clean, raw)), F.lit(""))


def metrics(documents: DataFrame, *keys: str) -> DataFrame:
    """Counts, sums over successful documents and rates, over all and by each prefix of ``keys``."""
    good = F.col("status") == "success"
    total = lambda c: F.coalesce(F.sum(F.when(good, F.col(c))), F.lit(0)).cast("long")
    grouped = documents.rollup(*keys) if keys else documents.groupBy()
    m = grouped.agg(F.count("*").alias("documents"), F.count_if(good).alias("successes"), *(total(c).alias(c) for c in COUNTERS))
    rate = lambda a, b, n=4: F.round(F.try_divide(a, b), n)
    return m.withColumns({
        "success_rate": rate("successes", "documents"), "articles_per_document": rate("articles", "successes", 2), "title_rate": rate("with_title", "articles"), "date_rate": rate("with_date", "articles"),
        "body_rate": rate("with_body", "articles"), "assignment_rate": F.round(F.try_divide(F.col("assigned_chars"), F.col("assigned_chars") + F.col("orphan_chars")), 4), "linkage_rate": rate("index_matched", "index_entries"),
    })


def issue_counts(documents: DataFrame, *keys: str) -> DataFrame:
    """(keys, issues map): anomalies (array of kind, count) added up by kind."""
    each = documents.select(*keys, F.explode("anomalies").alias("a")).groupBy(*keys, F.col("a.kind").alias("kind")).agg(F.sum("a.count").alias("n"))
    return each.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "n")))).alias("issues"))


def month_number(name: Column) -> Column:
    names = F.array(*map(F.lit, MONTH_NAMES))
    return F.coalesce(F.nullif(F.array_position(names, F.lower(name)).cast("int"), F.lit(0)), name.try_cast("int"))


def save_reports(documents: DataFrame, articles: DataFrame, root: str, document_columns: list[str], article_columns: list[str], audit_columns: list[str]) -> None:
    """documents, articles and an audit template as CSV; metrics over all, by year and by month as JSON."""
    order = lambda df: df.orderBy("year", month_number(F.col("month")), "pdf")
    write_csv(order(documents), f"{root}/documents", document_columns)
    write_csv(order(articles), f"{root}/articles", article_columns)
    blank = articles.withColumns({c: F.lit("") for c in audit_columns})
    write_csv(order(blank), f"{root}/audit_template", [*article_columns, *audit_columns])
    metrics(documents, "year", "month").write.mode("overwrite").json(f"{root}/metrics")
