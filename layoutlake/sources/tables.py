"""Pages and regions from the tables at hand.

``regions`` lays the lines of each document out in two columns on a 600 x 1400
page: document = source, page = doc_id, region = line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_WIDTH, PAGE_HEIGHT = 600.0, 1400.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """document_id, pdf_page, region_ord, text."""
    docs = read(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("document_id"), F.col("doc_id").alias("pdf_page"), F.posexplode(F.split("text", "\n")).alias("region_ord", "text"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    col = F.col("region_ord") % 2
    row = F.floor(F.col("region_ord") / 2)
    out = lines(spark, sf_dir).withColumn("x0", (40 + 270 * col).cast("double")).withColumn("y0", (60 + 24 * row).cast("double"))
    return out.select("document_id", "pdf_page", "region_ord", "text", F.when(F.col("region_ord") == 0, "section_header").otherwise("text").alias("raw_label"), "x0", "y0", (F.col("x0") + 240).alias("x1"), (F.col("y0") + 18).alias("y1"), F.lit(PAGE_WIDTH).alias("page_width"), F.lit(PAGE_HEIGHT).alias("page_height"))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, title and the raw article html."""
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1).alias("article"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kind, canonical and alias: nations and regions with a three-letter alias each."""
    nation = read(spark, sf_dir, "nation").select(F.lit("nation").alias("kind"), F.col("n_name").alias("canonical"))
    region = read(spark, sf_dir, "region").select(F.lit("region").alias("kind"), F.col("r_name").alias("canonical"))
    both = nation.unionByName(region)
    return both.select("kind", "canonical", F.explode(F.array("canonical", F.substring("canonical", 1, 3))).alias("alias"))
