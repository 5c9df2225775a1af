"""The corpus pipeline: raw documents to a clean, balanced, tokenised corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents`` (further columns pass through, whatever their
names).  ``run`` writes every stage's rows as Parquet and reads them again as the
next one's input.

Rows without a doc_id take part like others; empty tables give empty results.
A null text counts as empty: the classifier gives it its training share of label 1,
and no other stage takes it out.  Repeated rows are copies of each other, so the
near-duplicate stage keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layoutlake.llm import byte_bpe, line_runs, mixing, near_dup, quality
from layoutlake.llm.common import drop_written, fresh, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the raw documents."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    name = fresh(docs, "score")
    return quality.score(docs, model, name).filter(F.col(name) >= quality.THRESHOLD).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many documents stay in one of them; n_chars follows."""
    out = line_runs.apply(docs, line_runs.drops(docs), counts=False)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return near_dup.one_of_each(docs).select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for."""
    sized = mixing.with_size(docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("document"))).drop("text")
    planned = mixing.plan(written(sized.select("doc_id", "source", "size"), "pipeline-sizes"))
    mixed = mixing.apply(sized, planned).filter(F.col("copies") > 0)
    return mixed.select(F.explode(F.sequence(F.lit(1), F.col("copies"))), "document").select("document.*")


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of the ids and of the decoded bytes."""
    import public_tokenizers

    return byte_bpe.digest(docs, public_tokenizers.path(byte_bpe.RANKS_FILE), public_tokenizers.PATTERN, ("doc_id", "lang", "source", "n_chars"), ids=True, portion=byte_bpe.SMALL_PORTION)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_dup_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not raw:
            drop_written(before)
    return docs
