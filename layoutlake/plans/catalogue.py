"""All registered queries and their SQL."""

from layoutlake.plans import basics, belongings, classes, finals, flows, layouts, oracle, owners, queries, records, resolvers, texts
from layoutlake.sources import tables


def q70_article_records(spark, sf):
    """Records of all pages, with the body as a digest."""
    from pyspark.sql import functions as F

    found = records.records(tables.regions(spark, sf))
    return found.select("document_id", "pdf_page", "article_id", "title", F.length("body").alias("n_chars"), F.md5("body").alias("body_md5"), "n_parts", "coverage", "confidence", F.array_join("warnings", ";").alias("warnings"), "finalization_status")


def q71_document_report(spark, sf):
    """Ready articles and issues of each document."""
    return records.document_report(records.records(tables.regions(spark, sf)))


QUERIES = {**queries.QUERIES, **resolvers.QUERIES, **texts.QUERIES, **classes.QUERIES, **layouts.QUERIES, **flows.QUERIES, **finals.QUERIES, **owners.QUERIES, **basics.QUERIES, **belongings.QUERIES, "q70_article_records": q70_article_records, "q71_document_report": q71_document_report}
SQL = {**oracle.SQL, **resolvers.SQL, **texts.SQL, **classes.SQL, **layouts.SQL, **flows.SQL, **finals.SQL, **owners.SQL, **basics.SQL, **belongings.SQL}
