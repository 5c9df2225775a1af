"""Layout JSON (pages, texts, pictures, tables, key values, forms) to pages and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PROV = "array<struct<page_no:int,charspan:array<int>,bbox:struct<l:double,t:double,r:double,b:double,coord_origin:string>>>"
_ITEM = f"array<struct<self_ref:string,label:string,text:string,orig:string,prov:{_PROV}>>"
COLLECTIONS = ("texts", "pictures", "tables", "key_value_items", "form_items")
SCHEMA = "document_id string, pages map<string,struct<page_no:int,size:struct<width:double,height:double>>>, " + ", ".join(f"{c} {_ITEM}" for c in COLLECTIONS)
# Item labels and the region types they become.
LABELS = {"picture": "image", "caption": "caption", "section_header": "unknown", "page_header": "header_metadata", "page_footer": "footer", "text": "unknown"}


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document."""
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path)


def pages(documents: DataFrame) -> DataFrame:
    """document_id, pdf_page, page_width, page_height."""
    each = documents.select("document_id", F.explode("pages").alias("key", "page"))
    return each.select("document_id", F.coalesce("page.page_no", F.expr("try_cast(key as int)")).alias("pdf_page"), F.col("page.size.width").alias("page_width"), F.col("page.size.height").alias("page_height"))


def regions(documents: DataFrame) -> DataFrame:
    """One row for each provenance fragment; items on unknown pages drop out."""
    parts = None
    for k, name in enumerate(COLLECTIONS):
        items = documents.select("document_id", F.lit(k).alias("collection"), F.posexplode(name).alias("item_ord", "item"))
        parts = items if parts is None else parts.unionByName(items)
    each = parts.select("document_id", "collection", "item_ord", "item.self_ref", "item.label", F.coalesce("item.text", "item.orig").alias("whole"), F.posexplode("item.prov").alias("fragment", "prov"))
    each = each.withColumn("pdf_page", F.col("prov.page_no")).join(pages(documents), ["document_id", "pdf_page"])
    span, b = F.col("prov.charspan"), F.col("prov.bbox")
    fits = (F.size(span) == 2) & (span[0] >= 0) & (span[1] <= F.length("whole")) & (span[1] > span[0])
    # the origin is the top left; from the bottom left the page's height turns y over
    bottom = b.coord_origin == "BOTTOMLEFT"
    known = bottom & F.col("page_height").isNotNull() | (b.coord_origin == "TOPLEFT")
    y0 = F.when(bottom, F.col("page_height") - F.greatest(b.t, b.b)).otherwise(F.least(b.t, b.b))
    y1 = F.when(bottom, F.col("page_height") - F.least(b.t, b.b)).otherwise(F.greatest(b.t, b.b))
    # tables and pictures are what their collection says, whatever their label
    kind = F.when(F.col("collection") == 2, "table").when(F.col("collection") == 1, "image").otherwise(F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("label")), F.lit("unknown")))
    return each.select(
        "document_id",
        "pdf_page",
        F.row_number().over(_order()).alias("region_ord"),
        F.concat_ws(":", "self_ref", F.concat(F.lit("page="), "pdf_page"), F.concat(F.lit("fragment="), "fragment")).alias("region_id"),
        kind.alias("type"),
        F.col("label").alias("raw_label"),
        F.when(fits, F.substring(F.col("whole"), span[0] + 1, span[1] - span[0])).otherwise(F.col("whole")).alias("text"),
        F.when(known, F.least(b.l, b.r)).alias("x0"),
        F.when(known, y0).alias("y0"),
        F.when(known, F.greatest(b.l, b.r)).alias("x1"),
        F.when(known, y1).alias("y1"),
        "page_width",
        "page_height",
    )


def _order():
    from pyspark.sql import Window

    return Window.partitionBy("document_id", "pdf_page").orderBy("collection", "item_ord", "fragment")
