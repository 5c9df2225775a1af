"""Odd rows of pages: nulls, very long pages, repeats, empty tables, clashing columns."""

from pyspark.sql import functions as F

from layoutlake.llm import byte_bpe, html_text


def test_odd_pages(spark):
    long = "<article>" + "".join(f"<p>Paragraph {k} has a few words and no link at all in it</p>" for k in range(20_000)) + "</article>"
    rows = [(None, None, None), (1, "u", ""), (1, "u", long), (2, "v", long), (3, "w", "<" * 5_000), (4, "x", "<div>" * 3_000 + "text")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own")).withColumn("n_chars", F.lit(-1))
    out = html_text.extract(df.repartition(3)).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    texts = sorted((str(r.page_id), r.text.count("\n")) for r in out)
    assert texts[:4] == [("1", 0), ("1", 19_999), ("2", 19_999), ("3", 0)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_odd_texts_for_the_tokenizer(spark):
    import public_tokenizers as P

    rows = [(None, None), (1, "a " * 300_000), (1, ""), (2, "x" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("own")).withColumn("decoded", F.lit(1))
    out = byte_bpe.digest(df, P.path(byte_bpe.RANKS_FILE), P.PATTERN).collect()
    assert len(out) == 4 and sorted(r.n_tokens > 0 for r in out) == [False, False, True, True]
    whole = byte_bpe.encode(df, P.path(byte_bpe.RANKS_FILE), P.PATTERN).collect()
    assert sorted(len(r.decoded) for r in whole) == [0, 0, 50_000, 600_000]
