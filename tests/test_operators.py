"""Ranking, intervals and kernels on small frames."""

import pandas as pd
from pyspark.sql import functions as F

from layoutlake.operators import intervals, kernels, ranking
from layoutlake.sources import layout_json, reports


def test_winner(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 2, 0.7), ("b", 1, 0.8), ("b", 2, 0.75), ("c", 1, 0.5), ("d", 1, 0.9)], "k string, c int, s double")
    out = {r.k: r.status for r in ranking.winner(df, ["k"], "c", "s", 0.6, 0.1).collect()}
    assert out == {"a": "accepted", "b": "ambiguous", "c": "rejected", "d": "accepted"}


def test_nearest_takes_the_smaller_on_ties(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 2, 1.0), ("a", 1, 5.0)], "k string, v int, d double")
    assert ranking.nearest(df, ["k"], "v", "d").first().v == 2


def test_intervals(spark):
    df = spark.createDataFrame([("a", 0, 2, 6), ("a", 4, 6, 6), ("b", 1, 3, 5), ("b", 2, 4, 5)], "k string, start int, end int, n int")
    assert sorted(tuple(r) for r in intervals.gaps(df, ["k"], "n").collect()) == [("a", 2, 4), ("b", 0, 1), ("b", 4, 5)]
    assert sorted(tuple(r) for r in intervals.merged(df, ["k"]).collect()) == [("a", 0, 2), ("a", 4, 6), ("b", 1, 4)]


def _page(kind_owner):
    rows = [("d", 1, i, kind, float(x), float(y), float(x) + 200, float(y) + 20, 600.0, owner) for i, (kind, x, y, owner) in enumerate(kind_owner)]
    return pd.DataFrame(rows, columns=["document_id", "pdf_page", "region_ord", "kind", "x0", "y0", "x1", "y1", "page_width", "article_id"])


def test_columns_come_left_to_right():
    page = kernels.page_columns(_page([("body", 300, 0, None), ("body", 20, 0, None), ("body", 305, 30, None)]))
    assert page.column.tolist() == [1, 0, 1]


def test_membership_spreads_and_keeps_ambiguous_open():
    page = kernels.page_membership(_page([("body", 20, 0, "x"), ("body", 20, 25, None), ("body", 20, 50, None), ("body", 300, 0, None)]))
    assert page.article_id.tolist() == ["x", "x", "x", None]
    both = kernels.page_membership(_page([("body", 20, 0, "x"), ("body", 20, 60, "y"), ("body", 20, 30, None)]))
    assert both.article_id.tolist() == ["x", "y", None]


def test_assembly_joins_attested_words():
    parts = pd.DataFrame({"document_id": ["d"] * 3, "pdf_page": [1] * 3, "region_ord": [0, 1, 2], "text": ["la citta vede il mer-", "cato riapre", "Il mercato."]})
    out = kernels.assemble(parts).iloc[0]
    assert out.body == "la citta vede il mercato riapre\n\nIl mercato." and out.joined == 1


def test_layout_json(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"document_id":"d","pages":{"1":{"page_no":1,"size":{"width":600,"height":800}}},"texts":[{"self_ref":"#/texts/0","label":"text","text":"hello world","prov":[{"page_no":1,"charspan":[0,5],"bbox":{"l":10,"t":700,"r":110,"b":680,"coord_origin":"BOTTOMLEFT"}},{"page_no":9,"charspan":[6,11],"bbox":null}]}],"pictures":[{"self_ref":"#/pictures/0","label":"picture","prov":[{"page_no":1,"charspan":[0,0],"bbox":{"l":0,"t":0,"r":5,"b":9,"coord_origin":"TOPLEFT"}}]}]}')
    rows = {r.region_id: r for r in layout_json.regions(layout_json.read(spark, str(tmp_path))).collect()}
    first = rows["#/texts/0:page=1:fragment=0"]
    assert len(rows) == 2 and first.text == "hello" and (first.y0, first.y1) == (100.0, 120.0)
    assert rows["#/pictures/0:page=1:fragment=0"].type == "image"


def test_audit_rates(spark):
    df = spark.createDataFrame([("2024", "sì", "no"), ("2024", "0", "?"), ("2024", "TRUE", None)], "year string, title_ok string, body_ok string")
    out = {r.verdict: (r.reviewed, r.rate) for r in reports.audit_rates(df, ["year"], ["title_ok", "body_ok"]).collect()}
    assert out == {"title_ok": (3, 0.6667), "body_ok": (1, 0.0)}


def test_csv_joins_lists(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], 5)], "id int, names array<string>, extra int")
    reports.write_csv(df, str(tmp_path / "out"), ["id", "names"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).first().asDict() == {"id": "1", "names": "a; b"}


def test_chain_state_stream_equals_kernel(spark, tmp_path):
    from layoutlake.streaming.resume import chain_state

    rows = [(1, 0, ["aa", "bb"]), (1, 1, ["aa", "bb"]), (1, 3, ["aa", "bb"]), (2, 0, ["x"]), (2, 1, ["x"])]
    df = spark.createDataFrame(rows, "document_id long, pdf_page long, tokens array<string>")
    want = sorted(tuple(r) for r in kernels.chains(df).collect())
    df.write.parquet(str(tmp_path / "in"))
    stream = chain_state(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("chains").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("chains").collect()) == want


def test_resume_reads_each_file_once(spark, tmp_path):
    from layoutlake.streaming.resume import new_files

    args = (str(tmp_path / "in"), "id long", str(tmp_path / "out"), str(tmp_path / "c"), "v1")
    spark.range(3).write.parquet(args[0])
    new_files(spark, *args)
    spark.range(3, 5).write.mode("append").parquet(args[0])
    new_files(spark, *args)
    assert spark.read.parquet(args[2]).agg(F.count("*"), F.countDistinct("id")).first()[:] == (5, 5)
    # other code reads every file again
    new_files(spark, *args[:4], "v2")
    assert sorted(r["count"] for r in spark.read.parquet(args[2]).groupBy("fingerprint").count().collect()) == [5, 5]


def test_event_windows_and_sessions(spark, tmp_path):
    from layoutlake.streaming.resume import event_sessions, event_windows

    rows = [(u, f"2024-01-01 {h:02d}:{m:02d}:00", "a", 1.0) for u, h, m in ((1, 0, 0), (1, 0, 20), (1, 2, 0), (2, 0, 5))]
    df = spark.createDataFrame(rows, "user_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted((r.user_id, r.n) for r in event_sessions(df).collect()) == [(1, 1), (1, 2), (2, 1)]
    df.write.parquet(str(tmp_path / "in"))
    stream = event_windows(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "1 hour")
    q = stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("windows").collect()) == [1, 3]
