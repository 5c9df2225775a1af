"""Incremental processing: what a resume manifest does, as streams.

``new_files`` replays a folder once and remembers what it saw in its checkpoint.
``chain_state`` carries the running chain of each document from page to page.
``event_windows`` and ``event_sessions`` are extensions: tumbling windows, and sessions
that end after a time without events, both with a watermark.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def new_files(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, fingerprint: str) -> None:
    """Append rows of files not seen under this fingerprint of code and options.

    Each fingerprint has a checkpoint of its own, so a change of code or options reads
    every file again; its rows go to a partition of ``out`` of their own.
    """
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)
    mark = hashlib.sha256(fingerprint.encode()).hexdigest()[:16]
    rows.writeStream.format("parquet").option("checkpointLocation", f"{checkpoint}/{mark}").trigger(availableNow=True).start(f"{out}/fingerprint={mark}").awaitTermination()


STATE = "page long, start long, place long, tokens string"
OUT = "document_id long, pdf_page long, chain_start long, place long"
LONGEST, LEAST_SHARED = 6, 2


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    page, start, place, before = state.get if state.exists else (-2, -1, 0, "[]")
    tokens = set(json.loads(before))
    out = []
    for row in pd.concat(list(batches)).sort_values("pdf_page").itertuples():
        own = set(row.tokens)
        if page + 1 == row.pdf_page and place < LONGEST and len(own & tokens) >= LEAST_SHARED:
            place += 1
        else:
            start, place = row.pdf_page, 1
        page, tokens = row.pdf_page, own
        out.append((key[0], page, start, place))
    state.update((int(page), int(start), int(place), json.dumps(sorted(tokens))))
    yield pd.DataFrame(out, columns=["document_id", "pdf_page", "chain_start", "place"])


def chain_state(pages: DataFrame) -> DataFrame:
    """Streaming twin of the chain kernel; pages of a document must arrive in order."""
    return pages.groupBy("document_id").applyInPandasWithState(_advance, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def event_windows(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def event_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of a user's events without a break of ``gap``: (user_id, started, ended, n, total)."""
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return s.select("user_id", F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "n", "total")
