"""Incremental transcript ingestion with Structured Streaming.

The batch source (S1) reads a directory once.  This is the same scan as a file stream: new files are parsed and
scored with the batch operators.  A micro-batch writes its sessions, scored utterances and rejects (S9) below
``epoch=<number>`` of each table and replaces that folder if it runs again, so a replayed batch doubles no row.
Progress lives below the sink unless a folder is given, so a query started again on the same sink goes on where it
stopped.  Session-level roll-ups are batch queries over the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import preprocess as pp
from ..operators import sentiment as se
from ..options import SentimentOptions, TextOptions
from ..sources import transcripts as tr


def transcript_stream(spark: SparkSession, path: str, fmt: str = "mdx", max_files: int = 1000) -> DataFrame:
    """Streaming version of S1: one row per new file (``file_name, file_path, content``)."""
    raw = (spark.readStream.format("text").option("wholetext", True)
           .option("pathGlobFilter", f"*.{fmt}").option("maxFilesPerTrigger", max_files).load(path))
    return raw.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"),
                      tr.normalize_newlines(F.col("value")).alias("content"))


def score_batch(files: DataFrame, epoch: int, sink: str, fmt: str, lexicon: DataFrame, boosters: DataFrame | None = None,
                negators: DataFrame | None = None, text_opts: TextOptions = TextOptions(),
                sent_opts: SentimentOptions = SentimentOptions()) -> None:
    """Parse and score one batch of files; its folders are replaced."""
    sessions, rejects = tr.parse(files, fmt)
    scored = se.score_utterances(pp.preprocess(tr.utterances_of(sessions), text_opts), lexicon, boosters, negators, opts=sent_opts)
    tables = {"sessions": sessions.drop("dialogue"), "utterance_sentiment": scored}
    if rejects is not None:
        tables["rejects"] = rejects
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(os.path.join(sink, name, f"epoch={epoch}"))


def start_scoring(spark: SparkSession, path: str, sink: str, lexicon: DataFrame,
                  boosters: DataFrame | None = None, negators: DataFrame | None = None,
                  fmt: str = "mdx", text_opts: TextOptions = TextOptions(),
                  sent_opts: SentimentOptions = SentimentOptions(), checkpoint: str | None = None,
                  available_now: bool = False):
    """Start a query that adds parsed sessions, scored utterances and rejects for every new file."""
    def batch(df: DataFrame, epoch: int) -> None:
        score_batch(df, epoch, sink, fmt, lexicon, boosters, negators, text_opts, sent_opts)

    w = transcript_stream(spark, path, fmt).writeStream.foreachBatch(batch) \
        .option("checkpointLocation", checkpoint or os.path.join(sink, "_progress"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
