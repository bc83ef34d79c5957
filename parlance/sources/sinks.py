"""Sinks (S11-S13): flat utterance CSV, raw session JSON, report files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .report_files import report_format

#: metadata keys that become columns of their own in the flat table
MAX_METADATA_COLUMNS = 10_000


def flat_utterances(sessions: DataFrame, utterances: DataFrame, max_columns: int = MAX_METADATA_COLUMNS) -> DataFrame:
    """S11 table: one row per utterance with file/date/number and one ``metadata_<key>`` per key.

    The key set defines the schema, so it is the one thing gathered to the driver, and no more than
    ``max_columns`` + 1 keys of it.  Beyond that no table is that wide: all metadata are then one JSON column
    ``metadata``, whole.
    """
    keys = [r[0] for r in sessions.select(F.explode(F.map_keys("metadata")).alias("k"))
            .distinct().orderBy("k").limit(max_columns + 1).collect()]
    if len(keys) > max_columns:
        extra = [F.to_json("metadata").alias("metadata")]
        names = ["metadata"]
    else:
        extra = [F.col("metadata")[k].alias(f"metadata_{k}") for k in keys]
        names = [f"`metadata_{k}`" for k in keys]
    s = sessions.select("session_key", "file_name", "session_date", "session_number", *extra)
    return utterances.select("session_key", "dialogue_idx", "speaker", "text").join(s, "session_key") \
        .select("file_name", "session_date", "session_number", "speaker", "text", *names, "session_key", "dialogue_idx")


def write_flat_csv(sessions: DataFrame, utterances: DataFrame, path: str, mode: str = "overwrite"):
    """Header CSV (Parquet is the default working format; CSV is for export)."""
    flat_utterances(sessions, utterances).write.mode(mode).option("header", True).csv(path)


def write_raw_json(sessions: DataFrame, path: str, mode: str = "overwrite"):
    """Sessions as JSON Lines, dates as yyyy-MM-dd."""
    cols = [F.date_format("session_date", "yyyy-MM-dd").alias("session_date")
            if c == "session_date" else F.col(c) for c in sessions.columns]
    sessions.select(*cols).write.mode(mode).json(path)


def write_reports(reports: DataFrame, path: str, fmt: str = "md", as_text_files: bool = False,
                  mode: str = "overwrite"):
    """Write the reports table (group columns, ``session_key, report_name, content``).

    Default: Parquet table.  ``as_text_files``: one text folder per report
    (``partitionBy`` the group columns, session and name), content lines as written.  One named file per
    report: ``report_files.write_report_files``.
    """
    if as_text_files:
        keys = [c for c in reports.columns if c not in ("content", "insights", "recommendations")]
        reports.select(*keys, "content").write.mode(mode).partitionBy(*keys).text(path)
    else:
        reports.withColumn("format", F.lit(report_format(fmt))).write.mode(mode).parquet(path)
