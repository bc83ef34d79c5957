"""Report files (S13) as a data source: one named, time-stamped file per report, written by the tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..functions.ordering import join_groups

REPORT_FORMATS = ("md", "txt", "html")


def report_format(fmt: str) -> str:
    """Lower case; unknown formats fall back to md; html is the same text, unrendered."""
    return fmt.lower() if fmt.lower() in REPORT_FORMATS else "md"


def report_file_name(name, fmt: str, stamp: str):
    """``<name with spaces as _>_<stamp>.<fmt>`` as a column expression."""
    return F.concat(F.regexp_replace(name, " ", "_"), F.lit(f"_{stamp}.{report_format(fmt)}"))


@dataclass
class Written(WriterCommitMessage):
    files: int


class ReportFileWriter(DataSourceWriter):
    """Rows ``file, content``: a file each below the folder.

    A task writes each file under a temporary name and moves it to its own in one step, so a reader never
    sees half a report and a task that runs again (a lost executor, speculation) puts the same file in the same
    place.  The job's commit leaves ``_SUCCESS`` with the number of files; without it the folder is incomplete, and a
    run with the same stamp completes it.  Only counts go to the driver.
    """

    def __init__(self, path: str):
        self.path = path

    def _folder(self):
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator) -> Written:
        files, root = self._folder()
        made, n = set(), 0
        for row in iterator:
            target = f"{root}/{row.file}"
            folder = target.rsplit("/", 1)[0]
            if folder not in made:
                files.create_dir(folder, recursive=True)
                made.add(folder)
            part = f"{folder}/_{uuid.uuid4().hex}"
            with files.open_output_stream(part) as out:
                out.write((row.content or "").encode("utf-8"))
            files.move(part, target)
            n += 1
        return Written(n)

    def commit(self, messages: list) -> None:
        files, root = self._folder()
        files.create_dir(root, recursive=True)
        with files.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(str(sum(m.files for m in messages if m is not None)).encode())

    def abort(self, messages: list) -> None:
        """Whole files stay: they are right, and the next run with the stamp writes them again."""


class ReportFiles(DataSource):
    """``df.write.format("report_files").mode("append").save(folder)`` for rows ``file, content``."""

    @classmethod
    def name(cls) -> str:
        return "report_files"

    def schema(self) -> str:
        return "file string, content string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ReportFileWriter(self.options["path"])


def file_rows(reports: DataFrame, fmt: str, stamp: str) -> DataFrame:
    """``file, content``: group columns are folders ``column=value``; equal names in a folder get the session's key."""
    keys = [c for c in reports.columns if c not in (
        "content", "insights", "recommendations", "session_key", "report_name", "format")]
    named = reports.select(*keys, "session_key", F.regexp_replace("report_name", "[ /]", "_").alias("__name"), "content")
    same = named.groupBy(*keys, "__name").agg(F.count(F.lit(1)).alias("__same"))
    j = join_groups(named, same, [*keys, "__name"])
    name = F.when(F.col("__same") > 1, F.concat_ws("_", "__name", F.col("session_key").cast("string"))).otherwise(F.col("__name"))
    safe = lambda k: F.regexp_replace(F.coalesce(F.col(k).cast("string"), F.lit("none")), "[^\\w.-]", "_")
    folders = [F.concat(F.lit(f"{k}="), safe(k)) for k in keys]
    return j.select(F.concat_ws("/", *folders, report_file_name(name, fmt, stamp)).alias("file"), "content")


def write_report_files(reports: DataFrame, path: str, fmt: str = "md", stamp: str | None = None) -> str:
    """One file per report below ``path``; returns the stamp (default: now, ``yyyymmdd_hhmmss``).

    A run with the stamp of an earlier one writes the same names again: no duplicates.  ``path`` is a folder or URI
    that all executors share.
    """
    stamp = stamp or datetime.now().strftime("%Y%m%d_%H%M%S")
    reports.sparkSession.dataSource.register(ReportFiles)
    target = path if "://" in path else f"file://{path}"
    file_rows(reports, fmt, stamp).write.format("report_files").mode("append").save(target)
    return stamp
