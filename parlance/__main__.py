"""Command line: ``python -m parlance --input DIR --format mdx --lexicon lexicon.csv --output OUT``.

The lexicon (and optional boosters / negators / lemmas) are CSV files with a
header: ``term,valence`` / ``term,scalar`` / ``term`` / ``surface,lemma`` (idioms: ``phrase,valence``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .options import ReportOptions, SentimentOptions, TopicOptions
from .plans.analysis import analyze_directory, write_outputs
from .session import get_spark


def _csv(spark: SparkSession, path: str | None, schema: str):
    return spark.read.option("header", True).schema(schema).csv(path) if path else None


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="parlance")
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--format", default="mdx")
    ap.add_argument("--lexicon", required=True)
    ap.add_argument("--boosters")
    ap.add_argument("--negators")
    ap.add_argument("--lemmas")
    ap.add_argument("--idioms", help="CSV of phrase,valence")
    ap.add_argument("--group-by", action="append", default=[], help="metadata key that tells clients apart (repeatable)")
    ap.add_argument("--split-files", action="store_true", help="read line by line: files larger than a task")
    ap.add_argument("--positive-threshold", type=float, default=0.05)
    ap.add_argument("--negative-threshold", type=float, default=-0.05)
    ap.add_argument("--topics", type=int, default=5)
    ap.add_argument("--passes", type=int, default=10)
    ap.add_argument("--report-format", default="md")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = get_spark(master=a.master)
    res = analyze_directory(
        spark, a.input, a.format, _csv(spark, a.lexicon, "term string, valence double"),
        boosters=_csv(spark, a.boosters, "term string, scalar double"),
        negators=_csv(spark, a.negators, "term string"),
        lemmas=_csv(spark, a.lemmas, "surface string, lemma string"),
        idioms=_csv(spark, a.idioms, "phrase string, valence double"),
        group_by=tuple(a.group_by), split_files=a.split_files,
        sent_opts=SentimentOptions(positive_threshold=a.positive_threshold, negative_threshold=a.negative_threshold),
        topic_opts=TopicOptions(num_topics=a.topics, passes=a.passes),
        report_opts=ReportOptions(save_format=a.report_format))
    write_outputs(res, a.output, a.report_format)
    res.release()


if __name__ == "__main__":
    main()
