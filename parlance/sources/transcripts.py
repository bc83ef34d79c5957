"""Transcript directory source.

One file is one session.  Files are read whole (``wholetext``) with their
name from ``_metadata``; every parser is a per-row column expression over
the file content (split into lines, find speaker lines, slice the
continuation lines between them), so parsing needs no shuffle and no Python
worker.  The result is a session table (metadata, raw content, file-name
date and number, dialogue array) and an utterance table exploded from it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import schema as S
from ..functions import ordering
from ..functions.text import strip_py

FORMATS = ("mdx", "md", "json", "txt", "text")

# Python-compatible patterns (Java needs (?U) for Unicode \w \s, (?s) for '.').
SPEAKER_RE = r"(?Us)^([\w\s]+):\s*(.*)"
FRONT_MATTER_RE = r"(?Us)^---\s+(.*?)\s+---\s*"
DATE_RE = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"
NUMBER_RE = r"(?U)_([0-9]+)\.\w+$"

JSON_SCHEMA = T.StructType([
    T.StructField("metadata", S.METADATA),
    T.StructField("dialogue", T.ArrayType(S.DIALOGUE_ENTRY)),
    T.StructField("transcript", T.ArrayType(S.DIALOGUE_ENTRY)),
    T.StructField("raw_content", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])


@dataclass
class Transcripts:
    sessions: DataFrame
    utterances: DataFrame
    rejects: DataFrame


def _nonblank(c: Column) -> Column:
    return c.rlike(r"(?U)\S")


def file_date(name: Column) -> Column:
    """S3: first yyyy-mm-dd in the name; impossible calendar dates give null."""
    return F.try_to_date(F.nullif(F.regexp_extract(name, DATE_RE, 1), F.lit("")), "yyyy-MM-dd")


def file_number(name: Column) -> Column:
    """Digits between '_' and the extension."""
    return F.nullif(F.regexp_extract(name, NUMBER_RE, 1), F.lit("")).try_cast("int")


def normalize_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def front_matter(content: Column) -> tuple[Column, Column]:
    """(metadata map, content without the block).  Quotes kept; last duplicate key wins."""
    block = F.regexp_extract(content, FRONT_MATTER_RE, 1)
    has = content.rlike(FRONT_MATTER_RE)
    lines = F.filter(F.split(block, "\n"), lambda l: l.contains(":"))
    entries = F.transform(lines, lambda l: F.struct(
        strip_py(F.substring_index(l, ":", 1)).alias("key"),
        strip_py(F.regexp_extract(l, r"(?s)^[^:]*:(.*)$", 1)).alias("value")))
    rev = F.reverse(entries)
    keys = F.transform(rev, lambda e: e["key"])
    last = F.filter(rev, lambda e, i: F.array_position(keys, e["key"]) == i + 1)
    meta = F.when(has, F.map_from_entries(last)).otherwise(F.create_map().cast(S.METADATA))
    rest = F.when(has, F.regexp_replace(content, FRONT_MATTER_RE, "")).otherwise(content)
    return meta, rest


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column computed once per row.

    The one-row generator keeps Catalyst from inlining the expression into the lambda functions that
    read the column, where it would be evaluated again for every line.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _segments(df: DataFrame, content: str, name: str, is_speaker, speaker_of, first_piece, piece) -> DataFrame:
    """Generic line segmentation: a speaker line opens a segment that runs to the next one.

    Linear in the lines of a file: the lines and the positions of speaker lines are columns of
    their own, and each segment is one slice.
    """
    keep = df.columns
    df = _once(df, "_lines", F.split(F.col(content), "\n"))
    lines, starts = F.col("_lines"), F.col("_starts")
    df = _once(df, "_starts", F.filter(F.transform(lines, lambda l, i: F.when(is_speaker(l), i)), lambda i: i.isNotNull()))
    n, m = F.size(lines), F.size(starts)

    def seg(p, k):
        end = F.when(k + 1 < m, F.element_at(starts, k + 2)).otherwise(n)
        line = F.element_at(lines, p + 1)
        cont = F.filter(F.slice(lines, p + 2, end - p - 1), _nonblank)
        pieces = F.concat(first_piece(line), F.transform(cont, piece))
        return F.struct(speaker_of(line).alias("speaker"), F.array_join(pieces, " ").alias("text"),
                        F.size(pieces).alias("_n"))

    segs = F.transform(starts, seg)
    full = F.filter(segs, lambda s: (s["_n"] > 0) & (F.length(s["speaker"]) > 0))
    return df.select(*keep, F.transform(full, lambda s: F.struct(
        s["speaker"].alias("speaker"), s["text"].alias("text"))).alias(name))


@dataclass
class LineRules:
    """What a line means: does it open a segment, whose, with which text (null: none), and its text otherwise."""

    is_speaker: Callable[[Column], Column]
    speaker: Callable[[Column], Column]
    first: Callable[[Column], Column]
    rest: Callable[[Column], Column]


def colon_rules(speakers: tuple[str, ...] | None = None) -> LineRules:
    """``Speaker: text`` lines; ``speakers`` is an optional allow-list."""
    def is_speaker(line):
        m = line.rlike(SPEAKER_RE)
        if speakers:
            m = m & F.regexp_extract(line, SPEAKER_RE, 1).isin(list(speakers))
        return m

    return LineRules(is_speaker, lambda l: F.regexp_extract(l, SPEAKER_RE, 1),
                     lambda l: F.nullif(F.regexp_extract(l, SPEAKER_RE, 2), F.lit("")), lambda l: l)


def bold_rules(compat: bool = False) -> LineRules:
    """``**Speaker**`` lines (see ``bold_dialogue``)."""
    is_spk = lambda l: strip_py(l).startswith("**")

    def literal_name(l):  # strip()[2:-2].strip()
        s = strip_py(l)
        return strip_py(s.substr(F.lit(3), F.length(s) - 4))

    if compat:
        return LineRules(is_spk, literal_name, lambda l: F.lit(None).cast("string"), strip_py)
    bold = r"(?Us)^\s*\*\*(.*?)\*\*\s*:?(.*)$"

    def speaker(l):
        fixed = strip_py(F.regexp_replace(strip_py(F.regexp_extract(l, bold, 1)), r":$", ""))
        return F.when(l.rlike(bold), fixed).otherwise(literal_name(l))

    return LineRules(is_spk, speaker, lambda l: F.when(
        l.rlike(bold), F.nullif(strip_py(F.regexp_extract(l, bold, 2)), F.lit(""))), strip_py)


def rules_of(fmt: str, compat: bool = False, speakers: tuple[str, ...] | None = None) -> LineRules:
    return bold_rules(compat) if fmt == "md" else colon_rules(speakers)


def _dialogue(df: DataFrame, content: str, rules: LineRules, name: str) -> DataFrame:
    pieces = lambda l: F.filter(F.array(rules.first(l)), lambda x: x.isNotNull())
    return _segments(df, content, name, rules.is_speaker, rules.speaker, pieces, rules.rest)


def colon_dialogue(df: DataFrame, content: str, speakers: tuple[str, ...] | None = None,
                   name: str = "dialogue") -> DataFrame:
    """S6 (adds the column ``name``): ``Speaker: text`` lines; continuation lines appended unstripped; blanks dropped.

    ``speakers`` (optional allow-list): only these names open a segment, so a
    prose line such as ``I said: fine`` stays a continuation line.
    """
    return _dialogue(df, content, colon_rules(speakers), name)


def bold_dialogue(df: DataFrame, content: str, compat: bool = False, name: str = "dialogue") -> DataFrame:
    """S7 (adds the column ``name``): ``**Speaker**`` lines; following non-blank lines appended stripped.

    ``compat=True`` keeps the literal name rule (``strip()[2:-2].strip()``:
    ``**Client:**`` -> ``Client:``, inline text after ``**`` lost); the default
    strips a trailing colon and keeps inline text after the closing ``**``.
    """
    return _dialogue(df, content, bold_rules(compat), name)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def no_such_folder(e: AnalysisException) -> None:
    """A missing folder is an empty input; any other failure of a read stays one."""
    if e.getCondition() != "PATH_NOT_FOUND":
        raise e


def read_files(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """Non-recursive scan of ``*.{fmt}`` files, one row per file (None if nothing)."""
    try:
        raw = spark.read.text(path, wholetext=True, pathGlobFilter=f"*.{fmt}",
                              recursiveFileLookup=False)
    except AnalysisException as e:
        return no_such_folder(e)
    return raw.select(F.col("_metadata.file_name").alias("file_name"),
                      F.col("_metadata.file_path").alias("file_path"),
                      normalize_newlines(F.col("value")).alias("content"))


def parse(files: DataFrame, fmt: str, compat: bool = False,
          speakers: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse file rows into (sessions, rejects) for one format."""
    fmt = fmt.lower()
    base = [F.xxhash64("file_path").alias("session_key"), "file_name", "file_path",
            F.lit(fmt).alias("format")]
    dates = [file_date(F.col("file_name")).alias("session_date"),
             file_number(F.col("file_name")).alias("session_number")]
    empty_meta = F.create_map().cast(S.METADATA)
    if fmt == "mdx":
        meta, rest = front_matter(F.col("content"))
        s = files.select(*base, meta.alias("metadata"), rest.alias("raw_content"), *dates)
        return colon_dialogue(s, "raw_content", speakers), None
    if fmt in ("txt", "text"):
        s = files.select(*base, empty_meta.alias("metadata"), F.col("content").alias("raw_content"),
                         *dates)
        return colon_dialogue(s, "raw_content", speakers), None
    if fmt == "md":
        s = files.select(*base, empty_meta.alias("metadata"), F.col("content").alias("raw_content"),
                         *dates)
        return bold_dialogue(s, "raw_content", compat), None
    if fmt == "json":
        j = files.select(*base, *dates, F.from_json(
            "content", JSON_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
        ).alias("j"))
        bad = F.col("j").isNull() | F.col("j._corrupt").isNotNull()
        ok = j.where(~bad).select(
            "session_key", "file_name", "file_path", "format",
            F.coalesce("j.metadata", empty_meta).alias("metadata"),
            F.col("j.raw_content").alias("raw_content"), "session_date", "session_number",
            F.coalesce("j.dialogue", "j.transcript", F.array().cast(T.ArrayType(S.DIALOGUE_ENTRY)))
             .alias("dialogue"))
        rej = j.where(bad).select("file_name", "file_path", "format",
                                  F.lit("malformed JSON").alias("error"))
        return ok, rej
    raise ValueError(f"unsupported input format {fmt!r}; expected one of {FORMATS}")


def utterances_of(sessions: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per dialogue entry: (session_key, dialogue_idx, speaker, text, *carry)."""
    e = sessions.select("session_key", *carry, F.posexplode("dialogue").alias("dialogue_idx", "d"))
    return e.select("session_key", F.col("dialogue_idx").cast("bigint"), F.col("d.speaker").alias("speaker"),
                    F.col("d.text").alias("text"), *carry)


def read_transcripts(spark: SparkSession, path: str, fmt: str = "mdx", compat: bool = False,
                     group_cols: tuple[str, ...] = (),
                     speakers: tuple[str, ...] | None = None) -> Transcripts:
    """Read a transcript directory into sessions, utterances and rejects.

    ``sessions`` carries ``transcript_idx`` (S10: date, number with 0 as
    missing, file name; per ``group_cols`` group when given).  A missing
    directory or no matching file gives empty tables with the schema.
    """
    if fmt.lower() not in FORMATS:
        raise ValueError(f"unsupported input format {fmt!r}; expected one of {FORMATS}")
    files = read_files(spark, path, fmt)
    if files is None:
        sessions = _empty(spark, S.SESSIONS)
        rejects = _empty(spark, S.REJECTS)
    else:
        sessions, rejects = parse(files, fmt, compat, speakers)
        if rejects is None:
            rejects = _empty(spark, S.REJECTS)
    # utterances come from the parsed rows, not from those that the index is joined to: their text is not moved
    utterances = utterances_of(sessions)
    sessions = ordering.dense_index(sessions, ordering.session_order(), "transcript_idx", group_cols)
    return Transcripts(sessions=sessions, utterances=utterances, rejects=rejects)
