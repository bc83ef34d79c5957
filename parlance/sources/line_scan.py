"""Transcript files read line by line (S1-S7, S10): a file may be larger than any task.

The text scan splits files; a split's lines stay in order.  Speakers are carried over the borders of blocks of lines by
prefix sums over one row per block, so no file, only an utterance, has to fit into a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from .. import schema as S
from ..functions import ordering
from ..session import ensure_checkpoint_dir
from .transcripts import (FORMATS, FRONT_MATTER_RE, LineRules, Transcripts, _empty, _nonblank, file_date, file_number,
                          front_matter, no_such_folder, read_transcripts, rules_of)

SPLIT = ["file_path", "block_start"]
#: lines of a split that are numbered together: 2 to this power at most
BLOCK_BITS = 13
#: end of a front-matter block: dashes at the start of a line or after white space
_CLOSE = r"(?U)(^|\s)---"


def read_lines(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """``file_path, block_start, pos, line`` of all ``*.{fmt}`` files: the lines of a file are in order of
    (``block_start``, ``pos``), ``pos`` counts up inside a split.  None if there is no such folder.

    The lines are checkpointed once: where files are split depends on the executors at hand, and the passes
    over the lines must agree on it.
    """
    ensure_checkpoint_dir(spark)
    try:
        raw = spark.read.text(path, pathGlobFilter=f"*.{fmt}")
    except AnalysisException as e:
        return no_such_folder(e)
    return raw.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_block_start").alias("block_start"),
                      F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line")).checkpoint(eager=True)


def list_files(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``file_path, file_name`` of all ``*.{fmt}`` files, also empty ones; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").load(path)
    return files.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"))


def without_front_matter(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S5 on lines: (lines after the block, ``file_path, metadata`` of files that have one).

    The block runs from a first line of dashes to the next dashes that start a line or follow white space; white
    space after it is dropped, also over line ends, as with whole files.
    """
    at = F.struct("block_start", "pos")
    line = F.col("line")
    starts = lines.groupBy("file_path").agg(F.min_by("line", at).alias("first"), F.min(at).alias("start")) \
        .where(F.col("first").rlike(r"(?U)^---(\s|$)"))
    # the block needs white space on both sides: a second line of dashes right after the first ends nothing
    tight = (F.col("first") == "---") & line.startswith("---") & (F.col("block_start") == F.col("start.block_start")) & (
        F.col("pos") == F.col("start.pos") + 1)
    ends = (at > F.col("start")) & line.rlike(_CLOSE) & ~tight
    heads = lines.join(starts, "file_path").groupBy("file_path").agg(
        F.min("start").alias("start"), F.min("first").alias("first"), F.min(F.when(ends, at)).alias("later")).select(
        "file_path", F.when(F.col("first").rlike(FRONT_MATTER_RE), F.col("start")).otherwise(F.col("later")).alias("close")) \
        .where("close IS NOT NULL")
    marked = lines.join(heads, "file_path")
    inside = marked.where(at <= F.col("close"))
    block = inside.groupBy("file_path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(
        "block_start", "pos", "line"))), lambda x: x["line"]), "\n").alias("block"))
    meta, rest = front_matter(F.col("block"))
    block = block.select("file_path", meta.alias("metadata"), rest.alias("rest"))
    # the first line with text after the block loses its white space in front
    after = marked.where((at > F.col("close")) & _nonblank(F.col("line"))).groupBy("file_path").agg(F.min(at).alias("body"))
    known = heads.join(block.select("file_path", "rest"), "file_path").join(after, "file_path", "left")
    j = lines.join(known, "file_path", "left")
    has, here = F.col("close").isNotNull(), at
    text = F.when(has & (here == F.col("close")), F.col("rest")) \
        .when(has & (F.col("rest") == "") & (here == F.col("body")), F.regexp_replace("line", r"(?U)^\s+", "")) \
        .otherwise(F.col("line"))
    kept = j.where(~has | (here >= F.col("close"))).select(*SPLIT, "pos", text.alias("line"))
    return kept, block.select("file_path", "metadata")


def segments(lines: DataFrame, rules: LineRules) -> DataFrame:
    """S6/S7 on lines: ``file_path, dialogue_idx, speaker, text``, a row per utterance.

    In a block of a split's lines, running sums number the speaker lines and the utterances that have text; a block's first
    lines belong to the last speaker before it, which one row per block carries on.
    """
    line = F.col("line")
    spoken = rules.is_speaker(line)
    block = [*SPLIT, "_blk"]
    e = lines.withColumn("_spk", spoken).where(F.col("_spk") | _nonblank(line)).select(
        *SPLIT, "pos", F.shiftright("pos", BLOCK_BITS).alias("_blk"), "_spk", F.when(F.col("_spk"), rules.speaker(line)).alias("speaker"),
        F.when(F.col("_spk"), rules.first(line)).otherwise(rules.rest(line)).alias("piece"))
    named = F.length("speaker") > 0
    e = e.withColumn("_waits", F.col("_spk") & F.col("piece").isNull() & named)
    w = Window.partitionBy(*block).orderBy("pos")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("_prev", F.lag("_waits").over(w))
    e = e.withColumn("_opens", F.when(F.col("_spk"), F.col("piece").isNotNull() & named)
                     .otherwise(F.coalesce("_prev", F.lit(False))))
    e = e.select("*", F.count_if("_spk").over(so_far).alias("_seg"), F.count_if("_opens").over(so_far).alias("_open"))
    splits = e.groupBy(*block).agg(
        F.count_if("_spk").alias("_spks"), F.count_if("_opens").alias("_opened"),
        F.count_if(F.col("_prev").isNull() & ~F.col("_spk")).alias("_goes_on"), F.max_by("_waits", "pos").alias("_last"))
    over = Window.partitionBy("file_path").orderBy("block_start", "_blk")
    splits = splits.withColumn("_more", F.when((F.col("_goes_on") > 0) & F.coalesce(
        F.lag("_last").over(over), F.lit(False)), 1).otherwise(0))
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select(
        *block, "_more", F.coalesce(F.sum("_spks").over(earlier), F.lit(0)).alias("_seg0"),
        F.coalesce(F.sum(F.col("_opened") + F.col("_more")).over(earlier), F.lit(0)).alias("_open0"))
    j = e.join(carried, block).select(
        "file_path", (F.col("_seg") + F.col("_seg0")).alias("_seg"),
        (F.col("_open") + F.col("_open0") + F.col("_more")).alias("_open"), "speaker",
        F.when(F.col("piece").isNotNull(), F.struct("block_start", "pos", "piece")).alias("_piece"))
    g = j.where("_seg > 0").groupBy("file_path", "_seg").agg(
        F.max("speaker").alias("speaker"), F.max("_open").alias("_open"), F.sort_array(F.collect_list("_piece")).alias("_p"))
    return g.where((F.size("_p") > 0) & (F.length("speaker") > 0)).select(
        "file_path", (F.col("_open") - 1).alias("dialogue_idx"), "speaker",
        F.array_join(F.transform("_p", lambda p: p["piece"]), " ").alias("text"))


def read_transcript_lines(spark: SparkSession, path: str, fmt: str = "mdx", compat: bool = False,
                          group_cols: tuple[str, ...] = (), speakers: tuple[str, ...] | None = None) -> Transcripts:
    """``read_transcripts`` for files of any size: same utterances, sessions without ``raw_content`` and ``dialogue``.

    ``session_key`` numbers the files by path, so no two files can share one.  A JSON transcript is one value and
    is still read whole.
    """
    if fmt.lower() not in FORMATS:
        raise ValueError(f"unsupported input format {fmt!r}; expected one of {FORMATS}")
    if fmt.lower() == "json":
        return read_transcripts(spark, path, fmt, compat, group_cols, speakers)
    narrow = ["session_key", "file_name", "file_path", "format", "metadata", "session_date", "session_number"]
    lines = read_lines(spark, path, fmt)
    if lines is None:
        sessions = _empty(spark, S.SESSIONS).select(*narrow)
        sessions = sessions.withColumn("transcript_idx", F.lit(None).cast("long"))
        return Transcripts(sessions, _empty(spark, S.UTTERANCES), _empty(spark, S.REJECTS))
    fmt = fmt.lower()
    meta = None
    if fmt == "mdx":
        lines, meta = without_front_matter(lines)
    files = ordering.dense_index(list_files(spark, path, fmt), [F.col("file_path").asc()], "session_key",
                                 key="file_path", order_cols=("file_path",))
    none = F.create_map().cast(S.METADATA)
    described = files.join(meta, "file_path", "left") if meta is not None else files.withColumn("metadata", none)
    sessions = described.select("session_key", "file_name", "file_path", F.lit(fmt).alias("format"),
                                F.coalesce("metadata", none).alias("metadata"),
                                file_date(F.col("file_name")).alias("session_date"),
                                file_number(F.col("file_name")).alias("session_number"))
    sessions = ordering.dense_index(sessions, ordering.session_order(), "transcript_idx", group_cols)
    found = segments(lines, rules_of(fmt, compat, speakers))
    utterances = found.join(files.select("file_path", "session_key"), "file_path").select(
        "session_key", "dialogue_idx", "speaker", "text")
    return Transcripts(sessions, utterances, _empty(spark, S.REJECTS))
