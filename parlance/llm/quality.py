"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import barrier, word_array

#: length of the windows of words that count as repeated
WINDOW = 8
#: frequent function words of the languages that the rules let through
STOP_WORDS = ("the of and to in is that for it with as on was are be by this from or not "
              "der die das und in zu den von ist mit sich auf für nicht ein eine im dem "
              "le la les de des et en un une que est pour dans qui sur pas plus par "
              "el los las del y que en un una por con para no su es se al").split()


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high``; a side that is None has no bound."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: metric expressions are over the base columns of ``quality_metrics``
METRICS = {
    "mean_word_chars": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "stop_words": "n_stop_words",
    "repeated_line_share": "n_dup_lines / n_lines",
    "bullet_line_share": "n_bullet_lines / n_lines",
    "ellipsis_line_share": "n_ellipsis_lines / n_lines",
}
RULES = (
    Rule("word length", "mean_word_chars", 2, 15),
    Rule("symbols", "symbols_per_word", None, 0.2),
    Rule("stop words", "stop_words", 1, None),
    Rule("repeated lines", "repeated_line_share", None, 0.5),
    Rule("bullet lines", "bullet_line_share", None, 0.9),
    Rule("ellipsis lines", "ellipsis_line_share", None, 0.5),
)


def _word_hash(word: str) -> int:
    h = xxhash.xxh64_intdigest(word.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def quality_metrics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every text: the base columns of the rules.

    Repeated windows are found by sorting their 64-bit hashes within the row, and only in texts
    that have any; every step is linear or n log n in the words of a text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = barrier(docs.select(F.col(doc_id).alias("__id"), t.alias("__t")),
                __w=word_array(F.col("__t")), __l=F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    stops = sorted({_word_hash(v) for w in STOP_WORDS for v in (w, w.capitalize(), w.upper())})
    d = barrier(d, __h=F.transform("__w", lambda w: F.xxhash64(w)))
    n = F.size("__h")
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
        *[F.get("__h", i + k) for k in range(WINDOW)]))
    d = barrier(d, __x=F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    again = F.size(F.array_distinct("__x")) < F.size("__x")
    d = barrier(d, __s=F.when(again, F.sort_array(F.transform("__x", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(F.get(F.col("__s"), j)["h"] == x["h"], F.lit(False))
    places = F.transform("__s", lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
    d = barrier(d, __p=F.sort_array(F.filter(places, lambda p: p.isNotNull())))
    covered = F.aggregate(
        "__p", F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["at"])).alias("n")),
        lambda acc: acc["n"])
    blank = " \t\n\x0b\x0c\r"
    count = lambda pattern: F.size(F.filter("__l", lambda x: x.rlike(pattern)))
    return d.select(
        F.col("__id").alias(doc_id), F.size("__w").cast("long").alias("n_words"),
        F.length(F.translate("__t", blank, "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("__h", lambda h: h.isin(*stops))).cast("long").alias("n_stop_words"),
        F.size("__l").cast("long").alias("n_lines"),
        count(r"^\s*[-*•]\s").cast("long").alias("n_bullet_lines"),
        count(r"(\.\.\.|…)\s*$").cast("long").alias("n_ellipsis_lines"))


def compiled(rules: tuple[Rule, ...]) -> Column:
    """The names of the failed rules as one array expression; a metric without a value fails nothing."""
    failed = []
    for r in rules:
        value = F.expr(METRICS[r.metric].replace("/ n_words", "/ nullif(n_words, 0)").replace("/ n_lines", "/ nullif(n_lines, 0)"))
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (value < r.low)
        if r.high is not None:
            bad = bad | (value > r.high)
        failed.append(F.when(bad, F.lit(r.name)))
    return F.filter(F.array(*failed), lambda x: x.isNotNull())


def judge_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``failed_rules`` and ``kept`` for every input row.

    A text of fewer than 20 words, or with more than 30% of its words in repeated windows, fails
    the base check; otherwise it is kept if it fails no rule.  Null texts count as empty and fail;
    repeated rows come out as often as they come in; an empty table gives no rows; other columns
    are not read.
    """
    m = quality_metrics(docs, doc_id, text)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return m.withColumn("base_failed", base).withColumn("failed_rules", compiled(rules)) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))



