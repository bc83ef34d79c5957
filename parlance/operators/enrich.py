"""Optional text-generation enrichment (L1-L10) as batch inference over a DataFrame.

Prompts are column expressions built per session (or per client group for
the progress prompt); the completion itself is a caller-supplied function
``complete(list[str]) -> list[str]`` applied with ``mapInPandas`` over
prompt batches, so calls run in parallel on executors with no network
client shipped here.  Replies are sectioned with array functions.
"""

from __future__ import annotations

import inspect
import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import EnrichOptions
from ..functions.labels import fixed
from ..functions.text import strip_py
from .progress import top_terms

# Prompt texts.
SUMMARY_ASK = ("Please analyze this therapy session transcript and provide:\n\n"
               "1. A concise summary (3-5 sentences)\n"
               "2. 3-5 key insights or patterns\n"
               "3. Notable emotional themes\n"
               "4. Potential areas for therapeutic focus\n\n")
ANALYSIS_ASK = ("Please analyze this therapy session transcript along with the provided sentiment and "
                "topic analysis results. Provide:\n\n"
                "1. A contextual interpretation integrating the sentiment and topic analysis with the content\n"
                "2. 3-5 evidence-based insights that draw from both the quantitative analysis and the "
                "transcript content\n"
                "3. Suggested therapeutic approaches based on the combined analysis\n\n")
#: characters of the content that the reference sends
COMPAT_CHARS = 4000
PROGRESS_ASK = ("1. Key changes in emotional patterns and sentiment\n"
                "2. Evolution of discussion topics and themes\n"
                "3. Observable therapeutic progress\n"
                "4. Potential areas for future focus\n"
                "5. Evidence-based recommendations for continued treatment\n\n")
NO_SENTIMENT = "Sentiment data not available for this specific transcript."
NO_TOPIC = "Topic data not available for this specific transcript."


def _s(c: Column) -> Column:
    """Python's str() of an optional value: None -> 'None'."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def _f2(c: Column) -> Column:
    """'%.2f' of a double, via decimal(38,10) so last-bit noise cannot flip a .xx5 tie."""
    return fixed(c, 2)


def session_content(sessions: DataFrame, utterances: DataFrame) -> DataFrame:
    """L1: raw content, else ``speaker: text`` entries joined by blank lines."""
    lines = F.array_sort(F.collect_list(F.struct(
        "dialogue_idx", F.concat(F.coalesce("speaker", F.lit("Unknown")), F.lit(": "),
                                 F.coalesce("text", F.lit(""))).alias("l"))))
    rebuilt = utterances.groupBy("session_key").agg(
        F.array_join(F.transform(lines, lambda x: x["l"]), "\n\n").alias("_rebuilt"))
    raw = F.col("raw_content") if "raw_content" in sessions.columns else F.lit(None).cast("string")
    j = sessions.join(rebuilt, "session_key", "left")
    return j.withColumn("content", F.coalesce(F.nullif(raw, F.lit("")), F.col("_rebuilt"), F.lit(""))) \
            .drop("_rebuilt")


def _meta_line(date_col: Column, number_col: Column, patient: Column) -> Column:
    date_s = F.coalesce(F.date_format(date_col, "yyyy-MM-dd HH:mm:ss"), F.lit("None"))
    return F.concat(F.lit("Session metadata: Date: "), date_s, F.lit(", Session number: "), _s(number_col),
                    F.lit("\nPatient: "), F.coalesce(patient, F.lit("Unknown")), F.lit("\n\n"))


def _patient(df: DataFrame) -> Column:
    if "metadata" in df.columns:
        return F.col("metadata")["patient"]
    return F.lit(None).cast("string")


def summary_prompts(content: DataFrame) -> DataFrame:
    """L2: per-session summary prompt (content from L1); error row when there is no content."""
    prompt = F.concat(F.lit(SUMMARY_ASK), _meta_line(F.col("session_date"), F.col("session_number"),
                                                     _patient(content)),
                      F.lit("TRANSCRIPT:\n"), F.col("content"))
    ok = F.length("content") > 0
    return content.select("session_key", F.when(ok, prompt).alias("prompt"),
                          F.when(~ok, "No content found in transcript").alias("error"))


def sentiment_highlights(session_sent: DataFrame, progression: DataFrame | None) -> DataFrame:
    """L3: sentiment highlight text by session."""
    s = session_sent.select("session_key", F.concat(
        F.lit("Overall sentiment: "), F.col("overall_sentiment"), F.lit("\nCompound score: "),
        _f2(F.col("avg_compound")), F.lit("\nPositive: "), _f2(F.col("avg_positive")),
        F.lit(", Negative: "), _f2(F.col("avg_negative")), F.lit(", Neutral: "),
        _f2(F.col("avg_neutral")), F.lit("\n")).alias("_s"))
    if progression is None:
        return s.withColumnRenamed("_s", "sentiment_info")
    p = progression.select("session_key", F.concat(
        F.lit("Sentiment trend: "), F.col("sentiment_trend"), F.lit("\nStart sentiment: "),
        F.coalesce(_f2(F.col("start_sentiment")), F.lit("nan")), F.lit(", End sentiment: "),
        F.coalesce(_f2(F.col("end_sentiment")), F.lit("nan")), F.lit("\nSentiment shift: "),
        _f2(F.col("sentiment_shift")), F.lit("\n")).alias("_p"))
    return s.join(p, "session_key", "left").select(
        "session_key", F.concat(F.col("_s"), F.coalesce("_p", F.lit(""))).alias("sentiment_info"))


def topic_highlights(transcript_topics: DataFrame, topic_terms: DataFrame | None) -> DataFrame:
    """L4: dominant topic, probability and top-10 terms by session."""
    t = transcript_topics.select("session_key", "dominant_topic", F.concat(
        F.lit("Dominant topic: Topic "), _s(F.col("dominant_topic")), F.lit(" (probability: "),
        _f2(F.col("dominant_topic_prob")), F.lit(")\n")).alias("_t"))
    if topic_terms is None:
        return t.select("session_key", F.col("_t").alias("topic_info"))
    tt = top_terms(topic_terms, 10).select(F.col("topic_id").alias("dominant_topic"), "terms")
    j = t.join(tt, "dominant_topic", "left")
    return j.select("session_key", F.concat(
        F.col("_t"), F.when(F.col("terms").isNotNull(),
                            F.concat(F.lit("Top terms: "), F.array_join("terms", ", "), F.lit("\n")))
        .otherwise(F.lit(""))).alias("topic_info"))


def analysis_prompts(content: DataFrame, sentiment_info: DataFrame, topic_info: DataFrame,
                     opts: EnrichOptions = EnrichOptions()) -> DataFrame:
    """Combined prompt with the whole content; error row without content.

    Content over ``content_chars`` is cut (+ '...') only if that is set. The default always sends the
    full prompt; ``compat=True`` reproduces the reference: its cut (4000 unless set) and the
    precedence slip where content of at most so many characters is sent alone.
    """
    most = opts.content_chars if opts.content_chars is not None else COMPAT_CHARS if opts.compat else None
    j = content.join(sentiment_info, "session_key", "left").join(topic_info, "session_key", "left")
    long = F.length("content") > most if most is not None else F.lit(False)
    body = F.col("content") if most is None else F.when(
        long, F.concat(F.substring("content", 1, most), F.lit("..."))).otherwise(F.col("content"))
    full = F.concat(F.lit(ANALYSIS_ASK), _meta_line(F.col("session_date"), F.col("session_number"),
                                                    _patient(j)),
                    F.lit("SENTIMENT ANALYSIS:\n"), F.coalesce("sentiment_info", F.lit(NO_SENTIMENT)),
                    F.lit("\n\nTOPIC ANALYSIS:\n"), F.coalesce("topic_info", F.lit(NO_TOPIC)),
                    F.lit("\n\nTRANSCRIPT:\n"), body)
    prompt = F.when(long, full).otherwise(F.col("content")) if opts.compat else full
    ok = F.length("content") > 0
    return j.select("session_key", F.when(ok, prompt).alias("prompt"),
                    F.when(~ok, "No content found in transcript").alias("error"))


def progress_prompts(sessions: DataFrame, utterances: DataFrame, sentiment_info: DataFrame,
                     topic_info: DataFrame, group_cols: Sequence[str] = (), compat: bool = False) -> DataFrame:
    """One progress prompt per client group (needs >= 2 sessions).

    Per session: all entries in full, plus L3/L4 text; sessions in index order; patient of the first
    session.  ``compat=True`` takes the reference's preview: the first five entries, cut to 100
    characters + '...'.
    """
    keys = list(group_cols)
    text = F.coalesce("text", F.lit(""))
    entries = utterances.where(F.col("dialogue_idx") < 5) if compat else utterances
    entries = entries.groupBy("session_key").agg(
        F.array_sort(F.collect_list(F.struct("dialogue_idx", F.concat(
            F.coalesce("speaker", F.lit("Unknown")), F.lit(": "),
            F.concat(F.substring(text, 1, 100), F.lit("...")) if compat else text).alias("l")))).alias("_l"))
    s = sessions.join(entries, "session_key", "left").join(sentiment_info, "session_key", "left") \
                .join(topic_info, "session_key", "left")
    date_s = F.coalesce(F.date_format("session_date", "yyyy-MM-dd HH:mm:ss"), F.lit("None"))
    block = F.concat(
        F.lit("SESSION "), _s(F.col("session_number")), F.lit(" ("), date_s, F.lit("):\nContent preview: " if compat else "):\nContent: "),
        F.array_join(F.transform(F.coalesce("_l", F.array()), lambda x: x["l"]), "\n"),
        F.lit("\nSentiment: "), F.coalesce("sentiment_info", F.lit(NO_SENTIMENT)),
        F.lit("\nTopics: "), F.coalesce("topic_info", F.lit(NO_TOPIC)), F.lit("\n"))
    patient = _patient(s)
    g = s.select(*keys, "transcript_idx", block.alias("block"), patient.alias("patient")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_sessions"),
        F.array_sort(F.collect_list(F.struct("transcript_idx", "block"))).alias("_b"),
        F.min_by("patient", "transcript_idx").alias("patient"))
    prompt = F.concat(F.lit("Please analyze these therapy session transcripts from "),
                      F.coalesce("patient", F.lit("the client")),
                      F.lit(" and provide insights about the client's progress across sessions:\n\n"),
                      F.lit(PROGRESS_ASK), F.lit("SESSION DATA:\n\n"),
                      F.array_join(F.transform("_b", lambda x: x["block"]), "\n\n"))
    ok = F.col("n_sessions") >= 2
    return g.select(*keys, F.when(ok, prompt).alias("prompt"),
                    F.when(~ok, "Need at least 2 transcripts to analyze progress").alias("error"))


class RateLimit:
    """Token bucket: at most ``burst`` requests at once and ``per_second`` on average (None: no limit)."""

    def __init__(self, per_second: float | None, burst: int = 1, clock=time.monotonic, sleep=time.sleep):
        self.per_second, self.burst, self.clock, self.sleep = per_second, max(burst, 1), clock, sleep
        self.tokens, self.at = float(self.burst), clock()

    def take(self) -> None:
        if not self.per_second:
            return
        now = self.clock()
        self.tokens = min(self.burst, self.tokens + (now - self.at) * self.per_second)
        self.at = now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.per_second)
            self.tokens, self.at = 1.0, self.clock()
        self.tokens -= 1


def ask(prompts: list[str], completer: Callable, opts: EnrichOptions, limit: RateLimit,
        sleep=time.sleep) -> list[tuple[str | None, str | None]]:
    """Replies and errors of one batch.  A failed batch is asked again prompt by prompt, each at most
    ``opts.retries`` more times, waiting ``opts.backoff_seconds`` doubled each time; an empty reply or a reply list of
    the wrong length is a failure."""
    takes_options = len(inspect.signature(completer).parameters) > 1

    def call(some):
        limit.take()
        replies = list(completer(some, opts) if takes_options else completer(some))
        if len(replies) != len(some):
            raise ValueError(f"{len(replies)} replies to {len(some)} prompts")
        return replies

    said = lambda r: (r, None) if isinstance(r, str) and r else (None, "Failed to get LLM response")
    try:
        replies = call(prompts)
        if all(isinstance(r, str) and r for r in replies):
            return [(r, None) for r in replies]
    except Exception:  # noqa: BLE001 -- asked again below, one by one
        replies = [None] * len(prompts)
    out = []
    for prompt, reply in zip(prompts, replies):
        result = said(reply)
        for attempt in range(opts.retries):
            if result[0] is not None:
                break
            sleep(opts.backoff_seconds * 2 ** attempt)
            try:
                result = said(call([prompt])[0])
            except Exception as e:  # noqa: BLE001 -- the last error is reported with the row
                result = (None, f"Failed to get response: {e}")
        out.append(result)
    return out


def complete(prompts: DataFrame, completer: Callable, opts: EnrichOptions = EnrichOptions(),
             model: str = "custom") -> DataFrame:
    """Add ``response, model`` (and ``error``): ``completer(prompts)`` or ``completer(prompts, opts)`` on executors.

    Equal prompts are asked once: the distinct ones (by SHA-256) are dealt over ``opts.partitions`` tasks, asked in
    batches of ``opts.batch_size`` under the rate limit (shared out over the tasks), and joined back.  The options
    (temperature, max_tokens, system_prompt, extra) go to a completer with two parameters.  Rows with an error or
    without a prompt are not asked; a prompt that fails keeps its error and a null response (L10).  The join
    reads the replies once; checkpoint the result before reading it twice, or the prompts are asked again.
    """
    if "error" not in prompts.columns:
        prompts = prompts.withColumn("error", F.lit(None).cast("string"))
    keyed = prompts.withColumn("__key", F.when(F.col("error").isNull(), F.sha2("prompt", 256)))
    n = opts.partitions or max(1, prompts.sparkSession.sparkContext.defaultParallelism)
    distinct = keyed.where(F.col("__key").isNotNull()).groupBy("__key").agg(F.first("prompt").alias("prompt")) \
        .repartition(n, "__key")
    per_task = opts.requests_per_second / n if opts.requests_per_second else None

    def run(batches):
        limit = RateLimit(per_task)
        for pdf in batches:
            said = []
            for lo in range(0, len(pdf), opts.batch_size):
                said += ask(pdf["prompt"].iloc[lo:lo + opts.batch_size].tolist(), completer, opts, limit)
            yield pd.DataFrame({"__key": pdf["__key"], "response": [r for r, _ in said], "__failed": [e for _, e in said]})

    asked = distinct.mapInPandas(run, "`__key` string, response string, `__failed` string")
    j = keyed.join(asked, "__key", "left")
    return j.select(*[F.coalesce("error", "__failed").alias(c) if c == "error" else F.col(c) for c in prompts.columns],
                    "response", F.lit(model).alias("model"))


def parse_reply(reply: Column) -> Column:
    """Section a reply on blank lines into summary / insights / themes / focus.

    One pass: every section is tagged with its class and the section after it; the lists are picked from
    the tagged array, which is made once.
    """
    secs = F.split(reply, "\n\n")
    low = lambda x: F.lower(x["s"])
    pairs = F.arrays_zip(secs.alias("s"), F.concat(F.slice(secs, 2, F.greatest(F.size(secs) - 1, F.lit(0))), F.array(
        F.lit(None).cast("string"))).alias("after"))
    summary = lambda x: low(x).contains("summary") & x["after"].isNotNull()
    tagged = F.transform(pairs, lambda x: F.struct(
        x["s"].alias("s"), F.when(summary(x), x["after"]).alias("summary"),
        F.when(summary(x), "summary")
         .when(low(x).contains("insight") | low(x).contains("pattern"), "insight")
         .when(low(x).contains("emotion") | low(x).contains("theme"), "theme")
         .when(low(x).contains("therapeutic") | low(x).contains("focus") | low(x).contains("intervention"), "focus")
         .alias("k")))

    def picked(t):
        of = lambda kind: F.transform(F.filter(t, lambda x: x["k"] == kind), lambda x: x["s"])
        last = F.coalesce(F.try_element_at(F.filter(t, lambda x: x["summary"].isNotNull()), F.lit(-1))["summary"], F.lit(""))
        return F.struct(F.when((last == "") & (F.size(of("insight")) == 0), reply).otherwise(last).alias("summary"),
                        of("insight").alias("insights"), of("theme").alias("emotional_themes"),
                        of("focus").alias("therapeutic_focus"), reply.alias("full_response"))

    # a one-element array hands the tagged sections on as a lambda variable, computed once
    return F.when(reply.isNotNull(), F.element_at(F.transform(F.array(tagged), picked), 1))


def paragraphs(reply: Column) -> Column:
    """Reply split into paragraphs."""
    return F.split(strip_py(reply), "\n\n")
