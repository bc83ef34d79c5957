"""Cross-session analytics (R1-R25, D1-D6): relational roll-ups per client group.

Inputs are small per-session tables (one row per session), so every rule is
a ``groupBy(group_cols)`` aggregate with ordered ``min_by``/``max_by`` keys,
or a window partitioned by the group over sessions.  ``group_cols=[]``
reproduces the single-client behaviour; with keys each client is independent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import labels as lb
from ..functions.ordering import join_groups, rank_within, with_offsets
from ..session import with_scalar

# Rule texts of the reports.
TXT_SESSION_POSITIVE = "The session had a positive emotional tone, suggesting constructive engagement."
TXT_SESSION_NEGATIVE = ("The session had a negative emotional tone, which may indicate challenging "
                        "content or distress.")
TXT_TREND_IMPROVING = "The emotional tone improved during the session, suggesting progress or relief."
TXT_TREND_DETERIORATING = ("The emotional tone declined during the session, which may indicate "
                           "increasing distress or uncovering difficult topics.")
TXT_TREND_STABLE = "The emotional tone remained stable throughout the session."
TXT_THEMES = "The session focused on themes related to {terms}."
TXT_FOCUS_SINGLE = "The session was strongly focused on a single theme (Topic {topic})."
TXT_FOCUS_DIVERSE = ("The session covered a diverse range of themes without a strong focus on any "
                     "one topic.")
REC_NEGATIVE = "Follow up on topics that evoked negative emotions to address underlying concerns."
REC_DETERIORATING = ("Begin future sessions by checking in on the client's emotional state, as this "
                     "session ended on a more negative note.")
REC_CONTINUE = "Continue exploring themes related to {terms} in future sessions."
REC_SECONDARY = ("Consider exploring Topic {topic} in more depth as it appeared as a secondary "
                 "theme.")
REC_SESSION_GENERIC = [
    "Review the session transcript for any topics that warrant follow-up.",
    "Consider exploring the emotional context of the main themes in greater detail.",
    "Track changes in sentiment on these topics in future sessions.",
]
INS_IMPROVED = ("The overall emotional tone has improved over the course of therapy, suggesting "
                "positive progress.")
INS_DECLINED = ("The overall emotional tone has declined, which may indicate uncovering of "
                "challenging issues or increasing distress.")
INS_STABLE = "The emotional tone has remained relatively stable throughout the therapy period."
INS_VOLATILE = ("There has been high emotional volatility between sessions, suggesting significant "
                "processing of emotions.")
INS_CONSISTENT = ("Emotional tone has been very consistent between sessions, suggesting stability "
                  "or potential plateauing.")
INS_THEME_CONSISTENT = ("Theme {topic} ({terms}) has been consistently present throughout therapy, "
                        "suggesting an ongoing area of focus or concern.")
INS_CLIENT_NEGATIVE = ("The client consistently expresses more negative emotions compared to the "
                       "therapist, which may indicate ongoing distress or challenging issues.")
INS_CLIENT_POSITIVE = ("The client consistently expresses more positive emotions compared to the "
                       "therapist, suggesting either good progress or potential avoidance of "
                       "difficult topics.")
REC_LATEST_NEGATIVE = ("The most recent session had a negative emotional tone. Consider following up "
                       "on recent distressing topics.")
REC_STAGNATION = ("Recent sessions show minimal emotional variation. Consider introducing new "
                  "therapeutic approaches or exploring different areas.")
REC_EMERGING = ("Theme {topic} ({terms}) is becoming increasingly prominent. Consider dedicating "
                "more focus to this emerging area.")
REC_OVERALL_GENERIC = [
    "Continue to monitor emotional progression across sessions to identify patterns.",
    "Periodically revisit key themes to track progress and development.",
    "Consider supplementing with quantitative assessments to validate these qualitative findings.",
]


def _fmt(template: str, **cols: Column) -> Column:
    """Fill ``{name}`` slots of a fixed text with column values (as strings)."""
    parts, rest = [], template
    while "{" in rest:
        pre, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        parts += [F.lit(pre), cols[name].cast("string")]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def _nonnull(*cols: Column) -> Column:
    return F.filter(F.array(*cols), lambda x: x.isNotNull())


# ------------------------------------------------------------------ R2
def top_terms(topic_terms: DataFrame, n: int) -> DataFrame:
    """R2: (topic_id, terms array, weights array) of the first ``n`` terms by weight (ties by term)."""
    w = Window.partitionBy("topic_id").orderBy(F.col("weight").desc(), F.col("term").asc())
    r = topic_terms.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    g = r.groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("_r", "term", "weight"))).alias("_t"))
    return g.select("topic_id", F.transform("_t", lambda x: x["term"]).alias("terms"),
                    F.transform("_t", lambda x: x["weight"]).alias("weights"))


def _terms_str(terms: Column, n: int) -> Column:
    return F.array_join(F.slice(terms, 1, n), ", ")


# ---------------------------------------------------------- R1, R3-R10
def session_facts(sessions: DataFrame, session_sent: DataFrame, progression: DataFrame | None,
                  transcript_topics: DataFrame | None, topic_terms: DataFrame | None) -> DataFrame:
    """One row per session with everything the session report needs.

    ``sessions`` must carry ``session_key`` and ``transcript_idx``;
    ``transcript_topics`` holds the session-level mixture
    (``topic_distribution``, ``dominant_topic``, ``dominant_topic_prob``).
    """
    s = sessions.join(session_sent.select("session_key", "avg_compound", "avg_positive", "avg_negative",
                                          "avg_neutral", "positive_count", "neutral_count",
                                          "negative_count", "scored_count", "overall_sentiment"),
                      "session_key", "left")
    if progression is not None:
        s = s.join(progression.select("session_key", "start_sentiment", "end_sentiment",
                                      "sentiment_shift", "sentiment_trend"), "session_key", "left")
    else:
        for c, t in (("start_sentiment", "double"), ("end_sentiment", "double"),
                     ("sentiment_shift", "double"), ("sentiment_trend", "string")):
            s = s.withColumn(c, F.lit(None).cast(t))
    if transcript_topics is not None:
        s = s.join(transcript_topics.select("session_key", "topic_distribution", "dominant_topic",
                                            "dominant_topic_prob"), "session_key", "left")
    else:
        s = s.withColumn("topic_distribution", F.lit(None).cast("array<struct<topic_id:int,prob:double>>")) \
             .withColumn("dominant_topic", F.lit(None).cast("int")) \
             .withColumn("dominant_topic_prob", F.lit(None).cast("double"))
    if topic_terms is not None:
        tt = top_terms(topic_terms, 10).select(F.col("topic_id").alias("dominant_topic"),
                                               F.col("terms").alias("top_terms"),
                                               F.col("weights").alias("top_weights"))
        s = s.join(tt, "dominant_topic", "left")
    else:
        s = s.withColumn("top_terms", F.lit(None).cast("array<string>")) \
             .withColumn("top_weights", F.lit(None).cast("array<double>"))
    has_sent = F.col("overall_sentiment").isNotNull()
    total = F.col("positive_count") + F.col("neutral_count") + F.col("negative_count")

    def pct(c):
        return F.when(total > 0, F.round(F.col(c) / total * 100, 1))

    has_topic = F.col("dominant_topic").isNotNull()
    has_terms = has_topic & (F.size(F.coalesce("top_terms", F.array())) > 0)
    n_mix = F.size(F.coalesce("topic_distribution", F.array()))
    secondary = F.get(F.col("topic_distribution"), 1)["topic_id"]
    insights = _nonnull(
        F.when(has_sent & (F.col("overall_sentiment") == "positive"), TXT_SESSION_POSITIVE)
         .when(has_sent & (F.col("overall_sentiment") == "negative"), TXT_SESSION_NEGATIVE),
        F.when(has_sent & (F.col("sentiment_trend") == "improving"), TXT_TREND_IMPROVING)
         .when(has_sent & (F.col("sentiment_trend") == "deteriorating"), TXT_TREND_DETERIORATING)
         .when(has_sent & (F.col("sentiment_trend") == "stable"), TXT_TREND_STABLE),
        F.when(has_terms, _fmt(TXT_THEMES, terms=_terms_str(F.col("top_terms"), 5))),
        F.when(has_terms & (F.col("dominant_topic_prob") > 0.7),
               _fmt(TXT_FOCUS_SINGLE, topic=F.col("dominant_topic")))
         .when(has_terms & (F.col("dominant_topic_prob") < 0.3), F.lit(TXT_FOCUS_DIVERSE)),
    )
    recs = _nonnull(
        F.when(has_sent & (F.col("overall_sentiment") == "negative"), REC_NEGATIVE),
        F.when(has_sent & (F.col("sentiment_trend") == "deteriorating"), REC_DETERIORATING),
        F.when(has_terms, _fmt(REC_CONTINUE, terms=_terms_str(F.col("top_terms"), 3))),
        F.when(has_terms & (n_mix > 1), _fmt(REC_SECONDARY, topic=secondary)),
    )
    recs = F.when(F.size(recs) == 0, F.array(*[F.lit(x) for x in REC_SESSION_GENERIC])).otherwise(recs)
    return s.select(
        *s.columns,
        F.coalesce(F.nullif(F.col("session_number"), F.lit(0)).cast("bigint"),
                   F.col("transcript_idx") + 1).alias("display_number"),
        lb.tone_description(F.col("avg_compound")).alias("tone_description"),
        lb.label_emoji(F.col("overall_sentiment")).alias("emoji"),
        pct("positive_count").alias("positive_pct"), pct("neutral_count").alias("neutral_pct"),
        pct("negative_count").alias("negative_pct"),
        F.slice(F.coalesce("topic_distribution", F.array()), 2, 3).alias("secondary_topics"),
        insights.alias("insights_all"),
        insights.alias("insights"),
        recs.alias("recommendations"),
    )


# -------------------------------------------------------- R11-R13, R17-R22
def corpus_trend(facts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per group of sessions.

    ``facts`` needs session_date, transcript_idx, avg_compound, overall_sentiment.
    Sessions without sentiment count as 0 / 'neutral' (A11).
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(facts.sparkSession)
    keys = list(group_cols)
    # one narrow row per session, read by three branches below: materialise it once
    f = facts.select(*keys, "transcript_idx", "session_date",
                     F.coalesce("avg_compound", F.lit(0.0)).alias("avg_compound"),
                     F.coalesce("overall_sentiment", F.lit("neutral")).alias("overall_sentiment")) \
        .checkpoint(eager=True)
    dated = F.col("session_date").isNotNull()
    order = F.struct("session_date", "transcript_idx")
    # Orders come from block-wise ranks (no window over a whole client): for dated
    # sessions, transcript order is date order.
    ra = rank_within(f.select(*keys, "transcript_idx", "avg_compound"), keys, "transcript_idx", "_ra", "_na")
    last3 = ra.where(F.col("_ra") > F.col("_na") - 3).groupBy(*keys).agg(
        F.max("avg_compound").alias("_hi3"), F.min("avg_compound").alias("_lo3"))
    rd = rank_within(f.where(dated).select(*keys, "transcript_idx", "avg_compound"), keys,
                     "transcript_idx", "_rd", "_nd")
    rd = with_offsets(rd, keys, "_rd", ["avg_compound"], [-1])
    vol = rd.groupBy(*keys).agg(F.avg(F.abs(F.col("avg_compound") - F.col("avg_compound_m1"))).alias("_vol"))
    agg = f.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.min("session_date").alias("first_date"),
        F.max("session_date").alias("last_date"),
        F.count_if(dated).alias("dated_sessions"),
        F.min_by(F.when(dated, F.col("avg_compound")), F.when(dated, order)).alias("first_compound"),
        F.max_by(F.when(dated, F.col("avg_compound")), F.when(dated, order)).alias("last_compound"),
        F.count_if(dated & (F.col("overall_sentiment") == "positive")).alias("positive_sessions"),
        F.count_if(dated & (F.col("overall_sentiment") == "negative")).alias("negative_sessions"),
        F.count_if(dated & (F.col("overall_sentiment") == "neutral")).alias("neutral_sessions"),
        F.max_by("overall_sentiment", "transcript_idx").alias("latest_sentiment"),
    )
    if keys:
        agg = join_groups(join_groups(agg, last3, keys, "left"), vol, keys, "left")
    else:  # single client: the two one-row roll-ups are attached as literals
        agg = with_scalar(with_scalar(agg, last3), vol)
    change = F.col("last_compound") - F.col("first_compound")
    vol = F.coalesce(F.col("_vol"), F.lit(0.0))
    has = F.col("dated_sessions") > 0
    return agg.select(
        *keys, "sessions", "first_date", "last_date", "dated_sessions",
        F.when(has, change).alias("sentiment_change"),
        F.when(has, lb.change_level(change)).alias("trend_description"),
        "positive_sessions", "negative_sessions", "neutral_sessions",
        F.when(has, vol).alias("between_session_volatility"),
        F.when(has, F.when(change > 0.05, INS_IMPROVED).when(change < -0.05, INS_DECLINED)
               .otherwise(INS_STABLE)).alias("direction_insight"),
        F.when(has, F.when(vol > 0.2, INS_VOLATILE).when(vol < 0.05, INS_CONSISTENT)).alias("volatility_insight"),
        F.when((F.col("sessions") > 1) & (F.col("latest_sentiment") == "negative"),
               REC_LATEST_NEGATIVE).alias("latest_recommendation"),
        F.when((F.col("sessions") >= 3) & (F.col("_hi3") - F.col("_lo3") < 0.1),
               REC_STAGNATION).alias("stagnation_recommendation"),
    )


# ------------------------------------------------------------------ R15
def progress_table(facts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Dated sessions in date order with label and 2-decimal score."""
    keys = list(group_cols)
    d = rank_within(facts.where(F.col("session_date").isNotNull()), keys, "transcript_idx", "row_order", "_n")
    return d.select(*keys, F.col("row_order").cast("int").alias("row_order"), "display_number", "session_date",
                    F.initcap(F.coalesce("overall_sentiment", F.lit("neutral"))).alias("sentiment"),
                    lb.fixed(F.coalesce("avg_compound", F.lit(0.0)), 2).alias("score"))


# ------------------------------------------------------------ R14, R16, R19, R23
def recurrent_topic(transcript_topics: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Most frequent dominant topic over session documents (ties: lower id)."""
    keys = list(group_cols)
    c = transcript_topics.where(F.col("dominant_topic").isNotNull()) \
        .groupBy(*keys, "dominant_topic").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy(*keys).agg(
        F.max_by("dominant_topic", F.struct("n", -F.col("dominant_topic"))).alias("recurrent_topic"),
        F.max("n").alias("recurrent_count"))


def _first_last(prev: DataFrame, keys: list[str], dated_only: bool) -> DataFrame:
    p = prev.where(F.col("session_date").isNotNull()) if dated_only else prev
    # nulls last for the undated variant (R23): order key (is_null, date, idx)
    o = F.struct(F.col("session_date").isNull(), "session_date", "transcript_idx")
    return p.groupBy(*keys, "topic_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("prevalence", o).alias("first"),
        F.max_by("prevalence", o).alias("last"),
        F.avg("prevalence").alias("mean_prevalence"))


def theme_evolution(prevalence: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Topics with > 1 dated rows and |last - first| > 0.1, ordered by |change| desc."""
    keys = list(group_cols)
    fl = _first_last(prevalence, keys, True)
    ch = F.col("last") - F.col("first")
    r = fl.where((F.col("n") > 1) & (F.abs(ch) > 0.1)).select(
        *keys, "topic_id", "first", "last", ch.alias("change"),
        F.when(ch > 0, "increasing").otherwise("decreasing").alias("trend"))
    w = Window.partitionBy(*keys).orderBy(F.abs(F.col("change")).desc(), "topic_id")
    return r.withColumn("rank", F.row_number().over(w))


def consistent_topic(prevalence: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Highest mean prevalence among topics with > 1 rows (all rows; ties: lower id)."""
    keys = list(group_cols)
    fl = _first_last(prevalence, keys, False).where(F.col("n") > 1)
    return fl.groupBy(*keys).agg(
        F.max_by("topic_id", F.struct("mean_prevalence", -F.col("topic_id"))).alias("consistent_topic"),
        F.max("mean_prevalence").alias("consistent_mean"))


def emerging_topic(prevalence: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Largest last - first (> 0.1) over all rows, undated last (ties: lower id)."""
    keys = list(group_cols)
    fl = _first_last(prevalence, keys, False).where(F.col("n") > 1)
    ch = F.col("last") - F.col("first")
    inc = fl.where(ch > 0.1).select(*keys, "topic_id", ch.alias("change"))
    return inc.groupBy(*keys).agg(
        F.max_by("topic_id", F.struct("change", -F.col("topic_id"))).alias("emerging_topic"),
        F.max("change").alias("emerging_change"))


# ------------------------------------------------------------------ R20
def speaker_gap(scored: DataFrame, sessions: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Client minus therapist mean compound; 'first' speaker by first appearance.

    A speaker matches a class by case-insensitive substring; among matches the
    one that appears first (session index, then dialogue index) is used.
    """
    keys = list(group_cols)
    s = scored.where(F.col("speaker").isNotNull() & (F.col("speaker") != "")) \
        .join(sessions.select("session_key", "transcript_idx"), "session_key")
    sp = s.groupBy(*keys, "speaker").agg(
        F.avg("compound_score").alias("avg_compound"),
        F.min(F.struct("transcript_idx", "dialogue_idx")).alias("first_seen"))
    low = F.lower("speaker")
    g = sp.groupBy(*keys).agg(
        F.min_by(F.when(low.contains("client"), F.col("avg_compound")),
                 F.when(low.contains("client"), F.col("first_seen"))).alias("client_compound"),
        F.min_by(F.when(low.contains("therapist"), F.col("avg_compound")),
                 F.when(low.contains("therapist"), F.col("first_seen"))).alias("therapist_compound"))
    gap = F.col("client_compound") - F.col("therapist_compound")
    return g.select(*keys, "client_compound", "therapist_compound", gap.alias("sentiment_gap"),
                    F.when(gap < -0.2, INS_CLIENT_NEGATIVE).when(gap > 0.2, INS_CLIENT_POSITIVE)
                     .alias("gap_insight"))


# -------------------------------------------------------------- D1-D6
def moving_average(facts: DataFrame, k: int = 3, group_cols: Sequence[str] = (),
                   value: str = "avg_compound") -> DataFrame:
    """Mean of the last ``k`` dated sessions (inclusive) in date order."""
    keys = list(group_cols)
    d = rank_within(facts.where(F.col("session_date").isNotNull()).select(
        *keys, "session_key", "session_date", "transcript_idx", value), keys, "transcript_idx", "_rk", "_n")
    d = with_offsets(d, keys, "_rk", [value], [-o for o in range(k - 1, 0, -1)])
    prev = [F.col(f"{value}_m{o}") for o in range(k - 1, 0, -1)]  # oldest first, as a window sums
    total = F.lit(0.0)
    for c in prev:
        total = total + F.coalesce(c, F.lit(0.0))
    total = total + F.col(value)
    n = F.lit(1)
    for c in prev:
        n = n + F.when(c.isNotNull(), 1).otherwise(0)
    return d.select(*keys, "session_key", "session_date", value, (total / n).alias("moving_avg"))


def linear_trend(facts: DataFrame, group_cols: Sequence[str] = (), value: str = "avg_compound") -> DataFrame:
    """Least-squares slope of the value over session ordinal (transcript_idx)."""
    keys = list(group_cols)
    return facts.groupBy(*keys).agg(F.regr_slope(F.col(value), F.col("transcript_idx").cast("double"))
                                    .alias("slope"), F.count(F.lit(1)).alias("n"))


def change_flags(facts: DataFrame, threshold: float = 0.05, group_cols: Sequence[str] = (),
                 value: str = "avg_compound") -> DataFrame:
    """D3: change from the previous session (index order) and a flag when |change| > threshold."""
    keys = list(group_cols)
    r = rank_within(facts.select(*keys, "session_key", "transcript_idx", value), keys, "transcript_idx",
                    "_rk", "_n")
    r = with_offsets(r, keys, "_rk", [value], [-1])
    delta = F.col(value) - F.col(f"{value}_m1")
    return r.select(*keys, "session_key", "transcript_idx", value, delta.alias("delta")) \
        .withColumn("significant", F.abs("delta") > threshold)


def emotional_peaks(scored: DataFrame, session_keys: Sequence[str] = ("session_key",)) -> DataFrame:
    """Local maxima/minima of compound and label transitions inside a session."""
    keys = list(session_keys)
    r = rank_within(scored.select(*keys, "dialogue_idx", "compound_score", "sentiment_category"),
                    keys, "dialogue_idx", "_rk", "_n")
    r = with_offsets(r, keys, "_rk", ["compound_score", "sentiment_category"], [-1, 1])
    c = F.col("compound_score")
    prv, nxt = F.col("compound_score_m1"), F.col("compound_score_p1")
    return r.select(*keys, "dialogue_idx", "compound_score", "sentiment_category",
                    F.when((c > prv) & (c > nxt), "peak").when((c < prv) & (c < nxt), "trough")
                     .alias("extremum"),
                    (F.col("sentiment_category_m1") != F.col("sentiment_category")).alias("transition"))


def speaker_by_session(scored: DataFrame, speakers: Sequence[str] = ("Client", "Therapist"),
                       session_keys: Sequence[str] = ("session_key",)) -> DataFrame:
    """Mean compound per session for each listed speaker (pivot with a known value list)."""
    return scored.groupBy(*session_keys).pivot("speaker", list(speakers)).agg(F.avg("compound_score"))


def vocabulary_shift(processed: DataFrame, sessions: DataFrame, speaker: str = "Client",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """Per consecutive pair of sessions, log-ratio of a speaker's term frequencies (add-one)."""
    keys = list(group_cols)
    t = processed.where(F.col("speaker") == speaker).select("session_key", F.explode("tokens").alias("term"))
    tf = t.groupBy("session_key", "term").agg(F.count(F.lit(1)).alias("n"))
    tot = t.groupBy("session_key").agg(F.count(F.lit(1)).alias("total"))
    # the session after each one by rank, so no window holds a client and null clients keep theirs
    s = rank_within(sessions.select(*keys, "session_key", "transcript_idx"), keys, "transcript_idx", "_rk", "_n")
    s = with_offsets(s, keys, "_rk", ["session_key"], [1]).select(
        *keys, "session_key", F.col("session_key_p1").alias("next_key")).where(F.col("next_key").isNotNull())
    a = tf.join(tot, "session_key").select("session_key", "term", (F.col("n") / F.col("total")).alias("f"))
    cur = s.join(a, "session_key").select(*keys, "session_key", "next_key", "term", F.col("f").alias("f_prev"))
    nxt = s.join(a.withColumnRenamed("session_key", "next_key"), "next_key") \
           .select(*keys, "session_key", "next_key", "term", F.col("f").alias("f_next"))
    j = join_groups(cur, nxt, [*keys, "session_key", "next_key", "term"], "full_outer")
    return j.select(*keys, "session_key", "next_key", "term",
                    F.coalesce("f_prev", F.lit(0.0)).alias("f_prev"),
                    F.coalesce("f_next", F.lit(0.0)).alias("f_next"),
                    F.log((F.coalesce("f_next", F.lit(0.0)) + 1e-6) / (F.coalesce("f_prev", F.lit(0.0)) + 1e-6))
                     .alias("log_ratio"))


# ------------------------------------------------------------------ D10
def validate_sessions(sessions: DataFrame, utterances: DataFrame) -> DataFrame:
    """Per-session checks -- no utterances, fewer than two speakers, no date.

    The date falls back to ``metadata['date']`` when the file name has none.
    """
    u = utterances.where(F.col("text").isNotNull() & (F.length("text") > 0)).groupBy("session_key").agg(
        F.count(F.lit(1)).alias("n_utterances"),
        F.count_distinct(F.when(F.col("speaker") != "", F.col("speaker"))).alias("n_speakers"))
    meta_date = (F.try_to_date(F.col("metadata")["date"], "yyyy-MM-dd")
                 if "metadata" in sessions.columns else F.lit(None).cast("date"))
    s = sessions.join(u, "session_key", "left").select(
        *sessions.columns,
        F.coalesce("n_utterances", F.lit(0)).alias("n_utterances"),
        F.coalesce("n_speakers", F.lit(0)).alias("n_speakers"),
        F.coalesce(F.col("session_date"), meta_date).alias("resolved_date"))
    issues = F.filter(F.array(
        F.when(F.col("n_utterances") == 0, F.lit("no utterances")),
        F.when(F.col("n_speakers") < 2, F.lit("fewer than two speakers")),
        F.when(F.col("resolved_date").isNull(), F.lit("no session date"))), lambda x: x.isNotNull())
    return s.withColumn("issues", issues).withColumn("valid", F.size("issues") == 0)
