"""Report text (R24-R29): one row per session report plus one overall report per group.

A session report joins an array of line columns (optional lines are nulls and drop out), built from the session
facts.  An overall report is rows of numbered lines, whatever the number of sessions; one text of them is made only
where it is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import fixed
from ..functions.ordering import join_groups, running_sums
from ..functions.text import strip_py
from ..options import ReportOptions
from ..session import with_scalar
from . import progress as pg


def _f(fmt: str, c: Column) -> Column:
    """``'%.Nf'`` formatting through ``labels.fixed`` (half-up, stable against last-bit noise)."""
    return fixed(c, int(fmt[2:-1]))


def _numbered(arr: Column) -> Column:
    return F.transform(arr, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x))


def _date_str(c: Column, missing: str) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(missing))


def session_reports(facts: DataFrame, opts: ReportOptions = ReportOptions(),
                    enrichment: DataFrame | None = None, group_cols: Sequence[str] = ("patient_id",)) -> DataFrame:
    """Markdown text of every session report (``report_name``, ``content``).

    The columns of ``group_cols`` that the facts have say whose session it is.
    """
    f = facts
    if enrichment is not None and opts.include_enrichment:
        f = f.join(enrichment, "session_key", "left")
    has_sent = F.col("overall_sentiment").isNotNull()
    has_topic = F.col("dominant_topic").isNotNull()
    terms = F.coalesce("top_terms", F.array().cast("array<string>"))
    weights = F.coalesce("top_weights", F.array().cast("array<double>"))
    has_terms = has_topic & (F.size(terms) > 0)
    date = _date_str(F.col("session_date"), "Unknown Date")
    num = F.col("display_number").cast("string")
    total = F.col("positive_count") + F.col("neutral_count") + F.col("negative_count")

    def cat_line(name, c):
        return F.when(has_sent & (total > 0), F.concat(
            F.lit(f"  - {name}: "), F.col(c).cast("string"), F.lit(" statements ("),
            _f("%.1f", F.col(c) / total * 100), F.lit("%)")))

    prog_ok = has_sent & F.col("start_sentiment").isNotNull() & F.col("end_sentiment").isNotNull()
    term_lines = F.transform(F.arrays_zip(F.slice(terms, 1, 10), F.slice(weights, 1, 10)),
                             lambda z: F.concat(F.lit("  - "), z["0"], F.lit(" ("), _f("%.3f", z["1"]), F.lit(")")))
    sec = F.coalesce("secondary_topics", F.array())
    sec_lines = F.transform(sec, lambda t: F.concat(F.lit("  - Topic "), t["topic_id"].cast("string"),
                                                    F.lit(": "), _f("%.3f", t["prob"])))
    # The text prints the first few, the stored lists stay whole
    ins = F.slice(F.coalesce("insights", F.array().cast("array<string>")), 1, opts.highlight_count)
    recs = F.slice(F.coalesce("recommendations", F.array().cast("array<string>")), 1, opts.highlight_count)
    lines = F.flatten(F.array(
        F.array(F.concat(F.lit("# Session "), num, F.lit(" Report ("), date, F.lit(")")), F.lit(""),
                F.lit("## Session Information"), F.lit(""), F.concat(F.lit("- **Date**: "), date),
                F.concat(F.lit("- **Session Number**: "), num),
                F.concat(F.lit("- **File**: "), F.coalesce(F.col("file_name"), F.lit("None"))), F.lit(""),
                F.lit("## Summary"), F.lit("")),
        F.array(F.when(has_sent, F.concat(F.lit("This session had an overall "), F.col("tone_description"),
                                          F.lit(" tone ("), F.col("emoji"), F.lit(" "),
                                          _f("%.2f", F.col("avg_compound")), F.lit(")."))),
                F.when(has_topic, F.concat(F.lit("The main theme (Topic "), F.col("dominant_topic").cast("string"),
                                           F.lit(") was present with a strength of "),
                                           _f("%.2f", F.col("dominant_topic_prob")), F.lit("."))),
                F.when(has_terms, F.concat(F.lit("Key terms: "), F.array_join(F.slice(terms, 1, 5), ", "),
                                           F.lit("."))),
                F.lit(""), F.lit("## Emotional Tone Analysis"), F.lit("")),
        F.when(has_sent, F.array(
            F.concat(F.lit("- **Overall Emotional Tone**: "), F.initcap("overall_sentiment")),
            F.concat(F.lit("  - Compound Score: "), _f("%.3f", F.col("avg_compound"))),
            F.concat(F.lit("  - Positive Aspects: "), _f("%.3f", F.col("avg_positive"))),
            F.concat(F.lit("  - Negative Aspects: "), _f("%.3f", F.col("avg_negative"))),
            F.concat(F.lit("  - Neutral Aspects: "), _f("%.3f", F.col("avg_neutral"))), F.lit(""),
            F.when(total > 0, F.lit("- **Emotional Tone Breakdown**:")),
            cat_line("Positive", "positive_count"), cat_line("Neutral", "neutral_count"),
            cat_line("Negative", "negative_count"), F.when(total > 0, F.lit("")),
            F.when(prog_ok, F.lit("- **Session Progression**:")),
            F.when(prog_ok, F.concat(F.lit("  - Started: "), _f("%.3f", F.col("start_sentiment")))),
            F.when(prog_ok, F.concat(F.lit("  - Ended: "), _f("%.3f", F.col("end_sentiment")))),
            F.when(prog_ok, F.concat(F.lit("  - Shift: "), _f("%.3f", F.col("sentiment_shift")), F.lit(" ("),
                                     F.col("sentiment_trend"), F.lit(")"))),
            F.when(prog_ok, F.lit(""))))
         .otherwise(F.array(F.lit("No sentiment analysis data available for this session."), F.lit(""))),
        F.array(F.lit("## Theme Analysis"), F.lit("")),
        F.when(has_topic, F.flatten(F.array(
            F.array(F.concat(F.lit("- **Primary Theme**: Topic "), F.col("dominant_topic").cast("string")),
                    F.concat(F.lit("  - Strength: "), _f("%.3f", F.col("dominant_topic_prob"))), F.lit("")),
            F.when(has_terms, F.concat(F.array(F.lit("- **Key Terms**:")), term_lines, F.array(F.lit(""))))
             .otherwise(F.array().cast("array<string>")),
            F.when(F.size(sec) > 0, F.concat(F.array(F.lit("- **Secondary Themes**:")), sec_lines,
                                             F.array(F.lit("")))).otherwise(F.array().cast("array<string>")))))
         .otherwise(F.array(F.lit("No topic analysis data available for this session."), F.lit(""))),
        F.array(F.lit("## Key Insights"), F.lit("")),
        F.when(F.size(ins) > 0, _numbered(ins))
         .otherwise(F.array(F.lit("No specific insights available for this session."))),
        F.array(F.lit(""), F.lit("## Recommendations"), F.lit(""),
                F.lit("Based on the analysis, consider the following for future sessions:"), F.lit("")),
        _numbered(recs),
        F.array(F.lit(""), F.lit("---"), F.lit(""), F.lit(f"*Report generated at {opts.generated_at}*")),
        _enrichment_lines(f, opts),
    ))
    return f.select(*[c for c in group_cols if c in f.columns], "session_key",
                    F.concat(F.lit("session_"), num).alias("report_name"),
                    F.array_join(lines, "\n").alias("content"),
                    F.col("insights"), F.col("recommendations"))


def _enrichment_lines(f: DataFrame, opts: ReportOptions) -> Column:
    """Appended enrichment sections, when an enrichment table was joined."""
    none = F.array().cast("array<string>")
    if not opts.include_enrichment or "enriched_summary" not in f.columns:
        return none
    whole = lambda c: F.filter(F.coalesce(F.col(c), none), lambda x: x.isNotNull()) if c in f.columns else none

    def listed(title, col):
        items = F.transform(whole(col), lambda x: F.concat(F.lit("- "), strip_py(x)))
        return F.when(F.size(items) > 0, F.concat(F.array(F.lit(title), F.lit("")), items, F.array(F.lit("")))).otherwise(none)

    said = F.flatten(F.transform(whole("contextual_insights"), lambda x: F.array(strip_py(x), F.lit(""))))
    # Headings of the enrichment sections.
    return F.flatten(F.array(
        F.array(F.lit(""), F.lit("## LLM-Generated Insights"), F.lit("")),
        F.when(F.col("enriched_summary") != "", F.array(F.lit("### Summary"), F.lit(""), F.col("enriched_summary"), F.lit("")))
         .otherwise(none),
        listed("### Key Insights", "enriched_insights"), listed("### Emotional Themes", "enriched_themes"),
        listed("### Therapeutic Focus Areas", "enriched_focus"),
        F.when(F.size(said) > 0, F.concat(F.array(F.lit("### Contextual Analysis"), F.lit("")), said)).otherwise(none)))


def _overall_facts(facts: DataFrame, trend: DataFrame, recurrent: DataFrame | None, evolution: DataFrame | None,
                   consistent: DataFrame | None, emerging: DataFrame | None, gap: DataFrame | None,
                   topic_terms: DataFrame | None, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """One row per group with what the overall report says once, and the evolution rows with their terms."""
    tops = pg.top_terms(topic_terms, 5) if topic_terms is not None else None

    def terms_of(df, topic_col, n, alias):
        if tops is None:
            return df.withColumn(alias, F.lit(None).cast("string"))
        t = tops.select(F.col("topic_id").alias(topic_col), F.array_join(F.slice("terms", 1, n), ", ").alias(alias))
        return df.join(t, topic_col, "left")

    def attach(r, df, types):
        """Columns of ``df`` per group; nulls where it is missing or has no row."""
        if df is None:
            return r.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items()])
        df = df.select(*keys, *types)
        if keys:
            return join_groups(r, df, keys, "left")
        return with_scalar(r, df.agg(*[F.any_value(c).alias(c) for c in types]))

    r = trend
    for df, col, n, alias in ((recurrent, "recurrent_topic", 5, "recurrent_terms"),
                              (consistent, "consistent_topic", 3, "consistent_terms"),
                              (emerging, "emerging_topic", 3, "emerging_terms")):
        r = attach(r, terms_of(df, col, n, alias) if df is not None else None, {col: "int", alias: "string"})
    r = attach(r, gap, {"gap_insight": "string"})
    ev = terms_of(evolution, "topic_id", 3, "ev_terms") if evolution is not None else None
    n_ev = ev.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_ev")) if ev is not None else None
    return attach(r, n_ev, {"_n_ev": "long"}), ev


def _overall_rules(r: DataFrame) -> tuple[Column, Column]:
    insights = _some(
        F.col("direction_insight"), F.col("volatility_insight"),
        F.when(F.col("consistent_terms").isNotNull(), pg._fmt(pg.INS_THEME_CONSISTENT, topic=F.col("consistent_topic"),
                                                              terms=F.col("consistent_terms"))),
        F.col("gap_insight"))
    recs = _some(
        F.col("latest_recommendation"), F.col("stagnation_recommendation"),
        F.when(F.col("emerging_terms").isNotNull(), pg._fmt(pg.REC_EMERGING, topic=F.col("emerging_topic"),
                                                            terms=F.col("emerging_terms"))))
    return insights, F.when(F.size(recs) == 0, F.array(*[F.lit(x) for x in pg.REC_OVERALL_GENERIC])).otherwise(recs)


def _some(*cols: Column) -> Column:
    return F.filter(F.array(*cols), lambda x: x.isNotNull())


def overall_report_lines(facts: DataFrame, trend: DataFrame, recurrent: DataFrame | None,
                         evolution: DataFrame | None, consistent: DataFrame | None, emerging: DataFrame | None,
                         gap: DataFrame | None, topic_terms: DataFrame | None, group_cols: Sequence[str] = (),
                         opts: ReportOptions = ReportOptions(), enrichment: DataFrame | None = None) -> DataFrame:
    """The overall report as rows ``group_cols, line_no, line`` (from 0).

    A client's sessions stay rows: lines are numbered by distributed prefix sums, never collected.  Line breaks
    inside a line do not occur.  ``enrichment`` (``group_cols, paragraphs``) are the paragraphs of the progress reply.
    """
    keys = list(group_cols)
    r, ev = _overall_facts(facts, trend, recurrent, evolution, consistent, emerging, gap, topic_terms, keys)
    if enrichment is not None:
        e = enrichment.select(*keys, F.col("paragraphs").alias("_said"))
        r = join_groups(r, e, keys, "left") if keys else with_scalar(r, e.agg(F.any_value("_said").alias("_said")))
    else:
        r = r.withColumn("_said", F.lit(None).cast("array<string>"))
    insights, recs = _overall_rules(r)
    none = F.array().cast("array<string>")
    has_dated = F.col("dated_sessions") > 0
    n_ev = F.coalesce("_n_ev", F.lit(0))
    has_themes = ((n_ev > 0) | has_dated) if ev is not None else F.lit(False)
    period = F.when(F.col("first_date").isNotNull(), F.concat(
        F.date_format("first_date", "yyyy-MM-dd"), F.lit(" to "), F.date_format("last_date", "yyyy-MM-dd"))) \
        .otherwise(F.lit("Unknown date range"))
    lines = lambda *x: F.array(*[F.lit(v) if isinstance(v, str) else v for v in x])
    text = lambda c: F.col(c).cast("string")
    # Headings and sentences of the overall report, by section; odd sections hold rows.
    sections = [
        (0, lines("# Therapy Progress Report", "", F.concat(F.lit("**Period**: "), period),
                  F.concat(F.lit("**Sessions Analyzed**: "), text("sessions")), "", "## Executive Summary", "")),
        (2, F.when(has_dated, lines(
            F.concat(F.lit("Over the course of therapy, the emotional tone has shown "), F.col("trend_description"), F.lit(".")),
            F.concat(F.lit("Out of "), text("dated_sessions"), F.lit(" sessions, "), text("positive_sessions"),
                     F.lit(" were predominantly positive, "), text("negative_sessions"), F.lit(" were negative, and "),
                     text("neutral_sessions"), F.lit(" were neutral.")))).otherwise(none)),
        (4, F.when(F.col("recurrent_terms").isNotNull(), lines(F.concat(
            F.lit("The most recurrent theme across sessions was Topic "), text("recurrent_topic"),
            F.lit(", which includes terms like "), F.col("recurrent_terms"), F.lit(".")))).otherwise(none)),
        (6, lines("", "## Progress Tracking", "")),
        (8, F.when(has_dated, lines("### Emotional Tone Progression", "", "| Session | Date | Sentiment | Score |",
                                    "|---------|------|-----------|-------|")).otherwise(none)),
        (10, F.when(has_dated, lines("")).otherwise(none)),
        (12, F.when(has_themes, lines("### Theme Evolution", "",
                                      "The following themes have shown significant changes in prevalence over time:", ""))
         .otherwise(none)),
        (14, F.when(has_themes, F.when(n_ev > 0, lines("")).otherwise(lines(
            "No significant changes in theme prevalence were observed.", ""))).otherwise(none)),
        (16, lines("## Key Insights", "")),
        (18, F.when(F.size(insights) > 0, _numbered(insights)).otherwise(lines("No specific overall insights available."))),
        (20, lines("", "## Recommendations", "")),
        (22, _numbered(recs)),
        (24, lines("", "## Session Summaries", "")),
        (28, lines("", "---", "", f"*Report generated at {opts.generated_at}*")),
        (30, F.when(F.col("_said").isNotNull(), F.concat(lines("", "## LLM-Generated Progress Insights", ""), F.flatten(
            F.transform("_said", lambda x: F.concat(F.split(strip_py(x), "\n"), F.array(F.lit(""))))))).otherwise(none)),
    ]
    fixed_rows = r.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("s"), v.alias("l")) for n, v in sections])).alias("x")) \
        .select(*keys, F.col("x.s").alias("_sec"), F.posexplode("x.l").alias("_sub", "line")) \
        .select(*keys, "_sec", F.lit(0).cast("long").alias("_pos"), "_sub", "line")
    row = lambda sec, pos, line: (F.lit(sec).alias("_sec"), pos.cast("long").alias("_pos"), F.lit(0).alias("_sub"), line.alias("line"))
    label = F.initcap(F.coalesce("overall_sentiment", F.lit("neutral")))
    score = _f("%.2f", F.coalesce("avg_compound", F.lit(0.0)))
    table = facts.where(F.col("session_date").isNotNull()).select(*keys, *row(9, F.col("transcript_idx"), F.concat(
        F.lit("| "), text("display_number"), F.lit(" | "), F.date_format("session_date", "yyyy-MM-dd"), F.lit(" | "),
        label, F.lit(" | "), score, F.lit(" |"))))
    summaries = facts.select(*keys, "transcript_idx", F.posexplode(lines(
        F.concat(F.lit("### Session "), text("display_number"), F.lit(" ("), _date_str(F.col("session_date"), "Unknown"), F.lit(")")),
        "", F.concat(F.lit("- **Emotional Tone**: "), label, F.lit(" ("), score, F.lit(")")),
        F.concat(F.lit("- **Primary Theme**: Topic "), F.coalesce(text("dominant_topic"), F.lit("N/A"))),
        F.concat(F.lit("- **Key Insight**: "), F.coalesce(F.get(F.col("insights"), 0), F.lit("No specific insights."))),
        "")).alias("_sub", "line")).select(*keys, F.lit(25).alias("_sec"), F.col("transcript_idx").cast("long").alias("_pos"),
                                           "_sub", "line")
    fixed_rows = fixed_rows.where("line IS NOT NULL")
    out = fixed_rows.unionByName(table).unionByName(summaries)
    if ev is not None:
        out = out.unionByName(ev.select(*keys, *row(13, F.col("rank"), F.concat(
            F.lit("- **Topic "), text("topic_id"), F.lit("** ("), F.coalesce("ev_terms", F.lit("")), F.lit("): "),
            F.col("trend"), F.lit(" by "), _f("%.1f", F.abs(F.col("change")) * 100), F.lit("% (from "),
            _f("%.2f", F.col("first")), F.lit(" to "), _f("%.2f", F.col("last")), F.lit(")")))))
    numbered = running_sums(out, keys, ["_sec", "_pos", "_sub"], {"line_no": F.lit(1)})
    return numbered.select(*keys, "line_no", "line")


def overall_reports(facts: DataFrame, trend: DataFrame, recurrent: DataFrame | None,
                    evolution: DataFrame | None, consistent: DataFrame | None, emerging: DataFrame | None,
                    gap: DataFrame | None, topic_terms: DataFrame | None,
                    group_cols: Sequence[str] = (), opts: ReportOptions = ReportOptions(),
                    enrichment: DataFrame | None = None) -> DataFrame:
    """R27 as one text per group, for groups whose report fits a row: ``overall_report_lines`` put together."""
    keys = list(group_cols)
    args = (facts, trend, recurrent, evolution, consistent, emerging, gap, topic_terms)
    whole = overall_report_lines(*args, keys, opts, enrichment).groupBy(*keys).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("content"))
    r, _ = _overall_facts(*args, keys)
    insights, recs = _overall_rules(r)
    r = r.select(*keys, insights.alias("insights"), recs.alias("recommendations"))
    j = join_groups(r, whole, keys) if keys else with_scalar(r, whole)
    return j.select(*keys, F.lit(None).cast("bigint").alias("session_key"), F.lit("overall_progress").alias("report_name"),
                    "content", "insights", "recommendations")


def all_reports(session_rep: DataFrame, overall_rep: DataFrame) -> DataFrame:
    """Session reports plus the overall report(s) in one table."""
    return session_rep.unionByName(overall_rep, allowMissingColumns=True)
